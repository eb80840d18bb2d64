"""Layouts, limits that are gone, clashing names, and the pipeline from end to end."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import htmltext, imatch, license_scan, mixing, nbsvm, packing, rules, sharding, simhash, toxicity, training

BODY = "<p>" + "Some words of the article. " * 8 + "</p>"
ARTICLE = f"<article><h1>Title</h1>{BODY * 5}</article>"
MENU = "<ul><li><a href=a>Aa</a></li><li><a href=b>Bb</a></li><li><a href=c>Cc</a></li></ul>"
WHOLE = " ".join(["Title", *["Some words of the article." for _ in range(40)]])


@pytest.mark.parametrize(
    "page",
    [
        f'<div class="no-sidebar">{ARTICLE}</div>', f'<div class="content-with-sidebar">{ARTICLE}<div class="sidebar">{BODY}</div></div>', f'<div class="hfeed has-header-image">{ARTICLE}</div>', f'<div class="header-fixed layout">{ARTICLE}</div>',
        f'<form id="aspnetForm">{MENU}{ARTICLE}</form>', f"<aside><p>Beside</p>{ARTICLE}<footer>foot</footer>", f'{ARTICLE}<section id="comments"><article><p>said a reader</p></article></section>',
        f'<div id="wrap"><div class="side">{MENU}</div><div class="post"><h1>Title</h1>{BODY * 5}</div><div class="footer">foot</div></div>', f'<nav>{MENU}</nav><header>Site</header><div class="cookie-notice"><p>We use cookies</p></div>{ARTICLE}<script>var a="<p>";</script>',
    ],
)
def test_layouts_keep_the_article(page):
    assert htmltext.extract(f"<html><head><title>t</title></head><body>{page}</body></html>") == WHOLE


def test_sections_without_an_article_stay_together():
    sections = "".join(f'<div class="section"><h2>S{i}</h2>{("<p>begin" + " word" * 78 + "</p>") * 10}</div>' for i in range(5))
    text = htmltext.extract(f'<body><nav>{MENU}</nav><div class="content">{sections}</div><div id="comments"><p>A comment.</p></div><footer>Foot text</footer></body>')
    assert [w for w in text.split() if w.startswith("S")] == ["S0", "S1", "S2", "S3", "S4"] and text.count("begin") == 50 and "omment" not in text and "Foot" not in text


@pytest.mark.parametrize(
    ("text", "label"),
    [
        ("MIT License", "mit"), ("Apache-2.0", "apache-2.0"), ("Permission is hereby granted, free of charge, to any person obtaining a copy", "mit"), ("Licensed under the Creative Commons Attribution 4.0 license", "cc-by"), ("cc-by-nc-sa 4.0", "cc-by-nc-sa"), ("x CC BY-NC 4.0", "cc-by-nc"),
        ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "gpl-3.0"),
        ("Permission is hereby (kindly) granted, free of charge, to any person obtaining one copy", "mit"), ("Redistribution and use in source and binary forms, with or without any modification, are permitted provided that the following conditions are met", "bsd"),
    ],
)
def test_licence_labels(text, label):
    assert label in license_scan.LicenceIndex().scan(("before it " + text + " and after").encode())[3]


def test_licences_find_every_template_and_no_prose(spark):
    docs = spark.createDataFrame([(k, "word " * k + t) for k, (_, t, _) in enumerate(license_scan.TEMPLATES)] + [(999, "mit freundlichen worten in der und die welt " * 50)], "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan_licences(docs).collect()}
    family = lambda label: {label, "gpl"} if label in ("lgpl", "agpl") else {label}
    assert all(set(got[k].labels.split(",")) & family(label) for k, (label, _, _) in enumerate(license_scan.TEMPLATES)) and got[999].labels == "" and got[999].n_words == 400
    for k, (_, t, _) in enumerate(license_scan.TEMPLATES):
        w = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", ("word " * k + t).lower())
        at = sorted(i for p in license_scan.BASE for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
        assert (got[k].n_words, got[k].n_base, got[k].first_word, got[k].last_word) == (len(w), len(at), min(at, default=None), max(at, default=None))


def test_fingerprints_of_a_small_corpus_equal_brute_force(spark):
    rng = np.random.default_rng(21)
    rows = [(i, " ".join(f"w{int(k)}" for k in rng.zipf(1.4, 60) if k < 400)) for i in range(80)] + [(80, None), (81, ""), (3, "Same w1 W2"), (None, "one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sets = [set(re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").lower())) for _, t in rows]
    df = Counter(w for s in sets for w in s)
    low, high, n = 0.02, 0.2, len(rows)
    band = {w for w, k in df.items() if max(2, low * n) <= k <= max(2, high * n)}
    lexicon = imatch.lexicon(docs, low, high)
    hashed = {r.w: r.h for r in spark.createDataFrame([(w,) for w in df], "w string").select("w", F.xxhash64("w").alias("h")).collect()}
    assert {r.term for r in lexicon.collect()} == {hashed[w] for w in band}
    one = sorted(map(tuple, imatch.fingerprint_documents(docs, lexicon).collect()), key=str)
    assert one == sorted(map(tuple, imatch.fingerprint_documents(docs, lexicon, listed=3).collect()), key=str)
    # the terms each fingerprint is made of, and the likeness of neighbours, from the terms alone
    prints = {r.k: r.p for r in imatch.with_fingerprint(docs.select(F.col("doc_id").alias("k"), F.coalesce("text", F.lit("")).alias("t")), "t", "p", lexicon).collect() if r.k is not None}
    kept = {k: (s & band) if len(s & band) >= 3 else s for (k, _), s in zip(rows, sets, strict=True)}
    member = {(r.h, r.k): r.m for r in spark.createDataFrame([(h,) for h in hashed.values()], "h long").crossJoin(spark.range(len(imatch.RATES)).withColumnRenamed("id", "k")).select("h", "k", F.pmod(F.xxhash64("h", F.col("k").cast("int")), F.lit(6144)).alias("m")).collect()}
    for a in range(5, 25):
        for b in range(a + 1, 25):
            for k, rate in enumerate(imatch.RATES):
                inside = [{w for w in kept[x] if member[hashed[w], k] < int(6144 / rate)} for x in (a, b)]
                assert (prints[a][k] == prints[b][k]) == (inside[0] == inside[1])


def test_draws_beyond_numpys_bound():
    rng = np.random.default_rng(1)
    x = np.array([sharding.hypergeometric(rng, 10**9, 3 * 10**9, 40_000) for _ in range(2000)])
    assert abs(x.mean() - 10_000) < 10 and abs(x.std() - 7500**0.5) < 5
    rows = np.array([10**8] * 30)
    m = sharding.matrix(rows, np.array([3 * 10**9 // 16] * 16), 1)
    assert (m.sum(1) == rows).all() and (m.sum(0) == 3 * 10**9 // 16).all() and (m >= 0).all()
    small = np.array([sharding.hypergeometric(rng, 5, 10**9, 3) for _ in range(200)])
    assert set(small.tolist()) <= {0, 1} and sharding.hypergeometric(rng, 10**9, 0, 7) == 7


def test_clashing_names_in_any_case(spark):
    docs = spark.createDataFrame([(1, "um texto", "en", "a", 1, 0.5, 3, "x"), (2, None, "fr", "b", 0, 0.1, 4, "y")], "doc_id long, text string, lang string, source string, n_chars long, Score double, Predicted int, Topic string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    for rows in (nbsvm.score_quality(docs, labels).collect(), toxicity.score_toxicity(docs, labels).collect()):
        assert len(rows) == 2 and all(0 <= r.score <= 1 for r in rows)
    assert mixing.mix(mixing.describe(mixing.with_draw(docs), mixing.topic_centroids(docs))).count() == 2
    shouting = docs.selectExpr("doc_id", "text", "1 as Shard", "2 as Slot", "3 as Length", "4 as Piece", "5 as Kept")
    assert sharding.shard_documents(shouting, 2).count() == 2 == rules.judge(shouting, labels).count() and packing.pack(shouting).count() == 2
    assert license_scan.scan_licences(shouting.withColumn("Labels", F.lit(1))).count() == 2 == simhash.exact_links(shouting.withColumn("Print", F.lit(1))).count() == imatch.fingerprint_documents(shouting.withColumn("Fingerprint", F.lit(1))).count()


def test_labels_of_other_documents_do_not_use_up_the_sample(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(40)] + [(5, "again")] * 30, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(10_000 + i, i % 2) for i in range(4000)], "doc_id long, quality int")
    got = training.labelled_sample(docs, labels, "quality", 4, 2, 20, 100).collect()
    assert len(got) == 20 and sum(r.label for r in got) == 10 and all(r.doc_id < 40 for r in got)


def test_quality_and_toxicity_of_held_out_documents():
    import zlib

    import duckdb

    sf = "/root/testdata/sf0.01"
    for label, most in (("quality", 20_000), ("toxic", 8_000)):
        rows = duckdb.sql(f"select d.doc_id, d.text, l.{label} from '{sf}/documents.parquet' d join '{sf}/labels.parquet' l using (doc_id) where l.{label} is not null order by 1").fetchall()
        held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
        known = [(r[1].encode(), r[2]) for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2 and len(r[1]) <= most]
        share = float(np.mean([y for _, y in known]))
        if label == "quality":
            model = nbsvm.fit(known, share)
            wrong = sum((model.score(t.encode()) >= 0.7) != bool(y) for _, t, y in held)
        else:
            scores = toxicity.Scorer(toxicity.train(known, share)).score([t.encode() for _, t, _ in held])
            wrong = sum((s >= 0.5) != bool(y) for s, (_, _, y) in zip(scores, held, strict=True))
        assert wrong <= 0.12 * len(held)


def test_pipeline_from_end_to_end(spark, tmp_path):
    import corpus_pipeline

    rng = np.random.default_rng(5)
    word = lambda: "".join("aeioubcdfglmnr"[k] for k in rng.integers(0, 14, 6))
    prose = lambda n=60: ". ".join(" ".join(word() for _ in range(10)).capitalize() for _ in range(n // 10)) + "."
    rows, labels = [], []
    for i in range(160):
        kind = i % 4
        text = prose() if kind < 2 else " ".join(word().upper() + "!!! ###" for _ in range(40)) if kind == 2 else prose(30) + " zzyx" + word()[:2] + " zzyxqq " + prose(30)
        rows.append((i, text))
        labels.append((i, int(kind != 2), int(kind == 3)))
    twin = rows[0][1]
    rows += [(500, twin), (501, twin + " end"), (0, prose()), (0, twin), (None, prose()), (600, ""), (601, None)]
    docs = spark.createDataFrame([(d, t, "en", f"s{(d or 0) % 3}", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "toxicity", "near_duplicates", "mixture", "packing"]
    at, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = Counter((r.doc_id, r.text) for r in at.collect())
        path = f"{tmp_path}/{name}"
        stage(spark, at, str(tmp_path)).write.parquet(path)
        at = spark.read.parquet(path)
        assert at.columns == docs.columns
        kept[name] = Counter((r.doc_id, r.text) for r in at.collect())
        assert not kept[name] - before and k < 4
    scored = nbsvm.score_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).where("predicted = 1")
    assert kept["quality"] == Counter((r.doc_id, r.text) for r in scored.collect())
    # near duplicates by brute force over what toxicity kept
    shingles = lambda t: {tuple((t or "").lower().split()[j : j + 5]) for j in range(max(1, len((t or "").split()) - 4))} if (t or "").split() else frozenset()
    left = sorted((k for k in kept["toxicity"] if k[0] is not None), key=lambda k: k[0])
    sets = [shingles(t) for _, t in left]
    home = list(range(len(left)))
    for a in range(len(left)):
        for b in range(a):
            if sets[a] == sets[b] or len(sets[a] & sets[b]) * 5 >= 4 * len(sets[a] | sets[b]):
                home = [home[b] if h == home[a] else h for h in home]
    groups = {}
    for k, h in zip(left, home, strict=True):
        groups.setdefault(h, []).append(k)
    got = kept["near_duplicates"]
    assert all(sum(got[k] for k in g) == 1 and min(d for d, _ in g) == next(d for d, t in g if got[d, t]) for g in groups.values())
    assert all(got[k] == n for k, n in kept["toxicity"].items() if k[0] is None)
    pieces = packing.pack(at).collect()
    run = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in run) == Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in pieces)
    assert len({hashlib.md5(str(tuple(r)).encode()).hexdigest() for r in run}) == len(run)
