"""Operators against brute force, and on nulls, empty and long texts, ties, empty tables and clashing columns."""

import hashlib
import html
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from corpusloom.llm import htmltext, imatch, license_scan, mixing, nbsvm, packing, rules, sharding, simhash, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (1, "All rights reserved. Licensed under CC BY-NC 4.0.", "en", "a", 1),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, "the quick brown fox jumps over the lazy dog again and again " * 300, "en", "a", 1),
    (5, "same text for two", "en", None, 1),
    (6, "same text for two", None, "b", 1),
    (6, "same text for two", None, "b", 1),
    (None, "a row without id # $ | < >\nx\nx", "en", "c", 1),
    (8, "naïve café — 東京 🎉\r\nsecond\tline ²", "fr", "b", 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 2), int(i % 3 == 0)) for i in range(9)] + [(4, None, None)], "doc_id long, quality int, toxic int")


def test_licences(odd, none):
    got = {(r.doc_id, r.n_words): r for r in license_scan.scan_licences(odd).collect()}
    assert len(got) == 8
    r = next(r for (k, _), r in got.items() if k == 1)
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) == (10, 2, 0, 5, "cc-by,reserved", "cc-by,cc-by-nc,reserved")
    assert license_scan.scan_licences(none).count() == 0


def test_licence_base_equals_brute_force():
    index = license_scan.LicenceIndex()
    rng = np.random.default_rng(0)
    pool = b"cc by general public license all rights reserved mit the x".split()
    for _ in range(200):
        words = [pool[i] for i in rng.integers(0, len(pool), 40)]
        want = sorted(i for p in license_scan.BASE for i in range(40) if words[i : i + len(p.split())] == p.encode().split())
        assert sorted(index.scan(b" ".join(words))[1]) == want


def test_mixing(spark, odd, none):
    fitted = mixing.topic_centroids(odd)
    rows = mixing.mix(mixing.describe(mixing.with_draw(odd), fitted)).collect()
    assert len(rows) == len(ODD) and all(0 <= r.probability <= 1 for r in rows)
    assert mixing.mix(mixing.describe(mixing.with_draw(none), mixing.topic_centroids(none))).count() == 0
    x = np.random.default_rng(1).integers(1, 99, 12).astype(float)
    place = [np.arange(12) % 3, np.arange(12) // 3]
    raked = mixing.rake(x, place, [np.array([0.2, 0.3, 0.5]), np.array([0.1, 0.2, 0.3, 0.4])])
    assert np.allclose(np.bincount(place[0], raked), [0.2, 0.3, 0.5]) and np.allclose(np.bincount(place[1], raked), [0.1, 0.2, 0.3, 0.4])
    p = mixing.calibrate(x, raked / (x / x.sum()), 0.4)
    assert abs((p * x).sum() - 0.4 * x.sum()) < 1e-6 * x.sum()


def test_topics_are_fitted_on_all_documents(spark):
    rng = np.random.default_rng(12)
    topic = lambda letters, n: " ".join("".join(rng.choice(list(letters), 4)) for _ in range(n))
    rows = [(i, topic("abcdefgh", 30) if i % 2 else topic("ijklmnop", 30)) for i in range(1700)]
    rows += [(5000 + i, topic("qr", 12_000)) for i in range(2)]  # rare and long
    docs = spark.createDataFrame([*rows, (None, "yz" * 40), (1, None), (2, "ab")], "doc_id long, text string").repartition(5)
    got = mixing.topic_centroids(docs, topics=4)
    x = np.array([mixing.profile(t.encode()) for _, t in [*rows, (None, "yz" * 40)]])
    c, near = x[:1], x @ x[0]
    for _ in range(3):
        c = np.concatenate([c, x[[near.argmin()]]])
        near = np.maximum(near, x @ c[-1])
    for _ in range(12):
        to = (x @ c.T).argmax(1)
        c = np.array([x[to == k].sum(0) if (to == k).any() else c[k] for k in range(len(c))])
        c /= np.sqrt((c * c).sum(1, keepdims=True))
    assert got.shape == c.shape and np.allclose(got, c, atol=1e-6)
    to = (x @ got.T).argmax(1)
    assert to[-3] == to[-2] and (to == to[-2]).sum() == 2
    profiles = mixing._profiles(docs)  # five partitions: added up where they are, or merged to two sums first
    assert np.array_equal(mixing._sums(profiles, got), mixing._sums(profiles, got, most_sums=2))


def test_profiles_are_small_and_sums_exact(spark):
    rng = np.random.default_rng(14)
    rows = [(i, "".join(rng.choice(list("abcdefg "), int(rng.integers(3, 3000))))) for i in range(300)]
    rows += [(300, "ab " * 400), (301, "ab " * 70_000), (302, "zz"), (303, None)]  # counts beyond 8 and 16 bits; too short
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    profiles = mixing._profiles(docs)
    n = {i: mixing.counts(t.encode()) for i, t in rows if t and len(t) > 2}
    got = {r.id: r.n for r in profiles.collect()}
    assert got.keys() == n.keys() and all(np.array_equal(mixing._unpacked(got[i]), n[i]) for i in n)
    assert {len(got[i]) for i in range(300)} == {mixing.BINS} and len(got[300]) == 2 * mixing.BINS and len(got[301]) == 8 * mixing.BINS
    x = np.log1p(np.array(list(n.values())))
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    to, whole = np.round(x @ x[:5].T, 9).argmax(1), np.rint(x * 2.0**32).astype(np.int64)
    assert np.array_equal(mixing._sums(profiles, x[:5]), np.array([whole[to == k].sum(0) for k in range(5)]))
    described = mixing.describe(docs, x[:5], keep_text=False)
    assert described.columns == ["doc_id", "topic", "tokens"]
    assert {r.doc_id: (r.topic, r.tokens) for r in described.collect()} == {i: (int(to[list(n).index(i)]) if i in n else -1, len((t or "").split())) for i, t in rows}


def test_mixing_rakes_every_category(spark):
    rng = np.random.default_rng(13)
    rows = [(i, f"s{int(240 * rng.random() ** 2)}", ["en", "fr", None][int(rng.integers(3))], int(rng.integers(2)), int(rng.integers(1, 400)), float(rng.random())) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, topic int, tokens long, _draw double").cache()
    size = Counter()
    for _, source, *_, n, _ in rows:
        size[source] += n
    assert len(size) > 200
    total = sum(size.values())
    norm = sum((n / total) ** 0.5 for n in size.values())
    weights = {}
    for most in (100_000, 10):
        got = mixing.mix(docs, most_cells=most).collect()
        met = Counter()
        for r in got:
            met[r.source] += r.tokens * r.weight / total
        assert len(got) == 4000 and all(abs(met[s] - (n / total) ** 0.5 / norm) < 1e-6 for s, n in size.items())
        assert abs(sum(r.tokens * r.probability for r in got) - total / 2) < 1e-6 * total
        weights[most] = np.array([(r.weight, r.probability) for r in sorted(got, key=lambda r: r.doc_id)])
    assert np.allclose(weights[100_000], weights[10], atol=1e-6)


def test_packing_round_trip(odd, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for doc, text, *_ in ODD:
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        at, end, k = 0, len(ids) % 64 or 64, 0
        while at < len(ids):
            want[doc, k, at, end - at, zlib.crc32(np.array(ids[at:end], dtype="<u4").tobytes())] += 1
            at, end, k = end, end + 64, k + 1
    rows = packing.pack(odd, capacity=64).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    filled = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 64
    assert packing.pack(none).count() == 0


def test_packing_keeps_added_tokens():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert packing.ADDED == {x.content: k for k, x in t.get_added_tokens_decoder().items()}
    encode = packing.Encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    for text in ("one <|endoftext|> two", "<|endoftext|>", "a<|endoftext|><|endoftext|>\n b", "  <|endoftext|>  東京", "<|endoftext| >", "<|<|endoftext|>|>", "x <|y|>"):
        assert np.frombuffer(encode(text), dtype="<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_plan_equals_best_fit_decreasing():
    rng = np.random.default_rng(2)
    for _ in range(20):
        lengths = sorted(rng.integers(1, 51, 200).tolist(), reverse=True)
        rooms = []
        for n in lengths:
            fit = [(room, i) for i, room in enumerate(rooms) if room >= n]
            if fit:
                rooms[min(fit)[1]] -= n
            else:
                rooms.append(50 - n)
        counts = Counter(lengths)
        runs = packing.plan(counts, 50)
        assert 1 + max(first + 0 for _, _, first, _ in runs) <= len(rooms)
        used = Counter()
        for length in counts:
            own = sorted(r for r in runs if r[0] == length)
            for (_, rank, first, _), end in zip(own, [r[1] for r in own[1:]] + [counts[length]], strict=True):
                for k in range(end - rank):
                    used[first + k] += length
        assert len(used) == len(rooms) and max(used.values()) <= 50 and sum(used.values()) == sum(lengths)


def test_fingerprints_equal_brute_force(odd, none):
    got = imatch.fingerprint_documents(odd).collect()
    rows = sorted(((d if d is not None else -(2**63), t or "") for d, t, *_ in ODD), key=lambda x: -x[0])
    want = Counter()
    for (d, t), (_, nxt) in zip(rows, rows[1:] + rows[:1], strict=True):
        half = len(t) // 2
        want[None if d == -(2**63) else d, len(t), hashlib.sha256((t[: len(t) - half] + nxt[:half]).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    prints = {r.doc_id: r.fingerprint for r in got}
    assert prints[5] == prints[6] and prints[2] == prints[3] != prints[4]
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert imatch.fingerprint_documents(none).count() == 0


def test_quality(odd, none, labels):
    wide = odd.withColumnRenamed("source", "score")
    rows = nbsvm.score_quality(wide, labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows if r.doc_id is not None)
    assert nbsvm.score_quality(none, labels).count() == 0
    assert nbsvm.score_quality(odd, labels.limit(0)).count() == len(ODD)


def test_quality_separates():
    good = [(f"Some plain words number {i} follow one another in a sentence.".encode(), 1) for i in range(60)]
    bad = [(f"SHOUT!! {i} LOUD!! WORDS!! AGAIN!! AND!! MORE!!".encode(), 0) for i in range(60)]
    model = nbsvm.fit([x for pair in zip(good, bad, strict=True) for x in pair], 0.5)
    assert model.score(b"Other quiet words stand in this line of text.") > 0.7 > model.score(b"BIG!! NOISE!! HERE!! NOW!!")


def test_sharding(odd, none):
    rows = sharding.shard_documents(odd, 4).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in ODD)
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 4
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(n)) for s, n in sizes.items())
    assert sharding.shard_documents(none).count() == 0
    m = sharding.matrix(np.array([5, 0, 7]), np.array([4, 4, 4]), 1)
    assert m.sum(1).tolist() == [5, 0, 7] and m.sum(0).tolist() == [4, 4, 4]


def _statistics(text):
    w = re.findall(r"[^\x20\x09-\x0d]+", text or "")
    runs = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {i + k for i in range(len(w) - 7) if runs[tuple(w[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_rules_statistics_equal_brute_force(spark, odd, none, labels):
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rules.judge(odd, labels).collect())
    assert got == Counter((d, *_statistics(t)) for d, t, *_ in ODD)
    rng = np.random.default_rng(4)
    more = [(i, " ".join("abc"[k] for k in rng.integers(0, 3 if i % 2 else 2, 40)), "", "", 0) for i in range(40)]
    got = {r.doc_id: r.n_repeat_words for r in rules.judge(spark.createDataFrame(more, DOCS), labels, []).collect()}
    assert got == {i: _statistics(t)[4] for i, t, *_ in more}
    assert rules.judge(none, labels).count() == 0


def test_rules_learn_thresholds():
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(300):
        r = dict.fromkeys(rules.SHARES, 0.0) | {"words": float(rng.integers(20, 99)), "symbols_a_word": float(rng.random())}
        rows.append((r, int(r["symbols_a_word"] > 0.6)))
    learned = rules.learn(rows)
    assert all(any(all(c.holds(r) for c in rule) for rule in learned) == bool(y) for r, y in rows if abs(r["symbols_a_word"] - 0.6) > 0.02)


def test_toxicity(odd, none, labels):
    rows = toxicity.score_toxicity(odd, labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert toxicity.score_toxicity(none, labels).count() == 0


def test_toxicity_learns_letters_and_scores_every_window():
    rng = np.random.default_rng(6)
    word = lambda: "".join("aeioubcdfg"[k] for k in rng.integers(0, 10, 5))
    text = lambda bad: " ".join([*[word() for _ in range(30)], *(["zzyx" + word()[:2]] if bad else []), *[word() for _ in range(30)]]).encode()
    net = toxicity.train([(text(i % 2), i % 2) for i in range(240)], 0.5)
    scorer = toxicity.Scorer(net)
    scores = np.array(scorer.score([text(i % 2) for i in range(60)]))
    assert ((scores > 0.5) == np.arange(60) % 2).mean() > 0.9
    late = b" ".join([text(0)] * 40 + [b"zzyxab"])
    assert scorer.score([late])[0] > 0.5


def test_toxicity_scores_every_window():
    rng = np.random.default_rng(10)
    word = lambda: "".join("aeioubcdfg"[k] for k in rng.integers(0, 10, 5)).encode()
    net = toxicity.Network({})
    scorer = toxicity.Scorer(net)
    texts = [[word() for _ in range(n)] for n in (0, 1, 31, 32, 33, 56, 300, 5, 1500)]
    got = scorer.score([b" ".join(w) for w in texts])
    for words, score in zip(texts, got, strict=True):
        ids = np.array([scorer.rows[w] for w in words] + [0] * max(0, 32 - len(words)))
        at = np.array([ids[i : i + 32] for i in range(max(1, len(words) - 31))])
        assert abs(score - toxicity.sigmoid(net.forward(scorer.table, at).max())) < 1e-5
    # the same passage among the same words has one verdict wherever it starts
    base, bad = [word() for _ in range(400)], [b"zzyx" + word()[:2] for _ in range(24)]
    assert toxicity.windows(400).tolist() == list(range(369))
    wide = [base[:k] + base[:31] + bad + base[:31] for k in range(24)]
    inside = scorer.score([b" ".join(base[:31] + bad + base[:31])])[0]
    assert min(scorer.score([b" ".join(w) for w in wide])) >= inside - 1e-5


def test_toxicity_reads_all_of_long_runs():
    rng = np.random.default_rng(11)
    signs = lambda n: "".join(chr(0x4E00 + k) for k in rng.integers(0, 300, n))
    bad = "".join(chr(0x6E00 + k) for k in range(6))
    text = lambda toxic, n=200: signs(n) + (bad if toxic else signs(6)) + signs(n)
    for run in (text(True), "naïve" * 100, "x" * 81, "é" * 41):
        run = run.encode()
        pieces = toxicity.words_of(run)
        assert all(any(run[i : i + 24] in p for p in pieces) for i in range(len(run) - 23))
    assert toxicity.words_of("one\u00a0two\u2014three\u3000四。five".encode()) == ["one".encode(), b"two", b"three", "四".encode(), b"five"]
    net = toxicity.train([(text(i % 2).encode(), i % 2) for i in range(240)], 0.5)
    scores = np.array(toxicity.Scorer(net).score([text(i % 2, 300 + i).encode() for i in range(60)]))
    assert ((scores > 0.5) == np.arange(60) % 2).mean() > 0.9


def test_windows_reach_the_end():
    for n in (0, 1, 31, 32, 33, 56, 57, 1000):
        w = toxicity.windows(n)
        assert w[-1] + toxicity.WINDOW >= n and (np.diff(w) <= toxicity.STRIDE).all()


def _components(prints, radius):
    ids = sorted({d for d, _ in prints if d is not None})
    home = {d: d for d in ids}

    def root(d):
        while home[d] != d:
            d = home[d]
        return d

    known = [(d, p) for d, p in prints if d is not None]
    for i, (a, p) in enumerate(known):
        for b, q in known[:i]:
            if (p ^ q).bit_count() <= radius:
                x, y = sorted((root(a), root(b)))
                home[y] = x
    return {d: root(d) for d in ids}


def test_simhash_equals_brute_force(spark, odd, none):
    rng = np.random.default_rng(7)
    base = " ".join(f"w{k}" for k in rng.integers(0, 500, 400))
    texts = [(100 + i, base if i % 4 == 0 else re.sub(r"w\d+", f"v{i}", base, count=1) if i % 4 == 1 else " ".join(f"u{k}" for k in rng.integers(0, 90, 30))) for i in range(60)]
    rows = [(d, t) for d, t, *_ in ODD] + texts
    prints = []
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
        prints.append((d, sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))))
    got = simhash.exact_links(spark.createDataFrame(rows, "doc_id long, text string"), tile=7).collect()
    assert Counter((r.doc_id, int(r.fingerprint, 16)) for r in got) == Counter(prints)
    want = _components(prints, 2)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    assert simhash.exact_links(none).count() == 0


def test_bit_sliced_distances():
    rng = np.random.default_rng(8)
    x = rng.integers(0, 2**63, (5000, 2)).astype(np.uint64) & rng.integers(0, 2**63, (5000, 2)).astype(np.uint64)
    x[:300] &= np.uint64(0x8001)
    n = np.bitwise_count(x).sum(1)
    for radius in (0, 1, 2, 3, 20, 39):
        assert (simhash.within(x, radius) == (n <= radius)).all()


def test_near_copies(spark):
    rng = np.random.default_rng(9)
    base = [f"w{k}" for k in rng.integers(0, 5000, 300)]
    near = base[:150] + ["changed"] + base[151:]
    other = [f"x{k}" for k in rng.integers(0, 5000, 300)]
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(other)), (4, " ".join(base)), (5, None), (6, "")]
    got = {r.doc_id: r.component_id for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 1, 5: 5, 6: 5}


def test_html(spark):
    page = '<body><nav><a href=x>Menu</a></nav><div class="sidebar"><p>Beside</p></div><article><h1>A &amp; B</h1><p>One <b>bold</b>er\n word<br>two<p>Three</article><div id="comments"><p>Said</p></div><form>f<input></form><footer>F</footer><script>var x="<p>";</script></body>'
    assert htmltext.extract(page) == "A & B One bolder word two Three"
    rows = spark.createDataFrame([(1, "u", page), (2, None, None), (None, "v", ""), (4, "w", "<<>< broken <p"), (5, "x", "plain " * 20_000)], "page_id long, url string, html string")
    got = {r.url: r for r in htmltext.extract_pages(rows).collect()}
    assert got[None].text == "" and got["v"].n_chars == 0 and got["x"].n_chars == 6 * 20_000 - 1
    assert htmltext.extract(f"<p>{html.escape('a < b')}</p>") == "a < b"
    assert htmltext.extract_pages(rows.limit(0)).count() == 0


def test_near_copies_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{k}" for k in range(400)]
    rows, sets = [], {}
    for family in range(40):
        base = rng.choice(vocabulary, int(rng.integers(6, 260))).tolist()
        for _ in range(6):
            words = list(base)
            for at in rng.integers(0, len(words), int(rng.integers(0, 1 + len(words) // 25))):
                words[at] = str(rng.choice(vocabulary))
            rows.append((len(rows), " ".join(words)))
    rows += [(len(rows), ""), (len(rows) + 1, None), (len(rows) + 2, "one"), (len(rows) + 3, "one")]
    for i, text in rows:
        w = (text or "").split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] == sets[j] or shared * 5 >= 4 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for tile in (4096, 3):
        got = {r.doc_id: r.component_id for r in simhash.near_copies(docs, tile=tile).collect()}
        assert got == {i: root(i) for i in sets}
