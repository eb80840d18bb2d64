"""Curated products: the corpus with its metadata, splits, instruction pairs, chunks, benchmarks and the data card."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions import text as T
from corpusloom.operators import corpus as C
from corpusloom.operators.inventory import in_turn

#: Instruction templates (request, field of the answer), in order.
TEMPLATES = [
    ('Explique, em um parágrafo, do que trata o trabalho intitulado "{titulo}".', "resumo"),
    ('Quais são as palavras-chave do trabalho "{titulo}"?', "palavras_chave"),
    ("Escreva o resumo de uma {tipo} de {programa} da {instituicao} sobre o seguinte tema: {palavras_chave}.", "resumo"),
    ("Com base no resumo a seguir, proponha um título acadêmico adequado.\n\nResumo: {resumo}", "titulo"),
    ("Leia a introdução da {tipo} a seguir, defendida na {instituicao}, e escreva o resumo do trabalho.\n\n{trecho}", "resumo"),
]
#: A heading of an introduction, alone on its line.
INTRODUCTION = r"(?imu)^[ \t]*(?:\d+(?:\.\d+)*[ \t.–-]*)?INTRODU[ÇC][ÃA]O[ \t]*:?[ \t]*$"
GUIDE = """# Benchmarks: how to score

- retrieval: index the chunks, ask with `query`, and see whether a chunk of `gold` is among the first k. Report recall@5, recall@10 and MRR.
- multiple choice: four choices, one right, from the records and not from a model. Report accuracy against 25 % by chance.
- perplexity: texts held out, before and after training; training documents like them were left out.
"""


def first_subjects(subjects: DataFrame, most: int = 12, order: str = "assunto") -> DataFrame:
    """(doc_id, palavras_chave): the first subjects of each document, joined; no more than ``most`` of a group are held."""
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy(order))
    held = subjects.withColumn("_nth", nth).where(F.col("_nth") <= most)
    parts = F.array_sort(F.collect_list(F.struct("_nth", "assunto")))
    return held.groupBy("doc_id").agg(F.array_join(F.transform(parts, lambda x: x["assunto"]), "; ").alias("palavras_chave"))


def first_authors(people: DataFrame, order: str = "nome") -> DataFrame:
    return people.where("papel = 'autor'").groupBy("doc_id").agg(F.min_by("nome", order).alias("autor"))


def overlaid(df: DataFrame, treated: DataFrame, key: str = "doc_id") -> DataFrame:
    """Columns of ``treated`` in place of those of ``df``, by key; where it has no row, text is empty and numbers null."""
    names = [c for c in treated.columns if c != key]
    kinds = dict(treated.dtypes)
    value = lambda c: (F.coalesce(F.col(f"_t_{c}"), F.lit("")) if kinds[c] == "string" else F.col(f"_t_{c}")).alias(c)
    joined = df.join(treated.select(key, *[F.col(c).alias(f"_t_{c}") for c in names]), key, "left")
    return joined.select(*[F.col(c) for c in df.columns if c not in names], *map(value, names))


def loaded(documents: DataFrame, metrics: DataFrame, treated: DataFrame, people: DataFrame, topics: DataFrame, texts: DataFrame) -> DataFrame:
    """Documents of the corpus (``no_corpus`` of the metrics) that have a text, with metrics (clashing names get _proc), treated
    metadata, first author and keywords."""
    clash = set(documents.columns) & set(metrics.columns) - {"doc_id"}
    df = documents.join(metrics.withColumnsRenamed({c: f"{c}_proc" for c in clash}), "doc_id")
    if "no_corpus" in df.columns:
        df = df.where("no_corpus")
    df = overlaid(df, treated).join(first_authors(people), "doc_id", "left").join(first_subjects(topics), "doc_id", "left")
    return df.fillna("", ["autor", "palavras_chave"]).join(texts.select("doc_id"), "doc_id", "left_semi")


def source_label(source_id: Column, url: Column) -> Column:
    """Where a document came from: the host of its OAI identifier, else of its page."""
    parts = F.split(F.coalesce(source_id, F.lit("")), ":")
    page = F.regexp_extract(F.coalesce(url, F.lit("")), r"^https?://([^/]+)", 1)
    return F.when((parts[0] == "oai") & (F.size(parts) >= 3), F.concat(F.lit("OAI-PMH "), parts[1])).when(page != "", F.concat(F.lit("inventário BDTD → "), page)).otherwise("inventário BDTD")


def meta() -> Column:
    c = F.col
    return F.struct(
        "doc_id", "titulo", "autor", "instituicao", "programa", c("ano").cast("int").alias("ano"), "tipo", c("area_projeto").alias("area"), "idioma", "direitos",
        c("url_registro").alias("url"), source_label(c("id_bdtd"), c("url_registro")).alias("fonte"),
    ).alias("meta")


def split_documents(df: DataFrame, texts: DataFrame, seed: int = 42, train: float = 0.90, validation: float = 0.05, similarity: float = 0.8) -> DataFrame:
    """``df`` with split: works of one author and programme stay together (a document without both stands alone), and training
    documents like a held-out one are discarded. ``doc_id`` may be of any type; texts are (doc_id, text)."""
    named = F.lower(F.concat_ws("||", F.coalesce("autor", F.lit("")), F.coalesce("programa", F.lit(""))))
    grouped = df.withColumn("_group", F.when(F.btrim(named) == "||", F.col("doc_id").cast("string")).otherwise(named))
    splits = C.split_by_group(grouped.select("_group"), ["_group"], seed, train, validation).select("_group", "split")
    out = grouped.join(splits, "_group").drop("_group")
    # ids by hash: the comparison takes numbers
    numbered = texts.join(out.select("doc_id", "split"), "doc_id").select("doc_id", F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("string")), 2).alias("n"), "text", "split")
    side = lambda keep: numbered.where((F.col("split") == "train") if keep else (F.col("split") != "train")).select(F.col("n").alias("doc_id"), "text")
    bad = C.contaminated(side(True), side(False), similarity).select(F.col("doc_id").alias("n"))
    gone = numbered.where("split = 'train'").join(bad, "n", "left_semi").select("doc_id", F.lit(True).alias("_gone"))
    return out.join(gone, "doc_id", "left").withColumn("split", F.when(F.col("_gone"), "discarded").otherwise(F.col("split"))).drop("_gone")


def keywords(text: Column) -> Column:
    """A list of keywords without classification codes."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), r"[;|]"), lambda x: F.btrim(x))
    return F.array_join(F.filter(parts, lambda x: (x != "") & ~F.contains(x, F.lit("::"))), "; ")


def first_words(text: Column, n: int) -> Column:
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"\S+"), F.lit(0)), 1, n), " ")


def introduction(text: Column, abstract: Column, n: int = 600, within: float = 0.4) -> Column:
    """Words behind the last introduction heading of the first part of a text; empty if the abstract is short or stands there."""
    parts = F.split(F.coalesce(text, F.lit("")), INTRODUCTION)
    # places of the headings: a text less what stands from each heading on
    goal = first_words(F.coalesce(abstract, F.lit("")), 10**6)
    heads = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(INTRODUCTION), F.lit(0))
    step = lambda a, i: F.struct((a["at"] + F.length(F.get(parts, i)) + F.length(F.get(heads, i))).alias("at"), F.when(a["at"] + F.length(F.get(parts, i)) < F.length(text) * within, a["at"] + F.length(F.get(parts, i)) + F.length(F.get(heads, i))).otherwise(a["end"]).alias("end"))
    end = F.aggregate(F.when(F.size(heads) > 0, F.sequence(F.lit(0), F.size(heads) - 1)).otherwise(F.array().cast("array<int>")), F.struct(F.lit(0).alias("at"), F.lit(None).cast("int").alias("end")), step, lambda a: a["end"])
    part = first_words(F.substr(text, end + 1), n)
    found = F.contains(part, F.left(goal, F.lit(80))) | F.contains(part, F.right(goal, F.lit(80)))
    return F.when((F.length(goal) >= 120) & end.isNotNull() & ~found, part).otherwise("")


def filled(template: str, fields: list[str]) -> Column:
    """A template with the columns of its placeholders."""
    parts, rest = [], template
    while rest:
        at = min(((rest.find("{" + f + "}"), f) for f in fields if "{" + f + "}" in rest), default=None)
        if at is None:
            parts.append(F.lit(rest))
            break
        parts += [F.lit(rest[: at[0]]), F.col(at[1])]
        rest = rest[at[0] + len(at[1]) + 2 :]
    return F.concat(*parts)


def instruction_pairs(df: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, least: int = 200, most: int = 4, fits: Callable[[Column], Column] = T.in_portuguese, kind: str = "tese") -> DataFrame:
    """(doc_id, split, id, request, answer): the first ``most`` templates of each document that its fields can fill.

    ``df`` has doc_id, split, text and the fields. An answer but a title has ``least`` characters or more and fits the
    language, as do an abstract and an excerpt inside a request; discarded documents make none.
    """
    c = F.col
    trimmed = lambda name: F.btrim(F.coalesce(c(name), F.lit("")))
    df = df.where("split <> 'discarded'").select(
        "doc_id",
        "split",
        "text",
        trimmed("titulo").alias("titulo"),
        trimmed("resumo").alias("resumo"),
        keywords(c("palavras_chave")).alias("palavras_chave"),
        F.coalesce(F.nullif(F.btrim(F.split(trimmed("tipo"), r"\|")[0]), F.lit("")), F.lit(kind)).alias("tipo"),
        trimmed("instituicao").alias("instituicao"),
        F.btrim(F.split(trimmed("programa"), r"\|")[0]).alias("programa"),
    )
    df = df.withColumn("trecho", introduction(c("text"), c("resumo"))).drop("text")
    fields = [x for x in df.columns if x not in ("doc_id", "split")]
    df = df.withColumns({f"_fits_{f}": fits(c(f)) for f in ("resumo", "palavras_chave", "trecho")})
    made = []
    for template, answer in templates:
        used = [f for f in fields if "{" + f + "}" in template]
        ok = F.lit(True)
        for f in used:
            ok = ok & (c(f) != "")
        for f in ("resumo", "trecho"):
            if f in used:
                ok = ok & c(f"_fits_{f}")
        if answer != "titulo":
            ok = ok & (F.length(answer) >= least) & c(f"_fits_{answer}")
        made.append(F.when(ok, F.struct(filled(template, used).alias("request"), c(answer).alias("answer"))))
    pairs = F.slice(F.filter(F.array(*made), lambda x: x.isNotNull()), 1, most)
    out = df.select("doc_id", "split", F.posexplode(pairs).alias("n", "pair"))
    return out.select("doc_id", "split", F.concat_ws("-", c("doc_id").cast("string"), c("n").cast("string")).alias("id"), "pair.request", "pair.answer")


def messages() -> Column:
    """A pair as the turns of a conversation."""
    turn = lambda role, name: F.struct(F.lit(role).alias("role"), F.col(name).alias("content"))
    return F.array(turn("user", "request"), turn("assistant", "answer")).alias("messages")


def rag(df: DataFrame, size: int = 500, overlap: int = 50, least: int = 50, about: tuple[str, ...] = ()) -> DataFrame:
    """Chunks (chunk_id, doc_id, indice_chunk, texto, palavras, split) of documents that are not discarded, with columns
    ``about`` as meta_<name>; ``df`` has doc_id, text and split."""
    kept = df.where("split <> 'discarded'")
    parts = C.chunks(kept, size, overlap, least).select("doc_id", F.col("chunk").cast("int").alias("indice_chunk"), F.col("text").alias("texto"), F.col("words").cast("int").alias("palavras"))
    parts = parts.join(kept.select("doc_id", "split", *[F.col(a).alias(f"meta_{a}") for a in about]), "doc_id")
    return parts.withColumn("chunk_id", F.concat(F.col("doc_id").cast("string"), F.lit("#"), F.lpad(F.col("indice_chunk").cast("string"), 5, "0")))


def choices(items: DataFrame, value: str, pool: DataFrame, seed: int = 42, wrong: int = 3) -> DataFrame:
    """``items`` (doc_id, value) with ``choices``: the value and ``wrong`` others of the pool's distinct values, in hashed order.

    Every value of the pool has a place on a ring by its hash; an item takes the next places behind its own hash. The pool is
    ranked in buckets and met by equality, so neither side is multiplied by the other. Pools of too few values give no items.
    """
    distinct = pool.select(F.col(value).cast("string").alias("v")).where("v is not null and v <> ''").distinct()
    ring = in_turn(distinct.withColumn("_all", F.lit(0)), ["_all"], T.seeded_order(seed, F.col("v")), "v").select("v", (F.col("_rank") - 1).alias("k"), "_n")
    n = ring.agg(F.max("_n")).first()[0] or 0
    if n <= wrong:
        return items.withColumn("choices", F.array().cast("array<string>")).limit(0)
    # one place more than asked, as the value itself may stand among them
    start = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(seed)), F.lit(n))
    asked = items.select("doc_id", F.col(value).cast("string").alias("_own"), start.alias("s")).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(wrong))))
    met = asked.withColumn("k", F.pmod(F.col("s") + F.col("i"), F.lit(n))).join(ring.drop("_n"), "k").where("v <> _own")
    others = met.groupBy("doc_id", "_own").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("o"))
    four = F.concat(F.transform(F.slice("o", 1, wrong), lambda x: x["v"]), F.array("_own"))
    mixed = F.array_sort(F.transform(four, lambda v: F.struct(F.md5(F.concat_ws("|", F.col("doc_id").cast("string"), v)).alias("h"), v.alias("v"))))
    return items.join(others.select("doc_id", F.transform(mixed, lambda x: x["v"]).alias("choices")), "doc_id")


def retrieval_items(df: DataFrame, n: int = 300, seed: int = 42) -> DataFrame:
    """Held-out documents with a long abstract: its first 800 characters ask for the document."""
    held = df.where("split in ('validation', 'test')").where(F.length("resumo") > 300)
    some = held.orderBy(T.seeded_order(seed, F.col("doc_id")), "doc_id").limit(n)
    metrics = F.array(*map(F.lit, ("recall@5", "recall@10", "MRR")))
    return some.select(F.concat(F.lit("ret-"), F.col("doc_id").cast("string")).alias("id"), F.left("resumo", F.lit(800)).alias("query"), F.col("doc_id").alias("gold"), F.col("titulo").alias("gold_title"), metrics.alias("metrics"))


def choice_items(df: DataFrame, n: int = 300, seed: int = 7) -> DataFrame:
    """Where was it defended, and when: two kinds of item for held-out documents with an abstract of 300 characters, up to ``n``."""
    held = df.where("split in ('validation', 'test')").where(F.length("resumo") >= 300)
    # each document makes two items at most, so ``n`` documents are enough
    some = held.orderBy(T.seeded_order(seed, F.col("doc_id")), "doc_id").limit(n).withColumn("_order", T.seeded_order(seed, F.col("doc_id")))
    about = F.concat(F.lit("Em qual instituição foi defendido o trabalho descrito no resumo a seguir?\n\n"), F.left("resumo", F.lit(900)))
    place = choices(some.where("instituicao <> ''").select("doc_id", "instituicao", "_order", about.alias("question")), "instituicao", df).select("doc_id", "_order", F.lit("inst").alias("kind"), "question", "choices", F.col("instituicao").alias("answer"))
    when = F.concat(F.lit('Em que ano foi defendido o trabalho "'), F.col("titulo"), F.lit('"?'))
    year = choices(some.where("ano is not null").select("doc_id", F.col("ano").cast("string").alias("ano"), "_order", when.alias("question")), "ano", df).select("doc_id", "_order", F.lit("ano").alias("kind"), "question", "choices", F.col("ano").alias("answer"))
    both = place.unionByName(year).withColumn("id", F.concat(F.lit("mc-"), F.col("kind"), F.lit("-"), F.col("doc_id").cast("string")))
    return both.orderBy("_order", "doc_id", F.desc("kind")).limit(n).select("id", "kind", "question", "choices", "answer")


def perplexity_items(df: DataFrame, n: int = 200, words: int = 1024, seed: int = 13) -> DataFrame:
    some = df.where("split in ('validation', 'test')").orderBy(T.seeded_order(seed, F.col("doc_id")), "doc_id").limit(n)
    return some.select(F.concat(F.lit("ppl-"), F.col("doc_id").cast("string")).alias("id"), first_words(F.col("text"), words).alias("text"))


def pretrain_records(df: DataFrame) -> DataFrame:
    """(id, text, meta, split, shard) of documents that are not discarded: 5,000 a shard of a split."""
    kept = df.where("split <> 'discarded'")
    numbered = C.ranked(kept.withColumn("_bucket", F.left(F.sha1(F.col("doc_id").cast("string")), F.lit(2))), ["_bucket"], ["doc_id"], ["split"])
    shard = F.concat_ws("-", "split", F.lpad(F.floor((F.col("_rank") - 1) / 5000).cast("string"), 4, "0"))
    return numbered.select(F.col("doc_id").alias("id"), "text", meta(), "split", shard.alias("shard"))


def summary(df: DataFrame) -> DataFrame:
    """One row: documents, words, median words, first and last year, distinct institutions."""
    return df.agg(
        F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum("palavras"), F.lit(0)).alias("n_words"), F.median("palavras").alias("median_words"),
        F.min("ano").alias("first_year"), F.max("ano").alias("last_year"), F.count_distinct("instituicao").alias("n_institutions"),
    )


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    return df.groupBy(F.coalesce(F.nullif(F.col(column).cast("string"), F.lit("")), F.lit("(não informado)")).alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value").limit(n)


def datacard(df: DataFrame, title: str, products: dict[str, object], notes: tuple[str, ...] = ()) -> str:
    """A data card in Markdown; what comes to the driver are a summary row and top values."""
    s = summary(df).first()
    labelled = df.withColumn("_source", source_label(F.col("id_bdtd"), F.col("url_registro")))
    table = lambda head, rows: "\n".join([f"| {head} | documents |", "|---|---|", *[f"| {r.value} | {r.n} |" for r in rows.collect()]])
    lines = [
        f"# {title}", "", "| measure | value |", "|---|---|", f"| documents | {s.n_docs} |", f"| words | {s.n_words:,} |", f"| median words | {int(s.median_words or 0)} |",
        f"| years | {s.first_year or '-'} to {s.last_year or '-'} |", f"| institutions | {s.n_institutions} |", "",
        table("split", top_values(df, "split", 10)), "", table("institution", top_values(df, "instituicao", 10)), "", table("rights", top_values(df, "direitos", 8)), "", table("source", top_values(labelled, "_source", 40)), "",
        "## Products", "", *[f"- {k}: {v}" for k, v in products.items()], "", *[f"- {n}" for n in notes],
    ]
    return "\n".join(lines).rstrip() + "\n"
