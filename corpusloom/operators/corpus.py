"""Operators on documents: quality, deduplication, decontamination, splits and products. Each is DataFrame to DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions import text as T
from corpusloom.operators.neardup import across, near_copies
from corpusloom.storage import materialize, ship_package


def metrics(docs: DataFrame, stop: tuple[str, ...] = T.PT, among: int = 3000, languages: dict | None = None) -> DataFrame:
    """Counts, shares and language of each text; one row a document.

    A word is alphabetic if it has a letter; symbols are number signs and ellipses; function words are sought among the
    first ``among`` words. Without words or lines, shares that speak against a text are 1 and the others 0. Null is empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select("doc_id", "lang", text.alias("_t")).withColumn("_w", T.words(F.col("_t")))
    df = df.withColumn("_l", F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"\S")))
    df = T.with_language(df, "_t", "_language", languages)
    counts = df.select(
        "doc_id",
        "lang",
        F.size("_w").cast("long").alias("n_words"),
        F.size(F.filter("_w", lambda x: x.rlike(r"\p{L}"))).cast("long").alias("n_alphabetic"),
        F.size(F.filter("_w", lambda x: F.length(x) <= 2)).cast("long").alias("n_short"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(r"#|…|\.\.\.")).cast("long").alias("n_symbols"),
        F.length("_t").cast("long").alias("n_chars"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_duplicate_lines"),
        F.size(F.filter(F.slice("_w", 1, among), lambda x: F.lower(x).isin(*stop))).cast("long").alias("n_stopwords"),
        "_language",
    )
    share = lambda a, b, none: F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(none))
    return counts.select(
        "*",
        share("n_alphabetic", "n_words", 0.0).alias("alphabetic_share"),
        share("n_symbols", "n_words", 1.0).alias("symbol_share"),
        share("word_chars", "n_words", 0.0).alias("mean_word"),
        share("n_duplicate_lines", "n_lines", 1.0).alias("duplicate_line_share"),
        share("n_short", "n_words", 1.0).alias("short_share"),
        share("n_words", "n_lines", 0.0).alias("words_a_line"),
        F.col("_language.lang").alias("language"),
        F.col("_language.confidence").alias("confidence"),
    ).drop("_language")


#: Thresholds of the quality rules and the names of their reasons, in order.
RULES = {"least": 300, "most": 400_000, "alphabetic": 0.75, "symbols": 0.10, "word": (3.0, 10.0), "stopwords": 8, "duplicates": 0.30, "short": 0.55, "words_a_line": 3.0, "sure": 0.65}
REASONS = ("curto_demais", "longo_demais", "pouco_texto_alfabetico", "excesso_simbolos", "tamanho_medio_palavra_anomalo", "sem_stopwords_pt", "linhas_repetitivas", "ocr_fragmentado", "linhas_curtas_demais")


def decide(m: DataFrame, expected: str | None = "pt", **rules) -> DataFrame:
    """Reasons for rejection, in order, and whether there are none; ``language_alert`` where the expected language is unsure.

    ``expected`` None leaves the language rule out.
    """
    r = RULES | rules
    c = F.col
    holds = [
        c("n_words") < r["least"],
        c("n_words") > r["most"],
        c("alphabetic_share") < r["alphabetic"],
        c("symbol_share") > r["symbols"],
        ~c("mean_word").between(*r["word"]),
        c("n_stopwords") < r["stopwords"],
        c("duplicate_line_share") > r["duplicates"],
        c("short_share") > r["short"],
        c("words_a_line") < r["words_a_line"],
    ]
    sure = F.format_string("%.2f", F.floor(c("confidence") * 100 + 0.5) / 100)
    said = [F.when(h, F.lit(name)) for h, name in zip(holds, REASONS, strict=True)]
    alert = F.lit(None).cast("string")
    if expected is not None:
        said.append(F.when(c("language") != expected, F.concat(F.lit("idioma_"), c("language"), F.lit("_"), sure)))
        alert = F.when((c("language") == expected) & (c("confidence") < r["sure"]), F.concat(F.lit("confianca_baixa_"), sure))
    reasons = F.filter(F.array(*said), lambda x: x.isNotNull())
    return m.select("doc_id", F.array_join(reasons, "|").alias("reasons"), (F.size(reasons) == 0).alias("approved"), alert.alias("language_alert"))


def _count_of(stop):
    return F.size(F.filter("_w", lambda x: x.isin(*stop))).cast("long")


def stopword_scores(docs: DataFrame) -> DataFrame:
    """Counts of each language's function words; ``guess`` is the language with most, the first in order on ties."""
    df = docs.withColumn("_w", T.words(F.lower("text")))
    for lang, stop in T.STOPWORDS.items():
        df = df.withColumn(f"n_{lang}", _count_of(stop))
    langs = sorted(T.STOPWORDS)
    best = F.greatest(*[F.col(f"n_{x}") for x in langs])
    guess = F.when(best == 0, F.lit("unknown"))
    for x in langs:
        guess = guess.when(F.col(f"n_{x}") == best, F.lit(x))
    return df.select("doc_id", "lang", *[f"n_{x}" for x in langs], guess.alias("guess"))


def exact_map(docs: DataFrame) -> DataFrame:
    """Every document with the survivor of its exact-duplicate group: the longest text, then the smallest id (a null one last).

    A null text counts as empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", T.dedup_key(text).alias("key"), F.length(text).alias("n"))
    best = F.max(F.struct(F.col("n"), (-F.col("doc_id")).alias("neg")))
    return keyed.join(keyed.groupBy("key").agg(best.alias("best"), F.count(F.lit(1)).alias("members")), "key").select("doc_id", "key", (-F.col("best.neg")).alias("survivor"), "members")


def survivors(docs: DataFrame) -> DataFrame:
    """Documents that survive exact deduplication; ids alone are grouped, and texts meet the groups' survivors once."""
    text = F.coalesce(F.col("text"), F.lit(""))
    first = docs.groupBy(T.dedup_key(text).alias("key")).agg(F.max(F.struct(F.length(text).alias("n"), (-F.col("doc_id")).alias("neg"))).alias("best"))
    return docs.join(first.select((-F.col("best.neg")).alias("_id")), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")


def internal_repetition(docs: DataFrame, separator: str = "\n\n", least: int = 60, key_chars: int = 400, reject: float = 0.30) -> DataFrame:
    """Each text without paragraphs that repeat an earlier one; short ones are always kept.

    Paragraphs are trimmed and empty ones dropped; they are compared by their letters and digits alone. ``share`` is of the
    removed among all, to four decimals; ``rejected`` where it exceeds ``reject``. Null is empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    parts = F.filter(F.transform(F.split(text, separator), lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x != "")
    keys = F.transform("_p", lambda x: F.left(F.regexp_replace(F.lower(x), r"[^\p{L}\p{N}_]+", ""), F.lit(key_chars)))
    df = docs.select("doc_id", parts.alias("_p")).withColumn("_k", F.transform(keys, lambda k, i: F.when(F.length(k) < least, F.concat(F.lit("#"), i)).otherwise(k)))
    # most texts repeat nothing and need no places
    kept = F.when(F.size(F.array_distinct("_k")) == F.size("_k"), F.col("_p")).otherwise(F.filter("_p", lambda x, i: F.array_position("_k", F.get("_k", i)) == i + 1))
    df = df.withColumn("_kept", kept)
    removed = F.size("_p") - F.size("_kept")
    share = F.round(removed / F.greatest(F.size("_p"), F.lit(1)), 4)
    return df.select("doc_id", F.size("_p").cast("long").alias("paragraphs"), removed.cast("long").alias("removed"), share.alias("share"), (share > reject).alias("rejected"), F.array_join("_kept", separator).alias("text"))


def shingles(docs: DataFrame, n: int = 5, id_column: str = "doc_id") -> DataFrame:
    """(id, shingle): distinct n-word shingles of the lower-cased text; shorter texts give none."""
    w = T.words(F.lower("text"))
    df = docs.select(id_column, w.alias("w")).where(F.size("w") >= n)
    grams = F.transform(F.sequence(F.lit(1), F.size("w") - (n - 1)), lambda i: F.array_join(F.slice("w", i, n), " "))
    return df.select(id_column, F.explode(F.array_distinct(grams)).alias("shingle"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, n: int = 8, least: int = 5, filtered: int = 2_000_000) -> DataFrame:
    """Documents that share at least ``least`` n-word shingles with one benchmark item.

    Shingles travel as 64-bit hashes. Up to ``filtered`` hashes of the benchmark are broadcast, so that those of the corpus
    meet them where they are made; a larger benchmark is joined by a shuffle. The items' shared counts are small either way.
    """
    b = materialize(hashed_shingles(benchmark, n, "item_id"), "items")
    a = hashed_shingles(docs, n)
    if b.limit(filtered + 1).count() <= filtered:
        b = F.broadcast(b)
    return a.join(b, "h").groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("shared")).where(F.col("shared") >= least)


def hashed_shingles(docs: DataFrame, n: int = 5, id_column: str = "doc_id") -> DataFrame:
    """(id, h): 64-bit hashes of the distinct n-word shingles of the lower-cased text."""
    df = docs.select(id_column, T.words(F.lower("text")).alias("w")).where(F.size("w") >= n)
    grams = F.transform(F.sequence(F.lit(1), F.size("w") - (n - 1)), lambda i: F.xxhash64(F.slice("w", i, n)))
    return df.select(id_column, F.explode(F.array_distinct(grams)).alias("h"))


def contaminated(train: DataFrame, held_out: DataFrame, similarity: float = 0.8, n: int = 5) -> DataFrame:
    """(doc_id) of training documents like one of the held-out ones: ``n``-word shingles shared to ``similarity`` or more.

    Both sides are filed under bands of minimum hashes and compared across them alone, ids kept apart by side.
    """
    ship_package(train.sparkSession)
    side = lambda df, k: df.where("doc_id is not null").select((F.col("doc_id") * 2 + k).alias("doc_id"), F.array_join(T.words(F.lower("text")), " ").alias("text")).where("text <> ''")
    links = across(side(train, 0), side(held_out, 1), n, similarity)
    return links.select(F.shiftright(F.col("a"), 1).alias("doc_id")).distinct()


def fuzzy_components(docs: DataFrame, similarity: float = 0.8, n: int = 5) -> DataFrame:
    """(node, component) of documents that have near duplicates: the share of ``n``-word shingles is ``similarity`` or more.

    Bands of minimum hashes bring pairs together (at 0.8 they miss one in 100,000) and the shared shingles are counted.
    Documents without words have no duplicates.
    """
    ship_package(docs.sparkSession)
    w = T.words(F.lower("text"))
    worded = docs.where("doc_id is not null").select("doc_id", w.alias("w")).where(F.size("w") >= 1)
    found = near_copies(worded.select("doc_id", F.array_join("w", " ").alias("text")), n, similarity).where("doc_id <> component_id")
    return found.select(F.explode(F.array("doc_id", "component_id")).alias("node"), F.col("component_id").alias("component")).distinct()


def split_by_group(docs: DataFrame, key: list[str], seed: int = 42, train: float = 0.90, validation: float = 0.05, buckets: int = 1024) -> DataFrame:
    """Whole groups go to train, validation or test: groups in hashed order, cut by rank.

    Ranks are counted in buckets of the hash, so that no task orders all groups. A null in the key is a value of its own.
    """
    order = T.seeded_order(seed, *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key])
    groups = docs.groupBy(*key).agg(F.count(F.lit(1)).alias("members")).withColumn("_order", order)
    groups = groups.withColumn("_bucket", (F.conv(F.substring("_order", 1, 8), 16, 10).cast("long") * buckets / 2**32).cast("int"))
    return ranked(groups, ["_bucket"], ["_order", *key]).withColumn("split", F.when(F.col("_rank") <= F.floor(F.col("_n") * train), "train").when(F.col("_rank") <= F.floor(F.col("_n") * train) + F.floor(F.col("_n") * validation), "validation").otherwise("test")).drop("_rank", "_n", "_bucket", "_order")


def one_each(df: DataFrame, key: list[str]) -> DataFrame:
    """One row of each key, the same whatever the order of rows: the one whose JSON has the least hash. Null is a key."""
    row = F.struct(*df.columns)
    return df.groupBy(*key).agg(F.min_by(row, F.sha2(F.to_json(row), 256)).alias("_row")).select("_row.*")


def ranked(df: DataFrame, bucket: list[str], order: list[str], within: list[str] = ()) -> DataFrame:
    """``df`` with _rank (from 1, in order of bucket, then ``order``) and _n (all rows), of each group ``within``.

    Rows are numbered inside buckets; the table of buckets, which is small, adds what stands before each.
    """
    keys = [*within, *bucket]
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"))
    upto = Window.partitionBy(*within).orderBy(*bucket).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = sizes.withColumn("_before", F.sum("_size").over(upto) - F.col("_size")).withColumn("_n", F.sum("_size").over(Window.partitionBy(*within))).drop("_size")
    every = df.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    joined = every.join(sizes.withColumnsRenamed({k: f"_s{k}" for k in keys}), [F.col(k).eqNullSafe(F.col(f"_s{k}")) for k in keys])
    return joined.withColumn("_rank", F.col("_before") + F.col("_nth")).drop("_before", "_nth", *[f"_s{k}" for k in keys])


def chunks(docs: DataFrame, size: int = 100, overlap: int = 10, least: int = 50) -> DataFrame:
    """Windows of words with the white space between them as it was; the last short ones are left out unless first."""
    tokens = F.regexp_extract_all("text", F.lit(r"\s*\S+"), F.lit(0))
    step = size - overlap
    df = docs.select("doc_id", tokens.alias("t")).where("size(t) > 0")
    starts = F.sequence(F.lit(0), F.size("t") - 1, F.lit(step))
    df = df.select("doc_id", "t", F.posexplode(starts).alias("chunk", "start"))
    df = df.withColumn("part", F.slice("t", F.col("start") + 1, F.lit(size)))
    kept = df.where((F.size("part") >= least) | (F.col("chunk") == 0))
    return kept.select("doc_id", F.col("chunk").cast("long").alias("chunk"), F.size("part").cast("long").alias("words"), F.regexp_replace(F.array_join("part", ""), r"^\s+", "").alias("text"))


def token_windows(docs: DataFrame, length: int = 32, stride: int = 16) -> DataFrame:
    """Input and target sequences, the target one word further on."""
    df = docs.select("doc_id", T.words(F.col("text")).alias("t")).where(F.size("t") > length)
    df = df.select("doc_id", "t", F.explode(F.sequence(F.lit(0), F.size("t") - length - 1, F.lit(stride))).alias("start"))
    return df.select("doc_id", F.col("start").cast("long").alias("start"), F.array_join(F.slice("t", F.col("start") + 1, length), " ").alias("input"), F.array_join(F.slice("t", F.col("start") + 2, length), " ").alias("target"))


def shards(docs: DataFrame, per_shard: int = 500, split: str = "lang") -> DataFrame:
    """Shard name of each document: documents of a split in order of id, so many a shard; a null split is ``none``.

    Ids are numbered in buckets of their range, so that a split of any size is no single task.
    """
    bounds = docs.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    width = max(1, -(-((bounds.high or 0) - (bounds.low or 0) + 1) // 4096))
    df = docs.select("doc_id", F.coalesce(F.col(split), F.lit("none")).alias("_split"), F.floor((F.col("doc_id") - (bounds.low or 0)) / width).alias("_bucket"))
    at = F.floor((F.col("_rank") - 1) / per_shard).cast("string")
    return ranked(df, ["_bucket"], ["doc_id"], ["_split"]).select("doc_id", F.concat(F.col("_split"), F.lit("-"), F.lpad(at, 4, "0")).alias("shard"))
