"""Document fingerprints by I-Match over several randomised lexicon subsets, in DataFrame operations alone.

The lexicon holds the terms whose document frequency, over all documents, lies within a band; nothing else decides.
A document's fingerprint takes its distinct lexicon terms, sorted, and hashes for each of several random subsets of
the lexicon those it holds. The subsets differ in size, from most of the lexicon to one term in 256, so that the share
of equal hashes falls gradually as texts differ more. A document with too few lexicon terms takes all its distinct
terms instead.

Document frequencies sum to the number of (document, term) pairs, so a band above ``low`` holds at most as many terms
as a document holds on average, divided by ``low``. Up to ``LISTED`` terms are looked up in a set inside the
expression; a larger lexicon stays a table that the terms of distinct texts are joined with, to the same result.

Null and empty texts are texts without terms and share one fingerprint; equal texts have equal fingerprints; rows
that share a doc_id are ordered by a hash of their text; a null doc_id comes last in descending order. An empty table
gives an empty result. Texts of any length are read whole. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.storage import materialize

#: One random subset of the lexicon a rate: a term is in with probability 1 / rate.
RATES = (1.5,) * 4 + (16,) * 4 + (64,) * 8 + (256,) * 8


def terms(text: Column) -> Column:
    """Hashes of the distinct words (letters, digits and characters beyond ASCII), in lower case."""
    words = F.filter(F.split(F.lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")
    return F.transform(F.array_distinct(words), lambda w: F.xxhash64(w))


def lexicon(docs: DataFrame, low: float = 0.004, high: float = 0.2) -> DataFrame:
    """(term): hashes of terms in at least ``low`` and at most ``high`` of all documents, and in two at least."""
    exploded = docs.select(F.explode(terms(F.coalesce("text", F.lit("")))).alias("term"))
    n = docs.count()
    df = exploded.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return materialize(df.where(F.col("df").between(max(2.0, low * n), max(2.0, high * n))).select("term"), "lexicon")


#: So many terms at most are listed in an expression.
LISTED = 50_000


def subset_hashes(kept: Column) -> Column:
    """One hash a subset, of the sorted terms that it holds; zero if it holds none."""

    def one(k: int, rate: float) -> Column:
        inside = F.filter(kept, lambda t: F.pmod(F.xxhash64(t, F.lit(k)), F.lit(6144)) < int(6144 / rate))
        # the hash of no terms is the seed itself
        return F.nullif(F.xxhash64(inside), F.lit(42).cast("long"))

    return F.transform(F.array(*[one(k, rate) for k, rate in enumerate(RATES)]), lambda h: F.coalesce(h, F.lit(0).cast("long")))


def with_fingerprint(df: DataFrame, text: str, name: str, words: DataFrame, least: int = 3, listed: int = LISTED) -> DataFrame:
    """``df`` with the array of subset hashes of column ``text`` as column ``name``; ``words`` is the lexicon."""
    every, band, of = f"_{name}_every", f"_{name}_band", f"_{name}_of"
    df = df.withColumn(every, terms(F.col(text)))
    some = [r.term for r in words.limit(listed + 1).collect()]
    if len(some) <= listed:
        inside = F.expr(f"filter({every}, t -> t in ({', '.join(f'{w}L' for w in sorted(some) if w != -(2**63))}))") if some else F.array().cast("array<bigint>")
        df = df.withColumn(band, inside)
    else:
        df = df.withColumn(of, F.sha2(F.col(text).cast("binary"), 256))
        pairs = df.select(of, F.explode(every).alias("term")).distinct().join(words, "term", "left_semi")
        df = df.join(pairs.groupBy(of).agg(F.collect_list("term").alias(band)), of, "left").withColumn(band, F.coalesce(band, F.array().cast("array<bigint>"))).drop(of)
    df = df.withColumn(band, F.array_sort(F.when(F.size(band) < least, F.col(every)).otherwise(F.col(band))))
    return df.withColumn(name, subset_hashes(F.col(band))).drop(every, band)


def rendered(prints: Column) -> Column:
    return F.lower(F.array_join(F.transform(prints, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among subsets that hold a term of either; 1 if neither has terms."""
    pairs = F.zip_with(a, b, lambda x, y: F.when((x == 0) & (y == 0), F.lit(None).cast("int")).otherwise((x == y).cast("int")))
    met = F.filter(pairs, lambda x: x.isNotNull())
    return F.when(F.size(met) == 0, F.lit(1.0)).otherwise(F.size(F.filter(met, lambda x: x == 1)) / F.size(met))


def with_next(docs: DataFrame, columns: list[str], per_bucket: int = 2000) -> DataFrame:
    """Rows with ``next_<column>``, of the row that follows in descending doc_id; after the last comes the first.

    Rows go to buckets of the key's range, one shuffle in all. A bucket's first row is known beforehand, as the bounds
    are keys that occur; it also goes to the bucket before its own, behind the rows there, and the very first to the last.
    A bucket holds about ``per_bucket`` rows up to 131 million rows in all; beyond, 65,536 buckets grow with the table
    (150,000 rows each at 10^10) and are sorted with spill. Rows that repeat one doc_id are one bucket.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    n = docs.count()
    side = max(1, min(256, int((n / per_bucket) ** 0.5) + 1))
    buckets = side * side
    asked = [i / buckets for i in range(1, buckets)] + [1.0]
    bounds = docs.agg(F.percentile_approx(key, asked, max(10_000, 4 * buckets))).first()[0] or []
    top = docs.agg(F.max(key)).first()[0]
    bounds = sorted({*bounds, *([top] if top is not None else [])}, reverse=True)  # bucket k: keys in (bounds[k + 1], bounds[k]]
    if not bounds:
        bounds = [0]
    step = max(1, int(len(bounds) ** 0.5))
    heads = bounds[::step]
    chunk = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    coarse = F.size(F.filter(F.array(*[F.lit(b) for b in heads]), lambda b: b >= F.col("_key"))) - 1
    fine = F.size(F.filter(F.element_at(F.array(*[F.array(*[F.lit(b) for b in c]) for c in chunk]), F.col("_coarse") + 1), lambda b: b >= F.col("_key"))) - 1
    rows = docs.withColumn("_key", key).withColumn("_coarse", coarse).withColumn("_bucket", (F.col("_coarse") * step + fine).cast("int"))
    is_bound = F.element_at(F.array(*[F.array(*[F.lit(b) for b in c]) for c in chunk]), F.col("_coarse") + 1)
    is_bound = F.array_contains(is_bound, F.col("_key"))
    last = len(bounds) - 1
    before = F.when(F.col("_bucket") == 0, F.lit(last)).otherwise(F.col("_bucket") - 1)
    here, ahead = F.struct(F.col("_bucket").alias("b"), F.lit(0).alias("c")), F.struct(before.alias("b"), F.lit(1).alias("c"))
    rows = rows.withColumn("_at", F.explode(F.when(is_bound, F.array(here, ahead)).otherwise(F.array(here))))
    rows = rows.withColumn("_tie", F.xxhash64("text")).withColumn("_part", F.col("_at.b")).withColumn("_copy", F.col("_at.c"))
    order = Window.partitionBy("_part").orderBy("_copy", F.desc("_key"), "_tie")
    out = rows.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns])
    return out.where("_copy = 0").drop("_key", "_coarse", "_bucket", "_at", "_tie", "_part", "_copy")


def fingerprint_documents(docs: DataFrame, words: DataFrame | None = None, listed: int = LISTED) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row."""
    words = lexicon(docs) if words is None else words
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    own = with_fingerprint(own, "text", "prints", words, listed=listed)
    pairs = with_next(own, ["text", "prints"])
    n = F.length("text")
    pairs = pairs.withColumn("edited", F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 2) as int))"), F.expr("substring(next_text, 1, cast(floor(length(text) / 2) as int))")))
    pairs = with_fingerprint(pairs.withColumn("n_chars", n.cast("long")).drop("text", "next_text"), "edited", "edited_prints", words, listed=listed)
    return pairs.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        rendered(F.col("prints")).alias("fingerprint"),
        rendered(F.col("edited_prints")).alias("edited_fingerprint"),
        likeness(F.col("prints"), F.col("edited_prints")).cast("double").alias("near_edited"),
        likeness(F.col("prints"), F.col("next_prints")).cast("double").alias("near_next"),
    )
