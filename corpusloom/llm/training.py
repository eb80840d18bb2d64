"""Bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def held_out(modulus: int, remainder: int):
    """True where crc32 of doc_id as text leaves ``remainder``; a null doc_id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, remainder: int, most: int, most_chars: int) -> DataFrame:
    """(text, label) of at most ``most`` labelled rows outside the held-out fold, half of each class where both have enough.

    Rows are taken by a hash of their id and text, among those that have a document of at most ``most_chars`` characters:
    that bounds the sample's bytes, and training alone leaves longer texts out; scoring takes every text whole. Labels that
    are null, or of no document, do not count. Rows that repeat a doc_id count each, within the bound.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(modulus, remainder)).select(F.col("doc_id"), F.col(label).cast("int").alias("label"))
    half = (most + 1) // 2
    short = docs.select("doc_id", "text").where(F.coalesce(F.length("text"), F.lit(0)) <= most_chars)
    # ids alone are joined and ranked; the texts of those picked come in a second pass
    met = known.join(short.select("doc_id", F.xxhash64("text").alias("tie")), "doc_id").withColumn("rank", F.xxhash64(F.col("doc_id").cast("long"), F.lit(11)))
    first = lambda k: met.where(F.col("label") == k).orderBy("rank", "doc_id", "tie").limit(half)
    # at most `most` rows: a proven size for the broadcast side
    picked = first(1).unionByName(first(0)).select("doc_id", "tie", "label").distinct()
    found = short.withColumn("tie", F.xxhash64("text")).join(F.broadcast(picked), ["doc_id", "tie"])
    return found.orderBy("doc_id", "tie", "label").limit(most).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "label")


def class_shares(labels: DataFrame, label: str, modulus: int, remainder: int) -> float:
    """Share of label 1 among all labelled rows outside the held-out fold (0.5 if there are none)."""
    row = labels.where(~held_out(modulus, remainder)).agg(F.avg(F.col(label).cast("double")).alias("share")).first()
    return 0.5 if row.share is None else float(row.share)
