"""From raw documents to packed sequences: five stages, each over all that the one before has kept.

Every stage reads ``documents`` columns (doc_id, text, lang, source, n_chars); all but the last return them. The result
of each stage is written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import mixing, nbsvm, packing, simhash, toxicity
from corpusloom.storage import materialize, ship_package


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what the quality classifier accepts, rows alike with it: null and empty texts are scored by the bias alone, repeats alike."""
    ship_package(spark)
    scored = nbsvm.score_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.where("predicted = 1").select(docs.columns)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the toxicity network rejects; null and empty texts score as padding, repeats alike, long texts by every window."""
    ship_package(spark)
    scored = toxicity.score_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.where("predicted = 0").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more) the document of smallest doc_id stays.

    Rows of different texts that share a doc_id are documents of their own; if a group's smallest doc_id has several, the
    one whose text has the smallest hash stays, and of rows alike in both one. Null and empty texts are one group. Rows
    without doc_id cannot be named, and all stay.
    """
    ship_package(spark)
    groups = simhash.near_copies(docs.where("doc_id is not null").select("doc_id", "text"))
    first = groups.groupBy("component").agg(F.min(F.struct("doc_id", "tie")).alias("first")).select("first.doc_id", F.col("first.tie").alias("_tie"))
    kept = docs.withColumn("_tie", F.xxhash64("text")).join(first, ["doc_id", "_tie"], "left_semi").dropDuplicates(["doc_id", "_tie"])
    return kept.select(docs.columns).unionByName(docs.where("doc_id is null"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Half of the tokens, drawn towards flatter shares of sources, languages and topics.

    Null sources and languages are categories; rows that repeat doc_id and text share one draw; an empty table stays empty.
    """
    ship_package(spark)
    fitted = mixing.topic_centroids(docs)
    described = materialize(mixing.describe(mixing.with_draw(docs), fitted), "described")
    return mixing.mix(described).where("sampled").select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 1,024 tokens; a null or empty text packs as its end token, every row for itself."""
    ship_package(spark)
    return packing.pack(docs)


STAGES = [("quality", quality), ("toxicity", toxic), ("near_duplicates", near_duplicates), ("mixture", mixture), ("packing", pack)]
#: Trained models and tokenizers have no SQL; tests/llm checks the operators behind the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
