"""Records that arrive as files, taken in as a stream; each batch is written once however often it is tried."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from corpusloom.operators.corpus import one_each


def file_stream(spark: SparkSession, folder: str, schema: StructType | str, form: str = "json", pattern: str = "*", files_a_batch: int = 1000) -> DataFrame:
    """A stream over the files of a folder whose names fit ``pattern``."""
    reader = spark.readStream.format(form).schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_a_batch)
    return reader.load(folder)


def ingest(stream: DataFrame, table: str, key: list[str], state: str) -> DataFrame:
    """Take in all that has arrived and return the table; rows whose ``key`` is already in it are left out.

    Batch n is the folder ``batch=n``, overwritten as a whole and compared with earlier batches alone, so a batch
    repeated after a failure gives the same rows. ``state`` remembers the files that were taken.
    """
    spark, schema = stream.sparkSession, stream.schema

    def take(batch: DataFrame, n: int) -> None:
        new = one_each(batch, key)
        if n:
            before = batch.sparkSession.read.schema(schema).option("basePath", table).parquet(table).where(f"batch < {int(n)}")
            new = new.join(before.select(*key), key, "left_anti")
        new.select(schema.names).write.mode("overwrite").parquet(f"{table}/batch={int(n)}")

    run = stream.writeStream.foreachBatch(take).option("checkpointLocation", state).trigger(availableNow=True).start()
    run.awaitTermination()
    if run.exception():
        raise RuntimeError(str(run.exception()))
    return spark.read.parquet(table).drop("batch")
