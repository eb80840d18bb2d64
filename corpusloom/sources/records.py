"""Sources and sinks of records: JSON lines, date windows of a harvest, file kinds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: First bytes of common files, in hex.
SIGNATURES = {"pdf": "25504446", "zip": "504B0304", "ole": "D0CF11E0", "png": "89504E47", "jpg": "FFD8FF", "gzip": "1F8B"}


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One JSON object a line under a stated schema; blank lines give no row, and a path without files an empty table."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    matches = found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(found)
    if matches is None or not len(matches):
        return spark.createDataFrame([], schema)
    lines = spark.read.text(path).where(F.btrim("value") != "")
    text = schema if isinstance(schema, str) else schema.simpleString()
    return lines.select(F.from_json("value", text).alias("r")).select("r.*")


def write_jsonl(df: DataFrame, path: str, by: str | None = None, per_file: int = 5000) -> None:
    """JSON lines, at most ``per_file`` rows a file, in one folder for each value of ``by``."""
    out = df.write.mode("overwrite").option("maxRecordsPerFile", per_file)
    (out.partitionBy(by) if by else out).json(path)


def date_windows(bounds: DataFrame, days: int) -> DataFrame:
    """(position, first_day, last_day): windows of ``days`` that cover ``bounds`` (one row: low, high dates), the last one cut."""
    starts = F.posexplode(F.sequence("low", "high", F.make_dt_interval(F.lit(days))))
    df = bounds.where("low is not null and high is not null").select("high", starts.alias("position", "first_day"))
    return df.select(F.col("position").cast("long").alias("position"), "first_day", F.least(F.date_add("first_day", days - 1), "high").alias("last_day"))


def halved(windows: DataFrame) -> DataFrame:
    """Both halves of each window (first_day, last_day): what a harvest tries after a window failed; single days stay whole."""
    middle = F.date_add("first_day", F.floor(F.datediff("last_day", "first_day") / 2).cast("int"))
    parts = F.when(F.col("first_day") == F.col("last_day"), F.array(F.struct(F.col("first_day").alias("a"), F.col("last_day").alias("b")))).otherwise(
        F.array(F.struct(F.col("first_day").alias("a"), middle.alias("b")), F.struct(F.date_add(middle, 1).alias("a"), F.col("last_day").alias("b")))
    )
    return windows.select(F.explode(parts).alias("p")).select(F.col("p.a").alias("first_day"), F.col("p.b").alias("last_day"))


def file_kind(content: Column) -> Column:
    """Kind of a file by its first bytes; ``html`` for a leading angle bracket, else ``desconhecido``; null for null."""
    head = F.hex(F.substring(content, 1, 8))
    kind = F.when(content.isNull(), F.lit(None).cast("string"))
    for name, start in SIGNATURES.items():
        kind = kind.when(head.startswith(start), name)
    return kind.when(F.regexp_like(head, F.lit("^(09|0A|0D|20)*3C")), "html").otherwise("desconhecido")
