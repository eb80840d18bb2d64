"""Where lineage is cut: the folder that driver and executors share."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Applications whose executors have the package.
_SHIPPED: set[str] = set()


def local(spark: SparkSession) -> bool:
    """Whether executors are threads of the driver's machine."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only where the session names none (tests)."""
    held = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not held:
        if not local(spark):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        held = tempfile.mkdtemp(prefix="corpusloom-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(held)
    return held.rstrip("/")


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives lost executors, and its partitions never move."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a Parquet table to the shared folder and read it again."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote and nothing reads any more."""
    for table in tables:
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package when the driver found it through ``sys.path`` alone.

    Workers of a local session share the driver's folders; those of a cluster get the package as an archive, once a session.
    """
    context, root = spark.sparkContext, os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = context.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)
    if local(spark) or context.applicationId in _SHIPPED:
        return
    name, folder = os.path.basename(os.path.dirname(os.path.abspath(__file__))), tempfile.mkdtemp(prefix="package-")
    context.addPyFile(shutil.make_archive(os.path.join(folder, name), "zip", root, name))  # the driver serves it to the executors
    _SHIPPED.add(context.applicationId)
