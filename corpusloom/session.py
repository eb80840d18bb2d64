"""Session defaults: adaptive execution, UTC, Arrow, and shuffle partitions left to the caller's scale."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(app: str = "corpusloom", cores: str | None = None, **conf: str) -> SparkSession:
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    settings = {
        "spark.sql.shuffle.partitions": cores,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    } | conf
    return SparkSession.builder.master(f"local[{cores}]").appName(app).config(map=settings).getOrCreate()
