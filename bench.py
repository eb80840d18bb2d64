"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from corpusloom.plans import catalog
from corpusloom.session import session

HEADLINE = ["corpus_summary", "quality_decision", "exact_survivors", "internal_repetition", "decontaminate", "near_dup_components", "pii_email_masked", "group_split", "rag_chunks", "stratified_sample", "breaker_runs", "linkage_pairs"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session("bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/documents.parquet").count()  # the session's start does not count
    took = {}
    for name in HEADLINE:
        began = time.time()
        catalog.queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 3)
    spark.stop()
    print(json.dumps({"metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf_dir.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
