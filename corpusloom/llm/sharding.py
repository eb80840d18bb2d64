"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Row counts of all input partitions and the exact shard sizes fix the margins of a matrix; its entries, drawn
from the multivariate hypergeometric law, say how many rows each partition sends to each shard. Every partition
permutes its rows and sends the first of them to shard 0, the next to shard 1 and so on; after the exchange each
shard permutes again. The result is a uniformly random assignment with counts at most one apart, for any number of rows.

Null texts are empty and null ids are ids like others; repeated rows and equal texts each get a place; texts of any
length count whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm.arrow import wider, without
from corpusloom.storage import checkpoint


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` drawn without replacement are good: by numpy below its bound of 10^9, else by inversion from the mode outward."""
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, n)) if n else 0
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    mode = min(max((n + 1) * (good + 1) // (good + bad + 2), low), high)
    # the masses relative to the mode's, outward until they are nothing; their sum makes them a law
    up, down, p = [1.0], [], 1.0
    for k in range(mode, high):
        p *= (good - k) * (n - k) / ((k + 1) * (bad - n + k + 1))
        if p < 1e-18:
            break
        up.append(p)
    p = 1.0
    for k in range(mode, low, -1):
        p *= k * (bad - n + k) / ((good - k + 1) * (n - k + 1))
        if p < 1e-18:
            break
        down.append(p)
    mass = np.array(down[::-1] + up)
    return mode - len(down) + int(np.searchsorted(np.cumsum(mass), rng.random() * mass.sum(), side="right"))


def draw(rng: np.random.Generator, left: np.ndarray, n: int) -> np.ndarray:
    """Counts by colour of ``n`` drawn without replacement from ``left``, one colour after the other."""
    if left.sum() < 10**9:
        return rng.multivariate_hypergeometric(left, n, method="marginals")
    out, rest = np.zeros(len(left), dtype=np.int64), int(left.sum())
    for k, size in enumerate(left.tolist()):
        rest -= size
        out[k] = hypergeometric(rng, size, rest, n) if rest else n
        n -= int(out[k])
    return out


def matrix(rows: np.ndarray, sizes: np.ndarray, seed: int) -> np.ndarray:
    """Rows by partition and shard; its margins are exactly ``rows`` and ``sizes``."""
    rng, left, out = np.random.default_rng(seed), sizes.astype(np.int64).copy(), []
    for n in rows:
        out.append(draw(rng, left, int(n)))
        left -= out[-1]
    return np.array(out, dtype=np.int64).reshape(len(rows), len(sizes))


def shard(rows: DataFrame, shards: int = 16, seed: int = 42, per_task: int = 200_000) -> DataFrame:
    """``rows`` with shard and slot (gapless from 0 in its shard), in law "rows".

    Rows are taken as they are: nulls, repeated and empty rows each get a place; an empty table stays empty. The
    input is checkpointed first, so that a partition that is computed again holds the same rows in the same order.
    Columns named shard, slot or cell of the input are replaced.
    """
    held = checkpoint(without(rows, "shard", "slot", "cell", "draw", "nth", "before"))
    at = F.spark_partition_id()
    counts = {r.p: r.n for r in held.groupBy(at.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a partition
    parts = sorted(counts)
    n = sum(counts.values())
    sizes = np.array([n // shards + (k < n % shards) for k in range(shards)], dtype=np.int64)
    sent = dict(zip(parts, matrix(np.array([counts[p] for p in parts]), sizes, seed).tolist(), strict=True))
    cells = max(1, -(-n // (shards * per_task)))
    schema = wider(held, "shard int, cell int, draw long")

    def permute(batches):
        from pyspark import TaskContext

        p = TaskContext.get().partitionId()
        if p not in sent:
            return
        row = np.array(sent[p], dtype=np.int64)
        rng = np.random.default_rng([seed, p])
        left = row.copy()
        for batch in batches:
            n_rows = batch.num_rows
            # drawing the next rows' shards from what is left is the same as permuting the partition first
            take = draw(rng, left, n_rows)
            left -= take
            to = np.repeat(np.arange(shards), take)
            rng.shuffle(to)
            lot = rng.integers(0, 2**62, n_rows)
            more = [pa.array(to.astype("int32")), pa.array((lot % cells).astype("int32")), pa.array(lot)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "shard", "cell", "draw"])

    dealt = held.mapInArrow(permute, schema)
    # second permutation: a random cell of the shard, then a random order inside it
    dealt = checkpoint(dealt)
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    base = dealt.groupBy("shard", "cell").count().withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0))).select("shard", "cell", "before")
    order = Window.partitionBy("shard", "cell").orderBy("draw", *[c for c in rows.columns if c in ("doc_id", "text_crc32")])
    return dealt.withColumn("nth", F.row_number().over(order)).join(base, ["shard", "cell"]).withColumn("slot", F.col("before") + F.col("nth") - 1).drop("nth", "before", "cell", "draw")


def shard_documents(docs: DataFrame, shards: int = 16, seed: int = 42) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard; null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    digest = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    out = shard(digest, shards, seed)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
