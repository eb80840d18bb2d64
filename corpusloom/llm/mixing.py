"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic. The cells' token counts are raked until their marginals meet
the targets; a cell's factor (raked over observed share) gives each of its documents its inclusion probability, scaled
so that the expected number of tokens is the asked share, with probabilities at most 1. Documents are then drawn
independently by a hash, which gives the same sample on every run.

Topics are clusters of hashed three-byte profiles around centroids fitted on all documents: profiles are written once,
and each round of k-means adds up its clusters' profiles partition by partition. Null source or language
is a category of its own; null and empty texts have no tokens and a topic of their own, and are drawn as their
cell is. Rows that repeat doc_id and text share one draw; an empty table gives an empty result; texts of any length are
read whole; other columns pass through, but those named as a result column (in any case) are replaced. Every category is raked for itself: on the driver up to ``most_cells``
cells, beyond that by aggregations over the table of cells.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.arrow import texts, wider, without
from corpusloom.storage import materialize

BINS = 1024
NONE = "\x00none"
AXES = ("source", "lang", "topic")


def counts(text: bytes) -> np.ndarray:
    """Counts of hashed three-byte windows of the ASCII-lowered text."""
    b = np.frombuffer(text.lower(), dtype=np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(BINS, dtype=np.int64)
    g = (b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]) * np.uint32(2654435761) >> np.uint32(22)
    return np.bincount(g, minlength=BINS)


#: Logarithms of small counts, looked up.
LOGS = np.log1p(np.arange(1 << 16))


def damped(n: np.ndarray) -> np.ndarray:
    """Logarithms of rows of counts, each row of unit length."""
    x = LOGS[n] if n.max(initial=0) < len(LOGS) else np.log1p(n)
    return x / np.maximum(np.sqrt((x * x).sum(-1, keepdims=True)), 1e-12)


def profile(text: bytes) -> np.ndarray:
    """Damped counts of a text, of unit length."""
    return damped(counts(text))


def token_count(text: bytes) -> int:
    """White-space separated words."""
    b = np.frombuffer(text, dtype=np.uint8)
    space = (b == 32) | ((b >= 9) & (b <= 13))
    return int((~space[1:] & space[:-1]).sum() + (len(b) > 0 and not space[0]))


#: Type of the counts of a row by its bytes.
WIDTHS = {BINS: np.uint8, 2 * BINS: np.uint16, 8 * BINS: np.int64}


def _packed(n: np.ndarray) -> bytes:
    top = n.max()
    return n.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.int64).tobytes()


def _profiles(docs: DataFrame) -> DataFrame:
    """id, tie, n: counts of each text of three bytes or more, in 8 or 16 bits each where they fit, else in 64."""

    def run(batches):
        for batch in batches:
            t = list(texts(batch.column(2)))
            use = np.array([len(x) >= 3 for x in t], dtype=bool)
            n = [counts(x) for x, u in zip(t, use, strict=True) if u]
            packed = pa.array([_packed(x) for x in n], type=pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(use)), batch.column(1).filter(pa.array(use)), packed], names=["id", "tie", "n"])

    last = F.lit(2**63 - 1)
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), last).alias("id"), F.xxhash64("text").alias("tie"), "text")
    return keyed.mapInArrow(run, "id long, tie long, n binary")


def _unpacked(n: bytes) -> np.ndarray:
    return np.frombuffer(n, dtype=WIDTHS[len(n)]).astype(np.int64)


#: Rows whose profiles are computed at once, to stay in a core's cache.
SLICE = 64


def _slices(column):
    """First row and damped profiles of each slice of a batch."""
    held = list(texts(column))
    for lo in range(0, len(held), SLICE):
        n = np.empty((len(held[lo : lo + SLICE]), BINS), dtype=np.int64)
        for i, row in enumerate(held[lo : lo + SLICE]):
            n[i] = np.frombuffer(row, dtype=WIDTHS[len(row)])
        yield lo, damped(n)


def _farthest(profiles: DataFrame, chosen: np.ndarray):
    """The row that is least like its nearest of ``chosen``, the first by id and tie."""

    def run(batches):
        best = None
        for batch in batches:
            ids, ties = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, x in _slices(batch.column(2)):
                near = np.round((x @ chosen.T).max(1), 9)
                low = near.min()
                k = min((lo + int(i) for i in np.flatnonzero(near == low)), key=lambda i: (ids[i], ties[i]))
                if best is None or (low, ids[k], ties[k]) < best[:3]:
                    best = (float(low), ids[k], ties[k], batch.column(2)[k].as_py())
        if best is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in best], names=["near", "id", "tie", "n"])

    return profiles.mapInArrow(run, "near double, id long, tie long, n binary").orderBy("near", "id", "tie").limit(1).collect()


def _sums(profiles: DataFrame, c: np.ndarray, most_sums: int = 64) -> np.ndarray:
    """Sum of the profiles nearest to each centroid, in steps of 2^-32: whole numbers add up alike in any order."""

    def emit(total):
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], type=pa.binary())], names=["total"])

    def run(batches):
        total = np.zeros(c.shape, dtype=np.int64)
        for batch in batches:
            for _, x in _slices(batch.column(0)):
                member = np.round(x @ c.T, 9).argmax(1) == np.arange(len(c))[:, None]
                # a slice's sums stay under 2^53, so floats hold them exactly
                total += (member.astype(np.float64) @ np.rint(x * 2.0**32)).astype(np.int64)
        yield from emit(total)

    def merge(batches):
        total = np.zeros(c.shape, dtype=np.int64)
        for batch in batches:
            for b in texts(batch.column(0)):
                total += np.frombuffer(b, dtype=np.int64).reshape(c.shape)
        yield from emit(total)

    sums, parts = profiles.select("n").mapInArrow(run, "total binary"), profiles.rdd.getNumPartitions()
    if parts > most_sums:  # the driver gets at most so many sums, whatever the table's size
        sums = sums.repartition(most_sums).mapInArrow(merge, "total binary")
    return sum((np.frombuffer(r.total, dtype=np.int64).reshape(c.shape) for r in sums.collect()), np.zeros(c.shape, dtype=np.int64))


def topic_centroids(docs: DataFrame, topics: int = 8, rounds: int = 12) -> np.ndarray:
    """Spherical k-means over all documents; starts from the farthest points, so that it needs no random numbers.

    One row for each topic found: distinct profiles may be fewer than ``topics``.
    """
    profiles = materialize(_profiles(docs), "profiles")
    first = profiles.orderBy("id", "tie").limit(1).collect()
    if not first:
        return np.zeros((1, BINS))
    c = damped(_unpacked(first[0].n))[None]
    while len(c) < topics:
        (r,) = _farthest(profiles, c)
        if r.near >= 1 - 1e-9:
            break
        c = np.concatenate([c, damped(_unpacked(r.n))[None]])
    for _ in range(rounds):
        total = _sums(profiles, c).astype(np.float64)
        new = np.where(total.any(1, keepdims=True), total, c)
        new /= np.maximum(np.sqrt((new * new).sum(1, keepdims=True)), 1e-12)
        if np.array_equal(new, c):
            break
        c = new
    return c


def describe(docs: DataFrame, fitted: np.ndarray, keep_text: bool = True) -> DataFrame:
    """``docs`` with topic (-1 for texts too short to have one) and tokens; without ``keep_text`` the text stays behind."""
    docs = without(docs, "topic", "tokens", "weight", "probability", "sampled")
    kept = docs if keep_text else without(docs, "text")
    names = kept.columns

    def run(batches):
        for batch in batches:
            t = list(texts(batch.column(batch.schema.get_field_index("text"))))
            topic = np.full(len(t), -1, dtype=np.int32)
            for lo in range(0, len(t), SLICE):
                n = np.array([counts(x) for x in t[lo : lo + SLICE]])
                topic[lo : lo + SLICE] = np.where(n.any(1), np.round(damped(n) @ fitted.T, 9).argmax(1), -1)
            tokens = pa.array([token_count(x) for x in t], type=pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(c)) for c in names], pa.array(topic), tokens], names=[*names, "topic", "tokens"])

    return docs.mapInArrow(run, wider(kept, "topic int, tokens long"))


def rake(counts: np.ndarray, places: list[np.ndarray], targets: list[np.ndarray], rounds: int = 500, tolerance: float = 1e-9) -> np.ndarray:
    """Shares of cells whose marginals meet the targets. places: for each axis, each cell's category."""
    x = counts / counts.sum()
    targets = [t / t.sum() for t in targets]
    for _ in range(rounds):
        worst = 0.0
        for place, target in zip(places, targets, strict=True):
            now = np.bincount(place, weights=x, minlength=len(target))
            factor = np.divide(target, now, out=np.ones_like(target), where=now > 0)
            x = x * factor[place]
            worst = max(worst, float(np.abs(now - target).max()))
        if worst < tolerance:
            break
    return x


def calibrate(tokens: np.ndarray, factor: np.ndarray, share: float) -> np.ndarray:
    """Probabilities min(1, scale * factor) whose expected tokens are ``share`` of all."""
    goal, lo, hi = share * tokens.sum(), 0.0, 1.0
    reach = lambda s: (tokens * np.minimum(1, s * factor)).sum()
    while reach(hi) < goal * (1 - 1e-12) and hi < 1e18:
        hi *= 2
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if reach(mid) < goal else (lo, mid)
    return np.minimum(1, hi * factor)


def _category(name: str):
    return F.coalesce(F.col(name).cast("string"), F.lit(NONE)).alias(f"_{name}")


KEYS = [f"_{a}" for a in AXES]
CELLS = "_source string, _lang string, _topic string, weight double, probability double"


def _raked(cells: DataFrame, share: float, temper: float, targets: dict[str, dict]) -> DataFrame:
    """Weight and probability of each cell, computed on the driver."""
    rows = sorted(tuple(r[k] for k in KEYS) + (int(r["n"]),) for r in cells.collect())
    tokens = np.array([r[3] for r in rows], dtype=np.float64)
    if tokens.sum() > 0:
        places, wanted = [], []
        for k, a in enumerate(AXES):
            names, place = np.unique(np.array([r[k] for r in rows], dtype=object), return_inverse=True)
            observed = np.bincount(place, weights=tokens, minlength=len(names))
            goal = {str(x): w for x, w in targets.get(a, {}).items()}
            target = np.array([goal.get(x, 0.0) for x in names]) if goal else (observed / observed.sum()) ** temper
            target = np.where(observed > 0, target, 0.0)
            places.append(place)
            wanted.append(target if target.sum() > 0 else observed)
        raked = rake(tokens, places, wanted)
        factor = np.divide(raked, tokens / tokens.sum(), out=np.ones_like(raked), where=tokens > 0)
        probability = calibrate(tokens, factor, share)
    else:
        factor, probability = np.ones(len(rows)), np.full(len(rows), share)
    made = [(*r[:3], float(f), float(p)) for r, f, p in zip(rows, factor, probability, strict=True)]
    return F.broadcast(cells.sparkSession.createDataFrame(made, CELLS))


def _raked_in_frames(cells: DataFrame, share: float, temper: float, targets: dict[str, dict], rounds: int = 500, tolerance: float = 1e-9) -> DataFrame:
    """The same by aggregations, for any number of cells: a factor for each category of an axis, fitted in turn."""
    spark = cells.sparkSession
    total = float(cells.agg(F.sum("n")).first()[0] or 0)
    if not total:
        return cells.select(*KEYS, F.lit(1.0).alias("weight"), F.lit(share).cast("double").alias("probability"))
    factors = {}
    for a, k in zip(AXES, KEYS, strict=True):
        observed = cells.groupBy(k).agg((F.sum("n") / total).alias("x"))
        goal = [(str(x), float(w)) for x, w in targets.get(a, {}).items()]
        if goal:
            found = observed.join(spark.createDataFrame(goal, f"{k} string, w double"), k, "left").withColumn("t", F.coalesce("w", F.lit(0.0)))
        else:
            found = observed.withColumn("t", F.pow("x", F.lit(float(temper))))
        found = found.withColumn("t", F.when(F.col("x") > 0, F.col("t")).otherwise(0.0))
        all_of = float(found.agg(F.sum("t")).first()[0])
        goal_share = F.col("t") / all_of if all_of > 0 else F.col("x")
        factors[k] = materialize(found.select(k, goal_share.alias(f"t{k}"), F.lit(1.0).alias(f"f{k}")), "factors")

    def weighed():
        x = cells
        for k in KEYS:
            x = x.join(factors[k], k)
        return x.withColumn("raked", F.col("n") / total * F.col("f_source") * F.col("f_lang") * F.col("f_topic"))

    for _ in range(rounds):
        worst = 0.0
        for k in KEYS:
            now = weighed().groupBy(k, f"t{k}", f"f{k}").agg(F.sum("raked").alias("now"))
            ratio = F.when(F.col("now") > 0, F.col(f"t{k}") / F.col("now")).otherwise(1.0)
            table = materialize(now.select(k, f"t{k}", (F.col(f"f{k}") * ratio).alias(f"f{k}"), F.abs(F.col("now") - F.col(f"t{k}")).alias("off")), "factors")
            worst = max(worst, float(table.agg(F.max("off")).first()[0]))
            factors[k] = table.drop("off")
        if worst < tolerance:
            break
    weight = F.when(F.col("n") > 0, F.col("f_source") * F.col("f_lang") * F.col("f_topic")).otherwise(1.0)
    done = materialize(weighed().select(*KEYS, "n", weight.alias("weight")), "cells")
    # the scale between two powers of two, then 64 parts of the interval at a time
    goal, lo, hi = share * total, 0.0, 2.0**60
    reach = lambda scales: [float(x) for x in done.agg(*[F.sum(F.col("n") * F.least(F.lit(1.0), F.lit(s) * F.col("weight"))).alias(f"r{i}") for i, s in enumerate(scales)]).first()]
    grid = [2.0**k for k in range(-20, 61)]
    for _ in range(10):
        got = reach(grid)
        over = next((i for i, r in enumerate(got) if r >= goal * (1 - 1e-12)), None)
        if over is None:
            break
        hi, lo = grid[over], grid[over - 1] if over else lo
        grid = [lo + (hi - lo) * k / 64 for k in range(1, 65)]
    return done.select(*KEYS, "weight", F.least(F.lit(1.0), F.lit(hi) * F.col("weight")).alias("probability"))


def mix(described: DataFrame, share: float = 0.5, temper: float = 0.5, targets: dict[str, dict] | None = None, most_cells: int = 100_000) -> DataFrame:
    """``described`` with weight, probability and sampled.

    ``targets`` maps an axis to the weights of its categories; an axis without them takes its observed shares to the
    power ``temper``. Up to ``most_cells`` cells are raked on the driver and broadcast; more stay in tables.
    """
    keyed = described.select("*", *[_category(a) for a in AXES])
    cells = materialize(keyed.groupBy(*KEYS).agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")), "cells")
    few = cells.limit(most_cells + 1).count() <= most_cells
    table = (_raked if few else _raked_in_frames)(cells, share, temper, targets or {})
    out = keyed.join(table, KEYS, "left").drop(*KEYS)
    return out.withColumn("sampled", F.col("_draw") < F.col("probability")).drop("_draw")


def with_draw(docs: DataFrame, seed: int = 42) -> DataFrame:
    """A number in [0, 1) from doc_id and text, the same on every run."""
    return without(docs, "_draw").withColumn("_draw", F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")), 11) / F.lit(float(2**53)))
