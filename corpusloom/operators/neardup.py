"""Near duplicates: bands of minimum hashes bring documents together, and what two of them share is counted.

Documents are filed under keys; within a key every pair is a candidate. A key of more rows than a tile is first compared
with one of its rows, the pivot, in groups of a tile's size. Rows that these links join need no comparison with each
other, so a large group of copies costs one comparison a row; the rest of the key meets all of it tile by tile, in
different tasks. Only links that join something new are kept, so output stays below the number of filed rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.components import components
from corpusloom.storage import materialize

WORD = re.compile(rb"[^\x20\x09-\x0d]+")
#: Whether rows a[i] and b[i] of a batch are linked.
Near = Callable[[np.ndarray, np.ndarray], np.ndarray]


def utf8(column) -> Iterator[bytes]:
    """UTF-8 bytes of each row of an Arrow string or binary column; null counts as empty."""
    for x in column.cast(pa.large_binary()):
        yield x.as_py() or b""


def shingle_hashes(text: bytes, n: int) -> np.ndarray:
    """XXH64 (seed 42) of each n-word shingle of the ASCII-lowered text; of the whole sequence if it is shorter."""
    words = WORD.findall(text.lower())
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) <= n:
        return np.array([h(join(words), 42)], dtype=np.uint64)
    return np.array([h(join(s), 42) for s in zip(*(words[i:] for i in range(n)), strict=False)], dtype=np.uint64)


def scramble(h: np.ndarray, by: np.uint64) -> np.ndarray:
    """Another hash of the same shingles."""
    x = h ^ by
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def least_hashes(u: np.ndarray, lanes: np.ndarray) -> np.ndarray:
    """The minimum of each of several hashes of a set: its well-mixed members times odd numbers."""
    u = u if len(u) else np.zeros(1, dtype=np.uint64)
    out = np.full(len(lanes), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(u), 2048):
        np.minimum(out, (lanes[:, None] * u[None, at : at + 2048]).min(1), out=out)
    return out


def lanes_of(n: int) -> np.ndarray:
    return scramble(np.arange(1, n + 1, dtype=np.uint64), np.uint64(0x5851F42D4C957F2D)) | np.uint64(1)


def band_keys(u: np.ndarray, lanes: np.ndarray, bands: int) -> list[int]:
    """One key a band, of as many minimum hashes as fall to it."""
    least = least_hashes(u, lanes).reshape(bands, -1)
    mixed = np.arange(bands, dtype=np.uint64)
    for r in range(least.shape[1]):
        mixed = scramble(mixed, least[:, r])
    return mixed.view(np.int64).tolist()


def alike(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets ``a[i]`` and ``b[i]`` (sorted, distinct) share at least ``similarity`` of their union, counted exactly."""
    out = np.zeros(len(a), dtype=bool)
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = sets[x], sets[y]
        if len(x) > len(y):
            x, y = y, x
        if not len(x) or len(x) < similarity * len(y) - 1e-9:
            continue  # sizes alone rule it out
        at = np.searchsorted(y, x)
        shared = int((y[np.minimum(at, len(y) - 1)] == x).sum())
        out[k] = shared >= similarity * (len(x) + len(y) - shared) - 1e-9
    return out


def spanning_links(starts: np.ndarray, near: Near, side: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links (row, row) that join rows of each group (``starts``: first row of each, and the end) as all its links would.

    Every group walks breadth-first in step with the others: in a round each compares one row with its rows not yet
    reached. With ``side`` (0 or 1) only rows of different sides are compared.
    """
    sizes = np.diff(starts)
    group = np.repeat(np.arange(len(sizes)), sizes)
    reached = np.zeros(len(group), dtype=bool)
    queues: dict[int, list[int]] = {g: [] for g in np.flatnonzero(sizes > 1).tolist()}
    left_rows, right_rows = [], []
    first_open = {g: int(starts[g]) for g in queues}
    query = np.full(len(sizes), -1, dtype=np.int64)
    open_rows = np.flatnonzero(np.isin(group, list(queues)))
    while queues:
        query[:] = -1
        for g in list(queues):
            if queues[g]:
                query[g] = queues[g].pop()
                continue
            i, end = first_open[g], int(starts[g + 1])
            while i < end and reached[i]:
                i += 1
            first_open[g] = i + 1
            if i >= end - 1 and (side is None or i >= end):
                del queues[g]
                continue
            query[g] = i
            reached[i] = True
        open_rows = open_rows[~reached[open_rows]]
        q = query[group[open_rows]]
        rows, q = open_rows[q >= 0], q[q >= 0]
        if side is not None:
            other = side[rows] != side[q]
            rows, q = rows[other], q[other]
        if len(rows):
            linked = near(q, rows)
            rows, q = rows[linked], q[linked]
            reached[rows] = True
            left_rows.append(q)
            right_rows.append(rows)
            for r in rows.tolist():
                queues[int(group[r])].append(r)
        for g in [g for g in queues if not queues[g] and first_open[g] >= starts[g + 1]]:
            del queues[g]
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate(left_rows or [none]), np.concatenate(right_rows or [none])


def compared(dealt: DataFrame, near_of: Callable[[pa.Table], Near], group_bytes: int = 1 << 25) -> DataFrame:
    """(a, b): links within the groups (key, i, j) of ``dealt`` (key, i, j, id, side, payload); where i <> j, between sides alone."""
    dealt = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "id")
    schema = dealt.select(F.col("id").alias("a"), F.col("id").alias("b")).schema

    def link(batches):
        def flush(table):
            key, i, j, side = (table.column(c).to_numpy() for c in ("key", "i", "j", "side"))
            ids = table.column("id").combine_chunks()
            new = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            starts = np.concatenate([[0], new, [len(key)]])
            sizes = np.diff(starts)
            cross = i != j
            for which in (False, True):
                rows = np.flatnonzero(np.repeat(sizes > 1, sizes) & (cross == which))
                if not len(rows):
                    continue
                g = np.repeat(np.arange(len(sizes)), sizes)[rows]
                local = np.concatenate([[0], np.flatnonzero(g[1:] != g[:-1]) + 1, [len(rows)]])
                a, b = spanning_links(local, near_of(table.take(pa.array(rows))), side[rows] if which else None)
                if len(a):
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows[a])), ids.take(pa.array(rows[b]))], names=["a", "b"])

        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows < 20_000 and held.nbytes < group_bytes:
                continue
            # the last group may go on in the next batch; a group is at most two tiles
            cols = [held.column(c).to_numpy() for c in ("key", "i", "j")]
            same = np.logical_and.reduce([c == c[-1] for c in cols])
            last = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if last:
                yield from flush(held.slice(0, last))
                held = held.slice(last)
        if held is not None and held.num_rows:
            yield from flush(held)

    return dealt.mapInArrow(link, schema)


def bucket_links(filed: DataFrame, payload: DataFrame, near_of: Callable[[pa.Table], Near], tile: int, tile_bytes: int = 1 << 25) -> DataFrame:
    """(a, b) from ``filed`` (key long, id, bytes long): within a key, linked ids, all but redundant links.

    ``payload`` (id, ...) joins the rows dealt to tiles; ``near_of`` turns a batch of them into the comparison. Of keys that
    hold the same ids one is compared. A tile ends at ``tile`` rows or ``tile_bytes``.
    """
    members = [F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"), F.min("id").alias("low"), F.max("id").alias("high")]
    n = filed.groupBy("key").agg(F.count(F.lit(1)).alias("rows_of_key"), F.sum("bytes").alias("bytes_of_key"), *members).where("rows_of_key > 1")
    n = n.groupBy("rows_of_key", "bytes_of_key", "x", "y", "low", "high").agg(F.min("key").alias("key"))
    tiles = F.ceil(F.greatest(F.col("rows_of_key") / tile, F.col("bytes_of_key") / tile_bytes)).cast("int")
    n = materialize(n.select("key", tiles.alias("tiles"), F.col("low").alias("pivot")), "keys")
    one, zero = F.lit(1), F.lit(0)
    few = filed.join(n.where("tiles = 1"), "key").select("key", zero.alias("i"), zero.alias("j"), "id", zero.alias("side"))
    hot = n.where("tiles > 1")
    if not hot.limit(1).count():
        return compared(few.join(payload, "id"), near_of, tile_bytes)
    rows = materialize(filed.join(hot, "key"), "hot")
    # a group's number is negative on one side, so that it counts as two sides
    salt = F.pmod(F.xxhash64("id", "key"), F.col("tiles")).cast("int")
    pivots = hot.select("key", F.explode(F.sequence(zero, F.col("tiles") - 1)).alias("i"), F.col("pivot").alias("id"), one.alias("side"))
    others = rows.where("id <> pivot").select("key", salt.alias("i"), "id", zero.alias("side"))
    first = pivots.unionByName(others).select("key", "i", (-1 - F.col("i")).alias("j"), "id", "side")
    known = materialize(compared(few.unionByName(first).join(payload, "id"), near_of, tile_bytes), "pivot_links")
    home = components(known)
    at = rows.join(home.select(F.col("node").alias("id"), "component"), "id", "left").join(home.select(F.col("node").alias("pivot"), F.col("component").alias("main")), "pivot", "left")
    at = at.withColumn("rest", ~F.coalesce((F.col("component") == F.col("main")) | (F.col("id") == F.col("pivot")), F.lit(False)))
    at = materialize(at.select("key", "id", "bytes", "rest"), "rest")
    share = lambda flag: F.ceil(F.greatest(F.count(F.when(flag, 1)) / tile, F.coalesce(F.sum(F.when(flag, F.col("bytes"))), F.lit(0)) / tile_bytes)).cast("int")
    left = at.groupBy("key").agg(share(F.col("rest")).alias("u"), share(~F.col("rest")).alias("c")).where("u > 0")
    # tiles 0 to u - 1 hold the rest, the c tiles behind them what the pivot's component holds already
    own = F.when(F.col("rest"), F.pmod(F.xxhash64("id"), F.col("u"))).otherwise(F.col("u") + F.pmod(F.xxhash64("id"), F.greatest(F.col("c"), one))).cast("int")
    last = F.when(F.col("rest"), F.col("u") + F.col("c")).otherwise(F.col("u")) - 1
    pair = F.explode(F.transform(F.sequence(zero, last), lambda t: F.struct(F.least(t, F.col("own")).alias("i"), F.greatest(t, F.col("own")).alias("j"))))
    second = at.join(left, "key").withColumn("own", own).withColumn("pair", pair).select("key", "pair.i", "pair.j", "id", (F.col("own") == F.col("pair.j")).cast("int").alias("side"))
    return known.unionByName(compared(second.join(payload, "id"), near_of, tile_bytes))


def sketches(docs: DataFrame, words: int, bands: int, rows: int, more: dict[str, Callable[[np.ndarray], bytes]] | None = None) -> DataFrame:
    """doc_id, tie (a hash of the text), set (16 bytes that stand for the shingle set), keys (one a band), shingles (the
    set: sorted 32-bit hashes, 4 bytes a distinct shingle), and binary columns that ``more`` makes of the set's hashes."""
    more = more or {}

    def run(batches):
        lanes = lanes_of(bands * rows)
        for batch in batches:
            sets, keys, shingles, extra = [], [], [], [[] for _ in more]
            for text in utf8(batch.column(2)):
                u = np.unique(shingle_hashes(text, words))
                sets.append(xxhash.xxh3_128_digest(u.tobytes()))
                shingles.append(np.unique(u.astype(np.uint32)).tobytes())
                keys.append(band_keys(u, lanes, bands))
                for column, f in zip(extra, more.values(), strict=True):
                    column.append(f(u))
            made = [pa.array(sets, type=pa.binary()), pa.array(keys, type=pa.list_(pa.int64())), pa.array(shingles, type=pa.binary()), *[pa.array(c, type=pa.binary()) for c in extra]]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names=["doc_id", "tie", "set", "keys", "shingles", *more])

    schema = "doc_id long, tie long, set binary, keys array<long>, shingles binary" + "".join(f", {c} binary" for c in more)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), "text").mapInArrow(run, schema)


def counted(similarity: float) -> Callable[[pa.Table], Near]:
    """Comparison of the column ``shingles``: the share of equal shingles is ``similarity`` or more."""

    def near_of(table: pa.Table) -> Near:
        sets = [np.frombuffer(s, dtype=np.uint32) for s in table.column("shingles").to_pylist()]
        return lambda q, rows: alike(sets, q, rows, similarity)

    return near_of


def near_copies(docs: DataFrame, words: int = 5, similarity: float = 0.8, bands: int = 16, rows: int = 3, tile: int = 512, more: dict | None = None, near_of: Callable[[pa.Table], Near] | None = None) -> DataFrame:
    """doc_id, tie, component and component_id: components of documents whose shingle sets' similarity (Jaccard) is ``similarity`` or more.

    Documents of one shingle set are one class before anything is compared. Bands of minimum hashes bring classes
    together: of pairs at 0.8 they miss one in 100,000, of nearer ones fewer; the shared shingles of candidates are counted
    (32-bit hashes). Null and empty texts are one class, without other links. A class is known by its smallest doc_id and
    its set, so rows of different texts that share a doc_id stay apart; ``component`` is the smallest class, component_id its doc_id. Rows
    without doc_id belong to the class of their set; a class of such rows alone has component_id null. One row out for
    each row in, repeats included; ``tie`` is a hash of the text, which tells rows of one doc_id apart.
    """
    made = materialize(sketches(docs, words, bands, rows, more), "sketches")
    payload = ["shingles", *(more or {})]
    known = made.where("doc_id is not null")
    reps = known.groupBy("set").agg(F.min("doc_id").alias("doc_id"), F.min("keys").alias("keys"), F.min(F.octet_length("shingles")).cast("long").alias("bytes"))
    reps = reps.select(F.struct("doc_id", "set").alias("id"), "keys", "bytes", "set")
    filed = reps.select(F.explode("keys").alias("key"), "id", "bytes")
    contents = known.select(F.struct("doc_id", "set").alias("id"), *payload).groupBy("id").agg(*[F.first(c).alias(c) for c in payload]) if _repeats(known) else known.select(F.struct("doc_id", "set").alias("id"), *payload)
    links = bucket_links(filed, contents, near_of or counted(similarity), tile)
    found = components(links)
    home = reps.join(found, reps["id"] == found["node"], "left").select("set", F.coalesce("component", "id").alias("component"))
    return made.select("doc_id", "tie", "set").join(home, "set", "left").select("doc_id", "tie", "component", F.col("component.doc_id").alias("component_id"))


def _repeats(known: DataFrame) -> bool:
    """Whether a doc_id and set occur more than once, so that contents must be made distinct before they join."""
    return known.groupBy("doc_id", "set").count().where("count > 1").limit(1).count() > 0


def across(left: DataFrame, right: DataFrame, words: int = 5, similarity: float = 0.8, bands: int = 16, rows: int = 3) -> DataFrame:
    """(a): ids of ``left`` (doc_id, text) that are like some text of ``right``, whose ids must be others.

    Bands bring texts of the two sides together; one partner is enough, so a band keeps for each set one id a side, and the
    shared shingles are counted pair by pair where bands meet.
    """
    made = lambda df: sketches(df, words, bands, rows).groupBy("set").agg(F.min("keys").alias("keys"), F.min("shingles").alias("shingles"), F.min("doc_id").alias("doc_id"))
    held = materialize(sketches(left, words, bands, rows).select("doc_id", "set"), "left")
    one, two = materialize(made(left), "left_sets"), materialize(made(right), "right_sets")
    same = one.join(two, "set", "left_semi").select("set")
    pairs = one.select(F.explode("keys").alias("key"), F.col("set").alias("x")).join(two.select(F.explode("keys").alias("key"), F.col("set").alias("y")), "key").where("x <> y").select("x", "y").distinct()
    pairs = pairs.join(one.select(F.col("set").alias("x"), F.col("shingles").alias("p")), "x").join(two.select(F.col("set").alias("y"), F.col("shingles").alias("q")), "y")

    def compare(batches):
        for batch in batches:
            sets = [np.frombuffer(s, dtype=np.uint32) for c in ("p", "q") for s in batch.column(batch.schema.get_field_index(c)).to_pylist()]
            n = batch.num_rows
            near = alike(sets, np.arange(n), np.arange(n, 2 * n), similarity)
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("x")).filter(pa.array(near))], names=["set"])

    found = pairs.select("x", "p", "q").mapInArrow(compare, "set binary").unionByName(same).distinct()
    return held.join(found, "set", "left_semi").select(F.col("doc_id").alias("a"))
