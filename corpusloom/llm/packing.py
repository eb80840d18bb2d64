"""Best-fit-decreasing packing of tokenised documents into sequences of fixed length.

Lengths are whole numbers from 1 to the sequence length, so best-fit decreasing over *all* documents needs
their histogram only. ``plan`` takes lengths in falling order and asks a segment tree over remaining capacities
for the tightest open bin that still fits; equal documents that meet equal bins are placed at once, as a range
of sequence numbers. The plan's size depends on the sequence length, never on the number of documents. Each
piece then finds its place from its rank among pieces of its length; ranks come from counts per salt, so that no
length, however common, is numbered in one task.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm.arrow import texts
from corpusloom.storage import materialize

END = 2
#: Tokens added to the byte-level vocabulary: wherever the string stands in a text it is this id, and parts what stands around it.
ADDED = {"<|endoftext|>": 50256}
_ADDED = re.compile("(" + "|".join(map(re.escape, ADDED)) + ")")
#: Letters, digits and the rest as the vocabulary's pattern cuts them, for texts of ASCII and Latin letters alone.
_PLAIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ɏ]+| ?[0-9]+| ?[^\sA-Za-zÀ-ɏ0-9]+|\s+(?!\S)|\s+")
_OTHER = re.compile(r"[^\x00-\x1b\x20-\x7fÀ-ÖØ-öø-ɏ‐-‧₠-₿]")


class Encoder:
    """Ids of the byte-level vocabulary, by the rank table that holds the same merges.

    Cut pieces repeat, so their ids are remembered, up to ``memory`` pieces; texts with letters outside the Latin
    blocks go to the library whole.
    """

    def __init__(self, path: str, memory: int = 400_000):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.enc = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.memory, self.known = memory, {}

    def __call__(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if "<|" not in text:
            return self.ordinary(text)
        parts = _ADDED.split(text)  # every other part is an added token
        return b"".join(ADDED[p].to_bytes(4, "little") if k % 2 else self.ordinary(p) for k, p in enumerate(parts) if p)

    def ordinary(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        if _OTHER.search(text):
            return np.asarray(self.enc.encode_ordinary(text), dtype="<u4").tobytes()
        parts, known = _PLAIN.findall(text), self.known
        try:
            return b"".join(map(known.__getitem__, parts))
        except KeyError:
            pass
        if len(known) > self.memory:
            known.clear()
        encode = self.enc.encode_ordinary
        for p in set(parts).difference(known):
            known[p] = np.asarray(encode(p), dtype="<u4").tobytes()
        return b"".join(map(known.__getitem__, parts))


class SegmentTree:
    """Which remaining capacities have open bins; ``tightest`` is logarithmic in the sequence length."""

    def __init__(self, capacity: int):
        self.n = 1 << capacity.bit_length()
        self.tree = np.zeros(2 * self.n, dtype=np.int64)

    def add(self, capacity: int, bins: int) -> None:
        i = capacity + self.n
        while i:
            self.tree[i] += bins
            i >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest capacity >= least with an open bin."""
        i = least + self.n
        if self.tree[i]:
            return least
        while i > 1:
            if not i & 1 and self.tree[i + 1]:
                i += 1
                while i < self.n:
                    i = 2 * i if self.tree[2 * i] else 2 * i + 1
                return i - self.n
            i >>= 1
        return None


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int]]:
    """(length, first rank, first sequence, offset) of each run of placed pieces, by best-fit decreasing."""
    tree, bins = SegmentTree(capacity), defaultdict(list)  # remaining capacity -> ranges [first, end) of sequences
    runs, sequences = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                per = max(1, capacity // length)  # a new bin takes as many of this length as fit
                room, first, end = capacity, sequences, sequences + -(-left // per)
                sequences = end
            else:
                first, end = bins[room].pop()
                tree.add(room, first - end)
            # each bin of the range takes one piece; the tightest open bin is then asked for anew
            n = min(left, end - first)
            runs.append((length, rank, first, capacity - room))
            rank, left = rank + n, left - n
            for lo, hi, rest in ((first, first + n, room - length), (first + n, end, room)):
                if hi > lo and rest:
                    bins[rest].append((lo, hi))
                    tree.add(rest, hi - lo)
    return runs


def pieces(docs: DataFrame, vocabulary: str, capacity: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, tie: documents cut where they pass the capacity, the first piece the shorter."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, tie long"

    def run(batches):
        encode = Encoder(vocabulary)
        for batch in batches:
            out = [[] for _ in range(6)]
            for doc, tie, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), texts(batch.column(1)), strict=True):
                ids = encode(text.decode("utf-8", "replace")) + END.to_bytes(4, "little")
                n = len(ids) // 4
                at, end, k = 0, n % capacity or capacity, 0
                while at < n:
                    for c, v in zip(out, (doc, k, at, end - at, zlib.crc32(ids[4 * at : 4 * end]), tie), strict=True):
                        c.append(v)
                    at, end, k = end, end + capacity, k + 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(out, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32", "tie"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("doc_id", F.monotonically_increasing_id()).alias("tie")).mapInArrow(run, schema)


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = 1024, salts: int = 0) -> DataFrame:
    """Pieces of all documents with sequence_id and offset.

    A null text is empty and packs as its end token; a null doc_id keeps its row; repeated rows are packed each;
    an empty table gives an empty result. ``vocabulary`` is the rank file of the byte-level vocabulary. ``salts``
    deals each length to that many numbering tasks (0: by the number of pieces, about 50,000 a task).
    """
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    cut = materialize(pieces(docs, vocabulary, capacity), "pieces")
    histogram = {r.length: r["count"] for r in cut.groupBy("length").count().collect()}  # at most `capacity` rows
    runs = plan(histogram, capacity)
    n = sum(histogram.values())
    salts = salts or max(8, -(-n // 50_000))
    cut = cut.withColumn("salt", F.pmod(F.col("tie"), F.lit(salts)).cast("int"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = cut.groupBy("length", "salt").count().withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    within = Window.partitionBy("length", "salt").orderBy("tie", "doc_id", "piece")
    ranked = cut.withColumn("nth", F.row_number().over(within)).join(base, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("nth") - 1)

    # the plan's size is bounded by the capacity alone: a run needs a split of a range of equal bins
    keys = np.array([r[0] << 44 | r[1] for r in runs], dtype=np.int64)
    order = np.argsort(keys)
    keys, ranks, firsts, offsets = keys[order], *(np.array([r[i] for r in runs], dtype=np.int64)[order] for i in (1, 2, 3))

    def place(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            length, rank = (t.column(c).to_numpy().astype(np.int64) for c in ("length", "rank"))
            at = np.searchsorted(keys, length << 44 | rank, side="right") - 1
            cols = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(firsts[at] + rank - ranks[at]), pa.array(offsets[at])], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
