"""Near-duplicates by SimHash with bit-sliced comparison.

Two ways to candidates share one comparison. ``exact_links`` finds *every* pair of 64-bit fingerprints at radius
2 or less: such a pair agrees on at least two of four 16-bit quarters, so each fingerprint is filed under its six
pairs of quarters. ``near_copies`` files documents under bands of minimum shingle hashes, leaves out pairs whose wider
fingerprints are beyond a cosine radius and counts the shared shingles of the rest. Within a file, distances are taken
many at a time: the differences' bit planes lie vertically (one word holds one bit of 64 pairs), carry-save counters
add the planes, and a block of pairs is abandoned once all of it exceeds the radius. ``operators.neardup`` deals large
files to tasks.

Null and empty texts have fingerprint zero; texts of any length are read whole; repeated rows and equal texts share a
class, and each row keeps its own row; ties have no part, as components do not depend on order; an empty table gives
an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.arrow import texts
from corpusloom.operators import neardup
from corpusloom.operators.components import components
from corpusloom.operators.neardup import Near, alike, bucket_links, scramble, shingle_hashes
from corpusloom.storage import materialize

QUARTERS = list(combinations(range(4), 2))
_MIX = np.array([0, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)


def simhash(h: np.ndarray, words: int = 1) -> np.ndarray:
    """Fingerprint of 64-bit words; a bit is 1 if it is set in more than half of the hashes."""
    out = np.zeros(words, dtype=np.uint64)
    for k in range(words if len(h) else 0):
        ones = np.zeros(64, dtype=np.int64)
        for at in range(0, len(h), 65_536):
            x = h[at : at + 65_536] if not k else scramble(h[at : at + 65_536], _MIX[k])
            ones += np.unpackbits(x.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        out[k] = np.packbits((2 * ones > len(h)).astype(np.uint8), bitorder="little").view(np.uint64)[0]
    return out


def within(differences: np.ndarray, radius: int, lanes: int = 4096) -> np.ndarray:
    """Which rows of ``differences`` (pairs x words, the exclusive or of two fingerprints) have at most ``radius`` bits set."""
    n, words = differences.shape
    near = np.zeros(n, dtype=bool)
    levels = int(radius).bit_length() + 1
    for at in range(0, n, lanes):
        block = np.ascontiguousarray(differences[at : at + lanes])
        m = len(block)
        size = -(-m // 64) * 8
        count = [np.zeros(size // 8, dtype=np.uint64) for _ in range(levels)]
        over = np.zeros(size // 8, dtype=np.uint64)  # pairs whose counter has run over: beyond the radius for good
        dead = False
        for byte in range(8 * words):
            bits = np.unpackbits(block.view(np.uint8)[:, byte : byte + 1], axis=1, bitorder="little")
            planes = np.zeros((8, size), dtype=np.uint8)
            planes[:, : -(-m // 8)] = np.packbits(bits, axis=0, bitorder="little").T
            for carry in planes.view(np.uint64):
                for k in range(levels):
                    count[k], carry = count[k] ^ carry, count[k] & carry
                over |= carry
            if byte % 2:
                # greater than the radius: compare the vertical counters with the constant from the top bit down
                more, same = over.copy(), ~over
                for k in range(levels - 1, -1, -1):
                    if radius >> k & 1:
                        same &= count[k]
                    else:
                        more |= same & count[k]
                        same &= ~count[k]
                lanes_over = np.unpackbits(more.view(np.uint8), bitorder="little")[:m]
                dead = bool(lanes_over.all())
                if dead:
                    break
        if not dead:
            near[at : at + m] = lanes_over == 0
    return near


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id and print (binary): the 64-bit SimHash over shingles, repeats included."""

    def run(batches):
        for batch in batches:
            out = [simhash(shingle_hashes(text, words)).astype(">u8").tobytes() for text in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, type=pa.binary())], names=["doc_id", "print"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, print binary")


def _prints(table: pa.Table) -> np.ndarray:
    """Rows of 64-bit words of the column ``print``."""
    column = table.column("print").to_pylist()
    return np.frombuffer(b"".join(column), dtype=np.uint64).reshape(len(column), -1)


def at_radius(radius: int):
    """Comparison of fingerprints alone."""

    def near_of(table: pa.Table) -> Near:
        prints = _prints(table)
        return lambda q, rows: within(prints[rows] ^ prints[q], radius)

    return near_of


def at_radius_and_counted(radius: int, similarity: float):
    """Comparison of fingerprints, then of the shared shingles of those within the radius."""

    def near_of(table: pa.Table) -> Near:
        prints, sets = _prints(table), [np.frombuffer(s, dtype=np.uint32) for s in table.column("shingles").to_pylist()]

        def near(q: np.ndarray, rows: np.ndarray) -> np.ndarray:
            out = within(prints[rows] ^ prints[q], radius)
            at = np.flatnonzero(out)
            out[at] = alike(sets, q[at], rows[at], similarity)
            return out

        return near

    return near_of


def exact_links(docs: DataFrame, words: int = 3, radius: int = 2, tile: int = 4096) -> DataFrame:
    """doc_id, fingerprint, component_id: components of all pairs at ``radius`` (2 or less) or fewer differing bits.

    Texts without words have fingerprint zero and link like any other; null texts are empty. Rows without doc_id
    get their component's smallest doc_id (null if it has none). Repeated rows stay, one row out for each row in; rows of
    different texts that share a doc_id are documents of their own.
    """
    if not 0 <= radius <= 2:
        raise ValueError("four quarters find every pair at radius 0, 1 or 2 alone")
    prints = materialize(fingerprints(docs, words), "prints")
    reps = prints.groupBy("print").agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null").select(F.struct("doc_id", "print").alias("id"), "print")
    quarter = [F.substring("print", 2 * k + 1, 2) for k in range(4)]
    keys = F.array(*[F.xxhash64(F.lit(k), quarter[a], quarter[b]) for k, (a, b) in enumerate(QUARTERS)])
    links = bucket_links(reps.select(F.explode(keys).alias("key"), "id", F.lit(8).cast("long").alias("bytes")), reps, at_radius(radius), tile)
    found = components(links)
    home = reps.join(found, reps["id"] == found["node"], "left").select("print", F.coalesce("component", "id")["doc_id"].alias("component_id"))
    return prints.join(home, "print", "left").select("doc_id", F.lower(F.hex("print")).alias("fingerprint"), "component_id")


def near_copies(docs: DataFrame, words: int = 5, similarity: float = 0.8, width: int = 4, slack: float = 6.0, tile: int = 512) -> DataFrame:
    """doc_id, tie and component_id, as ``neardup.near_copies`` with a fingerprint before the count.

    A share s of equal shingles is a cosine of 2s / (1 + s) or more; SimHash leaves out pairs whose distance exceeds that
    angle's by ``slack`` standard errors, and the shared shingles of the others are counted.
    """
    angle = np.arccos(2 * similarity / (1 + similarity)) / np.pi
    bits = 64 * width
    radius = int(bits * angle + slack * np.sqrt(bits * angle * (1 - angle)))
    more = {"print": lambda u: simhash(u, width).astype(">u8").tobytes()}
    return neardup.near_copies(docs, words, similarity, tile=tile, more=more, near_of=at_radius_and_counted(radius, similarity))
