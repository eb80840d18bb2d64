"""Small helpers for Arrow-batched operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.pieces import pieces


def texts(column) -> Iterator[bytes]:
    """UTF-8 bytes of each row of a string column, without decoding; null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary())
    if not len(column):
        return
    import numpy as np

    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1].tolist()
    data = memoryview(column.buffers()[2] or b"")
    if column.null_count:
        for i, ok in enumerate(column.is_valid().to_pylist()):
            yield bytes(data[offsets[i] : offsets[i + 1]]) if ok else b""
    else:
        for i in range(len(column)):
            yield bytes(data[offsets[i] : offsets[i + 1]])


def slices(batch: pa.RecordBatch, column: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """A batch's rows in order, about ``most`` bytes of a string column at a time: what is sent back at once has a bound too."""
    lo = 0
    for piece in pieces(batch.column(column), most, 4096):
        yield batch.slice(lo, len(piece))
        lo += len(piece)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns of these names in any case, so that new ones can take the names."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns if c.lower() not in gone])


def wider(df: DataFrame, more: str) -> T.StructType:
    """The schema of ``df`` with the columns of a DDL string behind it."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(more).fields])
