"""Arrow batches cut into pieces of bounded size: a batch has as many rows as Spark gives it, however long its texts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def pieces(column: pa.Array, most: int = 1 << 20, rows: int = 512) -> Iterator[pa.Array]:
    """Slices, in order, of at most ``rows`` rows and, where they have several, at most ``most`` bytes of text or items of lists."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    kind = column.type
    sizes = pc.list_value_length(column) if pa.types.is_list(kind) or pa.types.is_large_list(kind) else pc.binary_length(column)
    ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    lo = 0
    while lo < len(column):
        before = ends[lo - 1] if lo else 0
        hi = min(max(int(np.searchsorted(ends, before + most, side="right")), lo + 1), lo + rows)
        yield column.slice(lo, hi - lo)
        lo = hi


def joined(made: Iterable[pa.Array], kind: pa.DataType) -> pa.Array:
    """What was made of a batch's pieces, as one array; Spark leaves an iterator's function inside another's argument unplanned."""
    some = list(made)
    return pa.concat_arrays(some) if some else pa.array([], type=kind)
