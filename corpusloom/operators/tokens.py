"""Shards of a split looked at and joined, token ids by a given vocabulary, and small position tables."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.functions.pieces import pieces

END = "<|endoftext|>"


def sample_statistics(docs: DataFrame, share: float = 0.1, seed: int = 42, shard: str = "shard", separator: str = "\n") -> DataFrame:
    """One row over some shards of a split, taken by hash: documents, mean paragraphs, mean words; ``share`` 1 takes all."""
    chosen = docs.where(F.pmod(F.xxhash64(F.col(shard), F.lit(seed)), F.lit(10_000)) < int(share * 10_000))
    text = F.coalesce("text", F.lit(""))
    paragraphs = F.size(F.filter(F.split(text, separator), lambda x: F.btrim(x) != ""))
    return chosen.agg(F.count(F.lit(1)).alias("n_docs"), F.avg(paragraphs).alias("mean_paragraphs"), F.avg(F.size(T.words(text))).alias("mean_words"))


def delimited(docs: DataFrame, order: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """(value, and columns to ``keep``) lines of one text of all documents with the end mark behind each; write with ``write.text``."""
    return docs.orderBy(order).select(*keep, F.concat(F.coalesce("text", F.lit("")), F.lit("\n" + END)).alias("value"))


@lru_cache(2)
def _tokenizer(vocabulary: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary)


def _ids_of(batches: Iterator[pa.Array], made) -> Iterator[pa.Array]:
    """Piece by piece and text by text: what the library keeps of a token besides its id is many times its text."""
    for piece in chain.from_iterable(map(pieces, batches)):
        ids = [np.array(made.encode(v.as_py() or "", add_special_tokens=False).ids, dtype=np.int32) for v in piece]
        ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
        yield pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))


def _texts_of(batches: Iterator[pa.Array], made) -> Iterator[pa.Array]:
    for piece in chain.from_iterable(map(pieces, batches)):
        yield pa.array([made.decode(v.as_py() or [], skip_special_tokens=False) for v in piece], type=pa.string())


def encoded(text: Column, vocabulary: str) -> Column:
    """Ids of a text by a tokenizer file; an end mark in the text is its own id. Null is no ids."""

    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _ids_of(batches, _tokenizer(vocabulary))

    return run(text)


def decoded(ids: Column, vocabulary: str) -> Column:
    """The text of ids, end marks included."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _texts_of(batches, _tokenizer(vocabulary))

    return run(ids)


def position_table(rows: Column, columns: int = 256) -> Column:
    """A row's position vector: the decimal written ``r + 1`` . ``c + 1``, of which only the last digit of the column counts."""
    return F.transform(F.sequence(F.lit(0), F.lit(columns - 1)), lambda c: F.concat_ws(".", (rows + 1).cast("string"), ((c + 1) % 10).cast("string")).cast("double"))


def embedded(vectors: Column, position: Column) -> Column:
    """Token vectors plus the position's."""
    return F.zip_with(vectors, position, lambda a, b: a + b)
