"""Turning text into vectors with a function the caller supplies."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from findry.functions.text import NOT_WORD, words

# Bytes of text an embedder is given at once; a longer text comes alone.
TEXT_BYTES = 1 << 20

Embedder = Callable[[Sequence[str]], Iterable[Sequence[float]]]


def in_parts(texts: pa.Array, most: int = TEXT_BYTES) -> Iterable[pa.Array]:
    """A text array in parts of at most ``most`` bytes or one text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
    at = 0
    while at < len(texts):
        done = ends[at - 1] if at else 0
        # Empty texts take room too.
        end = min(max(at + 1, int(np.searchsorted(ends, done + most, side="right"))), at + max(1, most // 64))
        yield texts.slice(at, end - at)
        at = end


def embed(text: Column, embedder: Embedder) -> Column:
    """Embed a text column.

    ``embedder`` takes a list of texts (a part of an Arrow batch, so that a task's memory does not
    follow the size of batches) and returns one vector per text, in order.  Null texts are embedded as empty ones.
    """

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def run(batch: pa.Array) -> pa.Array:
        parts = [embedded([t or "" for t in part.to_pylist()]) for part in in_parts(batch)]
        vectors = np.concatenate(parts) if parts else np.empty((0, 0))
        offsets = pa.array(np.arange(len(batch) + 1) * vectors.shape[1], pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.array(vectors.ravel()))

    def embedded(texts):
        vectors = embedder(texts)
        if not isinstance(vectors, np.ndarray):
            vectors = np.array(list(vectors))
        vectors = vectors.astype(np.float64, copy=False)
        if vectors.shape[0] != len(texts) or vectors.ndim != 2:
            raise ValueError("the embedder must return one equal-length vector per text")
        return vectors

    return run(text)


@lru_cache(1 << 16)
def _hashed(word: str) -> int:
    return int(hashlib.md5(word.encode()).hexdigest(), 16)


class HashedWords:
    """Bag-of-words embedder: each word adds one to the bucket its hash falls in."""

    def __init__(self, dim: int = 64):
        self.dim = dim

    def __call__(self, texts: Sequence[str]) -> np.ndarray:
        pieces = pc.split_pattern_regex(pa.array([t.lower() for t in texts], pa.string()), NOT_WORD)
        row = np.repeat(np.arange(len(texts)), pc.list_value_length(pieces).to_numpy())
        coded = pieces.flatten().dictionary_encode()
        # The hash of each distinct word is taken once; gaps at the ends split off empty ones.
        bucket = np.array([_hashed(w) % self.dim if w else -1 for w in coded.dictionary.to_pylist()], np.int64)
        bucket = bucket[coded.indices.to_numpy()] if len(bucket) else np.empty(0, np.int64)
        real = bucket >= 0
        counts = np.bincount(row[real] * self.dim + bucket[real], minlength=len(texts) * self.dim)
        return counts.reshape(len(texts), self.dim).astype(np.float64)


def hashed_word_counts(table: DataFrame, id_column: str, text_column: str,
                       dim: int = 64) -> DataFrame:
    """Non-zero entries of :class:`HashedWords` as rows ``(id, bucket, n)``.

    Runs without Python.  A power-of-two ``dim`` up to 65,536 is taken from the last
    four hex digits of the hash; copies of a word are combined before the shuffle.
    """
    if dim < 1 or dim > 65536 or dim & (dim - 1):
        raise ValueError("dim must be a power of two up to 65536")
    word = table.select(F.col(id_column), F.explode(words(F.col(text_column))).alias("word"))
    tail = F.conv(F.substring(F.md5(F.col("word").cast("binary")), 29, 4), 16, 10).cast("int")
    return (word.select(id_column, (tail % dim).alias("bucket"))
            .groupBy(id_column, "bucket").agg(F.count("*").alias("n")))
