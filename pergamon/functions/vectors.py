"""Embedding columns and the hyperplanes of the approximate search."""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from pergamon.functions.text import tokens

_CELLS = 4_000_000  # float64 cells a Python worker holds at a time


def _buckets(words, dimension):
    """Bucket of each word: the first 32 bits of its MD5, modulo the dimension.

    Each different word of the batch is hashed once.
    """
    encoded = words.dictionary_encode()
    of_word = np.array(
        [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % dimension
         for w in encoded.dictionary.to_pylist()],
        dtype=np.int64,
    )
    return of_word[encoded.indices.to_numpy()]


def _count_vectors(offsets, flat, dimension):
    """Unit-length bucket counts of consecutive rows, as float32."""
    rows = len(offsets) - 1
    row_of = np.repeat(np.arange(rows), np.diff(offsets))
    counts = np.bincount(row_of * dimension + flat, minlength=rows * dimension)
    counts = counts.reshape(rows, dimension).astype(np.float64)
    norms = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
    return np.divide(counts, norms, out=np.zeros_like(counts), where=norms > 0).astype(np.float32)


def _word_vectors(words, dimension):
    """Vectors of an Arrow batch of word lists, a limited number of cells at a time."""
    if len(words) == 0:
        return pa.array([], pa.list_(pa.float32()))
    offsets = np.asarray(words.offsets)
    flat = _buckets(words.values.slice(offsets[0], offsets[-1] - offsets[0]), dimension)
    offsets = offsets - offsets[0]
    step = max(1, _CELLS // dimension)
    parts = []
    for i in range(0, len(offsets) - 1, step):
        ends = offsets[i:i + step + 1]
        parts.append(_count_vectors(ends - ends[0], flat[ends[0]:ends[-1]], dimension))
    values = np.concatenate(parts)
    ends = np.arange(len(values) + 1, dtype=np.int32) * dimension
    return pa.ListArray.from_arrays(ends, pa.array(values.ravel()))


def hashed_embedding(text, dimension=64):
    """Deterministic stand-in for a served model: hashed word counts of unit length.

    Spark cuts the text into words; hashing and counting an Arrow batch, which no built-in does
    without a shuffle, is numpy. Empty text gives the zero vector.
    """

    @arrow_udf(T.ArrayType(T.FloatType()))
    def vectors(words: pa.Array) -> pa.Array:
        return _word_vectors(words, dimension)

    # else a filter on the vector is moved below, and every text is embedded a second time for it
    return vectors.asNondeterministic()(F.coalesce(tokens(text), F.array().cast("array<string>")))


def hyperplanes(tables, bits, dimension):
    """Signs of shape (tables, bits, dimension), each the low bit of an MD5: the same anywhere."""
    signs = [
        1.0 if hashlib.md5(f"{t}:{b}:{d}".encode()).digest()[0] % 2 == 0 else -1.0
        for t in range(tables) for b in range(bits) for d in range(dimension)
    ]
    return np.array(signs).reshape(tables, bits, dimension)


def signatures(vectors, planes):
    """Bucket of each vector in each table, shape (rows, tables): one bit per side of a plane."""
    tables, bits, dimension = planes.shape
    sides = (vectors @ planes.reshape(tables * bits, dimension).T) > 0
    return sides.reshape(len(vectors), tables, bits) @ (1 << np.arange(bits))
