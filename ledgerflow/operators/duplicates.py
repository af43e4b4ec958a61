"""Repeated keys without shuffling every key.

Each row's key falls into one of ``bits`` hash buckets. Tasks mark in two bitmaps which buckets they hit
once and which twice; the bitmaps of all tasks meet in chunks of 32,768 buckets, and a bucket that two
tasks hit counts as hit twice. Only rows of buckets hit twice can repeat a key: they alone are
shuffled and compared by their keys, so that the result is exact whatever the number of buckets.

The bitmaps have a fixed size (``bits`` / 8 bytes each), however many rows there are. With eight buckets
for each row about one row in eight is compared beside the real repeats; far below one bucket for
each row nearly all are, and the filter saves nothing.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.sources.stored import Scratch

# functions travel to the workers by value, which so need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 1 << 25
_CHUNK = 1 << 15
_WORDS = _CHUNK // 64


def bucket_of(keys: Sequence[str], bits: int) -> Column:
    parts = [p for k in keys for p in (F.col(k), F.col(k).isNull())]
    return F.pmod(F.xxhash64(*parts), F.lit(bits))


def _marks(batches: Iterator[pa.RecordBatch], bits: int) -> tuple[np.ndarray, np.ndarray]:
    once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
    for batch in batches:
        found, count = np.unique(batch.column(0).to_numpy(), return_counts=True)
        place, bit = found >> 3, np.left_shift(1, found & 7).astype(np.uint8)
        again = (once[place] & bit != 0) | (count > 1)
        np.bitwise_or.at(twice, place[again], bit[again])
        np.bitwise_or.at(once, place, bit)
    return once, twice


def hit_twice(df: DataFrame, keys: Sequence[str], bits: int = BITS) -> DataFrame:
    """(chunk, words) of the chunks with a bucket that more than one row hits."""
    bits = max(_CHUNK, bits // _CHUNK * _CHUNK)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = (m.reshape(-1, _CHUNK // 8) for m in _marks(batches, bits))
        for chunk in np.flatnonzero(once.any(axis=1)).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([once[chunk].tobytes()]), pa.array([twice[chunk].tobytes()])], names=["chunk", "once", "twice"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, once, twice = None, None, None

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at]), pa.array([twice.view(np.int64).tolist()], pa.list_(pa.int64()))], names=["chunk", "words"])

        for batch in batches:
            for chunk, a, b in zip(*(batch.column(n).to_pylist() for n in ("chunk", "once", "twice")), strict=True):
                a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
                if chunk != at:
                    if at is not None and twice.any():
                        yield out()
                    at, once, twice = chunk, a.copy(), b.copy()
                else:
                    twice |= b | (once & a)
                    once |= a
        if at is not None and twice.any():
            yield out()

    partial = df.select(bucket_of(keys, bits).alias("bucket")).mapInArrow(mark, "chunk long, once binary, twice binary")
    return partial.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(meet, "chunk long, words array<long>")


def suspects(df: DataFrame, keys: Sequence[str], bits: int = BITS, scratch: Scratch | None = None) -> DataFrame:
    """The rows whose bucket another row hits as well."""
    bits = max(_CHUNK, bits // _CHUNK * _CHUNK)
    # at most bits / 8 bytes, whatever the rows
    marks = F.broadcast((scratch or Scratch()).written(hit_twice(df, keys, bits)))
    placed = _placed(df, keys, bits)
    met = placed.join(marks, placed["__chunk"] == marks["chunk"])
    return met.filter(_is_marked()).drop("__chunk", "__word", "__bit", "chunk", "words")


def _placed(df: DataFrame, keys: Sequence[str], bits: int) -> DataFrame:
    """``df`` with the chunk, word and bit of each row's bucket."""
    bucket = bucket_of(keys, bits)
    # little-endian words: bit b of byte a is bit 8 a + b of the chunk
    within = F.pmod(bucket, F.lit(_CHUNK))
    return df.withColumns({"__chunk": F.floor(bucket / _CHUNK).cast("long"), "__word": F.floor(within / 64).cast("int"), "__bit": F.pmod(within, F.lit(64)).cast("int")})


def _is_marked() -> Column:
    return F.getbit(F.get("words", F.col("__word")), F.col("__bit")) == 1


def apart(table: DataFrame, keys: Sequence[str], scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of a stored table whose key no other row has, and all other rows.

    Only 64-bit hashes of keys are shuffled. Those of more than one row are marked in a bitmap of fixed size, by which each row
    is judged where it lies. Rows that share no key may be among the others, never the other way round.
    """
    scratch = scratch or Scratch()
    parts = [p for k in keys for p in (F.col(k), F.col(k).isNull())]
    hashed = table.select(F.xxhash64(*parts).alias("__hash"))
    repeated = scratch.written(hashed.groupBy("__hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("__hash"))
    bits = min(MOST_BITS, max(_CHUNK, 1 << (16 * repeated.count()).bit_length()))
    # each hash is listed twice, so that its bucket is hit twice
    listed = repeated.withColumn("twice", F.explode(F.array(F.lit(0), F.lit(1)))).select("__hash")
    marks = F.broadcast(scratch.written(hit_twice(listed, ["__hash"], bits)))
    placed = _placed(table.withColumn("__hash", F.xxhash64(*parts)), ["__hash"], bits).join(marks, F.col("__chunk") == F.col("chunk"), "left")
    marked = F.coalesce(_is_marked(), F.lit(False))
    return tuple(placed.filter(which).select(*table.columns) for which in (~marked, marked))


def repeated_keys(df: DataFrame, keys: Sequence[str], bits: int = BITS, scratch: Scratch | None = None) -> DataFrame:
    """(keys, rows) of the keys that more than one row has; null is a value like any other."""
    some = suspects(df.select(*keys), keys, bits, scratch)
    return some.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


#: Rows of a table between which bitmaps pay: fewer are soon shuffled, more fill bitmaps of MOST_BITS.
LEAST_ROWS, MOST_BITS = 2_000_000, 1 << 28


def of_stored(table: DataFrame, keys: Sequence[str], scratch: Scratch | None = None) -> DataFrame:
    """``repeated_keys`` of a stored table, which is counted for nothing: by bitmaps of eight buckets a row where they pay, else by grouping all keys."""
    n = table.count()
    if LEAST_ROWS <= n <= MOST_BITS:
        return repeated_keys(table, keys, min(MOST_BITS, 1 << (8 * n - 1).bit_length()), scratch)
    return table.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
