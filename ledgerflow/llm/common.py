"""Shared helpers: Arrow batches of bounded size, word tables over raw bytes, fold rules, checkpoints."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.sources.readers import spread
from ledgerflow.sources.stored import Scratch, written  # noqa: F401 - for the operators beside

#: Bytes of text and rows handled at once inside a task; a longer single text is handled alone.
SLICE_BYTES, SLICE_ROWS = 1 << 20, 512

_TEXT = "__text"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    # Python workers find the package where the driver has it
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spread(spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def literal_rows(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A small fixed table made of literals."""
    built = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row, strict=True)]) for row in rows])
    return spark.range(1).select(F.inline(built))


def stable(df: DataFrame) -> DataFrame:
    """``df`` with rows that come in the same order on every attempt of a task, so that numbers given to them hold.

    Blocks of a shuffle arrive in any order: behind one the rows are stored first. A plain scan is left as it is.
    """
    return written(df) if "Exchange" in df._jdf.queryExecution().executedPlan().toString() else df


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty string."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % parts


def own(df: DataFrame, columns: list[str], name: str = "__page") -> Column:
    """The caller's columns as one struct: whatever their names, they meet none of an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in columns]).alias(name) if columns else F.struct(F.lit(0).alias("__none")).alias(name)


def with_own(columns: list[str], name: str = "__page") -> list[Column]:
    """The columns that ``own`` packed, by their names."""
    return [F.col(f"`{name}`.`{c}`").alias(c) for c in columns]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Cut a record batch so that each part holds about ``limit`` bytes of ``column``, or one row, and at most ``rows`` rows."""
    n = batch.num_rows
    if n == 0:
        return
    _, offsets = text_bytes(batch.column(column))
    start = 0
    while start < n:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(n, start + rows, max(stop, start + 1))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts back to back, and n + 1 offsets; a null text is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(texts.type)
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def map_texts(
    df: DataFrame,
    text_col: str,
    new: list[tuple[str, T.DataType]],
    make: Callable[[], Callable[[pa.Array], list[pa.Array]]],
    keep: list[str] | None = None,
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """Add columns computed from whole texts in Arrow batches of about ``limit`` bytes.

    ``make`` runs once in each task and returns the function from a text array to the arrays
    of the new columns. Columns of ``df`` whose names clash with new ones are replaced.
    """
    names = [n for n, _ in new]
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    fields = [f for c in kept for f in df.schema.fields if f.name == c]
    schema = T.StructType([*fields, *(T.StructField(n, t) for n, t in new)])
    # a text that is kept travels once
    twice = text_col not in kept or df.schema[text_col].dataType != T.StringType()
    source = df.select(*[F.col(f"`{c}`") for c in kept], *([F.col(f"`{text_col}`").cast("string").alias(_TEXT)] if twice else []))
    column = _TEXT if twice else text_col

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, column, limit):
                texts = part.column(column)
                arrays = [part.column(i) for i in range(len(kept))] + work(texts)
                yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *names])

    return source.mapInArrow(run, schema)


def _lut(word: Callable[[int], bool]) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for b in range(256):
        low = b + 32 if 0x41 <= b <= 0x5A else b
        table[b] = low if word(low) else 0
    return table


#: Byte table of words: A-Z lowered, 0 for bytes that separate words.
ALNUM = _lut(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)


class Words:
    """Words of a batch of texts: lowered bytes, start and end of each word, words per text."""

    def __init__(self, texts: pa.Array, table: np.ndarray = ALNUM):
        raw, self.offsets = text_bytes(texts)
        self.n_texts = len(self.offsets) - 1
        self.low = table[raw]
        inside = self.low != 0
        edge = np.zeros(len(raw) + 1, bool)
        edge[self.offsets] = True
        first, last = inside.copy(), inside.copy()
        if len(raw):
            first[1:] &= ~inside[:-1] | edge[1:-1]
            last[:-1] &= ~inside[1:] | edge[1:-1]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.bounds)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_texts), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        return span_hashes(self.low, self.starts, self.ends)


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

#: Power tables of this worker process, the largest size met so far.
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(SLICE_BYTES * 2, 1 << (max(1, n) - 1).bit_length())
    if size not in _TABLES:
        _TABLES.clear()
        with np.errstate(over="ignore"):
            _TABLES[size] = tuple(np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size, b, np.uint64)])) for b in (_BASE, _INVERSE))
    return _TABLES[size]


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every input bit over 64 output bits."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of data[s:e] for every span, from prefix sums of a polynomial modulo 2**64.

    A hash does not depend on the place, so that long data are taken block by block; spans come sorted by start.
    """
    if len(data) > 2 * SLICE_BYTES and len(starts) > 1:
        cuts = np.unique(np.searchsorted(starts, np.arange(0, len(data) + SLICE_BYTES, SLICE_BYTES)))
        parts = [_span_hashes(data[starts[a] : ends[a:b].max()], starts[a:b] - starts[a], ends[a:b] - starts[a]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return np.concatenate(parts)
    return _span_hashes(data, starts, ends)


def _span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    power, inverse = _powers(len(data))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def blocks_of(n: int, size: int = 4 * SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(start, end) of consecutive stretches of at most ``size`` of n places."""
    for start in range(0, n, size):
        yield start, min(n, start + size)
