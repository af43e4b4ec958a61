"""Fill-in-middle transformation by secondary sort.

A text is a row of units: runs of A-Z and a-z, and single other code points. Two unit bounds, drawn
from a hash of the document id, part it into prefix, middle and suffix. The output is the plain
text, ``<P>``prefix``<S>``suffix``<M>``middle (psm) or ``<S>``suffix``<P>``prefix``<M>``middle (spm).

Tasks over the documents emit pieces: stretches of whole units of at most ``piece_bytes`` (a longer
unit is cut), keyed by document and place in the output. Repartitioned by document and sorted by
place within partitions, the pieces stream through incremental digests, so that no task holds an
output. The same stream is read back: marks are found in the output itself, and what lies between
them gets its place in the text again. A second sort within the same partitions, without a
shuffle, brings these pieces into the order of the text for the digest of the restored text.

A document is known by two hashes of id and text. Rows that repeat both send the same pieces; of
each place the first counts, and every row has a result. A null text is empty, a null id counts as
the empty string. Texts that hold a mark, and empty ones, stay plain. Columns named as one of the
new ones are replaced. Empty input gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import SLICE_BYTES, blocks_of, own, slices, text_bytes, with_own

PREFIX, SUFFIX, MIDDLE = MARKS = (b"<P>", b"<S>", b"<M>")
#: Marks in the order of the output, and the part of the text that follows each.
FORMS = {"plain": (), "psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}
PART = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
PIECE_BYTES = 1 << 16
#: Rows and bytes after which a task hands on what it has.
FLUSH_ROWS = 4096

NEW = ("n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256", "output", "restored")

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_FOLLOWS = (np.arange(256) & 0xC0) == 0x80


def unit_starts(data: np.ndarray, inside: bool = False) -> np.ndarray:
    """Mask of the bytes that start a unit; ``inside`` says that the byte before is a letter."""
    letter = _LETTER[data]
    starts = ~(letter | _FOLLOWS[data])
    after = np.empty_like(letter)
    after[:1] = inside
    after[1:] = letter[:-1]
    return starts | (letter & ~after)


def _marked(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(start of a block, places of its units)."""
    for a, b in blocks_of(len(data)):
        yield a, np.flatnonzero(unit_starts(data[a:b], a > 0 and bool(_LETTER[data[a - 1]])))


def cut(data: np.ndarray, first: int, second: int) -> tuple[int, int, int]:
    """(units, byte where the middle starts, byte where it ends) for two drawn numbers."""
    marked = list(_marked(data)) if len(data) <= 4 * SLICE_BYTES else None
    n = sum(len(units) for _, units in (marked or _marked(data)))
    low, high = sorted((first % (n + 1), second % (n + 1)))
    places, before = {n: len(data)}, 0
    for a, units in marked or _marked(data):
        for u in (low, high):
            if before <= u < before + len(units):
                places[u] = a + int(units[u - before])
        before += len(units)
    return n, places[low], places[high]


def points(data: np.ndarray) -> int:
    return sum(int(np.count_nonzero(~_FOLLOWS[data[a:b]])) for a, b in blocks_of(len(data)))


def stretches(data: np.ndarray, start: int, end: int, size: int) -> Iterator[tuple[int, int]]:
    """Stretches of at most ``size`` bytes that end between units; within a unit only where it is longer."""
    while end - start > size:
        units = np.flatnonzero(unit_starts(data[start : start + size + 1], start > 0 and bool(_LETTER[data[start - 1]])))
        stop = start + int(units[-1]) if len(units) and units[-1] > 0 else start + size
        yield start, stop
        start = stop
    if end > start:
        yield start, end


class _Out:
    """Rows of pieces and heads, handed on in Arrow batches."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, row: tuple, size: int = 0) -> None:
        self.rows.append(row)
        self.size += size

    def full(self) -> bool:
        return len(self.rows) >= FLUSH_ROWS or self.size >= SLICE_BYTES

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) if self.rows else [[]] * len(self.schema)
        arrays = [_pages(c, f.type) if f.name == "__page" else pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)]
        self.rows, self.size = [], 0
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def _pages(column: list, kind: pa.DataType) -> pa.Array:
    """One array of one-row arrays and None."""
    there = [p for p in column if p is not None]
    where = iter(range(len(there)))
    place = pa.array([None if p is None else next(where) for p in column], pa.int32())
    return pa.concat_arrays(there).take(place) if there else pa.nulls(len(column), kind)


class Restorer:
    """Cuts a streamed output at its marks; gives (part of the text, bytes)."""

    def __init__(self, form: str):
        self.marks, self.found, self.rest = FORMS[form], 0, b""

    def feed(self, chunk: bytes) -> Iterator[tuple[int, bytes]]:
        data, self.rest = self.rest + chunk, b""
        while self.found < len(self.marks):
            at = data.find(self.marks[self.found])
            if at < 0:
                # a mark may go on in the next piece
                data, self.rest = data[: max(0, len(data) - 2)], data[max(0, len(data) - 2) :]
                break
            yield from self._part(data[:at])
            data = data[at + len(self.marks[self.found]) :]
            self.found += 1
        yield from self._part(data)

    def _part(self, data: bytes) -> Iterator[tuple[int, bytes]]:
        if not data:
            return
        if self.marks and not self.found:
            raise ValueError("an output does not start with its first mark")
        yield PART[self.marks[self.found - 1]] if self.marks else 0, data

    def end(self) -> Iterator[tuple[int, bytes]]:
        if self.found < len(self.marks):
            raise ValueError("an output lacks a mark")
        yield from self._part(self.rest)


#: What a head row says of its document, beside the caller's columns.
_HEAD = [("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()), ("middle_chars", T.LongType())]
_KEY = [("r1", T.LongType()), ("r2", T.LongType()), ("place", T.LongType())]


def _schema(page: T.DataType, extra: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in [*_KEY, ("__page", page), *_HEAD, *extra, ("piece", T.BinaryType())]])


def _arrow(schema: T.StructType, batch: pa.RecordBatch) -> pa.Schema:
    """The Arrow schema of rows that carry the batch's pages."""
    kinds = {T.LongType(): pa.int64(), T.StringType(): pa.string(), T.BinaryType(): pa.binary()}
    return pa.schema([(f.name, batch.schema.field("__page").type if f.name == "__page" else kinds[f.dataType]) for f in schema.fields])


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, seed: int = 1, plain_percent: int = 10, spm_percent: int = 20, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Rows of the outputs in order: for each document a head (place -1) with the caller's columns, then its pieces.

    All rows of a document are in one partition, sorted by place.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in NEW]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    ident = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), ident), 256)
    numbers = [F.conv(F.substring(drawn, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    source = docs.select(own(docs, kept), F.xxhash64(ident, text).alias("r1"), F.xxhash64(F.lit(1), ident, text).alias("r2"), *numbers, text.alias("__text"))
    schema = _schema(source.schema["__page"].dataType, [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            out = out or _Out(_arrow(schema, batch))
            for part in slices(batch, "__text"):
                raw, offsets = text_bytes(part.column("__text"))
                page = part.column("__page")
                numbers = zip(*(part.column(c).to_pylist() for c in ("r1", "r2", "h1", "h2", "h3", "h4")), strict=True)
                for i, (r1, r2, h1, h2, h3, h4) in enumerate(numbers):
                    data = raw[offsets[i] : offsets[i + 1]]
                    n, low, high = cut(data, h1, h2)
                    whole = data.tobytes()
                    if not n or any(m in whole for m in MARKS) or h3 % 100 >= 100 - plain_percent:
                        form, parts = "plain", [(b"", 0, len(data))]
                    else:
                        form = "spm" if h4 % 100 < spm_percent else "psm"
                        spans = {PREFIX: (0, low), MIDDLE: (low, high), SUFFIX: (high, len(data))}
                        parts = [(m, *spans[m]) for m in FORMS[form]]
                    chars = (None, None) if form == "plain" else (points(data[:low]), points(data[low:high]))
                    out.add((r1, r2, -1, page.slice(i, 1), n, form, *chars, None))
                    place = 0
                    for mark, start, end in parts:
                        for a, b in stretches(data, start, end, piece_bytes) if end > start else [(start, start)]:
                            if mark or b > a:
                                out.add((r1, r2, place, None, None, None, None, None, mark + whole[a:b]), b - a)
                                place += 1
                            mark = b""
                            if out.full():
                                yield out.batch()
                yield out.batch()

    sent = source.mapInArrow(run, schema)
    return sent.repartition("r1", "r2").sortWithinPartitions("r1", "r2", "place")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(what, key, value) in order: "head" with page and head columns, "piece" with its bytes, "end" of a document."""
    key, place = None, None
    for batch in batches:
        page, piece = batch.column("__page"), batch.column("piece")
        named = [batch.column(n).to_pylist() for n in batch.schema.names if n not in ("__page", "piece")]
        for i, row in enumerate(zip(*named, strict=True)):
            if row[:2] != key:
                if key is not None:
                    yield "end", key, None
                key, place = row[:2], None
            if row[2] == -1:
                yield "head", key, (page.slice(i, 1), *row[3:])
            elif row[2] != place:
                yield "piece", key, piece[i].as_py()
            place = row[2]
    if key is not None:
        yield "end", key, None


def _streamed(schema: T.StructType, make) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task that shows each row in turn to the step of ``make(out)``, and hands on what the step adds to ``out``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        out = _Out(_arrow(schema, first))
        step = make(out)
        for what, key, value in _documents(chain([first], batches)):
            step(what, key, value)
            if out.full():
                yield out.batch()
        yield out.batch()

    return run


def output_digests(sorted_pieces: DataFrame, texts: bool = False) -> DataFrame:
    """Heads with the output's digest, and the pieces of the output cut at its marks, sorted for restoration.

    ``texts`` puts the whole output into its head as well.
    """
    schema = _schema(sorted_pieces.schema["__page"].dataType, [("output_sha256", T.StringType()), ("output", T.StringType())])

    def make(out: _Out):
        heads, whole, digest, restorer, count = [], [], hashlib.sha256(), None, 0

        def step(what: str, key: tuple, value) -> None:
            nonlocal heads, whole, digest, restorer, count
            if what == "head":
                heads.append(value)
                restorer = restorer or Restorer(value[2])
                return
            if what == "piece":
                digest.update(value)
                if texts:
                    whole.append(value)
            for part, data in restorer.feed(value) if what == "piece" else restorer.end():
                out.add((*key, part << 40 | count, None, None, None, None, None, None, None, data), len(data))
                count += 1
            if what == "end":
                output = b"".join(whole).decode() if texts else None
                for head in heads:
                    out.add((*key, -1, *head, digest.hexdigest(), output, None), len(output or ""))
                heads, whole, digest, restorer, count = [], [], hashlib.sha256(), None, 0

        return step

    return sorted_pieces.mapInArrow(_streamed(schema, make), schema).sortWithinPartitions("r1", "r2", "place")


def restored_digests(restored_pieces: DataFrame, texts: bool = False) -> DataFrame:
    """One row for each row of documents: the head's columns, and the digest of the text put together again."""
    added = [("output_sha256", T.StringType()), ("output", T.StringType()), ("restored_sha256", T.StringType()), ("restored", T.StringType())]
    schema = T.StructType([T.StructField(n, t) for n, t in [("__page", restored_pieces.schema["__page"].dataType), *_HEAD, *added]])

    def make(out: _Out):
        heads, whole, digest = [], [], hashlib.sha256()

        def step(what: str, key: tuple, value) -> None:
            nonlocal heads, whole, digest
            if what == "head":
                heads.append(value)
            elif what == "piece":
                digest.update(value)
                if texts:
                    whole.append(value)
            else:
                text = b"".join(whole).decode() if texts else None
                for head in heads:
                    out.add((*head, digest.hexdigest(), text), 2 * len(text or ""))
                heads, whole, digest = [], [], hashlib.sha256()

        return step

    return restored_pieces.mapInArrow(_streamed(schema, make), schema)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, texts: bool = True, **options) -> DataFrame:
    """``docs`` with n (units), form, prefix_chars, middle_chars (null if plain), output_sha256 and restored_sha256.

    ``texts`` adds output and restored themselves, for which a task holds one whole document; without
    it a task holds pieces only. ``options`` are those of ``pieces``.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in NEW]
    done = restored_digests(output_digests(pieces(docs, id_col, text_col, kept, **options), texts), texts)
    return done.select(*with_own(kept), *(c for c in NEW if texts or c not in ("output", "restored")))


def contract(transformed: DataFrame) -> DataFrame:
    """The digest columns of transformed ``documents``."""
    return transformed.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
