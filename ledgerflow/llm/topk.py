"""Exact top-k search by inner product: block-at-a-time pruning.

Vector components are quantised to integers, floor(scale * x). Rows are sorted into ranges of
ids; every ``block`` rows of a range form a block with a forward index (its integer matrix)
and the largest and smallest value of each component (the terms' maxima; with signed values
the minima stand in for negative query terms). A query's bound for a block is the sum of its
term products with them. Blocks are visited by falling bound and scored through their forward
index until the bound falls below the query's k-th score (or equals it and no smaller id can
come); what is left cannot enter the result.

Bounds form a tree: a page holds the bounds of a range of blocks, and has bounds of its own over
them. Three rounds, of which only the last moves blocks in numbers. First chunks of queries meet
the bounds of pages, and every query goes to its ``SEEDS`` best pages and names its ``SEEDS`` best
blocks there. Those are scored, which gives the query a floor, a score that k rows reach. Then
queries meet the bounds of pages again, go only to pages at or above their floor, and from there only
to slices (bounded sets of blocks) with such a bound; a block travels only to chunks with such a
query. Chunks and slices, each pair one bounded group made by an equi-join key, give local results
that merge by query with one top-k window over k rows from each slice.

Vectors that are null, or hold null or non-finite components, or components that leave 64 bits when scaled, take no part. Vectors of other
lengths are padded with zeros. Fewer rows than k give all; ties go to the smaller id; repeated
ids stay separate rows, but a query never meets rows that share its id. Components beyond
the range where products sum below 2**53 are not exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import Scratch

#: Rows of a block, blocks of a slice, queries of a chunk, slices of a page of bounds, blocks that give a query its floor.
BLOCK, SLICE_BLOCKS, CHUNK, PAGE_SLICES, SEEDS = 256, 64, 4096, 64, 2

#: Consecutive blocks that go to the same slice.
_RUN = 16

_PACKED = "id_min long, n int, width int, ids binary, forward binary, code string, high binary, low binary"
_FIELDS = ("n", "width", "ids", "forward", "code")
_HITS = "chunk int, slice long, block long, query_row long"


def _matrix(column: pa.Array, scale: float) -> np.ndarray:
    lengths = np.diff(column.offsets.to_numpy()).astype(np.int64)
    width = int(lengths.max(initial=0))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(lengths), width))
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = np.floor(flat * scale)
    return out


def pack_blocks(vectors: DataFrame, scale: float, block: int) -> DataFrame:
    """Rows of _PACKED from (id, vector) rows already sorted within partitions."""
    schema = pa.schema([("id_min", pa.int64()), ("n", pa.int32()), ("width", pa.int32()), ("ids", pa.binary()), ("forward", pa.binary()), ("code", pa.string()), ("high", pa.binary()), ("low", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, block):
                part = batch.slice(start, block)
                ids, m = part.column(0).to_numpy(), _matrix(part.column(1), scale)
                code = next(c for c, most in (("<i2", 1 << 15), ("<i4", 1 << 31), ("<f8", np.inf)) if np.abs(m).max(initial=0) < most)
                row = (int(ids.min()), len(ids), m.shape[1], ids.tobytes(), m.astype(code).tobytes(), code, m.max(axis=0).astype(code).tobytes(), m.min(axis=0).astype(code).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

    return vectors.mapInArrow(run, _PACKED)


def unpack(row) -> tuple[np.ndarray, np.ndarray]:
    """The ids and the integer matrix of a packed row."""
    return np.frombuffer(row["ids"], np.int64), np.frombuffer(row["forward"], row["code"]).reshape(row["n"], row["width"]).astype(np.float64)


def _pad(m: np.ndarray, width: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, width - m.shape[1])))


def _stack(parts: list[np.ndarray]) -> np.ndarray:
    width = max(m.shape[1] for m in parts)
    return np.vstack([_pad(m, width) for m in parts])


def bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The largest score that each query can have in each block."""
    width = max(queries.shape[1], high.shape[1])
    queries, high, low = (_pad(m, width) for m in (queries, high, low))
    return np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T


class Best:
    """The k best (score, id) of each query so far, best first; missing places hold -inf."""

    def __init__(self, n: int, k: int):
        self.score = np.full((n, k), -np.inf)
        self.id = np.full((n, k), np.iinfo(np.int64).max)

    def offer(self, q: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        k = self.score.shape[1]
        s = np.concatenate([self.score[q], score], axis=1)
        i = np.concatenate([self.id[q], np.broadcast_to(ids, score.shape)], axis=1)
        if s.shape[1] > 4 * k:  # all that reach the k-th score stay in play for the ties
            kth = np.partition(s, s.shape[1] - k, axis=1)[:, -k]
            width = max(k, int((s >= kth[:, None]).sum(axis=1).max()))
            keep = np.argpartition(-s, width - 1, axis=1)[:, :width] if width < s.shape[1] else np.broadcast_to(np.arange(s.shape[1]), s.shape)
            s, i = np.take_along_axis(s, keep, 1), np.take_along_axis(i, keep, 1)
        order = np.lexsort((i, -s), axis=1)[:, :k]
        self.score[q], self.id[q] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)


def search(queries: np.ndarray, query_ids: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray]], k: int, floor: np.ndarray | None = None) -> tuple[Best, int]:
    """Local top k of every query over (ids, forward index) blocks, and the number of (query, block) pairs scored.

    Scores below a query's ``floor`` may be missing.
    """
    width = max([queries.shape[1], *(m.shape[1] for _, m in blocks)])
    queries, blocks = _pad(queries, width), [(i, _pad(m, width)) for i, m in blocks]
    bound = bounds(queries, np.vstack([m.max(axis=0) for _, m in blocks]), np.vstack([m.min(axis=0) for _, m in blocks]))
    floor = np.full(len(queries), -np.inf) if floor is None else floor
    first_id = np.array([i.min() for i, _ in blocks])
    order = np.lexsort((np.broadcast_to(first_id, bound.shape), -bound), axis=1)
    best, scored = Best(len(queries), k), 0
    live = np.arange(len(queries))
    for turn in range(len(blocks)):
        at = order[live, turn]
        b = bound[live, at]
        kth = best.score[live, -1]
        # bounds only fall, but at equal bounds a later block may start at a larger id, so only b < kth ends a query
        reach = b >= np.maximum(kth, floor[live])
        live, at, b, kth = (x[reach] for x in (live, at, b, kth))
        if not len(live):
            break
        use = (b > kth) | (first_id[at] < best.id[live, -1])
        for block in np.unique(at[use]):
            q = live[use & (at == block)]
            ids, forward = blocks[block]
            score = queries[q] @ forward.T
            score[ids[None, :] == query_ids[q, None]] = -np.inf
            scored += len(q)
            best.offer(q, score, ids)
    return best, scored


def _met(asked: DataFrame, held: DataFrame, keys: list[str], work, schema: str) -> DataFrame:
    """``work(asks, held)`` on the rows of both sides that share ``keys``."""

    def run(asks: pd.DataFrame, mine: pd.DataFrame) -> pd.DataFrame:
        if asks.empty or mine.empty:
            return pd.DataFrame({c.split()[0]: [] for c in schema.split(", ")})
        return work(asks, mine)

    # both sides may come from one table: new names for one of them keep their columns apart
    held = held.select(*[F.col(c).alias(c) for c in held.columns])
    return asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(run, schema)


def _asks(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The ids and the matrix of query rows."""
    parts = [unpack(r) for r in rows.to_dict("records")]
    return np.concatenate([i for i, _ in parts]), _stack([m for _, m in parts])


def _page_bounds(asks: pd.DataFrame, held: pd.DataFrame) -> np.ndarray:
    ends = [[np.frombuffer(r[c], r["code"]).astype(np.float64)[None, :] for r in held.to_dict("records")] for c in ("high", "low")]
    return bounds(_asks(asks)[1], _stack(ends[0]), _stack(ends[1]))


def _all_of(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))


def _dealt(n: int, *columns: str | Column) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")


def page_tops(blocks: DataFrame) -> DataFrame:
    """The bounds of each page over those of its blocks."""

    def top(held: pd.DataFrame) -> pd.DataFrame:
        rows = held.to_dict("records")
        high, low = (_stack([np.frombuffer(r[c], r["code"]).astype(np.float64)[None, :] for r in rows]) for c in ("high", "low"))
        return pd.DataFrame([{"page": rows[0]["page"], "code": "<f8", "high": high.max(axis=0).tobytes(), "low": low.min(axis=0).tobytes()}])

    return blocks.select("page", "code", "high", "low").groupBy("page").applyInPandas(top, "page long, code string, high binary, low binary")


def asked_pages(asking: DataFrame, tops: DataFrame, chunks: int, seeds: int | None = None) -> DataFrame:
    """(query_row, chunk, page): the ``seeds`` best pages of each query, or all with a bound at or above its ``floor``."""

    def pick(asks: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        bound = _page_bounds(asks, held)
        if seeds is None:
            q, at = np.nonzero(bound >= asks["floor"].to_numpy()[:, None])
        else:
            n = min(seeds, bound.shape[1])
            at = np.argpartition(-bound, n - 1, axis=1)[:, :n].ravel()
            q = np.repeat(np.arange(len(asks)), n)
        return pd.DataFrame({"query_row": asks["query_row"].to_numpy(np.int64)[q], "chunk": asks["chunk"].iloc[0], "page": held["page"].to_numpy(np.int64)[at]})

    return _met(asking, tops.withColumn("chunk", _all_of(chunks)), ["chunk"], pick, "query_row long, chunk int, page long")


def _paged(asking: DataFrame, blocks: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Queries on the pages they ask for, and the bounds of a page's blocks for the chunks that ask for it."""
    held = blocks.select("block", "slice", "page", "code", "high", "low").join(pages.select("page", "chunk").distinct(), "page")
    return asking.drop("chunk").join(pages, "query_row"), held


def floors(asking: DataFrame, blocks: DataFrame, pages: DataFrame, k: int, scratch: Scratch) -> DataFrame:
    """(query_row, floor): the best k-th score among the blocks with a query's highest bounds; -inf where none holds k rows."""

    def best(asks: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        bound = _page_bounds(asks, held)
        n = min(SEEDS, bound.shape[1])
        at = np.argpartition(-bound, n - 1, axis=1)[:, :n]
        return pd.DataFrame({"query_row": np.repeat(asks["query_row"].to_numpy(np.int64), n), "chunk": asks["chunk"].iloc[0], "block": held["block"].to_numpy()[at].ravel(), "bound": np.take_along_axis(bound, at, 1).ravel()})

    def kth(asks: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        ids, m = _asks(asks)
        found, _ = search(m, ids, [unpack(r) for r in held.to_dict("records")], k)
        return pd.DataFrame({"query_row": asks["query_row"].to_numpy(np.int64), "floor": found.score[:, -1]})

    paged = _met(*_paged(asking, blocks, pages), ["page", "chunk"], best, "query_row long, chunk int, block long, bound double")
    order = Window.partitionBy("query_row").orderBy(F.desc("bound"), "block")
    seeds = scratch.written(paged.withColumn("turn", F.row_number().over(order)).filter(F.col("turn") <= SEEDS).select("query_row", "chunk", "block"))
    asked = asking.drop("chunk").join(seeds, "query_row")
    held = blocks.select("block", *_FIELDS).join(seeds.select("chunk", "block").distinct(), "block")
    return _met(asked, held, ["block", "chunk"], kth, "query_row long, floor double").groupBy("query_row").agg(F.max("floor").alias("floor"))


def reached(asking: DataFrame, blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """_HITS: each query with each slice that holds a bound at or above its ``floor``, and each such block with the chunk of queries."""

    def hits(asks: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        fits = _page_bounds(asks, held) >= asks["floor"].to_numpy()[:, None]
        slices, block, rows = held["slice"].to_numpy(np.int64), held["block"].to_numpy(np.int64), asks["query_row"].to_numpy(np.int64)
        wanted = np.flatnonzero(fits.any(axis=0))
        out = [pd.DataFrame({"slice": slices[wanted], "block": pd.array(block[wanted], "Int64"), "query_row": pd.array([None] * len(wanted), "Int64")})]
        for s in np.unique(slices):
            mine = rows[fits[:, slices == s].any(axis=1)]
            out.append(pd.DataFrame({"slice": s, "block": pd.array([None] * len(mine), "Int64"), "query_row": pd.array(mine, "Int64")}))
        return pd.concat(out).assign(chunk=asks["chunk"].iloc[0])[["chunk", "slice", "block", "query_row"]]

    return _met(*_paged(asking, blocks, pages), ["page", "chunk"], hits, _HITS)


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: float = 256.0,
    block: int = BLOCK,
    slice_blocks: int = SLICE_BLOCKS,
    chunk: int = CHUNK,
    page_slices: int = PAGE_SLICES,
    moved: list | None = None,
) -> DataFrame:
    """(query_id, rank, id_col, score) for each row of ``queries`` against all ``vectors``.

    ``moved``, if given, receives the tables of what moves: _HITS, and the pages that queries go to.
    """

    def usable(df: DataFrame) -> DataFrame:
        v = F.col(f"`{vector_col}`").cast("array<double>")
        fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < float(1 << 63)))
        return df.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v")).filter(F.col("id").isNotNull() & v.isNotNull() & fine)

    scratch, order = Scratch(), ("id", F.xxhash64("v"))
    packed = pack_blocks(usable(vectors).repartitionByRange(*order).sortWithinPartitions(*order), scale, block)
    packed = scratch.written(packed.select(F.monotonically_increasing_id().alias("block"), *_FIELDS, "high", "low"))
    # numbers of blocks hold that of their range of ids above 33 bits: a page is a stretch of one range
    stretch = F.floor(F.col("block").bitwiseAND(F.lit((1 << 33) - 1)) / (slice_blocks * page_slices))
    packed = packed.withColumn("page", F.shiftright("block", 33) * (1 << 20) + stretch)
    # short runs of neighbours, so that a slice holds whole ranges of ids and few of them
    blocks = packed.withColumn("slice", F.col("page") * page_slices + _dealt(page_slices, F.floor(F.col("block") / min(_RUN, slice_blocks))))
    tops = scratch.written(page_tops(blocks))

    asked = scratch.written(pack_blocks(usable(queries), scale, 1).select(F.monotonically_increasing_id().alias("query_row"), *_FIELDS))
    chunks = max(1, -(-asked.count() // chunk))
    asking = asked.withColumn("chunk", _dealt(chunks, "query_row"))
    seeds = scratch.written(asked_pages(asking, tops, chunks, SEEDS))
    asking = asking.join(scratch.written(floors(asking, blocks, seeds, k, scratch)), "query_row", "left").fillna(float("-inf"), ["floor"])
    pages = scratch.written(asked_pages(asking, tops, chunks))
    hits = scratch.written(reached(asking, blocks, pages))
    if moved is not None:
        moved += [hits, pages]

    def local(asks: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        ids, m = _asks(asks)
        found, _ = search(m, ids, [unpack(r) for r in held.to_dict("records")], k, asks["floor"].to_numpy())
        rows, places = np.nonzero(np.isfinite(found.score))
        return pd.DataFrame({"query_row": asks["query_row"].to_numpy(np.int64)[rows], "query_id": ids[rows], "id": found.id[rows, places], "score": found.score[rows, places].astype(np.int64)})

    going = hits.filter("query_row is not null").select("query_row", "slice").join(asking, "query_row")
    held = hits.filter("block is not null").select("block", "chunk").join(blocks.select("block", "slice", *_FIELDS), "block")
    near = _met(going, held, ["slice", "chunk"], local, "query_row long, query_id long, id long, score long")
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "id")
    ranked = near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
