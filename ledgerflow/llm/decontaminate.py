"""Benchmark decontamination: Wu-Manber search for all test windows at once.

Every item gives its windows of ``window`` consecutive words (an item of fewer words, but
not none, is one window). Texts and windows are compared as lowered words with one space
between and around them. For each length class of windows a shift table over hashed blocks
says how far a position may safely move; positions that cannot move are looked up in buckets
by the hash of the last block, and direct comparison of all bytes confirms an occurrence.
The scan runs over many stretches of a batch side by side, so that each step is one
vectorised table lookup.

Windows reach the tasks in groups of at most ``group_bytes``: a larger set of items takes
more passes over the same rows, each a job of its own that is written before the next one, with a
bounded broadcast and no shuffle.

Nulls: a null text has no words; a null item_id marks words but is not listed. Repeated rows
of documents are judged one by one, repeated items count once. With no items nothing is hit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import ALNUM, Scratch, Words, blocks_of, map_texts

WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of a block, and bits of its hash.
BLOCK, HASH_BITS = 6, 18
#: Bytes of text that one of the side-by-side scans covers.
LANE = 1024
#: Bytes of windows that one broadcast holds.
GROUP_BYTES = 16 << 20
#: Shortest windows of each class; a window belongs to the last class it reaches.
CLASSES = (1, 8, 16, 32, 64)

_SEPARATOR, _SPACE = 1, 32
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def windows_of(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """One row (item_id, gram) for each window of each item, distinct."""
    words = F.expr(f"regexp_extract_all(translate(`{text_col}`, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD_PATTERN.replace(chr(92), chr(92) * 2)}', 0)")
    listed = items.select(F.col(f"`{id_col}`").cast("string").alias("item_id"), words.alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (window - 1)))
    grams = F.transform(starts, lambda i: F.concat(F.lit(" "), F.concat_ws(" ", F.slice("words", i, F.lit(window))), F.lit(" ")))
    return listed.select("item_id", F.explode(grams).alias("gram")).distinct()


class WuManber:
    """Search tables of the windows of one length class."""

    def __init__(self, patterns: list[bytes]):
        self.patterns = patterns
        self.m = m = min(map(len, patterns))
        self.block = min(BLOCK, m)
        head = np.frombuffer(b"".join(p[:m] for p in patterns), np.uint8).reshape(-1, m)
        padded = np.concatenate([head, np.zeros((len(head), 8), np.uint8)], axis=1)
        self.default = m - self.block + 1
        self.shift = np.full(1 << HASH_BITS, self.default, np.int32)
        for j in range(self.default):
            at = self.hash(np.ascontiguousarray(padded[:, j : j + 8]).view("<u8")[:, 0])
            np.minimum.at(self.shift, at, m - self.block - j)
        suffix = self.hash(np.ascontiguousarray(padded[:, m - self.block : m - self.block + 8]).view("<u8")[:, 0])
        self.members = np.argsort(suffix, kind="stable")
        self.bucket = np.searchsorted(suffix[self.members], np.arange((1 << HASH_BITS) + 1))
        self.first = self.masked(np.ascontiguousarray(padded[:, :8]).view("<u8")[:, 0], min(8, m))
        self.lengths = np.array([len(p) for p in patterns])

    def masked(self, x: np.ndarray, n: int) -> np.ndarray:
        return x & np.uint64((1 << 8 * n) - 1)

    def hash(self, x: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((self.masked(x, self.block) * _MULTIPLIER) >> np.uint64(64 - HASH_BITS)).astype(np.int64)

    def search(self, text: bytes, eight: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(start, pattern number) of all occurrences in the first n bytes; eight[i] is text[i : i + 8]."""
        stop = n - self.m + 1
        if stop <= 0:
            return
        at = np.arange(0, stop, LANE)
        end = np.minimum(at + LANE, stop)
        reach = self.m - self.block
        while len(at):
            h = self.hash(eight[at + reach])
            step = self.shift[h]
            still = np.flatnonzero(step == 0)
            if len(still):
                yield from self.confirm(text, eight, n, at[still], h[still])
            at = at + np.maximum(step, 1)
            alive = at < end
            if not alive.all():
                at, end = at[alive], end[alive]

    def confirm(self, text: bytes, eight: np.ndarray, n: int, at: np.ndarray, h: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        low, size = self.bucket[h], self.bucket[h + 1] - self.bucket[h]
        start = np.repeat(at, size)
        if not len(start):
            return
        which = self.members[np.repeat(low, size) + np.arange(len(start)) - np.repeat(np.cumsum(size) - size, size)]
        likely = (self.masked(eight[start], min(8, self.m)) == self.first[which]) & (start + self.lengths[which] <= n)
        start, which = start[likely], which[likely]
        same = np.fromiter((text.startswith(self.patterns[w], s) for s, w in zip(start.tolist(), which.tolist(), strict=True)), bool, len(start))
        if same.any():
            yield start[same], which[same]


class Searcher:
    """All length classes of one group of windows, with the items of each window."""

    def __init__(self, grams: list[str], items: list[list[str]]):
        coded = [g.encode() for g in grams]
        level = np.searchsorted(CLASSES, [len(g) for g in coded], side="right")
        self.items = items
        self.parts = []
        for c in np.unique(level):
            numbers = np.flatnonzero(level == c)
            self.parts.append((numbers, WuManber([coded[i] for i in numbers])))
        self.words = np.array([g.count(" ") - 1 for g in grams])

    def find(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text number, first word (counted over the batch) and window of each occurrence."""
        # one space before each word, a space and a separator after each text
        sizes = w.ends - w.starts + 1
        extra = np.zeros(len(w.starts), np.int64)
        full = w.counts > 0
        extra[w.bounds[1:][full] - 1] = 2
        ends = np.cumsum(sizes + extra)
        begins = ends - sizes - extra
        total = int(ends[-1]) if len(ends) else 0
        if total == 0:
            none = np.empty(0, np.int64)
            return none, none, none
        flat = np.full(total + 8, _SPACE, np.uint8)
        flat[ends[extra > 0] - 1] = _SEPARATOR
        for a, b in blocks_of(len(sizes), 1 << 18):
            low = w.low[w.starts[a] : w.ends[b - 1]]
            source = np.flatnonzero(low)
            flat[source + np.repeat(begins[a:b] + 1 - w.starts[a:b] + w.starts[a], sizes[a:b] - 1)] = low[source]
        text = flat.tobytes()
        eight = np.ndarray((total + 1,), "<u8", flat, 0, (1,))
        starts, which = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for numbers, part in self.parts:
            for s, p in part.search(text, eight, total):
                starts.append(s)
                which.append(numbers[p])
        starts, which = np.concatenate(starts), np.concatenate(which)
        first = np.searchsorted(begins, starts)
        return np.searchsorted(w.bounds, first, side="right") - 1, first, which


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def _groups(windows: DataFrame, limit: int) -> Iterator[tuple[list[str], list[list[str]]]]:
    listed = windows.groupBy("gram").agg(F.sort_array(F.collect_set("item_id")).alias("items")).orderBy("gram")
    grams, items, held = [], [], 0
    for row in listed.toLocalIterator():
        grams.append(row["gram"])
        items.append(list(row["items"]))
        held += len(row["gram"].encode()) + sum(map(len, row["items"]))
        if held >= limit:
            yield grams, items
            grams, items, held = [], [], 0
    if grams or not held:
        yield grams, items


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    group_bytes: int = GROUP_BYTES,
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with n_words, n_hit, hit_spans (first and last word of each stretch), hit_items and contaminated."""
    kept = list(docs.columns if keep is None else keep)
    span = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))
    new = [("n_words", T.LongType()), ("n_hit", T.LongType()), ("hit_spans", span), ("hit_items", T.ArrayType(T.StringType())), ("contaminated", T.BooleanType())]
    sc, scratch = docs.sparkSession.sparkContext, Scratch()
    groups = _groups(windows_of(items, item_id_col, item_text_col, window), group_bytes)
    out, first_pass, held = docs, True, next(groups)
    while held is not None:
        following = next(groups, None)
        columns = kept if following is None else [*kept, *([text_col] if text_col not in kept else [])]
        out = _search(out, text_col, new, sc.broadcast(held), columns, first_pass)
        if following is not None:
            # one group at a time: its pass ends, and its tables go, before the next one is sent
            out = scratch.written(out)
        first_pass, held = False, following
    return out


def _search(df: DataFrame, text_col: str, new: list, held, kept: list[str], first_pass: bool) -> DataFrame:
    def make():
        searcher = Searcher(*held.value) if held.value[0] else None

        def work(texts: pa.Array) -> list[pa.Array]:
            w = Words(texts, ALNUM)
            spans: list[list[dict]] = [[] for _ in range(w.n_texts)]
            found: list[list[str]] = [[] for _ in range(w.n_texts)]
            hits = np.zeros(w.n_texts, np.int64)
            if searcher:
                text, first, which = searcher.find(w)
                order = np.lexsort((first, text))
                text, first, which = text[order], first[order], which[order]
                cuts = np.flatnonzero(np.diff(text, prepend=-1))
                for a, b in zip(cuts, np.append(cuts[1:], len(text)), strict=False):
                    t = int(text[a])
                    base = int(w.bounds[t])
                    spans[t] = merge([(int(f) - base, int(f) - base + int(n) - 1) for f, n in zip(first[a:b], searcher.words[which[a:b]], strict=True)])
                    hits[t] = sum(s["last"] - s["first"] + 1 for s in spans[t])
                    found[t] = sorted({i for p in np.unique(which[a:b]) for i in searcher.items[p]})
            types = (pa.int64(), pa.int64(), pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])), pa.list_(pa.string()), pa.bool_())
            return [pa.array(v, t) for v, t in zip((w.counts, hits, spans, found, hits > 0), types, strict=True)]

        return work

    if first_pass:
        return map_texts(df, text_col, new, make, kept)
    names = [n for n, _ in new]
    before = df.select("*", F.struct(*names).alias("__before")).drop(*names)
    now = map_texts(before, text_col, new, make, [*kept, "__before"])
    both = F.concat(F.col("__before.hit_spans"), F.col("hit_spans"))
    joined = F.aggregate(
        F.array_sort(both),
        F.lit(None).cast("array<struct<first:bigint,last:bigint>>"),
        lambda acc, s: F.when(acc.isNull(), F.array(s))
        .when(s["first"] <= F.element_at(acc, -1)["last"] + 1, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["first"].alias("first"), F.greatest(F.element_at(acc, -1)["last"], s["last"]).alias("last")))))
        .otherwise(F.concat(acc, F.array(s))),
    )
    merged = now.withColumn("hit_spans", F.coalesce(joined, F.col("hit_spans")))
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"] + 1)
    return merged.withColumns({"hit_items": F.array_sort(F.array_distinct(F.concat("__before.hit_items", "hit_items"))), "n_hit": n_hit}).withColumn("contaminated", F.col("n_hit") > 0).drop("__before")


def merge(spans: list[tuple[int, int]]) -> list[dict]:
    """Stretches of words that sorted, possibly overlapping spans cover."""
    out: list[dict] = []
    for first, last in sorted(spans):
        if out and first <= out[-1]["last"] + 1:
            out[-1]["last"] = max(out[-1]["last"], last)
        else:
            out.append({"first": first, "last": last})
    return out


def contract(judged: DataFrame) -> DataFrame:
    """The digest columns of a decontaminated ``documents`` table."""
    names = F.coalesce(F.col("hit_items"), F.array().cast("array<string>"))
    return judged.select("doc_id", "n_words", "n_hit", F.size(names).cast("long").alias("n_items"), F.sha2(F.concat_ws(",", F.array_sort(names)), 256).alias("items_sha256"), "contaminated")
