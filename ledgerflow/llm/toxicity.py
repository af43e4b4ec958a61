"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the distinct hashed words, word pairs and pairs with one word skipped,
of the whole text lowered A-Z, and word beginnings of a few bytes, so that inflected forms of
a learned word count where a language has many. The model is fitted on a bounded sample of labelled rows
(``max_train`` rows, the first by a hash of the id, of at most 256 MB of features) with one learning rate for each coordinate
and L1 regularisation. It is fitted in a task: the driver gets its few weights, never the features. They are broadcast as
two short arrays and every text is scored in Arrow batches.

Null and empty texts have no features and get the score of the bias. Labels other than 0 and 1
are not learned from; an id with several labels counts with each. Without usable labels, or
with one class only, the score is the smoothed share of the positive label.
Columns named score or predicted are replaced; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import Scratch, Words, fold, map_texts, mix, span_hashes

#: Labelled rows that a model is fitted on, at most.
MAX_TRAIN = 6000
#: Bytes of their features, at most.
MAX_BYTES = 256 << 20
HASH_BITS = 20
#: Bytes of the word beginnings that stand for inflected forms.
STEMS = (4, 5, 6)
ALPHA, BETA, L1, L2, EPOCHS = 1.0, 1.0, 2.5, 0.01, 4


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """(text number, feature) pairs, repeats included, and the number of texts."""
    w = Words(texts)
    h, doc = w.hashes(), w.text_of()
    with np.errstate(over="ignore"):
        pair, skip = h * np.uint64(0x9E3779B97F4A7C15), h * np.uint64(0xC2B2AE3D27D4EB4F)
        two = mix(pair[:-1] + h[1:])
        over = mix(skip[:-2] + h[2:])
    same2, same3 = doc[:-1] == doc[1:], doc[:-2] == doc[2:]
    docs, found = [doc, doc[:-1][same2], doc[:-2][same3]], [h, two[same2], over[same3]]
    for size in STEMS:
        longer = w.ends - w.starts > size
        start = w.starts[longer]
        docs.append(doc[longer])
        found.append(~span_hashes(w.low, start, start + size))
    ids = np.concatenate(found) >> np.uint64(64 - HASH_BITS)
    return np.concatenate(docs), ids.astype(np.int64), w.n_texts


class Ftrl:
    """Follow the regularised leader, one example at a time, over distinct binary features."""

    def __init__(self):
        self.z, self.n = np.zeros(1 << HASH_BITS), np.zeros(1 << HASH_BITS)
        self.bias_z = self.bias_n = 0.0

    def weights(self, ids: np.ndarray) -> np.ndarray:
        z = self.z[ids]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(self.n[ids])) / ALPHA + L2)

    @property
    def bias(self) -> float:
        return -self.bias_z / ((BETA + np.sqrt(self.bias_n)) / ALPHA)

    def learn(self, ids: np.ndarray, y: int) -> None:
        w, b = self.weights(ids), self.bias
        g = 1 / (1 + np.exp(-np.clip(w.sum() + b, -35, 35))) - y
        n = self.n[ids]
        self.z[ids] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[ids] = n + g * g
        self.bias_z += g - (np.sqrt(self.bias_n + g * g) - np.sqrt(self.bias_n)) / ALPHA * b
        self.bias_n += g * g


def fit(rows: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray, float]:
    """Features with weight, their weights, and the bias."""
    labels = [y for _, y in rows]
    if len(set(labels)) < 2:
        share = (sum(labels) + 0.5) / (len(labels) + 1)
        return np.empty(0, np.int64), np.empty(0), float(np.log(share / (1 - share)))
    model, rng = Ftrl(), np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            model.learn(*rows[i])
    w = model.weights(np.arange(1 << HASH_BITS))
    used = np.flatnonzero(w)
    return used, w[used], float(model.bias)


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, parts: int, held: int, most: int) -> DataFrame:
    """(__key, __id, label, text) of the texts of at most ``most`` labelled ids outside the held-out fold."""
    usable = labels.filter((fold(id_col, parts) != held) & F.col(label_col).isin(0, 1))
    chosen = usable.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("label")).distinct().orderBy(F.xxhash64("__id"), "__id", "label").limit(most)
    rows = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.join(F.broadcast(chosen), "__id").select(F.xxhash64("__id", "label", F.xxhash64("text")).alias("__key"), F.col("__id").cast("string").alias("__id"), "label", "text")


def first_rows(described: DataFrame, column: str, most: int, most_bytes: int, scratch: Scratch) -> DataFrame:
    """(__id, label, ``column``), stored, of at most ``most`` distinct rows and ``most_bytes`` bytes of ``column``.

    Rows that repeat id, text and label count once, so that an id that many rows share does not fill the sample.
    """
    rows = scratch.written(described.dropDuplicates(["__key"]))
    sizes = rows.select("__key", F.length(column).alias("size")).orderBy("__key").limit(most).collect()
    held = np.cumsum([r["size"] for r in sizes])
    inside = [r["__key"] for r, h in zip(sizes, held, strict=True) if h <= most_bytes]
    return rows.filter(F.col("__key") <= inside[-1] if inside else F.lit(False)).select(F.coalesce("__id", F.lit("")).alias("__id"), "label", column)


def bounded(described: DataFrame, column: str, most: int, most_bytes: int = MAX_BYTES) -> list[tuple[str, int, bytes]]:
    """(id, label, bytes of ``column``) of the first rows, in a fixed order."""
    scratch = Scratch()
    got = first_rows(described, column, most, most_bytes, scratch).collect()
    scratch.drop()
    # a fixed order makes the fit repeatable
    return sorted(((r["__id"], r["label"], bytes(r[column])) for r in got), key=lambda r: r)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", parts: int = 3, held: int = 1, max_train: int = MAX_TRAIN):
    """Weights learned from labelled rows outside the held-out fold."""

    def make():
        def work(texts: pa.Array) -> list[pa.Array]:
            doc, ids, n = features(texts)
            key = np.unique(doc << HASH_BITS | ids)
            cut = np.searchsorted(key, np.arange(n + 1) << HASH_BITS)
            ids = (key & ((1 << HASH_BITS) - 1)).astype("<i4")
            return [pa.array([ids[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())]

        return work

    chosen = training_rows(docs, labels, id_col, text_col, label_col, parts, held, max_train)
    scratch = Scratch()
    sample = first_rows(map_texts(chosen, "text", [("ids", T.BinaryType())], make, ["__key", "__id", "label"]), "ids", max_train, MAX_BYTES, scratch)

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(np.frombuffer(ids, "<i4"), y) for b in batches for ids, y in zip(b.column(2).to_pylist(), b.column(1).to_pylist(), strict=True)]
        used, weight, bias = fit(rows)
        yield pa.RecordBatch.from_arrays([pa.array([used.astype("<i8").tobytes()], pa.binary()), pa.array([weight.astype("<f8").tobytes()], pa.binary()), pa.array([bias])], names=["used", "weight", "bias"])

    # one task sees the bounded sample, in a fixed order, which makes the fit repeatable
    learned = sample.coalesce(1).sortWithinPartitions("__id", "label", "ids").mapInArrow(fitted, "used binary, weight binary, bias double").collect()
    scratch.drop()
    if not learned:
        return fit([])
    return np.frombuffer(bytes(learned[0]["used"]), "<i8"), np.frombuffer(bytes(learned[0]["weight"]), "<f8"), learned[0]["bias"]


def score(docs: DataFrame, model, text_col: str = "text", threshold: float = 0.7, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with score and predicted (1 if score >= ``threshold``)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        used, weight, bias = sent.value
        known = np.zeros(1 << HASH_BITS, bool)
        known[used] = True

        def work(texts: pa.Array) -> list[pa.Array]:
            doc, ids, n = features(texts)
            hit = known[ids]
            key = np.unique(doc[hit] << HASH_BITS | ids[hit])
            w = weight[np.searchsorted(used, key & ((1 << HASH_BITS) - 1))]
            z = bias + np.bincount(key >> HASH_BITS, weights=w, minlength=n)
            p = 1 / (1 + np.exp(-np.clip(z, -35, 35)))
            return [pa.array(p, pa.float64()), pa.array(p >= threshold).cast(pa.int32())]

        return work

    return map_texts(docs, text_col, [("score", T.DoubleType()), ("predicted", T.IntegerType())], make, keep)
