"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

A text is described by shape: its bytes become letters, capitals, digits, white space and the
punctuation marks themselves, and hashed 4-grams of these shapes are counted over the whole
text, along with classes of word lengths and of the shares of repeated words and lines. Counts
are damped, weighted by inverse document frequency and normalised; a singular value
decomposition of a bounded sample of labelled rows (``max_train`` rows, the first by a hash of
the id) gives the latent space. The labelled vectors are broadcast; every document meets all of
them in blocked cosine products and its ``k`` nearest (and all that tie with the k-th) vote
with their labels, weighted by similarity.

Null and empty texts have the zero vector, no neighbour and the sample's share of label 1 as
score. Labels other than 0 and 1 are not learned from. Repeated rows are scored one by one.
Without labelled rows the score is 0.5.
Columns named score or predicted are replaced; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerflow.llm.common import Words, blocks_of, map_texts, span_hashes, text_bytes
from ledgerflow.llm.toxicity import bounded, training_rows

#: Labelled rows in the space, at most.
MAX_TRAIN = 3000
SHAPES, RANK, NEIGHBOURS, POWER = 2048, 32, 15, 8
#: Places for word-length classes, repeated-word and repeated-line classes, after the shapes.
LENGTHS, REPEATS = 16, 12
DIM = SHAPES + LENGTHS + 2 * REPEATS


def _shape(b: int) -> int:
    if 0x61 <= b <= 0x7A or b >= 0x80:
        return 1
    if 0x41 <= b <= 0x5A:
        return 2
    if 0x30 <= b <= 0x39:
        return 3
    if b == 0x0A:
        return 5
    return 4 if b == 0x20 or 0x09 <= b <= 0x0D else 6 + b % 58


_SHAPE = np.array([_shape(b) for b in range(256)], np.uint32)


def _repeat_class(doc: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """Class 0 to REPEATS - 1 of the share of spans met before in their text."""
    total = np.bincount(doc, minlength=n)
    order = np.lexsort((h, doc))
    d, s = doc[order], h[order]
    again = (d[1:] == d[:-1]) & (s[1:] == s[:-1])
    repeated = np.bincount(d[1:][again], minlength=n)
    return np.minimum((repeated / np.maximum(total, 1) * REPEATS).astype(np.int64), REPEATS - 1)


def describe(texts: pa.Array) -> np.ndarray:
    """Counts, one row of DIM for each text."""
    raw, offsets = text_bytes(texts)
    n = len(offsets) - 1
    out = np.zeros((n, DIM), np.float32)
    if len(raw) == 0:
        return out
    for a, b in blocks_of(len(raw) - 3):
        # 4-grams that start in [a, b) and end in their own text
        s = _SHAPE[raw[a : b + 3]]
        doc = np.repeat(np.arange(n), np.diff(np.clip(offsets, a, b + 3)))
        gram = (s[:-3] << np.uint32(18) | s[1:-2] << np.uint32(12) | s[2:-1] << np.uint32(6) | s[3:]) * np.uint32(0x9E3779B1) >> np.uint32(21)
        same = doc[:-3] == doc[3:]
        out[:, :SHAPES] += np.bincount(doc[:-3][same] * SHAPES + gram[same], minlength=n * SHAPES).reshape(n, SHAPES)
    w = Words(texts)
    word_doc, size = w.text_of(), np.minimum(w.ends - w.starts, LENGTHS) - 1
    out[:, SHAPES : SHAPES + LENGTHS] = np.bincount(word_doc * LENGTHS + size, minlength=n * LENGTHS).reshape(n, LENGTHS)
    filled = np.diff(offsets) > 0
    rows = np.flatnonzero(filled)
    weight = np.maximum(np.bincount(word_doc, minlength=n), 1)
    out[rows, SHAPES + LENGTHS + _repeat_class(word_doc, w.hashes(), n)[rows]] = weight[rows]
    # lines: from a text's start or a line feed to the next
    starts = np.unique(np.concatenate([offsets[:-1][filled], np.flatnonzero(raw == 0x0A) + 1]))
    starts = starts[starts < len(raw)]
    ends = np.append(starts[1:], len(raw))
    out[rows, SHAPES + LENGTHS + REPEATS + _repeat_class(np.searchsorted(offsets, starts, side="right") - 1, span_hashes(raw, starts, ends), n)[rows]] = weight[rows]
    return out


def weighted(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(tf) * idf
    return v / np.maximum(np.sqrt((v * v).sum(axis=1, keepdims=True)), 1e-12)


def latent(v: np.ndarray, basis: np.ndarray) -> np.ndarray:
    x = v @ basis
    return (x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)).astype(np.float32)


def fit(tf: np.ndarray, y: np.ndarray, rank: int = RANK):
    """(idf, basis, labelled vectors, labels) of the sample."""
    idf = (np.log((1 + len(tf)) / (1 + (tf > 0).sum(axis=0))) + 1).astype(np.float32)
    v = weighted(tf, idf)
    _, vectors = np.linalg.eigh(v.T @ v)
    basis = vectors[:, ::-1][:, : min(rank, len(v))].astype(np.float32)
    return idf, basis, latent(v, basis), y.astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", parts: int = 5, held: int = 0, max_train: int = MAX_TRAIN):
    def make():
        return lambda texts: [pa.array([r.astype("<u4").tobytes() for r in describe(texts)], pa.binary())]

    chosen = training_rows(docs, labels, id_col, text_col, label_col, parts, held, max_train)
    got = bounded(map_texts(chosen, "text", [("tf", T.BinaryType())], make, ["__key", "__id", "label"], limit=1 << 18), "tf", max_train)
    if not got:
        return None
    tf = np.frombuffer(b"".join(r[2] for r in got), "<u4").reshape(-1, DIM).astype(np.float32)
    return fit(tf, np.array([r[1] for r in got]))


def vote(x: np.ndarray, known: np.ndarray, y: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """Share of label 1 among the neighbours, weighted by similarity."""
    prior = float(y.mean())
    cos = np.maximum(x @ known.T, 0)
    if cos.shape[1] > k:
        kth = np.partition(cos, cos.shape[1] - k, axis=1)[:, -k]
        cos[cos < kth[:, None]] = 0
    cos **= POWER
    total = cos.sum(axis=1)
    return np.where(total > 0, np.clip((cos @ y) / np.maximum(total, 1e-30), 0, 1), prior).astype(np.float64)


def score(docs: DataFrame, model, text_col: str = "text", threshold: float = 0.3, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with score and predicted (1 if score >= ``threshold``)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = sent.value

        def work(texts: pa.Array) -> list[pa.Array]:
            if model is None:
                p = np.full(len(texts), 0.5)
            else:
                idf, basis, known, y = model
                p = vote(latent(weighted(describe(texts), idf), basis), known, y)
            return [pa.array(p, pa.float64()), pa.array(p >= threshold).cast(pa.int32())]

        return work

    return map_texts(docs, text_col, [("score", T.DoubleType()), ("predicted", T.IntegerType())], make, keep, limit=1 << 19)
