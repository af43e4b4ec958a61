"""Language identification: nearest of several clustered centroids per language, by cosine.

A text is lower-cased; the byte trigrams of its letters (everything else is one space) are
hashed to ``DIM`` places, counted over the whole text, damped (1 + log), weighted by inverse
document frequency and normalised. The rows of each learned language (a bounded sample: about
``per_lang`` rows each and twice that at most, chosen by a hash of id and text, repeated rows once) are clustered into ``clusters`` centroids
by spherical k-means, one Spark group for each language. A text takes the language of the
centroid with the largest cosine.

Rejection is by distance, against the sample rows of the language that was found: a text of at
least ``SHORT`` n-grams is rejected if its best cosine does not exceed ``margin`` times the
``LOW`` quantile of the cosines of rows of about the same length. These are the rows of its own
length class (power of two of n-grams) and the two beside it, and of further classes until they
are ``LEAST`` rows or all there are. Shorter texts are too short to judge: they are rejected only
if they hold n-grams and none was learned. Null texts and texts without a letter are rejected too,
get `und` and score 0. Rejection does not alter lang_pred otherwise.

Rows with a null lang are not learned from, nor are languages beyond the ``max_langs`` most frequent ones. Ties go to the language first in code point order.
Repeated rows are predicted one by one. With nothing learned every text is `und`. Columns named lang_pred,
score or rejected are replaced; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import blocks_of, fold, map_texts, text_bytes

#: Sampled rows for each language, about; never more than twice that.
PER_LANG = 800
#: Languages learned, at most: the model has some 70 KB for each.
MAX_LANGS = 200
DIM, CLUSTERS, ROUNDS, MARGIN = 4096, 4, 8, 0.6
#: Quantile of the cosines that sets a limit, least rows it is taken over, and n-grams below which distance does not reject.
LOW, LEAST, SHORT = 0.01, 50, 15
#: Length classes.
SIZES = 65

_LETTERS = np.array([b if 0x61 <= b <= 0x7A or b >= 0x80 else 32 for b in range(256)], np.uint8)


def counts(texts: pa.Array) -> np.ndarray:
    """n-gram counts, one row of DIM for each text."""
    low = pa.array([(t or "").lower() for t in texts.to_pylist()], pa.large_string())
    raw, offsets = text_bytes(low)
    n = len(offsets) - 1
    if len(raw) < 3:
        return np.zeros((n, DIM), np.float32)
    out = np.zeros((n, DIM), np.float32)
    for a, b in blocks_of(len(raw) - 2):
        # trigrams that start in [a, b) and end in their own text
        c = _LETTERS[raw[a : b + 2]].astype(np.uint32)
        gram = (c[:-2] << np.uint32(16) | c[1:-1] << np.uint32(8) | c[2:]) * np.uint32(0x9E3779B1) >> np.uint32(20)
        doc = np.repeat(np.arange(n), np.diff(np.clip(offsets, a, b + 2)))
        keep = (doc[:-2] == doc[2:]) & ~((c[:-2] == 32) & (c[1:-1] == 32)) & ~((c[1:-1] == 32) & (c[2:] == 32))
        out += np.bincount(doc[:-2][keep] * DIM + gram[keep], minlength=n * DIM).reshape(n, DIM)
    return out


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def vectors(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(tf) * idf
    norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return v / np.maximum(norm, 1e-12)


def size_class(tf: np.ndarray) -> np.ndarray:
    return np.log2(tf.sum(axis=1) + 1).astype(np.int64)


def limits(best: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The low quantile of the cosines around each length class."""
    out = np.zeros(SIZES)
    for c in range(SIZES if len(best) else 0):
        away = np.abs(sizes - c)
        reach = max(1, int(np.sort(away)[min(LEAST, len(away)) - 1]))
        out[c] = np.quantile(best[away <= reach], LOW)
    return out


def cluster(v: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means; starts from rows far apart, so that reruns agree."""
    total = v.sum(axis=0)
    chosen = [int(np.argmax(v @ total))]
    near = v @ v[chosen[0]]
    while len(chosen) < min(k, len(v)):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, v @ v[chosen[-1]])
    centre = v[chosen]
    for _ in range(ROUNDS):
        own = np.argmax(v @ centre.T, axis=1)
        sums = np.zeros_like(centre)
        np.add.at(sums, own, v)
        norm = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centre = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-12), centre)
    return centre


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", parts: int = 4, held: int = 2, per_lang: int = PER_LANG, clusters: int = CLUSTERS, margin: float = MARGIN, max_langs: int = MAX_LANGS):
    """(languages, centroids, language of each centroid, idf, limit by language and size class)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    rows = rows.filter((fold("id", parts) != held) & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_langs).collect()}
    if not sizes:
        return [], np.zeros((0, DIM), np.float32), np.zeros(0, np.int64), np.ones(DIM, np.float32), np.zeros((0, SIZES))
    share = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(1.0, per_lang / n)))])
    rows = rows.withColumn("draw", F.xxhash64("id", "text", F.lit(1)))
    drawn = rows.filter(F.shiftrightunsigned("draw", 11) / F.lit(float(1 << 53)) < F.element_at(share, F.col("lang"))).dropDuplicates(["lang", "draw"])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    sample = drawn.withColumn("place", place).filter(F.col("place") <= 2 * per_lang).select("lang", "text")

    def make():
        def work(texts: pa.Array) -> list[pa.Array]:
            tf = counts(texts)
            return [pa.array([r.astype("<u4").tobytes() for r in tf], pa.binary())]

        return work

    counted = map_texts(sample, "text", [("tf", T.BinaryType())], make, ["lang"], limit=1 << 18).persist()

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(DIM, np.int64), 0
        for batch in batches:
            for blob in batch.column(1).to_pylist():
                df += np.frombuffer(blob, "<u4") > 0
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([df.tobytes()], pa.binary())], names=["n", "df"])

    seen = counted.coalesce(8).mapInArrow(frequencies, "n long, df binary").collect()
    n, df = sum(r["n"] for r in seen), sum(np.frombuffer(bytes(r["df"]), np.int64) for r in seen)
    idf = np.log((1 + n) / (1 + df)).astype(np.float32) + 1

    def centroids(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("tf")
        tf = np.frombuffer(b"".join(group["tf"]), "<u4").reshape(-1, DIM).astype(np.float32)
        v = vectors(tf, idf)
        centre = cluster(v, clusters).astype(np.float32)
        best = (v @ centre.T).max(axis=1)
        sizes_ = size_class(tf)
        real = tf.sum(axis=1) > 0
        low = limits(best[real], sizes_[real])
        return pd.DataFrame([{"lang": group["lang"].iloc[0], "centre": c.tobytes(), "low": low.tobytes()} for c in centre])

    got = counted.groupBy("lang").applyInPandas(centroids, "lang string, centre binary, low binary").collect()
    counted.unpersist()
    centres = sorted((r["lang"], bytes(r["centre"])) for r in got)
    languages = sorted({lang for lang, _ in centres}, key=lambda x: x.encode())
    centres.sort(key=lambda c: (languages.index(c[0]), c[1]))
    low = {r["lang"]: np.frombuffer(bytes(r["low"])) * margin for r in got}
    matrix = np.array([np.frombuffer(c, np.float32) for _, c in centres])
    return languages, matrix, np.array([languages.index(lang) for lang, _ in centres]), idf, np.array([low[lang] for lang in languages])


def identify(docs: DataFrame, model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with lang_pred, score (the best cosine) and rejected."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        languages, centres, owner, idf, limit = sent.value

        def work(texts: pa.Array) -> list[pa.Array]:
            letters = np.array([has_letter(t) for t in texts.to_pylist()], bool)
            if not languages:
                letters[:] = False
            tf = counts(texts)
            cos = np.clip(vectors(tf, idf) @ centres.T, 0, 1) if len(centres) else np.zeros((len(tf), 1))
            best = np.argmax(cos, axis=1)
            score = np.where(letters, cos[np.arange(len(tf)), best], 0.0).astype(np.float64)
            named = [languages[owner[b]] if ok else "und" for b, ok in zip(best, letters, strict=True)]
            grams = tf.sum(axis=1)
            far = (score <= 0) & (grams > 0)
            if languages:
                far |= (grams >= SHORT) & (score <= limit[owner[best], np.minimum(size_class(tf), SIZES - 1)])
            return [pa.array(named, pa.string()), pa.array(score), pa.array(~letters | far)]

        return work

    return map_texts(docs, text_col, [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("rejected", T.BooleanType())], make, keep, limit=1 << 19)
