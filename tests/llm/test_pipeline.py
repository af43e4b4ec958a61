"""The pipeline's stages one by one on planted cases, and all of them in a row."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def text(rng, lang, n):
    parts = {"xx": ["ka", "lo", "mi", "tu"], "yy": ["sch", "ung", "ber", "ei"]}[lang]
    return [str("".join(rng.choice(parts, size=4))) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    sf = str(tmp_path_factory.mktemp("sf"))
    rng = np.random.default_rng(11)
    item = [f"item{i}" for i in range(14)]
    rows, labels, planted = [], [], {"toxic": set(), "copy": set(), "leak": set(), "odd": set()}
    for i in range(240):
        w = text(rng, "xx" if i % 2 else "yy", 120)
        if i % 6 == 0:
            w[int(rng.integers(120))] = "vileword"
            planted["toxic"].add(i)
        labels.append((i, 1, int(i % 6 == 0)))
        if i % 20 == 1:
            w[30:44] = item
            planted["leak"].add(i)
        rows.append((i, " ".join(w), "xx" if i % 2 else "yy", ["s0", "s1", None][i % 3], 1))
    for k in range(20):
        base = rows[2 * k + 1]
        if base[0] in planted["toxic"] | planted["leak"]:
            continue
        w = base[1].split()
        w[60] = "edited"
        for n, copy in enumerate((base[1], " ".join(w))):
            rows.append((1000 + 2 * k + n, copy, base[2], "s0", 1))
            planted["copy"].add(1000 + 2 * k + n)
    for n, t in enumerate((None, "", "12 34 !!")):
        rows.append((2000 + n, t, None, None, 0))
        planted["odd"].add(2000 + n)
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    return sf, planted, {r[0] for r in rows}


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


@pytest.mark.parametrize("stage,cases", [(0, "toxic"), (1, "odd"), (2, "copy"), (3, "leak")])
def test_stage_drops_exactly_its_cases(spark, corpus, stage, cases):
    sf, planted, every = corpus
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("score", F.lit("clash"))
    out = C.STAGES[stage][1](spark, docs, sf)
    assert out.columns == docs.columns
    kept = ids(out)
    gone = every - kept
    if cases == "copy":
        # null, empty and number-only texts: the first two share the zero fingerprint
        gone -= planted["odd"]
    assert gone == planted[cases]
    assert C.STAGES[stage][1](spark, docs.filter("false"), sf).count() == 0


def test_all_stages(spark, corpus):
    sf, planted, every = corpus
    out = C.run(spark, sf)
    assert [n for n, _ in C.STAGES] == ["toxicity", "language", "near_duplicates", "decontamination", "mixing"]
    kept = every - planted["toxic"] - planted["odd"] - planted["copy"] - planted["leak"]
    assert ids(out) <= kept
    rows = out.collect()
    for source in ("s0", "s1", None):
        mine = [r for r in rows if r.source == source]
        assert abs(sum(r["size"] for r in mine) - mine[0].target) <= 200


def test_mixing_stage(spark, corpus):
    """One row for each copy; null, empty, tied and very long texts, clashing columns, an empty table."""
    sf, _, _ = corpus
    rng = np.random.default_rng(3)
    long = " ".join(f"w{int(x)}" for x in rng.integers(0, 900, size=30_000))
    rows = [(i, " ".join(text(rng, "xx", 40)), "xx", f"s{i % 3}", 1) for i in range(90)] + [(200 + i, "tied words", "xx", "s0", 1) for i in range(30)]
    rows += [(300, long, "xx", "s1", 1), (301, None, None, None, 1), (302, "", None, "s2", 1), (303, "a b c d e f", None, None, 1)]
    docs = spark.createDataFrame(rows, COLUMNS).withColumn("copy", F.lit("old")).withColumn("size", F.lit("old"))
    out = C.mix_sources(spark, docs, sf).collect()
    size = {r[0]: len((r[1] or "").split()) for r in rows}
    for r in out:
        assert r["size"] == size[r.doc_id] > 0 and 1 <= r.copy <= r.copies <= 2
    for source in ("s0", "s1", "s2", None):
        mine = [r for r in out if r.source == source]
        assert abs(sum(r["size"] for r in mine) - mine[0].target) <= max(r["size"] for r in mine)
    assert C.mix_sources(spark, docs.filter("false"), sf).count() == 0


@pytest.mark.parametrize("stage", [0, 1, 2, 3])
def test_stages_take_very_long_and_tied_texts(spark, corpus, stage):
    sf, _, _ = corpus
    rng = np.random.default_rng(19)
    long = " ".join(str(x) for x in rng.choice([a + b for a in ("ka", "lo") for b in ("mi", "tu")], size=60_000))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    more = spark.createDataFrame([(5000, long, "xx", "s0", 1), (5001, long, "xx", "s1", 1), (5002, "y" * 400_000, None, None, 1)], COLUMNS)
    tied = docs.filter("doc_id IN (3, 5)")
    kept = ids(C.STAGES[stage][1](spark, docs.unionByName(more).unionByName(tied), sf))
    assert 5000 in kept and {3, 5} <= kept
    assert (5001 in kept) == (stage != 2)


def test_repeated_ids_keep_one_row(spark, corpus):
    sf, _, _ = corpus
    docs = spark.read.parquet(f"{sf}/documents.parquet").filter("doc_id in (1, 3)")
    twice = docs.unionByName(docs).unionByName(docs.withColumn("doc_id", F.lit(None).cast("long")))
    out = C.drop_near_duplicates(spark, twice, sf).collect()
    assert sorted(r.doc_id for r in out) == [1, 3]


def test_near_copies_are_decided_by_exact_similarity(spark, tmp_path):
    """Four edits of 200 words leave 176 of 216 runs (0.81), five 171 of 221 (0.77)."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(200):
        w = text(rng, "xx", 200)
        rows.append((i, " ".join(w)))
        for e in range(4 + i % 2):
            w[20 + 30 * e] = f"edit{e}"
        rows.append((1000 + i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = ids(C.drop_near_duplicates(spark, docs, str(tmp_path)))
    close = set(range(1000, 1200, 2))
    assert len(close - kept) >= 0.95 * len(close)
    assert {i for i, _ in rows} - close <= kept
