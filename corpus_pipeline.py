"""Corpus pipeline: five stages, each of which keeps, drops or repeats documents of the one before.

toxicity, language identification, SimHash near-duplicates, benchmark decontamination, mixing.
Every stage works on whole texts of all rows that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import decontaminate, language, mixing, simhash, toxicity
from ledgerflow.llm.common import Scratch, read


def packed(docs: DataFrame) -> DataFrame:
    """The text, and all other columns as one struct, so that no name meets one of an operator's own."""
    return docs.select(F.struct(F.lit(0).alias("__none"), *[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("__rest"), "text")


def unpacked(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again."""
    return df.select(*["text" if c == "text" else F.col(f"__rest.`{c}`").alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.7; the model learns from all folds of the labels."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), held=-1)
    return unpacked(toxicity.score(packed(docs), model).filter("predicted = 0"), docs)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised: those with a letter and near enough to a learned language."""
    model = language.train(docs, held=-1)
    return unpacked(language.identify(packed(docs), model).filter("NOT rejected"), docs)


#: Five words, similarity of the word runs at least 0.8 by exact sets. The bits only propose: 0.8 is an angle
#: of 0.152 pi, 39 of 256 bits on average, and 52 lose few pairs. Candidates differ in at most 14 bits of
#: one of the four words of 64 bits and share two of its eight bit blocks (always so up to 6 bits,
#: in most cases up to 12).
NEAR = {"words": 5, "radius": 14, "blocks": 8, "agree": 2, "confirm_bits": 192, "wide": 52, "distinct": True, "probes": 4, "exact": 0.8}


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    linked = simhash.near_duplicates(packed(docs).withColumn("__doc", F.col("__rest.doc_id")), id_col="__doc", **NEAR)
    first = linked.filter(F.col("__doc").eqNullSafe(F.col("component_id")))
    # rows that repeat the smallest id share their group; the hash picks one of them
    row = F.struct("__rest", "text")
    one = first.groupBy("group").agg(F.min_by(row, F.xxhash64(row)).alias("__row"))
    return unpacked(one.select("__row.*"), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of ten words of a benchmark item."""
    judged = decontaminate.decontaminate(packed(docs), read(spark, sf_dir, "benchmark"))
    return unpacked(judged.filter("NOT contaminated"), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each copy of each document that the mix takes, with size, source_size and target."""
    mixed = mixing.mix(docs).filter("copies > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

#: Trained models and fingerprints have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again for the next."""
    docs, before = read(spark, sf_dir, "documents"), Scratch()
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            table = Scratch()
            docs = table.written(docs)
            before.drop()
            before = table
    return docs
