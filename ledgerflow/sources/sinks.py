"""Parquet sinks: overwrite, replace a range of days, upsert by keys, append, empty tables.

All work goes through Spark's readers and writers and its Hadoop file system, so that any store
that Spark reaches will do. Row counts come from an observation of the write, not from a second
run of the plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.sources.stored import Scratch


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    df, seen = _counted(df)
    df.write.mode("overwrite").partitionBy(*partition_by).option("partitionOverwriteMode", "static").parquet(path)
    return seen.get["rows"]


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    df, seen = _counted(df)
    df.write.mode("append").partitionBy(*partition_by).parquet(path)
    return seen.get["rows"]


def record_mark(mark: DataFrame, source: str, path: str) -> None:
    """Append the high-water mark (watermark_date) of a source to a table of marks; an empty source has none."""
    append(mark.filter("watermark_date IS NOT NULL").select(F.lit(source).alias("source_key"), "watermark_date"), path)


def append_merged(spark: SparkSession, old: str, df: DataFrame, path: str) -> int:
    """Old rows and new rows in a new snapshot, columns that one side lacks being null."""
    return overwrite(spark.read.parquet(old).unionByName(df, allowMissingColumns=True), path)


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def delete_days(spark: SparkSession, path: str, day: str, first: date, last: date, keep: Sequence[date] = ()) -> None:
    """Drop the partitions of a range of days, except those to keep."""
    kept = set(keep)
    for n in range((last - first).days + 1):
        d = first + timedelta(days=n)
        if d not in kept:
            p, fs = _hadoop(spark, f"{path}/{day}={d.isoformat()}")
            fs.delete(p, True)


def replace_days(df: DataFrame, path: str, day: str, first: date, last: date) -> int:
    """Make a range of days hold exactly the batch: its days are overwritten, other days of the range dropped.

    The two steps are not atomic; a rerun repairs a run that broke off between them. The batch is
    computed once and dealt by day, so that each partition gets few files. Its distinct days, which
    the range bounds, reach the driver with the observation of the write.
    """
    span = F.col(day).between(F.lit(first), F.lit(last))
    seen = Observation()
    counted = df.filter(span).observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set(F.col(day)).alias("days"))
    counted.repartition(day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
    delete_days(df.sparkSession, path, day, first, last, seen.get["days"])
    return seen.get["rows"]


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], update: bool = True) -> DataFrame:
    """The rows of a new snapshot after a null-safe merge by keys; ``update=False`` only inserts."""
    kept, other = (old, new) if update else (new, old)
    marked = other.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    rest = kept.join(marked, same, "left_anti")
    return rest.unionByName(new) if update else old.unionByName(rest)


def merge_partitions(new: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str], update: bool = True) -> int:
    """Merge a batch by keys into a partitioned table, in place; returns the rows written.

    The partition columns are among the keys, or follow from them, and are not null. The batch names the
    partitions it touches: only those are read, merged and overwritten, files of others stay as they are. What
    is written is stored first, as it is made of files that it replaces. Not atomic over several
    partitions; a rerun with the same batch repairs a break.
    """
    spark, scratch = new.sparkSession, Scratch()
    batch = scratch.written(new)
    # at most a row for each partition of the table, which the driver lists anyway; prunes the scan
    touched = F.broadcast(batch.select(*partition_by).distinct())
    here = spark.read.parquet(path).join(touched, list(partition_by), "left_semi")
    merged, seen = _counted(scratch.written(upsert(here, batch, keys, update)))
    merged.repartition(*partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    scratch.drop()
    return seen.get["rows"]


def empty_table(spark: SparkSession, schema: T.StructType | str, path: str) -> None:
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
