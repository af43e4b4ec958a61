"""Tolerant reads, column and row selection, audit columns, ingest windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class MissingSource(ValueError):
    """A mandatory source has none of its candidates."""


def _try(spark: SparkSession, name: str) -> DataFrame | None:
    try:
        if "/" in name:
            return spark.read.parquet(name)
        return spark.table(name) if spark.catalog.tableExists(name) else None
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
            return None
        raise


def read_source(spark: SparkSession, candidates: Sequence[str], optional: bool = False) -> DataFrame | None:
    """The first table or Parquet path that exists; None if an optional source has none."""
    for name in candidates:
        df = _try(spark, name)
        if df is not None:
            return df
    if optional:
        return None
    raise MissingSource(f"none of {', '.join(candidates)} exists")


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over all cores if its scan has fewer splits than that, as one file of one row group has.

    For work that costs far more for each row than moving it; a large table has splits enough and is not moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def select_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the wanted columns that are present; all columns if none is."""
    present = [c for c in columns if c in df.columns]
    return df.select(*present) if present else df


def exclude(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose value is in the list go; null values stay."""
    return df.filter(F.col(column).isNull() | ~F.col(column).isin(*values)) if values else df


def with_audit(df: DataFrame, run_id: str, source: str) -> DataFrame:
    return df.withColumns({"_ingested_at": F.current_timestamp(), "_run_id": F.lit(run_id), "_source": F.lit(source)})


def between_days(day: Column, first: str, last: str) -> Column:
    return day.between(F.lit(first).cast("date"), F.lit(last).cast("date"))


def ingest_days(df: DataFrame, stamp: str, day: str, first: str, last: str) -> DataFrame:
    """Rows of a range of days with the day derived from a time; the filter reaches the scan."""
    start, end = F.lit(first).cast("timestamp_ntz"), F.date_add(F.lit(last).cast("date"), 1).cast("timestamp_ntz")
    return df.filter((F.col(stamp) >= start) & (F.col(stamp) < end)).withColumn(day, F.to_date(stamp))


def ingest_window(marks: DataFrame, source: str, last: str, initial_days: int = 400, lookback_days: int = 7, full_refresh: bool = False) -> DataFrame:
    """One row (first_day, last_day): from the high-water mark less the lookback, or the initial load.

    ``marks`` has source_key and watermark_date.
    """
    end = F.lit(last).cast("date")
    mark = marks.filter(F.col("source_key") == source).agg(F.max("watermark_date").alias("mark"))
    back = F.when(F.col("mark").isNotNull(), F.date_sub(F.least("mark", end), lookback_days))
    first = F.date_sub(end, initial_days) if full_refresh else F.coalesce(back, F.date_sub(end, initial_days))
    return mark.select(first.alias("first_day"), end.alias("last_day"))


def high_water_marks(marks: DataFrame) -> DataFrame:
    return marks.groupBy("source_key").agg(F.max("watermark_date").alias("watermark_date"))
