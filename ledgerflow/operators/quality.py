"""Data-quality checks of priced usage as one aggregate pass that yields check rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.exprs import matches_any, money, money_if, rounded
from ledgerflow.operators import duplicates
from ledgerflow.operators.attribution import UNALLOCATED
from ledgerflow.sources.stored import Scratch


@dataclass(frozen=True)
class QualityConfig:
    max_lag_hours: float = 36
    max_null_ratio: float = 0.001
    min_rows: int = 1
    max_negative_rows: int = 0
    min_price_match: float = 0.98
    min_coverage: float = 0.80
    ignore_skus: tuple[str, ...] = ()
    coverage_dims: tuple[str, ...] = ("cost_center", "team")


def _row(name: str, passed: Column, value: Column, limit: float, level: str) -> Column:
    return F.struct(F.lit(name).alias("check_name"), F.coalesce(passed, F.lit(False)).alias("passed"), value.cast("double").alias("observed"), F.lit(float(limit)).alias("threshold"), F.lit(level).alias("severity"))


def checks(priced: DataFrame, as_of: str, keys: Sequence[str] = ("record_id",), c: QualityConfig = QualityConfig(), store: bool = True, scratch: Scratch | None = None) -> DataFrame:
    """(check_name, passed, observed, threshold, severity); ``keys`` is the full grain of the table.

    Without ``store`` the table is taken as stored already.
    """
    # both aggregations read the few columns that checks need, stored once
    wanted = dict.fromkeys([*keys, "sku_name", "usage_date", "total_cost_usd", "price_missing", *c.coverage_dims])
    scratch = scratch or Scratch()
    priced = scratch.written(priced.select(*wanted)) if store else priced
    ignored = matches_any(F.col("sku_name"), c.ignore_skus)
    cost = F.col("total_cost_usd")
    one = priced.agg(
        F.max("usage_date").alias("last"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(cost.isNull()).alias("nulls"),
        F.count_if(cost < 0).alias("negative"),
        F.count_if(~ignored).alias("due"),
        F.count_if(~ignored & ~F.col("price_missing")).alias("found"),
        money(cost).alias("cost"),
        *[money_if(F.col(d) != UNALLOCATED, cost).alias(f"has_{d}") for d in c.coverage_dims],
    )
    repeated = duplicates.of_stored(priced, keys, scratch).agg(F.count(F.lit(1)).alias("repeated"))
    # both sides are one aggregate row
    both = one.withColumn("k", F.lit(1)).join(repeated.withColumn("k", F.lit(1)), "k")
    lag = F.datediff(F.lit(as_of).cast("date"), "last") * 24
    share = lambda a, b, empty: F.when(b > 0, rounded(a / b, 6)).otherwise(F.lit(empty))
    n = F.col("n")
    rows = [
        _row("freshness", lag <= c.max_lag_hours, lag, c.max_lag_hours, "error"),
        _row("null_ratio", share(F.col("nulls"), n, 0.0) <= c.max_null_ratio, share(F.col("nulls"), n, 0.0), c.max_null_ratio, "error"),
        _row("row_count", n >= c.min_rows, n, c.min_rows, "error"),
        _row("negative_cost", F.col("negative") <= c.max_negative_rows, F.col("negative"), c.max_negative_rows, "error"),
        _row("price_match", share(F.col("found"), F.col("due"), 1.0) >= c.min_price_match, share(F.col("found"), F.col("due"), 1.0), c.min_price_match, "error"),
        *[_row(f"tag_coverage_{d}", share(F.col(f"has_{d}"), F.col("cost"), 1.0) >= c.min_coverage, share(F.col(f"has_{d}"), F.col("cost"), 1.0), c.min_coverage, "warning") for d in c.coverage_dims],
        _row("duplicate_keys", F.col("repeated") == 0, F.col("repeated"), 0, "error"),
    ]
    return both.select(F.inline(F.array(*rows)))


def summary(rows: DataFrame) -> DataFrame:
    ok = F.col("passed")
    return rows.agg(F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("passed"), F.count_if(~ok).alias("failed"), F.count_if(~ok & (F.col("severity") == "error")).alias("blocking"))


def enforce(rows: DataFrame) -> None:
    """Raise if a check of severity error failed; only names of failed checks reach the driver."""
    failed = [r["check_name"] for r in rows.filter("NOT passed AND severity = 'error'").select("check_name").collect()]
    if failed:
        raise ValueError(f"blocking quality checks failed: {', '.join(sorted(failed))}")


def unpriced(priced: DataFrame) -> DataFrame:
    """Records, quantity and span of days of all usage without a price, by SKU, product, unit and cloud."""
    return priced.filter("price_missing").groupBy("sku_name", "billing_origin_product", "usage_unit", "cloud").agg(F.count(F.lit(1)).alias("records"), F.sum("usage_quantity").alias("quantity"), F.min("usage_date").alias("first_seen"), F.max("usage_date").alias("last_seen"))


def table_exists(name: str, table: DataFrame | None, spark: SparkSession) -> DataFrame:
    """One check row for a table that a tolerant read gave or did not give."""
    found = float(table is not None)
    row = F.struct(F.lit("table_exists").alias("check_name"), F.lit(name).alias("table_name"), F.lit(found == 1).alias("passed"), F.lit(found).alias("observed"), F.lit(1.0).alias("threshold"), F.lit("error").alias("severity"))
    return spark.range(1).select(F.inline(F.array(row)))


def unpriced_skus(priced: DataFrame, top: int = 10) -> DataFrame:
    return priced.filter("price_missing").groupBy("sku_name").agg(F.count(F.lit(1)).alias("records"), F.sum("usage_quantity").alias("quantity"), F.min("usage_date").alias("first_seen"), F.max("usage_date").alias("last_seen")).orderBy(F.desc("records"), "sku_name").limit(top)
