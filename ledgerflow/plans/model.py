"""The operators wired to the model tables: priced usage, the daily fact and what hangs on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.operators import facts
from ledgerflow.sources import tables as T
from ledgerflow.sources.stored import Scratch

Days = tuple[str, str]


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.cluster_config(T.cluster_history(spark, sf_dir), "event_id")


def warehouses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.warehouse_config(T.warehouse_history(spark, sf_dir))


def priced(spark: SparkSession, sf_dir: str, days: Days | None = None, discounts: Sequence[Mapping] = T.DISCOUNTS, without: Sequence[str] = (), scratch: Scratch | None = None) -> DataFrame:
    """Priced usage, of columns that nothing after needs ``without``."""
    usage = T.usage(spark, sf_dir, days).drop(*without)
    return facts.priced_usage(usage, T.prices(spark), clusters(spark, sf_dir), T.jobs(spark, sf_dir), discounts, T.WORKSPACE_DEFAULTS, scratch=scratch)


def fact(spark: SparkSession, sf_dir: str, days: Days | None = None) -> DataFrame:
    behind = Scratch()
    return facts.cost_daily(priced(spark, sf_dir, days, without=["record_id"], scratch=behind), behind)


def last_days(n: int, as_of: str = T.AS_OF) -> Days:
    """The ``n`` days up to ``as_of``."""
    return str(date.fromisoformat(as_of) - timedelta(n - 1)), as_of


def recent(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """The fact of the last ``n`` days: older usage is not read."""
    return fact(spark, sf_dir, last_days(n))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.job_runs(T.run_periods(spark, sf_dir))


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.query_activity(T.query_history(spark, sf_dir))
