"""Queries on series, budgets, chargeback, recommendations, checks and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.exprs import money
from ledgerflow.operators import alerts, budgets, duplicates, facts, quality, recommend, series
from ledgerflow.operators.budgets import Budget
from ledgerflow.plans import model
from ledgerflow.sources import readers, stored
from ledgerflow.sources import tables as T

ANOMALY = series.AnomalyConfig(score_threshold=2.0, min_pct_change=0.2)
BUDGETS = (
    Budget("org", 6000.0),
    Budget("org-quarter", 20000.0, period="quarter"),
    Budget("sql", 1500.0, {"sku_group": "*SQL*"}),
    Budget("team-1", 600.0, {"team": ["team-1", "team-2"], "environment": "PRD"}),
    Budget("year", 20000.0, {"cost_center": "BUILDING"}, "year", (70, 95)),
    Budget("old", 10.0, effective_to="2000-01-01"),
)
AS_OF = "2001-07-20"
SHARED = ("WAREHOUSE:1*", "*0000000?7")
CHANNELS = (("pager", "critical"), ("chat", "high"), ("table", "low"))


def a16_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.series(spark, sf_dir)


def t5_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.anomalies(T.series(spark, sf_dir), ANOMALY)


def t5_incremental_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anomalies of the newest days from the stored state of the days before: one day, then the rest in one batch."""
    points = stored.written(T.series(spark, sf_dir))
    between = lambda a, b: points.filter(F.col("usage_date").between(F.lit(a).cast("date"), F.lit(b).cast("date")))
    state = stored.written(series.baseline_state(between("1970-01-01", "2024-01-25"), ANOMALY))
    after, first = series.advance(state, between("2024-01-26", "2024-01-26"), ANOMALY)
    # every series has all days, so that the new state is whole
    _, rest = series.advance(stored.written(after), between("2024-01-27", "2999-12-31"), ANOMALY)
    return first.unionByName(rest)


def t5_anomalies_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.anomalies(T.series(spark, sf_dir), series.AnomalyConfig(score_threshold=2.0, min_pct_change=0.2, day_of_week_aware=False, method="zscore", last_n=10))


def t6_gap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    some = T.series(spark, sf_dir).filter("day(usage_date) % 3 <> 0 OR dim_value = 'click'")
    f = series.filled(some, 20)
    return f.select("dimension", "dim_value", "history", F.posexplode("v").alias("i", "cost"))


def t14_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.forecasts(T.series(spark, sf_dir))


def t11_seasonal_naive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.forecasts(T.series(spark, sf_dir), series.ForecastConfig(method="seasonal_naive", weekly=False, horizon_days=10))


def t12_moving_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.forecasts(T.series(spark, sf_dir), series.ForecastConfig(method="moving_average", weekly=False, horizon_days=5))


def _status(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the widest period of the budgets is the year
    return budgets.budget_status(model.fact(spark, sf_dir, ("2001-01-01", AS_OF)), BUDGETS, AS_OF)


def b6_budget_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budgets.by_consumption(_status(spark, sf_dir))


def _scope(i: int) -> dict:
    if i % 5 < 3:
        return {"entity_key": f"JOB:{i}"}
    return {"team": [f"team-{i % 3}", "SIN_*"], "sku_group": "*SQL*", "environment": f"{'PDQ'[i % 3]}*"} if i % 5 == 3 else {}


#: Budgets by the thousand: of single jobs, of teams and SKU groups, of the whole organisation.
MANY_BUDGETS = tuple(Budget(f"b{i}", 5.0 + i % 100, _scope(i), ("month", "quarter", "year")[i % 3]) for i in range(10_000))


def b2_many_budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten thousand budgets by the index of predicates."""
    status = budgets.budget_status(model.fact(spark, sf_dir, ("2001-01-01", AS_OF)), MANY_BUDGETS, AS_OF)
    return status.select("budget_id", "scope", "period", "actual", "consumed_pct", "projected", "status")


def _budget_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluations of three days, from one stored fact."""
    costs = stored.written(model.fact(spark, sf_dir, ("2001-01-01", AS_OF)).select("usage_date", "total_cost_usd", "sku_group", "team", "environment", "cost_center"))
    days = ("2001-06-10", "2001-07-10", AS_OF)
    return alerts.union_all([budgets.budget_status(costs, BUDGETS, d).withColumn("as_of_date", F.lit(d).cast("date")) for d in days])


def w7_latest_budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest evaluation of each budget out of a history of them."""
    return budgets.latest_status(_budget_history(spark, sf_dir))


def l15_reloaded_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.reloaded(_budget_history(spark, sf_dir), series.anomalies(T.series(spark, sf_dir), ANOMALY), "2024-01-30")


def t15_budget_with_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Budgets whose rest of the month comes from a forecast of the organisation's series."""
    day = "2024-01-20"
    costs = T.read(spark, sf_dir, "events").select(F.to_date("ts").alias("usage_date"), F.col("value").alias("total_cost_usd"), F.col("event_type").alias("team")).filter(F.col("usage_date") <= F.lit(day).cast("date"))
    org = costs.groupBy(F.lit("all").alias("dimension"), F.lit("all").alias("dim_value"), "usage_date").agg(money(F.col("total_cost_usd")).alias("cost"))
    ahead = series.forecasts(org, series.ForecastConfig(method="moving_average", weekly=False, min_history_days=7))
    return budgets.budget_status(costs, (Budget("org", 90000.0), Budget("clicks", 20000.0, {"team": "click"})), day, ahead)


def a16_cost_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.daily_series(model.fact(spark, sf_dir), ("team", "sku_group", "environment", "absent"))


def q10_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existence checks of tables, one of which is not there."""
    rows = [quality.table_exists(t, readers.read_source(spark, [f"{sf_dir}/{t}.parquet"], optional=True), spark) for t in ("lineitem", "orders", "absent")]
    return alerts.union_all(rows)


def q5_unpriced_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unpriced(model.priced(spark, sf_dir))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budgets.chargeback(model.fact(spark, sf_dir), shared=SHARED, overhead=0.05)


def c3_chargeback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budgets.by_total(_lines(spark, sf_dir))


def c3_chargeback_none(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budgets.chargeback(model.fact(spark, sf_dir), shared=SHARED, strategy="none", unallocated_strategy="even")


def c4_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    # both sides read the fact, computed once
    fact = stored.written(model.fact(spark, sf_dir).select("year_month", "total_cost_usd", "entity_key", "cost_center", "entity_name", "project", "application"))
    return budgets.reconciliation(budgets.chargeback(fact, shared=SHARED, overhead=0.05), fact, 0.05)


def c5_showback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budgets.showback(_lines(spark, sf_dir))


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    clusters = model.clusters(spark, sf_dir)
    return recommend.profiles(model.recent(spark, sf_dir, 366), clusters, model.runs(spark, sf_dir), model.activity(spark, sf_dir), T.AS_OF, 365)


def a15_entity_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profiles(spark, sf_dir)


RULES = recommend.RuleConfig(min_savings=1.0, max_queries_per_hour=60.0, serverless_min_runs=5, serverless_savings=0.25, max_serverless_minutes=200.0, photon_min_monthly=20.0, min_failed=2)


def r11_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend.recommendations(_profiles(spark, sf_dir), RULES)


def r12_savings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recommend.savings_summary(recommend.recommendations(_profiles(spark, sf_dir), RULES))


IGNORED = quality.QualityConfig(ignore_skus=("UNKNOWN_*",))


def q9_quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.checks(model.priced(spark, sf_dir), "2001-11-05", c=IGNORED)


def q7_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines that share order and line number, found by bitmaps before any key is shuffled."""
    return duplicates.repeated_keys(T.read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def q8_quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.summary(q9_quality_checks(spark, sf_dir))


def q5_unpriced_skus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unpriced_skus(model.priced(spark, sf_dir))


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules over usage priced once and stored, and over the fact of it, stored as well."""
    scratch = stored.Scratch()
    wanted = dict.fromkeys([*facts.GRAIN, *facts.MEASURES, "record_id", "usage_quantity", "usage_unit", "entity_name", "owner_resolved", "price_missing", "is_untagged", "is_fully_tagged", "is_photon"])
    priced = scratch.written(model.priced(spark, sf_dir).select(*wanted))
    daily = scratch.written(facts.cost_daily(priced))
    status = budgets.budget_status(daily, BUDGETS, AS_OF)
    totals = daily.groupBy("usage_date").agg(money(F.col("total_cost_usd")).alias("cost"))
    of_day = daily.filter(F.col("usage_date") == F.lit(T.AS_OF).cast("date"))
    parts = [
        alerts.budget_threshold(status),
        alerts.forecast_overrun(status),
        alerts.cost_anomaly(series.anomalies(T.series(spark, sf_dir), ANOMALY), "low"),
        alerts.daily_spike(totals, 0.01, 1.0),
        alerts.new_expensive(facts.dim_entity(daily, T.AS_OF), T.AS_OF, 20.0, 60),
        alerts.coverage_drop(facts.tag_coverage(of_day), T.AS_OF, least=0.99),
        alerts.data_quality(quality.checks(priced, "2001-11-05", c=IGNORED, store=False)),
    ]
    return alerts.by_severity(alerts.union_all(parts))


def l10_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts(spark, sf_dir)


def l4_daily_spike(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = T.read(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("usage_date")).agg(money(F.col("o_totalprice")).alias("cost"))
    return alerts.daily_spike(totals, -0.9, 1.0)


def l7_pipeline_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = T.read(spark, sf_dir, "events").select(F.concat(F.lit("stage-"), (F.col("user_id") % 5).cast("string")).alias("stage"), F.col("event_type").alias("status"), F.col("ts").alias("finished_at"))
    return alerts.pipeline_health(log, "2024-01-30 00:00:00")


def _admitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stored.written(series.anomalies(T.series(spark, sf_dir), ANOMALY))
    raw = alerts.cost_anomaly(found, "low").unionByName(alerts.cost_anomaly(found.filter("dimension = 'event_type'"), "low"))
    history = raw.filter("fingerprint < '8'").select("fingerprint", F.when(F.col("fingerprint") < "4", F.lit("2024-01-30 10:00:00")).otherwise(F.lit("2024-01-28 10:00:00")).cast("timestamp_ntz").alias("created_at"))
    return alerts.admit(raw, history, "2024-01-31 00:00:00", cap=3, least="low")


def l11_admitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.alert_log(_admitted(spark, sf_dir), CHANNELS).drop("threshold", "value", "created_at")


def l13_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.route(_admitted(spark, sf_dir), CHANNELS).select("fingerprint", "channel", "severity")


def l16_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.digest(_admitted(spark, sf_dir))


QUERIES = {n: f for n, f in list(globals().items()) if n[0] in "atbcrqlw" and n.split("_")[0][1:].isdigit()}
