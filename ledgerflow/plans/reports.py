"""Report, governance-view and diagnostic queries over the facts: thin compositions of filters, sums and top-k."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.exprs import lookup, money, money_if, normalise_key, ratio, rounded
from ledgerflow.operators import facts, series
from ledgerflow.operators.attribution import UNALLOCATED, alias_index
from ledgerflow.plans import model
from ledgerflow.plans import queries_analytics as A
from ledgerflow.sources import stored
from ledgerflow.sources import tables as T

Query = Callable[[SparkSession, str], DataFrame]


def usd(name: str = "total_cost_usd") -> Column:
    return money(F.col(name))


def since(days: int, as_of: str = T.AS_OF, column: str = "usage_date") -> Column:
    end = F.lit(as_of).cast("date")
    return F.col(column).between(F.date_sub(end, days - 1), end)


def top(df: DataFrame, k: int, by: str, *ties: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(by), *ties).limit(k)


def d2_latest_kpi(s: SparkSession, d: str) -> DataFrame:
    k = facts.kpis(model.fact(s, d))
    pct = lambda c: rounded(F.coalesce(c, F.lit(0.0)) * 100, 2)
    return k.orderBy(F.desc("usage_date")).limit(1).select("usage_date", "total_cost_usd", "mtd_cost_usd", pct(F.col("dod_change")).alias("dod_pct"), pct(F.col("serverless_ratio")).alias("serverless_pct"))


def _kpis(s: SparkSession, d: str, days: int) -> DataFrame:
    """KPIs of the last days. The 28 days of usage that rolling means reach back to, and the month's start, lie in the three months before."""
    return facts.kpis(model.recent(s, d, days + 92)).filter(since(days))


def d3_daily_cost(s: SparkSession, d: str) -> DataFrame:
    return _kpis(s, d, 90).select("usage_date", "total_cost_usd", "avg_7d_usd", "avg_28d_usd")


def d4_cost_by_team(s: SparkSession, d: str) -> DataFrame:
    return top(model.recent(s, d, 30).groupBy("team").agg(usd().alias("cost")), 15, "cost", "team")


def d6_budget_now(s: SparkSession, d: str) -> DataFrame:
    return A.b6_budget_status(s, d).select("budget_id", "scope", "status", "consumed_pct", "projected_pct")


def d7_actual_and_forecast(s: SparkSession, d: str) -> DataFrame:
    org = T.read(s, d, "events").groupBy(F.lit("ORGANIZACION").alias("dimension"), F.lit("ORGANIZACION").alias("dim_value"), F.to_date("ts").alias("usage_date")).agg(money(F.col("value")).alias("cost"))
    actual = org.select("usage_date", F.col("cost").alias("amount"), F.lit("Real").alias("series"))
    ahead = series.forecasts(org, series.ForecastConfig(method="moving_average", weekly=False)).select(F.col("forecast_date").alias("usage_date"), F.col("expected_cost").alias("amount"), F.lit("Pronostico").alias("series"))
    return actual.filter(since(60, "2024-01-30")).unionByName(ahead)


def newest_anomalies(found: DataFrame) -> DataFrame:
    return found.orderBy(F.desc("usage_date"), F.desc(F.abs("score")), "dimension", "dim_value").limit(50).select("usage_date", "dimension", "dim_value", "score", "severity")


def severe(found: DataFrame) -> DataFrame:
    return found.filter(F.col("severity").isin("high", "critical"))


def d8_recent_anomalies(s: SparkSession, d: str) -> DataFrame:
    return newest_anomalies(A.t5_anomalies(s, d).filter(since(14, "2024-01-30")))


def d8_severe_anomalies(s: SparkSession, d: str) -> DataFrame:
    return newest_anomalies(severe(A.t5_anomalies(s, d).filter(since(14, "2024-01-30"))))


def d9_cost_by_entity(s: SparkSession, d: str) -> DataFrame:
    g = model.recent(s, d, 30).groupBy("entity_key", "entity_type", "team", "cost_center", "environment").agg(usd().alias("cost"))
    return top(g, 25, "cost", "entity_key", "team", "cost_center", "environment")


def d10_latest_chargeback(s: SparkSession, d: str) -> DataFrame:
    lines = A.c3_chargeback(s, d)
    last = lines.agg(F.max("year_month").alias("year_month"))
    return lines.join(F.broadcast(last), "year_month").select("year_month", "unit", "direct_usd", "total_usd", "pct_of_total")


def d11_chargeback_year(s: SparkSession, d: str) -> DataFrame:
    return A.c3_chargeback(s, d).filter(F.to_date(F.concat("year_month", F.lit("-01"))) >= F.add_months(F.trunc(F.lit(T.AS_OF).cast("date"), "MM"), -11)).select("year_month", "unit", "total_usd")


def d12_monthly_by_sku(s: SparkSession, d: str) -> DataFrame:
    f = model.fact(s, d, ("2000-08-01", "2999-12-31"))
    return f.groupBy("year_month", "sku_group").agg(usd().alias("cost"), F.sum("usage_quantity").alias("dbus"))


def d13_cost_by_workspace(s: SparkSession, d: str) -> DataFrame:
    names = T.read(s, d, "nation").filter("n_nationkey % 4 <> 0").select(F.col("n_nationkey").cast("string").alias("workspace_id"), F.col("n_name").alias("workspace_name"))
    return model.recent(s, d, 30).groupBy("workspace_id").agg(usd().alias("cost")).join(facts.small(names), "workspace_id", "left")


def _coverage(s: SparkSession, d: str, days: int, *keys: str) -> DataFrame:
    c = facts.tag_coverage(model.recent(s, d, days))
    g = c.groupBy(*keys).agg(usd("attributed_cost_usd").alias("attributed"), usd("total_cost_usd").alias("total"))
    return g.select(*keys, ratio(F.col("attributed") * 100, F.col("total"), 2).alias("coverage_pct"))


def d14_coverage_by_day(s: SparkSession, d: str) -> DataFrame:
    return _coverage(s, d, 60, "usage_date", "dimension")


def _job_costs(s: SparkSession, d: str, *dims: str) -> DataFrame:
    """Runs of the last 30 days by job and dimensions of the job."""
    runs = facts.job_runs(T.run_periods(s, d), T.jobs(s, d)).filter(since(30, column="run_date"))
    failed = F.col("is_failed")
    g = facts.job_run_cost(runs, model.priced(s, d)).groupBy(F.coalesce("job_name", F.col("job_id").cast("string")).alias("job"), *dims)
    return g.agg(F.count(F.lit(1)).alias("runs"), F.count_if(failed).alias("failures"), rounded(F.avg("duration_minutes"), 2).alias("avg_minutes"), usd("run_cost_usd").alias("cost"), money_if(failed, F.col("run_cost_usd")).alias("failed_cost"))


def d15_costly_jobs(s: SparkSession, d: str) -> DataFrame:
    g = _job_costs(s, d, "team", "cost_center").withColumns({"cost_per_run": ratio(F.col("cost"), F.col("runs"), 4), "cost": rounded(F.col("cost"), 2)})
    return top(g, 30, "cost", "job", "team", "cost_center").select("job", "team", "cost_center", "runs", "failures", "avg_minutes", "cost", "cost_per_run")


def d16_warehouses(s: SparkSession, d: str) -> DataFrame:
    w = facts.warehouse_cost(model.priced(s, d, model.last_days(30)), model.activity(s, d), model.warehouses(s, d))
    hours = F.sum(F.col("active_hours").cast("decimal(20,4)")).cast("double")
    g = w.groupBy(F.coalesce("warehouse_name", "warehouse_id").alias("warehouse"), "warehouse_size", "warehouse_type").agg(usd().alias("cost"), F.sum("query_count").alias("queries"), rounded(hours, 2).alias("hours"), F.max("auto_stop_minutes").alias("auto_stop_minutes"))
    return top(g.withColumn("cost_per_query", ratio(F.col("cost"), F.col("queries"), 4)), 30, "cost", "warehouse", "warehouse_size", "warehouse_type")


def d17_detail(s: SparkSession, d: str) -> DataFrame:
    f = model.recent(s, d, 7).groupBy("usage_date", "workspace_id", "entity_key", "sku_name").agg(usd().alias("cost"))
    return top(f, 500, "cost", "usage_date", "workspace_id", "entity_key", "sku_name")


def _found(s: SparkSession, d: str) -> DataFrame:
    return A.r11_recommendations(s, d)


def d18_savings_total(s: SparkSession, d: str) -> DataFrame:
    return _found(s, d).agg(usd("savings_usd").alias("savings_usd"), money_if(F.col("confidence") == "alta", F.col("savings_usd")).alias("high_confidence_usd"), F.count(F.lit(1)).alias("findings"), F.count_distinct("entity_key").alias("entities"))


def d20_recommendations(s: SparkSession, d: str) -> DataFrame:
    return top(_found(s, d), 200, "savings_usd", "entity_key", "workspace_id", "rule_id").select("entity_key", "workspace_id", "rule_id", "savings_usd", "severity")


def d21_shares(s: SparkSession, d: str) -> DataFrame:
    return _kpis(s, d, 90).select("usage_date", rounded(F.col("serverless_ratio") * 100, 2).alias("serverless_pct"), rounded(F.col("all_purpose_ratio") * 100, 2).alias("all_purpose_pct"), rounded(F.col("allocated_ratio") * 100, 2).alias("coverage_pct"), "cost_per_dbu")


def _untagged_by_resource(fact: DataFrame) -> DataFrame:
    cost = fact.filter("is_untagged").groupBy("entity_name", "entity_type", "workspace_id").agg(usd().alias("cost"))
    return top(cost, 50, "cost", "entity_name", "entity_type", "workspace_id")


def d22_untagged_by_resource(s: SparkSession, d: str) -> DataFrame:
    """Over all days; the report's 30 days are ``d22_untagged_30_days``."""
    return _untagged_by_resource(model.fact(s, d))


def d22_untagged_30_days(s: SparkSession, d: str) -> DataFrame:
    return _untagged_by_resource(model.recent(s, d, 30))


def d23_unstable_jobs(s: SparkSession, d: str) -> DataFrame:
    g = _job_costs(s, d, "team").filter("failures > 0")
    g = g.withColumns({"failure_pct": ratio(F.col("failures") * 100.0, F.col("runs"), 1), "failed_cost": rounded(F.col("failed_cost"), 2)})
    return top(g, 30, "failed_cost", "job", "team").select("job", "team", "runs", "failures", "failure_pct", "failed_cost")


def d24_cluster_config(s: SparkSession, d: str) -> DataFrame:
    cost = model.fact(s, d).filter("entity_type = 'CLUSTER'").groupBy(F.col("entity_id").alias("cluster_id")).agg(usd().alias("cost"))
    c = model.clusters(s, d).select("cluster_id", "worker_count", "dbr_version", "auto_termination_minutes")
    return top(cost.join(c, "cluster_id", "left"), 100, "cost", "cluster_id")


def d25_run_log(s: SparkSession, d: str) -> DataFrame:
    log = T.read(s, d, "events").select("event_id", F.col("ts").alias("finished_at"), F.col("event_type").alias("status"))
    return log.filter(F.col("finished_at") >= F.lit("2024-01-24").cast("timestamp_ntz")).orderBy(F.desc("finished_at"), F.desc("event_id")).limit(200)


def d26_alert_log(s: SparkSession, d: str) -> DataFrame:
    return newest_alerts(A.alerts.alert_log(A._admitted(s, d), A.CHANNELS), "2024-01-31")


def newest_alerts(log: DataFrame, as_of: str) -> DataFrame:
    """The 200 newest alerts of 14 days; ties by outcome, fingerprint and subject."""
    recent = log.filter(F.col("created_at") >= F.date_sub(F.lit(as_of).cast("date"), 13).cast("timestamp_ntz"))
    return recent.orderBy(F.desc("created_at"), "outcome", "fingerprint", "subject").limit(200).select("created_at", "rule", "severity", "subject", "fingerprint", "outcome", "channels")


def d27_coverage_by_dimension(s: SparkSession, d: str) -> DataFrame:
    return _coverage(s, d, 30, "dimension")


def d29_empty_tags(s: SparkSession, d: str) -> DataFrame:
    p = model.priced(s, d)
    has = F.exists(F.map_values("custom_tags"), lambda v: F.trim(v) != "")
    return p.agg(usd().alias("cost"), money_if(~has, F.col("total_cost_usd")).alias("cost_without_tags"), F.count_distinct("entity_key").alias("entities"))


def v1_usage_live(s: SparkSession, d: str) -> DataFrame:
    return model.priced(s, d, model.last_days(90)).select("record_id", "usage_date", "entity_type", "entity_id", "sku_name", "unit_price", "list_cost_usd")


def _tags(rows: DataFrame) -> DataFrame:
    """One row for each tag of usage rows; no join, so that a repeated record counts once for each of its rows."""
    known = {k: dim for dim, keys in alias_index().items() for k in keys}
    key = normalise_key(F.col("tag_key"))
    return rows.select("*", F.explode("custom_tags").alias("tag_key", "tag_value")).withColumns({"key": key, "dimension": lookup(known, key)})


def _spellings() -> list[Column]:
    return [F.concat_ws(",", F.array_sort(F.collect_set("tag_key"))).alias("spellings"), F.count_distinct("tag_value").alias("distinct_values")]


def v2_tag_inventory(s: SparkSession, d: str) -> DataFrame:
    return _tags(model.priced(s, d)).groupBy("key", "dimension").agg(*_spellings(), usd().alias("cost"))


def e9_tag_keys(s: SparkSession, d: str) -> DataFrame:
    """Keys with their spellings, values and the cost of the last 30 days."""
    cost = money_if(since(30), F.col("total_cost_usd"))
    return _tags(model.priced(s, d)).groupBy("key", "dimension").agg(*_spellings(), cost.alias("cost_30_days"))


def d30_unknown_keys_top(s: SparkSession, d: str) -> DataFrame:
    g = _tags(model.priced(s, d)).filter("dimension IS NULL").groupBy("key").agg(F.count(F.lit(1)).alias("records"), usd().alias("cost"))
    return top(g, 30, "cost", "key")


def e13_empty_tag_share(s: SparkSession, d: str) -> DataFrame:
    bare = F.coalesce(F.size("custom_tags") <= 0, F.lit(True))
    return T.usage(s, d).agg(F.count(F.lit(1)).alias("records"), F.count_if(bare).alias("without_tags"), ratio(F.count_if(bare) * 100.0, F.count(F.lit(1)), 4).alias("without_tags_pct"))


def e14e_copy_against_source(s: SparkSession, d: str) -> DataFrame:
    """Tranches and SKUs of the price list as ingested, and the SKUs of the usage it serves."""
    copy = stored.written(T.prices(s))
    listed = copy.agg(F.lit("copy").alias("side"), F.count(F.lit(1)).alias("tranches"), F.count_distinct("sku_name").alias("skus"))
    source = T.prices(s).agg(F.lit("source").alias("side"), F.count(F.lit(1)).alias("tranches"), F.count_distinct("sku_name").alias("skus"))
    used = T.usage(s, d).agg(F.lit("usage").alias("side"), F.count(F.lit(1)).alias("tranches"), F.count_distinct("sku_name").alias("skus"))
    return listed.unionByName(source).unionByName(used)


def e15c_sample(s: SparkSession, d: str) -> DataFrame:
    keys = ("usage_date", "sku_group", "entity_type", "team", "cost_center")
    g = model.recent(s, d, 30).groupBy(*keys).agg(usd().alias("cost"), F.sum("record_count").alias("records"))
    return top(g, 50, "cost", *keys)


def v3_coverage_live(s: SparkSession, d: str) -> DataFrame:
    return facts.live_coverage(model.priced(s, d, model.last_days(90)))


def v4_untagged_live(s: SparkSession, d: str) -> DataFrame:
    return facts.live_untagged(model.priced(s, d, model.last_days(90)))


def d31_tag_inventory_top(s: SparkSession, d: str) -> DataFrame:
    return top(v2_tag_inventory(s, d).select("key", F.coalesce("dimension", F.lit("NO RECONOCIDA")).alias("dimension"), "cost"), 50, "cost", "key")


def d32_unresolved(s: SparkSession, d: str) -> DataFrame:
    u = top(v4_untagged_live(s, d), 100, "list_cost_usd", "entity_type", "entity_id", "workspace_id", "sku_name", "billing_origin_product")
    return u.select("entity_type", "entity_id", "sku_name", "billing_origin_product", "records", "first_seen", "last_seen", "list_cost_usd")


def _untagged_by_type(untagged: DataFrame) -> DataFrame:
    return untagged.groupBy("entity_type").agg(rounded(usd("list_cost_usd"), 2).alias("cost"), F.sum("records").alias("records")).orderBy(F.desc("cost"))


def d33_untagged_by_type(s: SparkSession, d: str) -> DataFrame:
    """Over all days; the report on the view's 90 days is ``d33_untagged_90_days``."""
    return _untagged_by_type(facts.live_untagged(model.priced(s, d)))


def d33_untagged_90_days(s: SparkSession, d: str) -> DataFrame:
    return _untagged_by_type(v4_untagged_live(s, d)).drop("records")


def e1_daily(s: SparkSession, d: str) -> DataFrame:
    return model.recent(s, d, 30).groupBy("usage_date").agg(usd().alias("cost"))


def e2_teams(s: SparkSession, d: str) -> DataFrame:
    g = model.recent(s, d, 30).groupBy("team", "cost_center", "environment").agg(usd().alias("cost"), F.count_distinct("entity_key").alias("entities"))
    return top(g, 20, "cost", "team", "cost_center", "environment")


def e3_one_day(s: SparkSession, d: str) -> DataFrame:
    g = model.fact(s, d, ("2001-07-15", "2001-07-15")).groupBy("sku_group", "entity_key", "team").agg(usd().alias("cost"))
    return top(g, 50, "cost", "sku_group", "entity_key", "team")


def e7_invoice(s: SparkSession, d: str) -> DataFrame:
    return model.priced(s, d).groupBy(F.date_format("usage_date", "yyyy-MM").alias("year_month")).agg(usd("list_cost_usd").alias("list_usd"), usd("discount_usd").alias("discount_usd"), usd("effective_cost_usd").alias("effective_usd"))


def e8_attribution(s: SparkSession, d: str) -> DataFrame:
    return model.priced(s, d).groupBy("project", "project_source").agg(F.count(F.lit(1)).alias("records"), usd().alias("cost"))


def e10_values_of_key(s: SparkSession, d: str) -> DataFrame:
    return _tags(T.usage(s, d)).filter("key = 'equipo'").groupBy("tag_value").agg(F.count(F.lit(1)).alias("records"))


def e11_unknown_keys(s: SparkSession, d: str) -> DataFrame:
    return _tags(T.usage(s, d)).filter("dimension IS NULL").groupBy("tag_key").agg(F.count(F.lit(1)).alias("records"))


def e12_keys_by_resource(s: SparkSession, d: str) -> DataFrame:
    sources = (("CLUSTER", T.cluster_history(s, d)), ("JOB", T.jobs(s, d)), ("WAREHOUSE", T.warehouse_history(s, d)))
    rows = [df.select(F.lit(name).alias("resource"), F.explode("tags").alias("k", "v")) for name, df in sources]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).groupBy("resource", "k").agg(F.count_distinct("v").alias("values"))


def e14b_unpriced_share(s: SparkSession, d: str) -> DataFrame:
    p = model.priced(s, d)
    missing = F.col("price_missing")
    return p.agg(F.count(F.lit(1)).alias("records"), F.count_if(missing).alias("unpriced"), ratio(F.count_if(missing) * 100.0, F.count(F.lit(1)), 4).alias("unpriced_pct"), ratio(F.sum(F.when(missing, F.col("usage_quantity")).otherwise(0.0)) * 100, F.sum("usage_quantity"), 4).alias("quantity_pct"))


def e14c_unpriced_in_list(s: SparkSession, d: str) -> DataFrame:
    skus = model.priced(s, d).filter("price_missing").select("sku_name").distinct()
    p = T.prices(s).groupBy("sku_name").agg(F.concat_ws(",", F.array_sort(F.collect_set(F.upper("cloud")))).alias("clouds"), F.count(F.lit(1)).alias("tranches"))
    return skus.join(facts.small(p), "sku_name", "left").select("sku_name", F.coalesce("tranches", F.lit(0)).alias("tranches"), F.coalesce("clouds", F.lit("")).alias("clouds"))


def e14d_outside_validity(s: SparkSession, d: str) -> DataFrame:
    p = model.priced(s, d).filter("price_missing").groupBy("sku_name").agg(F.min("usage_date").alias("first_use"), F.max("usage_date").alias("last_use"))
    v = T.prices(s).groupBy("sku_name").agg(F.min(F.to_date("price_start_time")).alias("valid_from"), F.max(F.to_date(F.coalesce("price_end_time", F.lit("9999-12-31").cast("timestamp_ntz")))).alias("valid_to"))
    return p.join(facts.small(v), "sku_name").filter((F.col("first_use") < F.col("valid_from")) | (F.col("last_use") >= F.col("valid_to")))


def e14f_missing_skus(s: SparkSession, d: str) -> DataFrame:
    return T.usage(s, d).select("sku_name").distinct().subtract(T.prices(s).select("sku_name").distinct())


def e15a_freshness(s: SparkSession, d: str) -> DataFrame:
    parts = [(t, c) for t, c in (("lineitem", "l_shipdate"), ("orders", "o_orderdate"), ("events", "ts"))]
    rows = [T.read(s, d, t).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("rows"), F.min(F.to_date(c)).alias("first_day"), F.max(F.to_date(c)).alias("last_day")) for t, c in parts]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def e15b_lag(s: SparkSession, d: str) -> DataFrame:
    f = model.fact(s, d)
    return f.agg(F.datediff(F.lit("2001-12-01").cast("date"), F.max("usage_date")).alias("lag_days"), F.count_if(since(30)).alias("recent_rows"))


def e16_month_by_team(s: SparkSession, d: str) -> DataFrame:
    return model.fact(s, d, ("2001-07-01", "2001-07-31")).groupBy("team").agg(usd().alias("cost"))


def e17_job_averages(s: SparkSession, d: str) -> DataFrame:
    runs = facts.job_run_cost(model.runs(s, d), model.priced(s, d)).filter("has_cost")
    return runs.groupBy("job_id").agg(F.count(F.lit(1)).alias("runs"), ratio(usd("run_cost_usd"), F.count(F.lit(1)), 4).alias("avg_cost"), rounded(F.avg("duration_minutes"), 4).alias("avg_minutes"))


def e18_no_owner(s: SparkSession, d: str) -> DataFrame:
    return model.fact(s, d).filter(F.col("owner") == UNALLOCATED).groupBy("workspace_id").agg(usd().alias("cost"), F.count_distinct("entity_key").alias("entities"))


QUERIES: dict[str, Query] = {n: f for n, f in list(globals().items()) if n[0] in "dve" and n[1].isdigit()}
