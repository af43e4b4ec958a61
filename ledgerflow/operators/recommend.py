"""Savings recommendations: every rule is a Column over one entity profile, all in one scan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.exprs import money, money_if, rounded
from ledgerflow.operators.attribution import ALIASES


# Thresholds and shares of the rules; rule names and confidences below are fixed as well.
@dataclass(frozen=True)
class RuleConfig:
    min_savings: float = 25.0
    max_autotermination: int = 60
    autotermination_waste: float = 0.15
    all_purpose_min_runs: int = 5
    all_purpose_savings: float = 0.45
    min_runtime_major: int = 14
    runtime_savings: float = 0.10
    min_failed: int = 3
    min_failure_ratio: float = 0.15
    idle_days: int = 14
    min_fixed_workers: int = 4
    autoscale_savings: float = 0.15
    max_queries_per_hour: float = 5.0
    warehouse_savings: float = 0.40
    max_serverless_minutes: float = 12.0
    serverless_min_runs: int = 20
    serverless_savings: float = 0.20
    min_untagged: float = 100.0
    photon_min_monthly: float = 500.0
    photon_savings: float = 0.12
    disabled: tuple[str, ...] = ()


def profiles(daily: DataFrame, clusters: DataFrame, runs: DataFrame, activity: DataFrame, as_of: str, days: int) -> DataFrame:
    """One row for each entity and workspace with the cost, runs, queries and configuration of the days from ``days`` before ``as_of`` on."""
    end = F.lit(as_of).cast("date")
    within = lambda day: F.col(day).between(F.date_sub(end, days), end)
    p = daily.filter(within("usage_date")).groupBy("entity_key", "workspace_id").agg(
        F.max("entity_type").alias("entity_type"),
        F.max("entity_id").alias("entity_id"),
        F.max("entity_name").alias("entity_name"),
        F.max("owner_resolved").alias("owner"),
        F.max("sku_group").alias("sku_group"),
        money(F.col("total_cost_usd")).alias("cost_usd"),
        money_if(F.col("is_untagged"), F.col("total_cost_usd")).alias("untagged_cost_usd"),
        F.max("usage_date").alias("last_activity"),
        F.max("is_photon").alias("is_photon"),
        F.max("is_serverless").alias("is_serverless"),
        *[F.max(d).alias(f"dim_{d}" if d == "owner" else d) for d in ALIASES],
    )
    p = p.withColumns({"analysis_days": F.lit(days), "days_since_activity": F.date_diff(end, "last_activity")})
    job = runs.filter(within("run_date")).groupBy("workspace_id", F.concat(F.lit("JOB:"), "job_id").alias("entity_key")).agg(
        F.count(F.lit(1)).alias("run_count"), F.count_if("is_failed").alias("failed_runs"), rounded(F.avg("duration_minutes"), 4).alias("avg_minutes"), F.max("run_date").alias("last_run_date")
    )
    hours = rounded(F.sum(F.col("active_hours").cast("decimal(20,4)")).cast("double"), 4)
    house = activity.filter(within("query_date")).groupBy("workspace_id", F.concat(F.lit("WAREHOUSE:"), "warehouse_id").alias("entity_key")).agg(F.sum("query_count").alias("query_count"), hours.alias("active_hours"))
    config = clusters.select(F.concat(F.lit("CLUSTER:"), "cluster_id").alias("entity_key"), "workspace_id", "worker_count", "auto_termination_minutes", "dbr_version", "is_autoscale")
    keys = ["entity_key", "workspace_id"]
    return p.join(config, keys, "left").join(job, keys, "left").join(house, keys, "left")


def recommendations(profile: DataFrame, c: RuleConfig = RuleConfig()) -> DataFrame:
    monthly = F.when(F.col("analysis_days") > 0, F.col("cost_usd") / F.col("analysis_days") * 30).otherwise(0.0)
    cluster, serverless = F.col("entity_type") == "CLUSTER", F.col("is_serverless")
    minutes, runs, failed = F.col("auto_termination_minutes"), F.coalesce("run_count", F.lit(0)), F.coalesce("failed_runs", F.lit(0))
    major = F.regexp_extract(F.coalesce("dbr_version", F.lit("")), r"^(\d+)\.(\d+)", 1)
    per_hour = F.col("query_count") / F.col("active_hours")
    rate = failed / runs
    rules: list[tuple[str, Column, Column, Column | str]] = [
        ("NO_AUTOTERMINATION", cluster & ~serverless & minutes.isNotNull() & ~minutes.between(1, c.max_autotermination), monthly * c.autotermination_waste * F.when(minutes == 0, 2).otherwise(1), F.when(minutes == 0, "media").otherwise("baja")),
        ("ALL_PURPOSE_FOR_JOBS", (F.col("sku_group") == "ALL_PURPOSE") & (runs >= c.all_purpose_min_runs), monthly * c.all_purpose_savings, "alta"),
        ("LEGACY_RUNTIME", (major != "") & (F.expr("try_cast(regexp_extract(coalesce(dbr_version, ''), '^(\\\\d+)\\\\.(\\\\d+)', 1) AS int)") < c.min_runtime_major), monthly * c.runtime_savings, "baja"),
        ("FAILED_RUN_WASTE", (failed >= c.min_failed) & (runs > 0) & (rate >= c.min_failure_ratio), monthly * rate, "media"),
        ("ZOMBIE_ENTITY", (F.col("days_since_activity") >= c.idle_days) & (F.col("cost_usd") > 0), monthly, "alta"),
        ("NO_AUTOSCALE", cluster & ~F.coalesce("is_autoscale", F.lit(False)) & (F.col("worker_count") >= c.min_fixed_workers), monthly * c.autoscale_savings, "baja"),
        ("OVERSIZED_WAREHOUSE", (F.col("entity_type") == "WAREHOUSE") & (F.col("active_hours") > 0) & (per_hour <= c.max_queries_per_hour), monthly * c.warehouse_savings, "media"),
        ("SERVERLESS_CANDIDATE", ~serverless & (runs >= c.serverless_min_runs) & (F.col("avg_minutes") <= c.max_serverless_minutes), monthly * c.serverless_savings, "baja"),
        ("UNTAGGED_SPEND", F.col("untagged_cost_usd") >= c.min_untagged, F.lit(0.0), "alta"),
        ("PHOTON_OPPORTUNITY", ~F.col("is_photon") & F.col("sku_group").isin("JOBS", "SQL", "DLT") & (monthly >= c.photon_min_monthly), monthly * c.photon_savings, "baja"),
    ]
    found = []
    for rule, fires, savings, confidence in rules:
        if rule not in c.disabled:
            level = F.lit(confidence) if isinstance(confidence, str) else confidence
            found.append(F.when(fires, F.struct(F.lit(rule).alias("rule_id"), rounded(F.greatest(F.lit(0.0), savings), 2).alias("savings_usd"), level.alias("confidence"))))
    r = profile.withColumn("monthly_cost_usd", rounded(monthly, 4)).withColumn("r", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())))
    s = F.col("r.savings_usd")
    severity = F.when(s >= 1000, "critical").when(s >= 300, "high").when(s >= 100, "medium").otherwise("low")
    out = r.select("entity_key", "workspace_id", "entity_type", "r.rule_id", "monthly_cost_usd", "r.savings_usd", F.when(F.col("monthly_cost_usd") > 0, rounded(s / F.col("monthly_cost_usd"), 4)).otherwise(0.0).alias("savings_pct"), "r.confidence", severity.alias("severity"))
    return out.filter((F.col("savings_usd") >= c.min_savings) | (F.col("rule_id") == "UNTAGGED_SPEND"))


def savings_summary(found: DataFrame) -> DataFrame:
    return found.groupBy("rule_id").agg(F.count(F.lit(1)).alias("findings"), money(F.col("savings_usd")).alias("savings_usd"), money_if(F.col("confidence") == "alta", F.col("savings_usd")).alias("high_confidence_usd"), F.count_distinct("entity_key").alias("entities"))
