"""Alert rows from budgets, anomalies, daily totals, entities, coverage and checks; dedup, cooldown and routing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.exprs import fingerprint, money, rounded
from ledgerflow.operators.budgets import latest_status

# The levels in order; shares, amounts and days that the rules below have as defaults.
LEVELS = ("low", "medium", "high", "critical")
COLUMNS = ("rule", "severity", "subject", "value", "threshold", "fingerprint")


def rank(severity: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, LEVELS)), severity)


def alert(df: DataFrame, rule: str, severity: Column, subject: Column, value: Column, threshold: Column, *parts: Column) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), severity.alias("severity"), subject.cast("string").alias("subject"), rounded(value.cast("double"), 4).alias("value"), rounded(threshold.cast("double"), 4).alias("threshold"), fingerprint(F.lit(rule), *(parts or (subject,))).alias("fingerprint"))


def budget_threshold(status: DataFrame) -> DataFrame:
    c = F.col("consumed_pct")
    level = F.when(c >= 100, "critical").when(c >= 90, "high").when(c >= 80, "medium").otherwise("low")
    return alert(status.filter("threshold_reached IS NOT NULL"), "BUDGET_THRESHOLD", level, F.col("budget_id"), c, F.col("threshold_reached"), F.col("budget_id"), F.col("period_start"), F.col("threshold_reached").cast("int"))


def forecast_overrun(status: DataFrame, least: float = 0.05) -> DataFrame:
    over = (F.col("projected") - F.col("amount")) / F.col("amount")
    hit = status.filter((F.col("amount") > 0) & (F.col("consumed_pct") < 100) & (over >= least))
    return alert(hit, "FORECAST_OVERRUN", F.when(over >= 0.20, "high").otherwise("medium"), F.col("budget_id"), over, F.lit(least), F.col("budget_id"), F.col("period_start"))


def cost_anomaly(found: DataFrame, least: str = "high") -> DataFrame:
    hit = found.filter((rank(F.col("severity")) >= LEVELS.index(least) + 1) & (F.col("direction") == "SPIKE"))
    subject = F.concat_ws("=", "dimension", "dim_value")
    return alert(hit, "COST_ANOMALY", F.col("severity"), subject, F.col("actual"), F.col("expected"), subject, F.col("usage_date"))


def daily_spike(totals: DataFrame, pct: float = 0.35, least: float = 200.0) -> DataFrame:
    """The last day against the mean of the seven days before; ``totals`` has one row for each day."""
    w = Window.orderBy("usage_date")
    back = w.rowsBetween(-7, -1)
    t = totals.withColumns({"n": F.count("cost").over(back), "mean": F.sum(F.col("cost").cast("decimal(20,6)")).over(back).cast("double") / 7, "last": F.max("usage_date").over(Window.partitionBy())})
    up = (F.col("cost") - F.col("mean")) / F.col("mean")
    hit = t.filter((F.col("usage_date") == F.col("last")) & (F.col("n") == 7) & (F.col("mean") > 0) & (up >= pct) & (F.col("cost") >= least))
    return alert(hit, "DAILY_SPEND_SPIKE", F.when(up >= 1.0, "critical").otherwise("high"), F.col("usage_date"), F.col("cost"), F.col("mean") * (1 + pct))


def new_expensive(entities: DataFrame, as_of: str, least: float = 150.0, days: int = 7) -> DataFrame:
    cost = F.col("lifetime_cost_usd")
    new = entities.filter((F.datediff(F.lit(as_of).cast("date"), "first_seen") <= days) & (cost >= least))
    subject = F.concat_ws("@", "entity_key", "workspace_id")
    return alert(new, "NEW_EXPENSIVE_ENTITY", F.when(cost >= 3 * least, "high").otherwise("medium"), subject, cost, F.lit(least))


def coverage_drop(coverage: DataFrame, day: str, dimension: str = "cost_center", least: float = 0.80) -> DataFrame:
    """The coverage of one day by the dimension that costs are allocated by; one alert a month."""
    of_day = coverage.filter((F.col("dimension") == dimension) & (F.col("usage_date") == F.lit(day).cast("date")))
    sums = of_day.agg(money(F.col("attributed_cost_usd")).alias("a"), money(F.col("total_cost_usd")).alias("t")).filter("t > 0")
    ratio = F.col("a") / F.col("t")
    return alert(sums.filter(ratio < least), "TAG_COVERAGE_DROP", F.when(ratio < 0.75 * least, "high").otherwise("medium"), F.lit(f"dimension={dimension}"), ratio, F.lit(least), F.lit(dimension), F.lit(day[:7]))


def data_quality(checks: DataFrame) -> DataFrame:
    return alert(checks.filter("NOT passed AND severity = 'error'"), "DATA_QUALITY", F.lit("high"), F.col("check_name"), F.col("observed"), F.col("threshold"))


def pipeline_health(run_log: DataFrame, since: str) -> DataFrame:
    """One alert naming all stages with an error since a time; run_log has stage, status, finished_at."""
    bad = run_log.filter((F.col("status") == "error") & (F.col("finished_at") >= F.lit(since).cast("timestamp_ntz")))
    named = bad.agg(F.concat_ws(",", F.array_sort(F.collect_set("stage"))).alias("stages"), F.count(F.lit(1)).alias("n")).filter("n > 0")
    return alert(named, "PIPELINE_HEALTH", F.lit("critical"), F.col("stages"), F.col("n"), F.lit(0))


def reloaded(history: DataFrame, anomalies: DataFrame, as_of: str, days: int = 8) -> DataFrame:
    """Alerts of a run without analytics of its own: from the latest stored status of each budget and the stored anomalies of the last days."""
    recent = anomalies.filter(F.col("usage_date") >= F.date_sub(F.lit(as_of).cast("date"), days))
    status = latest_status(history)
    return union_all([budget_threshold(status), forecast_overrun(status), cost_anomaly(recent)])


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def by_severity(alerts: DataFrame) -> DataFrame:
    """Highest severity first, then rule, subject and fingerprint."""
    return alerts.orderBy(*_order())


def _order() -> list:
    return [rank(F.col("severity")).desc(), "rule", "subject", "fingerprint"]


def admit(alerts: DataFrame, history: DataFrame, now: str, cooldown_hours: int = 24, cap: int = 50, least: str = "medium") -> DataFrame:
    """Alerts with ``outcome`` (dispatched, or why not: duplicate, cooldown, severity, cap) and created_at.

    ``history`` has fingerprint and created_at of dispatched alerts. The cap takes the first of the
    alerts that pass all filters, which have distinct fingerprints: a top-k that merges small local
    lists, met again by fingerprint.
    """
    first = F.row_number().over(Window.partitionBy("fingerprint").orderBy(*_order()))
    stamp = F.lit(now).cast("timestamp_ntz")
    # older dispatches cannot hold an alert back: twice the cooldown is all that is read of the log
    recent = history.filter(F.col("created_at") >= stamp - F.make_dt_interval(hours=F.lit(2 * cooldown_hours)))
    seen = recent.groupBy("fingerprint").agg(F.max("created_at").alias("__last"))
    a = alerts.withColumn("__first", first).join(seen, "fingerprint", "left")
    quiet = F.timestamp_diff("SECOND", F.col("__last"), stamp) < cooldown_hours * 3600
    why = F.when(F.col("__first") > 1, "duplicate").when(F.coalesce(quiet, F.lit(False)), "cooldown").when(rank(F.col("severity")) < LEVELS.index(least) + 1, "severity")
    a = a.withColumn("__why", why)
    placed = a.filter("__why IS NULL").orderBy(*_order()).limit(cap).select("fingerprint", F.lit("dispatched").alias("__placed"))
    out = a.join(placed, "fingerprint", "left").withColumn("outcome", F.coalesce("__why", "__placed", F.lit("cap")))
    return out.select(*COLUMNS, "outcome", stamp.alias("created_at"))


def route(admitted: DataFrame, channels: Sequence[tuple[str, str]]) -> DataFrame:
    """One row for each dispatched alert and channel whose own minimum severity it reaches."""
    fits = F.array(*[F.when(rank(F.col("severity")) >= LEVELS.index(least) + 1, F.lit(name)) for name, least in channels])
    return admitted.filter("outcome = 'dispatched'").withColumn("channel", F.explode(F.filter(fits, lambda c: c.isNotNull())))


def alert_log(admitted: DataFrame, channels: Sequence[tuple[str, str]]) -> DataFrame:
    fits = F.array(*[F.when((F.col("outcome") == "dispatched") & (rank(F.col("severity")) >= LEVELS.index(least) + 1), F.lit(name)) for name, least in channels])
    return admitted.withColumn("channels", F.concat_ws(",", F.filter(fits, lambda c: c.isNotNull())))


def digest(admitted: DataFrame) -> DataFrame:
    return admitted.groupBy("severity", "outcome").agg(F.count(F.lit(1)).alias("alerts"))


