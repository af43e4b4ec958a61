"""Budget tracking and chargeback as joins and window sums."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.exprs import matches_any, money, rounded, scope_matches
from ledgerflow.operators import predicates
from ledgerflow.sources.stored import Scratch


@dataclass(frozen=True)
class Budget:
    budget_id: str
    amount: float
    scope: dict = field(default_factory=dict)
    period: str = "month"
    thresholds: tuple[float, ...] = (50, 80, 90, 100)
    effective_from: str = "1900-01-01"
    effective_to: str = "2999-12-31"


def period_start(day: Column, period: str) -> Column:
    return F.trunc(day, {"quarter": "QUARTER", "year": "YEAR"}.get(period, "MM"))


def period_end(day: Column, period: str) -> Column:
    months = {"quarter": 3, "year": 12}.get(period, 1)
    return F.date_sub(F.add_months(period_start(day, period), months), 1)


def scope_label(scope: dict) -> str:
    return " & ".join(f"{k}={v}" for k, v in sorted(scope.items())) or "ORGANIZACION"


def budget_status(costs: DataFrame, budgets: Sequence[Budget], as_of: str, forecast: DataFrame | None = None) -> DataFrame:
    """One row for each active budget with the period's actual and projected cost.

    ``costs`` has usage_date, total_cost_usd and the scope columns; it is read once, every row
    going to each budget whose scope it fits. Many budgets find their costs through the index of
    ``predicates``. ``forecast`` (forecast_date, expected_cost) serves budgets of the whole
    organisation. Without an active budget there are no rows.
    """
    spark = costs.sparkSession
    active = [b for b in budgets if b.effective_from <= as_of <= b.effective_to]
    day = F.lit(as_of).cast("date")
    table = spark.createDataFrame([(b.budget_id, float(b.amount), scope_label(b.scope), b.period, [float(t) for t in sorted(b.thresholds)], not b.scope) for b in active], "budget_id string, amount double, scope string, period string, thresholds array<double>, whole boolean")
    by_period = lambda f: F.when(F.col("period") == "quarter", f(day, "quarter")).when(F.col("period") == "year", f(day, "year")).otherwise(f(day, "month"))
    table = table.withColumns({"period_start": by_period(period_start), "period_end": by_period(period_end)})
    # only the widest of the active periods is read
    widest = min([_first_day(as_of, b.period) for b in active], default=as_of)
    costs = costs.filter(F.col("usage_date").between(F.lit(widest).cast("date"), day))
    daily = (_daily_by_scope if len(active) > predicates.FEW_RULES else _daily_by_column)(costs, active, table, day)
    total = daily.groupBy("budget_id").agg(money(F.col("cost")).alias("actual"), F.count(F.lit(1)).alias("data_days"), F.max("usage_date").alias("last_day"))
    s = table.join(total, "budget_id", "left").withColumns({"actual": F.coalesce("actual", F.lit(0.0)), "data_days": F.coalesce("data_days", F.lit(0))})
    last = F.coalesce("last_day", F.date_sub("period_start", 1))
    s = s.withColumns({"total_days": F.datediff("period_end", "period_start") + 1, "elapsed_days": F.datediff(day, "period_start") + 1, "remaining_days": F.greatest(F.lit(0), F.datediff("period_end", last))})
    s = s.withColumn("avg_daily", F.when(F.col("data_days") > 0, F.col("actual") / F.col("data_days")).otherwise(0.0))
    remaining = F.col("avg_daily") * F.col("remaining_days")
    if forecast is not None:
        ahead = forecast.select("forecast_date", "expected_cost").join(F.broadcast(s.filter("whole").select("budget_id", last.alias("__last"), "period_end")), (F.col("forecast_date") > F.col("__last")) & (F.col("forecast_date") <= F.col("period_end")))
        sums = ahead.groupBy("budget_id").agg(F.sum(F.col("expected_cost").cast("decimal(20,6)")).cast("double").alias("__sum"), F.count(F.lit(1)).alias("__days"))
        s = s.join(sums, "budget_id", "left")
        extended = F.col("__sum") + F.greatest(F.lit(0), F.col("remaining_days") - F.col("__days")) * (F.col("__sum") / F.col("__days"))
        remaining = F.when(F.col("__days") > 0, extended).otherwise(remaining)
    s = s.withColumn("remaining", remaining).withColumn("projected", rounded(F.col("actual") + F.col("remaining"), 4))
    consumed, projected = F.col("actual") / F.col("amount") * 100, F.col("projected") / F.col("amount") * 100
    s = s.withColumns({"consumed_pct": rounded(F.when(F.col("amount") > 0, consumed), 4), "projected_pct": rounded(F.when(F.col("amount") > 0, projected), 4)})
    crit = F.when(F.size("thresholds") > 1, F.get("thresholds", F.size("thresholds") - 2)).otherwise(90.0)
    warn = F.get("thresholds", F.lit(0))
    c, p = F.col("consumed_pct"), F.col("projected_pct")
    status = F.when(c >= 100, "EXCEEDED").when((c >= crit) | (p >= 100), "CRITICAL").when((c >= warn) | (p >= crit), "WARNING").otherwise("OK")
    rest = F.col("amount") - F.col("actual")
    return s.select(
        "budget_id",
        "scope",
        "period",
        "period_start",
        "period_end",
        "amount",
        rounded(F.col("actual"), 4).alias("actual"),
        "projected",
        "consumed_pct",
        "projected_pct",
        rounded(F.col("amount") - F.col("projected"), 4).alias("variance"),
        "elapsed_days",
        "remaining_days",
        "total_days",
        rounded(F.col("elapsed_days") / F.col("total_days") * 100, 4).alias("progress_pct"),
        rounded(F.when(F.col("remaining_days") > 0, F.greatest(F.lit(0.0), rest) / F.col("remaining_days")).otherwise(0.0), 4).alias("required_daily"),
        F.when(rest <= 0, 0).when(F.col("avg_daily") > 0, F.floor(rest / F.col("avg_daily") + 1e-9)).cast("int").alias("days_to_exhaustion"),
        F.array_max(F.filter("thresholds", lambda t: t <= F.col("consumed_pct"))).alias("threshold_reached"),
        status.alias("status"),
        (p <= 100).alias("on_track"),
    )


def _first_day(as_of: str, period: str) -> str:
    """``period_start`` of a day of the calendar, as text."""
    year, month = int(as_of[:4]), int(as_of[5:7])
    month = {"quarter": (month - 1) // 3 * 3 + 1, "year": 1}.get(period, month)
    return f"{year:04d}-{month:02d}-01"


def _daily_by_column(costs: DataFrame, active: Sequence[Budget], table: DataFrame, day: Column) -> DataFrame:
    """(budget_id, usage_date, cost), each budget a Column of the plan."""
    fits = F.array(*[F.when(scope_matches(b.scope) & F.col("usage_date").between(period_start(day, b.period), day), F.lit(b.budget_id)) for b in active]).cast("array<string>")
    spent = costs.select("usage_date", "total_cost_usd", F.explode(F.filter(fits, lambda x: x.isNotNull())).alias("budget_id"))
    return spent.groupBy("budget_id", "usage_date").agg(money(F.col("total_cost_usd")).alias("cost"))


def _daily_by_scope(costs: DataFrame, active: Sequence[Budget], table: DataFrame, day: Column) -> DataFrame:
    """(budget_id, usage_date, cost) by the index of predicates.

    Costs are summed by day and combination of scope values before they meet scopes, and by scope
    before they meet the budgets that share it.
    """
    scratch = Scratch()
    scopes = {scope_label(b.scope): b.scope for b in active}
    keys = predicates.keys_of(list(scopes.values()))
    by_combo = scratch.written(costs.groupBy("usage_date", *keys).agg(money(F.col("total_cost_usd")).alias("cost")))
    fits = predicates.matching(by_combo, list(scopes.values()), scratch)
    names = costs.sparkSession.createDataFrame(list(enumerate(scopes)), "rule long, scope string")
    met = by_combo.withColumns(predicates.combination(keys)).join(fits, ["c1", "c2"]).groupBy("rule", "usage_date").agg(money(F.col("cost")).alias("cost"))
    by_scope = met.join(names, "rule").select("scope", "usage_date", "cost")
    due = table.select("budget_id", "scope", "period_start")
    return by_scope.join(due, "scope").filter(F.col("usage_date") >= F.col("period_start")).select("budget_id", "usage_date", "cost")


def by_consumption(status: DataFrame) -> DataFrame:
    """The most consumed budgets first."""
    return status.orderBy(F.desc_nulls_last("consumed_pct"), "budget_id")


def by_total(lines: DataFrame) -> DataFrame:
    """The largest chargeback lines first."""
    return lines.orderBy(F.desc("total_usd"), "year_month", "unit")


def latest_status(history: DataFrame) -> DataFrame:
    """The newest row of each budget from a table of evaluations (budget_id, as_of_date, ...)."""
    w = Window.partitionBy("budget_id").orderBy(F.desc("as_of_date"))
    return history.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def chargeback(costs: DataFrame, unit_col: str = "cost_center", shared: Sequence[str] = (), shared_cols: Sequence[str] = ("entity_name", "entity_key", "project", "application"), unallocated: str = "SIN_ASIGNAR", strategy: str = "proportional", unallocated_strategy: str = "proportional", overhead: float = 0.0) -> DataFrame:
    """Direct cost of each unit and month plus its part of shared and unattributed cost.

    ``costs`` has year_month, total_cost_usd, entity_key, the unit column and the shared columns.
    """
    is_shared = F.lit(False)
    for c in shared_cols:
        is_shared = is_shared | matches_any(F.col(c), shared)
    kind = F.when(is_shared, "shared").when(F.coalesce(F.col(unit_col), F.lit(unallocated)) == unallocated, "unallocated").otherwise("direct")
    rows = costs.filter("total_cost_usd <> 0").select("year_month", F.col(unit_col).alias("unit"), kind.alias("kind"), "total_cost_usd", "entity_key")
    by_kind = rows.groupBy("year_month", "kind", F.when(F.col("kind") == "direct", F.col("unit")).alias("unit")).agg(money(F.col("total_cost_usd")).alias("cost"), F.count_distinct("entity_key").alias("entities"))
    w = Window.partitionBy("year_month")
    pool = lambda name: F.coalesce(F.sum(F.when(F.col("kind") == name, F.col("cost"))).over(w), F.lit(0.0))
    direct = F.col("kind") == "direct"
    weight = F.when(direct, F.greatest(F.lit(0.0), F.col("cost")))
    t = by_kind.withColumns({"__shared": F.greatest(F.lit(0.0), pool("shared")), "__none": F.greatest(F.lit(0.0), pool("unallocated")), "__units": F.count_if(direct).over(w), "__weights": F.sum(weight.cast("decimal(20,6)")).over(w).cast("double")})

    def part(total: Column, how: str) -> Column:
        even = total / F.col("__units")
        return F.when(F.col("__weights") > 0, total * weight / F.col("__weights")).otherwise(even) if how == "proportional" else even if how == "even" else F.lit(0.0)

    lines = t.filter(direct).select("year_month", "unit", "entities", F.col("cost").alias("direct"), part(F.col("__shared"), strategy).alias("shared"), part(F.col("__none"), unallocated_strategy).alias("none"))
    left = lambda how: F.lit(how == "none") | (F.col("__units") == 0)
    residual = t.filter(((F.col("kind") == "shared") & left(strategy) | (F.col("kind") == "unallocated") & left(unallocated_strategy)) & (F.col("cost") > 0))
    rest = residual.select("year_month", F.when(F.col("kind") == "shared", "COSTO_COMPARTIDO").otherwise(unallocated).alias("unit"), "entities", F.lit(0.0).alias("direct"), F.when(F.col("kind") == "shared", F.col("cost")).otherwise(0.0).alias("shared"), F.when(F.col("kind") == "unallocated", F.col("cost")).otherwise(0.0).alias("none"))
    both = lines.unionByName(rest)
    before = F.col("direct") + F.col("shared") + F.col("none")
    out = both.select("year_month", "unit", "entities", rounded(F.col("direct"), 4).alias("direct_usd"), rounded(F.col("shared"), 4).alias("shared_usd"), rounded(F.col("none"), 4).alias("unallocated_usd"), rounded(before * overhead, 4).alias("overhead_usd"), rounded(before * (1 + overhead), 4).alias("total_usd"))
    whole = F.sum(F.col("total_usd").cast("decimal(20,6)")).over(w).cast("double")
    return out.withColumn("pct_of_total", F.when(whole > 0, rounded(F.col("total_usd") / whole, 6)).otherwise(0.0))


def reconciliation(lines: DataFrame, costs: DataFrame, overhead: float = 0.0) -> DataFrame:
    """Allocated against source cost by month."""
    a = lines.groupBy("year_month").agg(money(F.col("total_usd")).alias("allocated"))
    b = costs.groupBy("year_month").agg(money(F.col("total_cost_usd")).alias("source"))
    expected = F.col("source") * (1 + overhead)
    apart = F.abs(F.coalesce("allocated", F.lit(0.0)) - expected)
    return b.join(a, "year_month", "left").select("year_month", F.col("source"), F.coalesce("allocated", F.lit(0.0)).alias("allocated"), (apart <= F.greatest(F.lit(0.01), F.abs(expected) * 1e-6)).alias("reconciles"))


def showback(lines: DataFrame, top: int = 3) -> DataFrame:
    """Totals of each month and its largest units."""
    w = Window.partitionBy("year_month").orderBy(F.desc("total_usd"), "unit")
    ranked = lines.withColumn("n", F.row_number().over(w))
    names = F.array_sort(F.collect_list(F.when(F.col("n") <= top, F.struct("n", "unit"))))
    return ranked.groupBy("year_month").agg(money(F.col("total_usd")).alias("total_usd"), F.count(F.lit(1)).alias("units"), money(F.col("shared_usd")).alias("shared_usd"), money(F.col("unallocated_usd")).alias("unallocated_usd"), F.concat_ws(",", F.transform(names, lambda x: x["unit"])).alias("top_units"))
