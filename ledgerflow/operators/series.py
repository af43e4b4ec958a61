"""Robust anomaly detection and forecasting of daily series, distributed by series.

Input is a long table (dimension, dim_value, usage_date, cost), one row for each point.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.exprs import mean_of, median_of, money, pstdev_of, rounded

KEYS = ("dimension", "dim_value")


def daily_series(daily: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Cost by day of each value of each dimension, from one scan of the cost fact; a null value is left out.

    Costs are summed over all dimensions together first, then unpivoted, so that each row of the fact is read once.
    """
    known = [d for d in dimensions if d in daily.columns]
    part = daily.groupBy("usage_date", *known).agg(money(F.col("total_cost_usd")).alias("v"))
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("dim_value")) for d in known])
    long = part.select("usage_date", "v", F.inline(pairs)).filter("dim_value IS NOT NULL")
    return long.groupBy(*KEYS, "usage_date").agg(money(F.col("v")).alias("cost"))


# Windows, thresholds and limits of severity below, and of the forecast.
@dataclass(frozen=True)
class AnomalyConfig:
    window_days: int = 28
    min_history_days: int = 14
    method: str = "mad"
    score_threshold: float = 3.5
    min_avg_cost: float = 20.0
    min_pct_change: float = 0.30
    day_of_week_aware: bool = True
    last_n: int | None = None
    critical: float = 8.0
    high: float = 6.0
    medium: float = 4.5


@dataclass(frozen=True)
class ForecastConfig:
    horizon_days: int = 45
    method: str = "holt"
    alpha: float = 0.35
    beta: float = 0.12
    damping: float = 0.92
    weekly: bool = True
    min_history_days: int = 21
    train_window_days: int = 120


def robust_score(x: Column, base: Column, method: str) -> Column:
    """struct(score, expected): 0.6745 deviations from the median by MAD, with fallbacks for flat baselines."""
    mean, sd = mean_of(base), pstdev_of(base)
    if method == "zscore":
        score = F.when(sd > 0, (x - mean) / sd).otherwise(0.0)
        return F.struct(score.alias("score"), mean.alias("expected"))
    med = median_of(base)
    apart = F.transform(base, lambda v: F.abs(v - med))
    mad, aad = median_of(apart), mean_of(apart)
    flat = F.when(F.abs(x - med) <= 1e-9, 0.0).otherwise(F.when(x > med, 99.0).otherwise(-99.0))
    score = F.when(mad > 0, 0.6745 * (x - med) / mad).when(aad > 0, 0.6745 * (x - med) / aad).when(sd > 0, (x - med) / sd).otherwise(flat)
    return F.struct(score.alias("score"), med.alias("expected"))


def severity(score: Column, c: AnomalyConfig) -> Column:
    a = F.abs(score)
    return F.when(a >= c.critical, "critical").when(a >= c.high, "high").when(a >= c.medium, "medium").otherwise("low")


def anomalies(series: DataFrame, c: AnomalyConfig = AnomalyConfig()) -> DataFrame:
    """Points that leave the range of their trailing calendar-day baseline."""
    day = F.datediff("usage_date", F.lit("1970-01-01"))
    s = series.withColumns({"__day": day, "__dow": F.dayofweek("usage_date")})
    whole, ordered = Window.partitionBy(*KEYS), Window.partitionBy(*KEYS).orderBy("__day")
    parts = (*KEYS, "__dow") if c.day_of_week_aware else KEYS
    back = Window.partitionBy(*parts).orderBy("__day").rangeBetween(-c.window_days, -1)
    s = s.withColumns(
        {
            "__n": F.count("cost").over(whole),
            "__mean": (F.sum(F.col("cost").cast("decimal(20,6)")).over(whole)).cast("double") / F.count("cost").over(whole),
            "__i": F.row_number().over(ordered) - 1,
            "__base": F.collect_list("cost").over(back),
        }
    )
    return _judged(_due(s, c), c)


def _due(s: DataFrame, c: AnomalyConfig) -> DataFrame:
    """Points that are to be judged: of long and costly enough series, late enough, with enough of a baseline."""
    least = 3 if c.day_of_week_aware else c.min_history_days
    start = F.lit(c.min_history_days) if c.last_n is None else F.greatest(F.lit(c.min_history_days), F.col("__n") - c.last_n)
    return s.filter((F.col("__n") >= c.min_history_days + 1) & (F.col("__mean") >= c.min_avg_cost) & (F.col("__i") >= start) & (F.size("__base") >= least))


def _judged(points: DataFrame, c: AnomalyConfig) -> DataFrame:
    """Those of (keys, usage_date, cost, __base) that leave the range of their baseline."""
    s = points.withColumn("__r", robust_score(F.col("cost"), F.array_sort("__base"), c.method))
    score, expected = F.col("__r.score"), F.col("__r.expected")
    pct = F.when(expected > 0, (F.col("cost") - expected) / expected).otherwise(F.when(F.col("cost") > 0, 1.0).otherwise(0.0))
    hit = s.filter((F.abs(score) >= c.score_threshold) & (F.abs(pct) >= c.min_pct_change))
    return hit.select(
        *KEYS,
        "usage_date",
        rounded(F.col("cost"), 4).alias("actual"),
        rounded(expected, 4).alias("expected"),
        rounded(score, 4).alias("score"),
        rounded(pct, 6).alias("pct_change"),
        F.when(F.col("cost") > expected, "SPIKE").otherwise("DROP").alias("direction"),
        severity(score, c).alias("severity"),
        F.size("__base").alias("baseline_points"),
    )


def baseline_state(series: DataFrame, c: AnomalyConfig = AnomalyConfig()) -> DataFrame:
    """What judging later days needs of a history: for each series its points, their exact sum, and the points of the last window, by day.

    ``series`` has one row for each day. A row of the state holds at most ``window_days`` points.
    """
    last = F.max("usage_date").over(Window.partitionBy(*KEYS))
    near = F.when(F.datediff("__last", "usage_date") < c.window_days, F.struct("usage_date", "cost"))
    rows = series.withColumn("__last", last)
    return rows.groupBy(*KEYS).agg(F.count("cost").alias("points"), F.sum(F.col("cost").cast("decimal(20,6)")).alias("total"), F.sort_array(F.collect_list(near)).alias("recent"))


def advance(state: DataFrame, new: DataFrame, c: AnomalyConfig = AnomalyConfig()) -> tuple[DataFrame, DataFrame]:
    """(state after the new days, anomalies among them), from the state and the new days alone.

    ``new`` has the days after those of the state, one row for each series and day. The anomalies are those
    that a run over the whole history up to the last new day finds on the new days. Series without new
    days keep their state. Only state rows of series with new days are joined; ``sinks.merge_partitions``
    or ``sinks.upsert`` by series puts them back.
    """
    fresh = new.groupBy(*KEYS).agg(F.count("cost").alias("n"), F.sum(F.col("cost").cast("decimal(20,6)")).alias("sum"), F.sort_array(F.collect_list(F.struct("usage_date", "cost"))).alias("fresh"))
    both = fresh.join(state, list(KEYS), "left")
    none = F.array().cast("array<struct<usage_date:date,cost:double>>")
    both = both.select(*KEYS, F.coalesce("points", F.lit(0)).alias("before"), (F.coalesce("points", F.lit(0)) + F.col("n")).alias("points"), (F.coalesce("total", F.lit(0).cast("decimal(30,6)")) + F.col("sum")).cast("decimal(30,6)").alias("total"), F.concat(F.coalesce("recent", none), "fresh").alias("all"), "fresh")
    newest = F.element_at("all", -1)["usage_date"]
    after = both.select(*KEYS, "points", "total", F.filter("all", lambda p: F.datediff(newest, p["usage_date"]) < c.window_days).alias("recent"))

    one = both.select("*", (F.col("total").cast("double") / F.col("points")).alias("__mean"), F.posexplode("fresh").alias("__at", "__p"))
    day, dow = F.col("__p.usage_date"), F.dayofweek(F.col("__p.usage_date"))
    ago = lambda p: F.datediff(day, p["usage_date"])
    inside = lambda p: ago(p).between(1, c.window_days)
    alike = (lambda p: inside(p) & (F.dayofweek(p["usage_date"]) == dow)) if c.day_of_week_aware else inside
    base = F.transform(F.filter("all", alike), lambda p: p["cost"])
    judged = one.select(*KEYS, day.alias("usage_date"), F.col("__p.cost").alias("cost"), base.alias("__base"), (F.col("before") + F.col("__at")).alias("__i"), F.col("points").alias("__n"), "__mean")
    return after, _judged(_due(judged, c), c)


def filled(series: DataFrame, train: int) -> DataFrame:
    """One row for each series: last day, days of history, and values of the last ``train`` days, 0 for days without.

    Rows of one day are summed. Only days of the training window are gathered, so that a row holds ``train`` values at most.
    """
    daily = series.groupBy(*KEYS, "usage_date").agg(F.sum("cost").alias("cost"))
    w = Window.partitionBy(*KEYS)
    spans = daily.withColumns({"first": F.min("usage_date").over(w), "last": F.max("usage_date").over(w)}).filter(F.datediff("last", "usage_date") < train)
    g = spans.groupBy(*KEYS, "first", "last").agg(F.map_from_entries(F.collect_list(F.struct("usage_date", "cost"))).alias("__m"))
    days = F.sequence(F.greatest(F.col("first"), F.date_sub("last", train - 1)), F.col("last"))
    g = g.withColumns({"history": F.datediff("last", "first") + 1, "d": days})
    return g.select(*KEYS, "last", "history", F.transform("d", lambda d: F.coalesce(F.element_at("__m", d), F.lit(0.0))).alias("v"), "d")


def weekly_indices(v: Column, d: Column, weekly: bool) -> Column:
    """Seven factors, Sunday first: mean of the day over the mean of all, within 0.2 and 3."""
    if not weekly:
        return F.array(*[F.lit(1.0)] * 7)
    mean = mean_of(v)

    def one(k: int) -> Column:
        mine = F.transform(F.filter(F.arrays_zip(d.alias("d"), v.alias("v")), lambda z: F.dayofweek(z["d"]) == k), lambda z: z["v"])
        return F.when((F.size(mine) < 2) | (mean <= 0), 1.0).otherwise(F.least(F.lit(3.0), F.greatest(F.lit(0.2), mean_of(mine) / mean)))

    return F.array(*[one(k) for k in range(1, 8)])


def holt(x: Column, c: ForecastConfig) -> Column:
    """struct(l, b, f): level, damped trend and one-step fitted values."""
    zero = F.lit(0.0)
    start = F.struct(F.get(x, F.lit(0)).alias("l"), F.when(F.size(x) > 1, F.get(x, F.lit(1)) - F.get(x, F.lit(0))).otherwise(zero).alias("b"), F.array(F.get(x, F.lit(0))).alias("f"))

    def step(acc: Column, v: Column) -> Column:
        pred = acc["l"] + c.damping * acc["b"]
        level = c.alpha * v + (1 - c.alpha) * pred
        trend = c.beta * (level - acc["l"]) + (1 - c.beta) * c.damping * acc["b"]
        return F.struct(level.alias("l"), trend.alias("b"), F.concat(acc["f"], F.array(pred)).alias("f"))

    return F.aggregate(F.slice(x, 2, F.greatest(F.lit(0), F.size(x) - 1)), start, step)


def damped_sum(phi: float, h: Column) -> Column:
    return h.cast("double") if phi == 1 else phi * (1 - F.pow(F.lit(phi), h)) / (1 - phi)


def forecasts(series: DataFrame, c: ForecastConfig = ForecastConfig()) -> DataFrame:
    """Expected cost of each day of the horizon after the last day of every long enough series."""
    g = filled(series, c.train_window_days).filter(F.col("history") >= c.min_history_days)
    g = g.withColumn("i", weekly_indices(F.col("v"), F.col("d"), c.weekly))
    g = g.withColumn("x", F.zip_with("v", "d", lambda v, d: v / F.get("i", F.dayofweek(d) - 1)))
    if c.method in ("seasonal_naive", "moving_average"):
        g = g.withColumn("m", F.struct(F.lit(0.0).alias("l"), F.lit(0.0).alias("b"), F.col("x").alias("f")))
    else:
        g = g.withColumn("m", holt(F.col("x"), c))
    off = F.zip_with("x", "m.f", lambda a, f: a - f)
    pairs = F.filter(F.zip_with("x", "m.f", lambda a, f: F.when(a > 0, F.abs((a - f) / a))), lambda p: p.isNotNull())
    g = g.withColumns({"sigma": pstdev_of(off), "mape": F.when(F.size(pairs) >= 3, mean_of(pairs))})
    g = g.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(c.horizon_days))))
    last7 = F.slice("x", F.greatest(F.lit(1), F.size("x") - 6), 7)
    if c.method == "seasonal_naive":
        base = F.greatest(F.lit(0.0), F.get(last7, F.pmod(F.col("h") - 1, F.size(last7))))
    elif c.method == "moving_average":
        base = mean_of(last7)
    else:
        base = F.greatest(F.lit(0.0), F.col("m.l") + F.col("m.b") * damped_sum(c.damping, F.col("h")))
    day = F.date_add("last", F.col("h"))
    index = F.get("i", F.dayofweek(day) - 1)
    est = F.greatest(F.lit(0.0), base * index)
    margin = 1.96 * F.col("sigma") * F.sqrt(F.col("h").cast("double")) * index
    return g.select(*KEYS, day.alias("forecast_date"), F.col("h").alias("step"), rounded(est, 4).alias("expected_cost"), rounded(F.greatest(F.lit(0.0), est - margin), 4).alias("lower"), rounded(est + margin, 4).alias("upper"), rounded(F.col("sigma"), 6).alias("sigma"), rounded(F.col("mape"), 6).alias("mape"))
