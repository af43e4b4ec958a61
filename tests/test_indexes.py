"""Indexes, roll-ups and incremental operators against brute force."""

from __future__ import annotations

import os
from collections import Counter
from datetime import date, datetime, timedelta
from statistics import median

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.functions import exprs, pricing
from ledgerflow.operators import budgets, duplicates, facts, predicates, quality, rollups, series, tranches
from ledgerflow.plans import model, queries_analytics, queries_facts
from ledgerflow.sources import sinks, stored

SF = "/root/testdata/sf0.001"
RULES = [
    {"sku": "PREMIUM_*", "cloud": ["aws", "gcp"]},
    {"sku": "*sql*"},
    {"sku": "x?z", "ws": ["1", "2", "1*"]},
    {},
    {"ws": "[34]*", "cloud": "*"},
    {"sku": "", "ws": "9"},
    {"cloud": "a.s"},
]


def usage(spark, n=400):
    rng = np.random.default_rng(1)
    pick = lambda values: values[int(rng.integers(len(values)))]
    rows = [(i, pick(["premium_SQL", "PREMIUM_X", "xyz", "XYZ", "xz", "", None, "a sql"]), pick(["AWS", "gcp", "a.s", "abs", None]), pick(["1", "10", "2", "3", "34", "9", None])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, sku string, cloud string, ws string")


def test_predicate_index_finds_what_columns_find(spark):
    df = usage(spark)
    rules = RULES * 3 + [{"ws": str(i), "sku": f"none{i}*"} for i in range(50)]
    want = Counter()
    for n, rule in enumerate(rules):
        for r in df.filter(exprs.scope_matches(rule)).select("id").collect():
            want[r.id, n] += 1
    keys = predicates.keys_of(rules)
    got = Counter((r.id, r.rule) for r in df.withColumns(predicates.combination(keys)).join(predicates.matching(df, rules), ["c1", "c2"]).select("id", "rule").collect())
    assert got == want
    first = {r.id: r.rule for r in df.withColumns(predicates.combination(keys)).join(predicates.first_match(df, rules), ["c1", "c2"], "left").select("id", "rule").collect()}
    assert first == {i: min(n for (j, n) in want if j == i) for i in range(400)}


def plan_size(df):
    return len(df._jdf.queryExecution().optimizedPlan().treeString().splitlines())


def test_plan_of_an_index_does_not_grow_with_the_rules(spark):
    df = usage(spark, 50)
    sizes = {n: plan_size(predicates.first_match(df, [{"sku": f"s{i}*", "ws": str(i)} for i in range(n)])) for n in (2, 2000)}
    assert sizes[2] == sizes[2000]


def test_rules_meet_classes_of_values_and_not_values(spark):
    n = 3000
    df = spark.range(n).select(F.concat(F.lit("e"), F.col("id").cast("string")).alias("entity"), F.when(F.col("id") % 7 != 0, (F.col("id") % 5).cast("string")).alias("ws"))
    rules = [{"ws": str(i % 5), "entity": [f"e{i % 9}*", f"?{i % 10}"]} for i in range(300)]
    keys = predicates.keys_of(rules)
    combos, fits = predicates._by_class(df, rules, keys, stored.Scratch())
    assert combos.count() == n
    # entities fall into classes by their first digit and by having one digit only
    assert combos.select("r1", "r2").distinct().count() <= 20 * 6
    want = {}
    for r in df.collect():
        alone = len(r.entity) == 2
        want[r.entity] = [i for i, rule in enumerate(rules) if rule["ws"] == r.ws and (r.entity.startswith(rule["entity"][0][:-1]) or alone and r.entity[1] == rule["entity"][1][1])]
    got = {e: [] for e in want}
    for r in df.withColumns(predicates.combination(keys)).join(predicates.matching(df, rules), ["c1", "c2"]).select("entity", "rule").collect():
        got[r.entity].append(r.rule)
    assert {e: sorted(x) for e, x in got.items()} == want
    first = {r.entity: r.rule for r in df.withColumns(predicates.combination(keys)).join(predicates.first_match(df, rules), ["c1", "c2"]).select("entity", "rule").collect()}
    assert first == {e: x[0] for e, x in want.items() if x}


def test_many_discounts_as_few(spark):
    df = usage(spark).withColumn("record_id", F.col("id"))
    rules = [{"name": f"r{i}", "match": m, "discount_pct": 0.01 * i} for i, m in enumerate(RULES[:3] + RULES[4:])]
    want = {r.id: tuple(r.d) for r in df.select("id", pricing.discount(rules).alias("d")).collect()}
    got = {r.id: tuple(r["__discount"]) for r in facts.with_discount(df, rules).collect()}
    assert got == want


def test_many_budgets_as_few(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(date(2026, 1, 1) + timedelta(int(rng.integers(80))), float(rng.integers(1, 50)), "ABC"[int(rng.integers(3))], None if rng.random() < 0.1 else f"team-{int(rng.integers(5))}") for _ in range(500)]
    costs = spark.createDataFrame(rows, "usage_date date, total_cost_usd double, sku string, team string")
    scopes = [{}, {"sku": "a"}, {"team": "team-?", "sku": ["A", "B"]}, {"team": "*-3"}, {"team": "nobody"}]
    many = [budgets.Budget(f"b{i}", 100.0 * (i + 1), scopes[i % 5], ("month", "quarter", "year")[i % 3]) for i in range(20)]
    want = sorted(map(str, budgets.budget_status(costs, many, "2026-03-10").collect()))
    monkeypatch.setattr(predicates, "FEW_RULES", 3)
    assert sorted(map(str, budgets.budget_status(costs, many, "2026-03-10").collect())) == want and len(want) == 20


def best(tranche_rows, sku, unit, cloud, at):
    fit = [(a, c, (b is not None, b or 0), p) for s, u, c, a, b, p in tranche_rows if (s, u) == (sku, unit) and c in ("", cloud) and a is not None and a <= at and (b is None or at < b)]
    top = max(fit, key=lambda t: (t[0], t[1], t[2], -1 if t[3] is None else t[3]), default=None)
    return (None, None) if top is None else (top[0], top[3])


@pytest.mark.parametrize("few", [10**6, 0])
def test_interval_index_prices_as_brute_force(spark, few):
    rng = np.random.default_rng(3)
    origin = datetime(2020, 1, 1)
    hours = lambda n: origin + timedelta(hours=int(n))
    listed = []
    for _ in range(6000):
        # one SKU has most tranches; lengths from an hour to years, starts that tie, clustered ones, open ends
        sku = "hot" if rng.random() < 0.9 else f"s{int(rng.integers(3))}"
        start = int(rng.integers(0, 20_000)) // 4 * 4 if rng.random() < 0.7 else 10_000 + int(rng.integers(0, 60))
        end = None if rng.random() < 0.05 else start + int(10 ** (rng.random() * 4)) - 1
        listed.append((sku, "DBU", ["", "AWS", "GCP"][int(rng.integers(3))], hours(start), None if end is None else hours(end), None if rng.random() < 0.02 else float(rng.integers(1, 1000))))
    listed += [("hot", "DBU", "", None, None, 1.0), ("hot", "", "", hours(5), hours(9), 7.0), ("ends", "DBU", "", hours(0), hours(10), 5.0)]
    used = [(i, ["hot", "hot", "hot", "s0", "s1", "nowhere", None][int(rng.integers(7))], ["DBU", "DBU", None][int(rng.integers(3))], ["aws", "GCP", "azure", None][int(rng.integers(4))], None if i % 97 == 0 else hours(int(rng.integers(-100, 25_000)))) for i in range(1500)]
    used += [(9000 + i, "hot", "DBU", "aws", hours(10_000 + i)) for i in range(70)] + [(9990, "ends", "DBU", "aws", hours(10)), (9991, "ends", "DBU", "aws", hours(0))]
    prices = spark.createDataFrame(listed, "sku_name string, usage_unit string, cloud string, price_start_time timestamp_ntz, price_end_time timestamp_ntz, pricing double")
    df = spark.createDataFrame(used, "id long, sku_name string, usage_unit string, cloud string, usage_end_time timestamp_ntz")
    out = facts.with_price(df, prices, few)
    assert set(out.columns) == {*df.columns, "price_start_time", "unit_price"}
    got = {r.id: (r.price_start_time, r.unit_price) for r in out.collect()}
    assert len(got) == len(used)
    for i, sku, unit, cloud, at in used:
        assert got[i] == ((None, None) if at is None else best(listed, sku, unit or "", (cloud or "").upper(), at)), (i, sku, at)


def test_intervals_of_a_sweep_do_not_overlap():
    found = list(tranches.sweep(iter([(0, 100, 1.0), (10, 20, 2.0), (10, 50, 3.0), (15, 18, 4.0), (60, 200, 5.0)])))
    assert found == [(0, 10, 0, 1.0), (10, 15, 10, 3.0), (15, 18, 15, 4.0), (18, 50, 10, 3.0), (50, 60, 0, 1.0), (60, 200, 60, 5.0)]


def test_index_is_about_as_long_as_the_list(spark):
    rows = [("a", "u", "", datetime(2020, 1, 1) + timedelta(hours=i), datetime(2020, 1, 1) + timedelta(hours=i + 5000), 1.0) for i in range(4000)]
    listed = spark.createDataFrame(rows, "sku string, unit string, cloud string, a timestamp_ntz, b timestamp_ntz, price double")
    _, buckets = tranches.index(tranches.elementary(listed))
    sizes = [r.n for r in buckets.select(F.size("intervals").alias("n")).collect()]
    assert sum(sizes) <= 4000 + 2 * 4000 / tranches.PER_BUCKET and max(sizes) <= 50


def test_salted_job_join(spark, monkeypatch):
    """Jobs beyond a broadcast: nine rows in ten have no job, one job has half of the rest; no task is much larger than others."""
    jobs = spark.range(500).select(F.lit("w").alias("j_ws"), F.col("id").cast("string").alias("j_id"), F.concat(F.lit("job-"), "id").alias("job_name"))
    job = F.when(F.col("id") % 10 == 0, F.when(F.col("id") % 20 == 0, "7").otherwise((F.col("id") % 500).cast("string")))
    df = spark.range(0, 40_000, 1, 4).select(F.col("id").alias("record_id"), F.lit("w").alias("workspace_id"), F.struct(job.alias("job_id")).alias("usage_metadata"))
    want = {r.record_id: (f"job-{r.usage_metadata.job_id}" if r.usage_metadata.job_id else None) for r in df.collect()}
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(old, ("false", "-1", "4"), strict=True):
            spark.conf.set(k, v)
        out = facts.with_job(df, jobs, hot=50, most=10)
        got = out.select("record_id", "job_name", F.spark_partition_id().alias("task"), F.col("usage_metadata.job_id").isNull().alias("bare")).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert {r.record_id: r.job_name for r in got} == want and len(got) == 40_000
    tasks = Counter(r.task for r in got if not r.bare)
    assert max(tasks.values()) <= 2 * median(tasks.values()) and not {r.task for r in got if r.bare} & set(tasks)


def test_job_sums_of_both_grains(spark):
    dims = ", ".join(f"v AS {d}" for d in facts.DIMS)
    priced = spark.sql(f"SELECT 'w' AS workspace_id, named_struct('job_id', j, 'job_run_id', r) AS usage_metadata, 1.5D AS total_cost_usd, 1.0D AS usage_quantity, {dims} FROM VALUES ('1', 'a', 'x'), ('1', 'a', 'y'), ('1', 'b', 'x'), ('1', NULL, 'z'), (NULL, NULL, 'q') AS t(j, r, v)")
    runs, jobs = facts.job_sums(priced)
    assert {(r.job_id, r.run_id): (r.run_cost_usd, r.dbus) for r in runs.collect()} == {("1", "a"): (3.0, 2.0), ("1", "b"): (1.5, 1.0)}
    assert [(r.job_id, r.team) for r in jobs.collect()] == [("1", "z")]
    assert facts.run_cost(priced).count() == 2


def test_merged_sketches_keep_their_rank_error(spark):
    rng = np.random.default_rng(6)
    values = np.round(rng.lognormal(6, 1.5, 60_000)).astype(int)
    rows = [(date(2026, 1, 1) + timedelta(int(i % 40)), "w", int(v)) for i, v in enumerate(values)] + [(date(2026, 1, 1), "w", None)]
    q = spark.createDataFrame(rows, "query_date date, workspace_id string, total_duration_ms long")
    daily = rollups.duration_sketches(q, ["query_date", "workspace_id"], k=256)
    got = rollups.merged_quantiles(daily, {"month": F.month("query_date")}, {"p50": 0.5, "p95": 0.95}, k=256).collect()
    assert {r.month: r.queries for r in got} == {1: 60_000 // 40 * 31, 2: 60_000 // 40 * 9}
    for r in got:
        own = np.sort(values[[(i % 40 < 31) == (r.month == 1) for i in range(60_000)]])
        for value, rank in ((r.p50, 0.5), (r.p95, 0.95)):
            low, high = (np.searchsorted(own, value, side) / len(own) for side in ("left", "right"))
            assert low - 2.3 / 256**0.9 <= rank <= high + 2.3 / 256**0.9


def test_counts_of_durations_give_exact_quantiles(spark):
    rng = np.random.default_rng(16)
    values = np.round(rng.lognormal(6, 1.5, 20_000)).astype(int)
    rows = [(date(2026, 1, 1) + timedelta(i % 40), "w", int(v)) for i, v in enumerate(values)] + [(date(2026, 1, 1), "w", None), (date(2026, 4, 1), "w", None)] + [(date(2026, 5, 1), "w", v) for v in (-5, 7)]
    q = spark.createDataFrame(rows, "query_date date, workspace_id string, total_duration_ms long")
    daily = rollups.duration_counts(q, ["query_date", "workspace_id"])
    got = {r.month: tuple(r)[1:] for r in rollups.exact_quantiles(daily, {"month": F.month("query_date")}, {"p50": "0.5", "p95": "0.95"}).collect()}
    own = {m: sorted(v for d, _, v in rows if d.month == m and v is not None) for m in (1, 2, 5)}
    at = lambda v, percent: v[-(-len(v) * percent // 100) - 1]
    want = {m: (len(v) + (m == 1), at(v, 50), at(v, 95)) for m, v in own.items()} | {4: (1, None, None)}
    assert got == want


def test_monthly_p95_is_exact(spark, monkeypatch):
    # more distinct durations in a warehouse than a sketch holds one by one
    n = 60_000
    start = F.lit("2026-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=(F.col("id") % 40).cast("int"))
    q = spark.range(n).select(F.to_date(start).alias("query_date"), F.lit("1").alias("workspace_id"), F.lit("2").alias("warehouse_id"), (F.col("id") * 7919 % n).alias("total_duration_ms"))
    monkeypatch.setattr(queries_facts.T, "query_history", lambda *_: q)
    whole = next(r for r in queries_facts.a11_monthly_p95(spark, "").collect() if r.span == "all")
    assert (whole.queries, whole.p50_ms, whole.p95_ms) == (n, n // 2 - 1, n * 95 // 100 - 1)


def test_bitmaps_roll_up_and_stay_valid(spark):
    rng = np.random.default_rng(7)
    rows = [(date(2026, 1, 1) + timedelta(int(rng.integers(70))), None if rng.random() < 0.01 else f"e{int(rng.zipf(1.3)) % 40_000}") for _ in range(20_000)]
    df = spark.createDataFrame(rows, "usage_date date, entity_key string").cache()
    early = df.filter("usage_date < DATE '2026-02-01'")
    first = rollups.entity_numbers(early).cache()
    maps = rollups.entity_bitmaps(early, first)
    numbers = rollups.entity_numbers(df, known=first).cache()
    assert {r.number for r in numbers.collect()} == set(range(numbers.count())) and numbers.count() == len({k for _, k in rows if k})
    both = maps.unionByName(rollups.entity_bitmaps(df.filter("usage_date >= DATE '2026-02-01'"), numbers))
    got = {r.month: r.entities for r in rollups.merged_counts(both, {"month": F.month("usage_date")}).collect()}
    assert got == {m: len({k for d, k in rows if d.month == m and k}) for m in (1, 2, 3)}
    assert rollups.merged_counts(both, {"all": F.lit(1)}).first().entities == len({k for _, k in rows if k})


@pytest.mark.parametrize("bits", [1 << 25, 1 << 15])
def test_repeated_keys(spark, bits):
    rng = np.random.default_rng(8)
    rows = [(int(rng.integers(100_000)), f"k{int(rng.integers(3))}") for _ in range(20_000)] + [(None, "n"), (None, "n"), (1 << 40, None), (5 << 40, None)] + [(7 << 40, "hot")] * 3000
    df = spark.createDataFrame(rows, "a long, b string").repartition(5)
    got = {(r.a, r.b): r.rows for r in duplicates.repeated_keys(df, ["a", "b"], bits).collect()}
    assert got == {k: n for k, n in Counter(rows).items() if n > 1}
    if bits > 1 << 20:
        # what is shuffled is little more than the repeats themselves
        assert duplicates.suspects(df, ["a", "b"], bits).count() <= sum(got.values()) + 200
    assert duplicates.repeated_keys(df.filter("false"), ["a", "b"]).count() == 0


def test_rows_whose_key_no_other_has_stay_where_they_lie(spark):
    rng = np.random.default_rng(17)
    rows = [(i, None if rng.random() < 0.01 else int(rng.integers(20_000)), "xy"[int(rng.integers(2))]) for i in range(8000)]
    times = Counter((a, b) for _, a, b in rows)
    alone, others = duplicates.apart(spark.createDataFrame(rows, "id long, a long, b string"), ["a", "b"])
    apart = {r.id for r in alone.collect()}
    assert {i for i, a, b in rows if times[a, b] > 1} <= {i for i, *_ in rows} - apart
    assert sorted([*apart, *(r.id for r in others.collect())]) == list(range(8000))
    assert len(apart) >= 0.85 * sum(n for n in times.values() if n == 1)
    assert "Exchange hashpartitioning" not in alone._jdf.queryExecution().executedPlan().toString()
    nobody, none = duplicates.apart(spark.createDataFrame(rows[:0], "id long, a long, b string"), ["a", "b"])
    assert nobody.count() == none.count() == 0


def test_facts_of_large_tables_as_of_small(spark):
    priced = stored.written(model.priced(spark, SF).unionByName(model.priced(spark, SF, ("1998-01-01", "1998-12-31"))))
    behind = stored.Scratch()
    behind.written(spark.range(3))
    daily = facts.cost_daily(priced, behind, large=0)
    assert behind.size() == 0
    # groups of one record are not shuffled
    plan = daily._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "Union" in plan
    plain = facts.cost_daily(priced)
    assert sorted(map(str, daily.collect())) == sorted(map(str, plain.collect())) and daily.dtypes == plain.dtypes
    months, kpis = facts.cost_monthly(daily, large=0), facts.kpi_base(daily, large=0)
    assert sorted(map(str, months.collect())) == sorted(map(str, facts.cost_monthly(plain).collect())) and months.dtypes == facts.cost_monthly(plain).dtypes
    assert sorted(map(str, kpis.collect())) == sorted(map(str, facts.kpi_base(plain).collect())) and kpis.dtypes == facts.kpi_base(plain).dtypes


def test_reconciliation_computes_the_fact_once(spark, monkeypatch):
    calls = []
    fact = model.fact
    monkeypatch.setattr(model, "fact", lambda *a: calls.append(a) or fact(*a))
    assert all(r.reconciles for r in queries_analytics.c4_reconciliation(spark, SF).collect()) and len(calls) == 1


def test_checks_find_repeats_either_way(spark, monkeypatch):
    rows = [(i % 900, None if i % 900 == 5 else "s", date(2026, 1, 1), 1.0, False, "A", "B") for i in range(1000)]
    df = spark.createDataFrame(rows, "record_id long, sku_name string, usage_date date, total_cost_usd double, price_missing boolean, cost_center string, team string")
    repeats = lambda: {r.check_name: r.observed for r in quality.checks(df, "2026-01-01", ["record_id", "sku_name"]).collect()}["duplicate_keys"]
    assert repeats() == 100
    monkeypatch.setattr(duplicates, "LEAST_ROWS", 10)
    assert repeats() == 100


@pytest.mark.parametrize("aware", [True, False])
def test_incremental_anomalies(spark, aware):
    rng = np.random.default_rng(9)
    start = date(2026, 1, 1)
    rows = []
    for s in range(12):
        for i in range(70):
            if rng.random() > 0.1 and i >= (60 if s == 10 else 0):  # gaps, and a series that begins late
                rows.append(("d", f"v{s}", start + timedelta(i), float(rng.integers(80, 120)) * (6 if rng.random() < 0.06 else 1)))
    df = spark.createDataFrame(rows, "dimension string, dim_value string, usage_date date, cost double").cache()
    c = series.AnomalyConfig(day_of_week_aware=aware, score_threshold=2.0)
    upto = lambda i: df.filter(F.col("usage_date") < F.lit(start + timedelta(i)))
    state = series.baseline_state(upto(55), c)
    found = 0
    for a, b in ((55, 56), (56, 57), (57, 64), (64, 70)):
        new = upto(b).filter(F.col("usage_date") >= F.lit(start + timedelta(a)))
        after, got = series.advance(state, new, c)
        want = series.anomalies(upto(b), c).filter(F.col("usage_date") >= F.lit(start + timedelta(a)))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        found += got.count()
        state = sinks.upsert(state, after, ["dimension", "dim_value"]).cache()
        assert state.agg(F.max(F.size("recent"))).first()[0] <= c.window_days
        whole = {r.dim_value: (r.points, r.total, r.recent) for r in series.baseline_state(upto(b), c).collect()}
        # a series without new days keeps points that its next day will leave out
        assert all(whole[r.dim_value][:2] == (r.points, r.total) for r in state.collect())
    assert found > 3


def test_merge_leaves_other_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([(m, k, "old") for m in ("a", "b", "c") for k in range(5)] + [("a", None, "old")], "m string, k int, v string")
    sinks.overwrite(old.repartition("m"), path, ["m"])
    stamps = lambda: {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}
    before = stamps()
    new = spark.createDataFrame([("a", 3, "new"), ("a", 9, "new"), ("a", None, "new"), ("d", 1, "new")], "m string, k int, v string")
    for _ in range(2):
        assert sinks.merge_partitions(new, path, ["m", "k"], ["m"]) == 8
        got = {(r.m, r.k): r.v for r in spark.read.parquet(path).collect()}
        assert got == {(m, k): "old" for m in ("a", "b", "c") for k in range(5)} | {(r.m, r.k): "new" for r in new.collect()}
    after = stamps()
    assert all(after[f] == t for f, t in before.items() if "m=a" not in f) and not any(f in after for f in before if "m=a" in f)
    assert sinks.merge_partitions(new.withColumn("v", F.lit("later")), path, ["m", "k"], ["m"], update=False) == 8
    assert {r.v for r in spark.read.parquet(path).collect()} == {"old", "new"}
