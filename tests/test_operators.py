"""Small numeric examples of the cost operators, and invariants of sinks and streams."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerflow.functions import exprs, pricing
from ledgerflow.operators import alerts, attribution, budgets, facts, quality, recommend, series
from ledgerflow.sources import readers, sinks
from ledgerflow.streaming import late_usage


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or ["id"]).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "sku,product,group",
    [
        ("PREMIUM_JOBS_COMPUTE_(PHOTON)", None, "JOBS"),
        ("PREMIUM_SQL_PRO_COMPUTE_US_EAST", None, "SQL"),
        ("PREMIUM_SERVERLESS_SQL_COMPUTE", None, "SERVERLESS_SQL"),
        ("PREMIUM_SERVERLESS_REAL_TIME_INFERENCE", None, "MODEL_SERVING"),
        ("MODEL_TRAINING_GPU", None, "AI_TRAINING"),
        ("ALGO_DESCONOCIDO", None, "OTHER"),
        ("PREMIUM_ALL_PURPOSE_COMPUTE", "JOBS", "JOBS"),
        ("X_SERVERLESS", "JOBS", "SERVERLESS_JOBS"),
    ],
)
def test_sku_group(spark, sku, product, group):
    assert one(spark, pricing.sku_group(F.lit(sku), F.lit(product).cast("string"))) == group


def test_discount_clamp_and_null(spark):
    rules = [{"name": "big", "match": {"cloud": "*"}, "discount_pct": 5.0}]
    assert one(spark, pricing.discount(rules), cloud="AWS")["pct"] == 0.999
    df = spark.sql("SELECT CAST(NULL AS STRING) AS cloud").select(pricing.discount(rules).alias("d"))
    assert df.first()["d"]["name"] == "sin_descuento"


def test_price_of_a_record(spark):
    df = spark.sql("SELECT 'X_SQL' AS sku_name, CAST(NULL AS STRING) AS billing_origin_product, 100.0D AS usage_quantity, 1.0D AS unit_price")
    for group in pricing.priced_columns([{"name": "a", "match": {}, "discount_pct": 0.2}], True, {"OTHER": 0.5}):
        df = df.withColumns(group)
    r = df.first()
    assert (r.list_cost_usd, r.discount_usd, r.effective_cost_usd, r.infra_cost_usd, r.total_cost_usd) == (100, 20, 80, 40, 120)


@pytest.mark.parametrize("glob,text,fits", [("a*", "Abc", True), ("a?c", "abc", True), ("a?c", "ac", False), ("[xy]1", "y1", True), ("[!xy]1", "y1", False), ("a_b", "axb", False), ("a.b", "axb", False), ("*", "line\nbreak", True)])
def test_glob(spark, glob, text, fits):
    assert one(spark, exprs.matches_any(F.lit(text), [glob])) is fits


USE = "SELECT 'A' AS sku_name, 'DBU' AS usage_unit, 'aws' AS cloud, TIMESTAMP_NTZ '2026-02-01 00:00:00' AS usage_end_time"


@pytest.mark.parametrize(
    "pricing_column,price",
    [
        ("named_struct('default', 2.0D, 'effective_list', named_struct('default', 1.5D))", 1.5),
        ("named_struct('default', CAST(NULL AS DOUBLE), 'promotional', named_struct('default', 0.5D))", 0.5),
        ("3.0D", 3.0),
        ("named_struct('other', 1)", None),
    ],
)
def test_price_shapes_and_cloud_without_case(spark, pricing_column, price):
    prices = spark.sql(f"SELECT 'A' AS sku_name, 'DBU' AS usage_unit, 'AWS' AS cloud, TIMESTAMP_NTZ '2026-01-01 00:00:00' AS price_start_time, CAST(NULL AS TIMESTAMP_NTZ) AS price_end_time, {pricing_column} AS pricing")
    assert facts.with_price(spark.sql(USE), prices).first()["unit_price"] == price


def test_normalised_maps(spark):
    df = spark.sql("SELECT map('Cost-Center', '-', 'cost_center', 'x', 'COSTCENTER', 'y', 'Env', ' prod ') AS m UNION ALL SELECT NULL UNION ALL SELECT map()")
    got = [r["x"] for r in df.select(exprs.normalise_map(F.col("m")).alias("x")).collect()]
    assert got == [{"costcenter": "x", "env": "prod"}, {}, {}]


def test_warehouse_cost_meets_queries_of_its_own_day_and_workspace(spark):
    dims = ", ".join(f"'{d}-1' AS {d}" for d in facts.DIMS)
    rows = " UNION ALL ".join(f"SELECT DATE '2026-0{m}-05' AS usage_date, '{w}' AS workspace_id, named_struct('warehouse_id', {h}) AS usage_metadata, 5.0D AS total_cost_usd" for m in (1, 2) for w in ("a", "b") for h in ("'h'", "'h'", "CAST(NULL AS STRING)"))
    priced = spark.sql(f"SELECT *, {dims}, 1.0D AS list_cost_usd, 0.0D AS discount_usd, 1.0D AS effective_cost_usd, 0.0D AS infra_cost_usd, 2.0D AS usage_quantity, 'SQL' AS sku_group, false AS is_serverless FROM ({rows})")
    activity = spark.createDataFrame([(date(2026, 2, 5), "a", "h", "u", 4, 0, 1.5, 10.0, 7), (date(2026, 2, 5), "a", "h", "v", 1, 1, 0.5, 30.0, 1)], "query_date date, workspace_id string, warehouse_id string, executed_by string, query_count long, failed_queries long, active_hours double, avg_ms double, read_bytes long")
    got = {(r.usage_date.month, r.workspace_id): r for r in facts.warehouse_cost(priced, activity).collect()}
    assert {k: r.cost_per_query for k, r in got.items()} == {(1, "a"): None, (1, "b"): None, (2, "a"): 2.0, (2, "b"): None}
    r = got[2, "a"]
    assert (r.distinct_users, r.active_hours, r.avg_ms, r.read_bytes, r.usage_quantity, r.list_cost_usd, r.entity_key) == (2, 2.0, 20.0, 8, 4.0, 2.0, "WAREHOUSE:h")


def test_hours_are_those_that_queries_took(spark):
    q = spark.sql("SELECT DATE '2026-01-01' AS query_date, 'w' AS workspace_id, 'h' AS warehouse_id, 'u' AS executed_by, s AS execution_status, CAST(ms AS LONG) AS total_duration_ms, CAST(NULL AS LONG) AS waiting_for_compute_duration_ms, 1L AS read_bytes, 2L AS produced_rows, s AS statement_id FROM VALUES ('Failed', 100), ('query_failed', NULL), (NULL, 3599900) AS t(s, ms)")
    r = facts.query_activity(q).first()
    assert (r.active_hours, r.failed_queries, r.total_ms, r.queue_ms, r.query_count, r.avg_ms) == (1.0, 2, 3_600_000, 0, 3, 1_800_000.0)


def test_profiles_leave_old_runs_and_queries_out(spark):
    dims = ", ".join(f"'x' AS {d}" for d in facts.DIMS)
    daily = spark.sql(f"SELECT DATE '2001-08-01' AS usage_date, k AS entity_key, 'w' AS workspace_id, 'JOB' AS entity_type, '1' AS entity_id, 'n' AS entity_name, 'o' AS owner_resolved, 'JOBS' AS sku_group, 10.0D AS total_cost_usd, u AS is_untagged, false AS is_photon, false AS is_serverless, {dims} FROM VALUES ('JOB:1', false), ('JOB:1', true), ('WAREHOUSE:1', false), ('CLUSTER:1', false) AS t(k, u)")
    runs = spark.sql("SELECT 'w' AS workspace_id, '1' AS job_id, d AS run_date, true AS is_failed, 1.0D AS duration_minutes FROM VALUES (DATE '1999-08-01'), (DATE '2001-07-01'), (DATE '2001-07-02') AS t(d)")
    activity = spark.sql("SELECT 'w' AS workspace_id, '1' AS warehouse_id, d AS query_date, 3L AS query_count, 0.5D AS active_hours FROM VALUES (DATE '1999-08-01'), (DATE '2001-07-30') AS t(d)")
    clusters = spark.sql("SELECT '1' AS cluster_id, w AS workspace_id, n AS worker_count, 0 AS auto_termination_minutes, '15.3' AS dbr_version, false AS is_autoscale FROM VALUES ('w', 4), ('other', 9) AS t(w, n)")
    got = {r.entity_key: r for r in recommend.profiles(daily, clusters, runs, activity, "2001-08-01", 30).collect()}
    assert (got["JOB:1"].run_count, got["JOB:1"].failed_runs, got["JOB:1"].last_run_date, got["JOB:1"].untagged_cost_usd) == (1, 1, date(2001, 7, 2), 10.0)
    assert (got["WAREHOUSE:1"].query_count, got["WAREHOUSE:1"].active_hours) == (3, 0.5)
    assert got["CLUSTER:1"].worker_count == 4 and len(got) == 3


def test_live_coverage_counts_own_tags_only(spark):
    sources = lambda own: ", ".join(f"'{'usage' if d in own else 'job'}' AS {d}_source" for d in facts.DIMS)
    row = lambda entity, cost, own: f"SELECT DATE '2026-01-01' AS usage_date, 'w' AS workspace_id, {entity} AS entity_id, 'JOB' AS entity_type, 's' AS sku_name, CAST(NULL AS STRING) AS billing_origin_product, {cost}D AS list_cost_usd, map('a', 'b') AS custom_tags, {sources(own)}"
    priced = spark.sql(" UNION ALL ".join([row("'1'", 8.0, ["team"]), row("'1'", 2.0, []), row("'2'", 4.0, []), row("CAST(NULL AS STRING)", 2.0, ["team"])]))
    got = {r.dimension: r for r in facts.live_coverage(priced).collect()}
    r = got["team"]
    assert (r.total_cost_usd, r.attributed_cost_usd, r.unattributed_cost_usd, r.coverage_pct, r.attributed_entities, r.total_entities) == (16, 10, 6, 62.5, 1, 2)
    assert (got["owner"].coverage_pct, got["owner"].attributed_entities) == (0, 0)
    bare = {r.entity_id: (r.records, r.list_cost_usd, r.tag_count) for r in facts.live_untagged(priced).collect()}
    assert bare == {"1": (1, 2.0, 1), "2": (1, 4.0, 1)}


def test_coverage_alert_of_one_day_and_dimension(spark):
    rows = [(date(2026, 1, 30), "cost_center", 100.0, 100.0), (date(2026, 1, 31), "cost_center", 100.0, 50.0), (date(2026, 1, 31), "team", 100.0, 0.0)]
    coverage = spark.createDataFrame(rows, "usage_date date, dimension string, total_cost_usd double, attributed_cost_usd double")
    got = [(r.subject, r.severity, r.value, r.threshold) for r in alerts.coverage_drop(coverage, "2026-01-31").collect()]
    assert got == [("dimension=cost_center", "high", 0.5, 0.8)]
    assert alerts.coverage_drop(coverage, "2026-01-30").count() == 0 and alerts.coverage_drop(coverage, "2026-02-01").count() == 0


def test_series_of_the_fact_and_latest_budget(spark):
    daily = spark.createDataFrame([(date(2026, 1, 1), "t", "A", 1.0), (date(2026, 1, 1), "t", "B", 2.0), (date(2026, 1, 2), None, "A", 4.0)], "usage_date date, team string, sku_group string, total_cost_usd double")
    got = {(r.dimension, r.dim_value, r.usage_date.day): r.cost for r in series.daily_series(daily, ["team", "sku_group", "absent"]).collect()}
    assert got == {("team", "t", 1): 3, ("sku_group", "A", 1): 1, ("sku_group", "B", 1): 2, ("sku_group", "A", 2): 4}
    history = spark.sql("SELECT 'b' AS budget_id, DATE '2026-01-01' AS as_of_date, 'OK' AS status UNION ALL SELECT 'b', DATE '2026-01-03', 'WARNING'")
    assert [r.status for r in budgets.latest_status(history).collect()] == ["WARNING"]


def test_streams_of_costs_and_alerts(spark, tmp_path):
    src = str(tmp_path / "u")
    spark.sql("SELECT TIMESTAMP '2026-01-01 05:00:00' AS usage_end_time, 'A' AS sku_group, 1.0D AS total_cost_usd UNION ALL SELECT TIMESTAMP '2026-01-01 09:00:00', 'A', 2.0D UNION ALL SELECT TIMESTAMP '2026-01-20 00:00:00', 'A', 9.0D").write.parquet(src)
    usage = spark.readStream.schema("usage_end_time timestamp, sku_group string, total_cost_usd double").parquet(src)
    q = late_usage.daily_cost_stream(usage).writeStream.format("memory").queryName("daily_costs").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert [(r.usage_date, r.cost, r.records) for r in spark.table("daily_costs").collect()] == [(date(2026, 1, 1), 3.0, 2)]
    src = str(tmp_path / "a")
    spark.sql("SELECT 'f' AS fingerprint, TIMESTAMP '2026-01-01 05:00:00' AS created_at UNION ALL SELECT 'f', TIMESTAMP '2026-01-01 06:00:00' UNION ALL SELECT 'g', TIMESTAMP '2026-01-01 06:00:00'").coalesce(1).write.parquet(src)
    found = spark.readStream.schema("fingerprint string, created_at timestamp").parquet(src)
    q = late_usage.first_alerts(found).writeStream.format("memory").queryName("first_alerts").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(r.fingerprint for r in spark.table("first_alerts").collect()) == ["f", "g"]


def test_entity_and_dimensions(spark):
    df = spark.sql("SELECT named_struct('job_id', ' ', 'cluster_id', 'c1') AS usage_metadata, map('Equipo', 'Datos', 'cc', 'n/a', 'CC ', 'CC-1', 'ambiente', 'prod') AS custom_tags, '3' AS workspace_id")
    r = attribution.with_dimensions(attribution.with_entity(df), {"3": {"environment": "qa", "project": "p"}}).first()
    assert (r.entity_key, r.cost_center, r.team, r.environment, r.project, r.owner) == ("CLUSTER:c1", "CC-1", "Datos", "PRD", "p", "SIN_ASIGNAR")
    assert r.tags_resolved == 4 and not r.is_fully_tagged
    empty = spark.sql("SELECT named_struct('job_id', CAST(NULL AS STRING)) AS usage_metadata")
    assert attribution.with_entity(empty).first()["entity_key"] == "UNKNOWN:SIN_ID"


def days(spark, values, start=date(2026, 1, 5)):
    return spark.createDataFrame([("d", "v", start + timedelta(i), float(x)) for i, x in enumerate(values)], "dimension string, dim_value string, usage_date date, cost double")


def test_robust_scores(spark):
    base = F.array(*[F.lit(20.0)] * 100)
    flat = F.array(*[F.lit(float(x)) for x in (1, 2, 3, 4, 5)])
    assert one(spark, series.robust_score(F.lit(500.0), base, "mad"))["score"] == 99
    assert one(spark, series.robust_score(F.lit(20.0), base, "mad"))["score"] == 0
    assert one(spark, exprs.median_of(F.transform(flat, lambda v: F.abs(v - 3)))) == 1


def test_weekday_aware_series_has_no_anomaly(spark):
    weekly = [300 if i % 7 < 5 else 30 for i in range(60)]
    assert series.anomalies(days(spark, weekly), series.AnomalyConfig(score_threshold=1.5)).count() == 0
    found = series.anomalies(days(spark, weekly), series.AnomalyConfig(score_threshold=1.5, day_of_week_aware=False)).collect()
    assert {r.direction for r in found} <= {"DROP"}
    spike = series.anomalies(days(spark, [*weekly, 3000]), series.AnomalyConfig()).collect()
    assert [(r.direction, r.severity) for r in spike] == [("SPIKE", "critical")]


def test_forecast_of_constant_and_short_series(spark):
    out = series.forecasts(days(spark, [100] * 30), series.ForecastConfig(horizon_days=5)).collect()
    assert [r.expected_cost for r in out] == [100] * 5 and {r.sigma for r in out} == {0}
    assert series.forecasts(days(spark, [100] * 20)).count() == 0
    gap = series.filled(spark.createDataFrame([("d", "v", date(2026, 1, 1), 10.0), ("d", "v", date(2026, 1, 4), 40.0)], "dimension string, dim_value string, usage_date date, cost double"), 120).first()
    assert list(gap.v) == [10, 0, 0, 40]
    twice = spark.createDataFrame([("d", "v", date(2026, 1, 1) + timedelta(i), float(i)) for i in range(200)] + [("d", "v", date(2026, 7, 19), 1.0)], "dimension string, dim_value string, usage_date date, cost double")
    r = series.filled(twice, 3).first()
    assert (list(r.v), r.history, r["last"]) == ([197.0, 198.0, 200.0], 200, date(2026, 7, 19)) and [x.day for x in r.d] == [17, 18, 19]


def test_budget(spark):
    costs = spark.createDataFrame([(date(2026, 3, 1) + timedelta(i), 100.0, "t") for i in range(15)], "usage_date date, total_cost_usd double, team string")
    r = budgets.budget_status(costs, [budgets.Budget("b", 3000.0)], "2026-03-15").first()
    assert (r.consumed_pct, r.projected, r.required_daily, r.remaining_days, r.days_to_exhaustion) == (50, 3100, 93.75, 16, 15)
    assert r.status == "CRITICAL" and r.threshold_reached == 50
    assert budgets.budget_status(costs, [], "2026-03-15").count() == 0
    assert budgets.budget_status(costs, [budgets.Budget("old", 1.0, effective_to="2020-01-01")], "2026-03-15").count() == 0
    ordered = budgets.by_consumption(budgets.budget_status(costs, [budgets.Budget("a", 9000.0), budgets.Budget("b", 3000.0)], "2026-03-15"))
    assert [r.budget_id for r in ordered.collect()] == ["b", "a"]
    ahead = spark.createDataFrame([(date(2026, 3, 16) + timedelta(i), 120.0) for i in range(16)], "forecast_date date, expected_cost double")
    r = budgets.budget_status(costs, [budgets.Budget("b", 3000.0)], "2026-03-15", ahead).first()
    assert r.projected == 1500 + 1920


def test_chargeback_reconciles(spark):
    rows = [("2026-01", 600.0, "e1", "x", "A"), ("2026-01", 400.0, "e2", "x", "B"), ("2026-01", 100.0, "e3", "x", "SIN_ASIGNAR"), ("2026-01", 50.0, "e4", "shared-db", "A")]
    costs = spark.createDataFrame(rows, "year_month string, total_cost_usd double, entity_key string, entity_name string, cost_center string")
    lines = budgets.chargeback(costs, shared=["shared-*"], shared_cols=["entity_name"])
    got = {r.unit: r for r in lines.collect()}
    assert (got["A"].unallocated_usd, got["B"].unallocated_usd, got["A"].total_usd) == (60, 40, 690)
    assert [r.unit for r in budgets.by_total(lines).collect()] == ["A", "B"]
    assert budgets.reconciliation(lines, costs).first()["reconciles"]


@pytest.mark.parametrize(
    "more,rule,savings",
    [
        ({"entity_type": "CLUSTER", "auto_termination_minutes": 0}, "NO_AUTOTERMINATION", 900),
        ({"entity_type": "CLUSTER", "auto_termination_minutes": 180}, "NO_AUTOTERMINATION", 450),
        ({"entity_type": "JOB", "run_count": 20, "failed_runs": 8}, "FAILED_RUN_WASTE", 1200),
        ({"entity_type": "WAREHOUSE", "query_count": 100, "active_hours": 100}, "OVERSIZED_WAREHOUSE", 1200),
        ({"entity_type": "JOB", "sku_group": "ALL_PURPOSE", "run_count": 5}, "ALL_PURPOSE_FOR_JOBS", 1350),
        ({"entity_type": "JOB", "days_since_activity": 14}, "ZOMBIE_ENTITY", 3000),
        ({"entity_type": "CLUSTER", "dbr_version": "12.2.x-scala2.12"}, "LEGACY_RUNTIME", 300),
        ({"entity_type": "JOB", "sku_group": "SQL"}, "PHOTON_OPPORTUNITY", 360),
        ({"entity_type": "CLUSTER", "is_autoscale": False, "worker_count": 4}, "NO_AUTOSCALE", 450),
        ({"entity_type": "JOB", "run_count": 20, "avg_minutes": 5.0}, "SERVERLESS_CANDIDATE", 600),
        ({"entity_type": "JOB", "untagged_cost_usd": 100.0}, "UNTAGGED_SPEND", 0),
    ],
)
def test_rules(spark, more, rule, savings):
    base = {"entity_key": "k", "workspace_id": "w", "entity_type": "JOB", "sku_group": "OTHER", "cost_usd": 3000.0, "untagged_cost_usd": 0.0, "is_photon": False, "is_serverless": False, "analysis_days": 30, "days_since_activity": 0, "worker_count": 1, "auto_termination_minutes": None, "dbr_version": None, "is_autoscale": True, "run_count": None, "failed_runs": None, "avg_minutes": 100.0, "query_count": None, "active_hours": None} | more
    schema = ", ".join(f"{k} {'string' if k in ('entity_key', 'workspace_id', 'entity_type', 'sku_group', 'dbr_version') else 'double' if k in ('cost_usd', 'untagged_cost_usd', 'avg_minutes') else 'boolean' if k.startswith('is_') else 'int'}" for k in base)
    found = {r.rule_id: r.savings_usd for r in recommend.recommendations(spark.createDataFrame([tuple(base.values())], schema)).collect()}
    assert found[rule] == savings


def test_quality_enforcement(spark):
    rows = spark.createDataFrame([("a", False, "error"), ("b", False, "warning")], "check_name string, passed boolean, severity string")
    with pytest.raises(ValueError, match="a"):
        quality.enforce(rows)
    quality.enforce(rows.filter("severity = 'warning'"))


def test_cooldown_and_cap(spark):
    raw = spark.createDataFrame([("R", s, f"s{i}", 1.0, 1.0, f"f{i}") for i, s in enumerate(("low", "critical", "medium", "high"))] + [("R", "high", "again", 1.0, 1.0, "f3")], "rule string, severity string, subject string, value double, threshold double, fingerprint string")
    history = spark.sql("SELECT 'f1' AS fingerprint, TIMESTAMP_NTZ '2026-01-01 10:00:00' AS created_at UNION ALL SELECT 'f2', TIMESTAMP_NTZ '2025-12-30 10:00:00'")
    got = {r.subject: r.outcome for r in alerts.admit(raw, history, "2026-01-01 12:00:00", cap=1).collect()}
    assert got["s1"] == "cooldown" and got["s0"] == "severity" and got["s2"] == "cap"
    assert sorted((got["s3"], got["again"])) == ["dispatched", "duplicate"]
    # a longer log changes nothing, and no dispatch older than twice the cooldown is grouped
    old = history.unionByName(spark.sql("SELECT 'f3' AS fingerprint, TIMESTAMP_NTZ '2025-12-01 10:00:00' AS created_at"))
    assert {r.subject: r.outcome for r in alerts.admit(raw, old, "2026-01-01 12:00:00", cap=1).collect()}["s2"] == "cap"


def test_sources(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.range(3).write.parquet(p)
    assert readers.read_source(spark, [f"{p}-absent", p]).count() == 3
    assert readers.read_source(spark, [f"{p}-absent"], optional=True) is None
    with pytest.raises(readers.MissingSource):
        readers.read_source(spark, [f"{p}-absent"])
    assert readers.select_existing(spark.range(1), ["x"]).columns == ["id"]
    assert set(readers.with_audit(spark.range(1), "r", "s").columns) == {"id", "_ingested_at", "_run_id", "_source"}


def batch(spark, *rows):
    return spark.createDataFrame([(date(2026, 1, d), v) for d, v in rows], "usage_date date, v int")


def test_replace_days_is_idempotent(spark, tmp_path):
    p = str(tmp_path / "t")
    sinks.overwrite(batch(spark, (1, 1), (2, 2), (3, 3), (5, 5)), p, ["usage_date"])
    for _ in range(2):
        assert sinks.replace_days(batch(spark, (2, 20), (2, 21), (9, 9)), p, "usage_date", date(2026, 1, 2), date(2026, 1, 4)) == 2
        got = sorted((r.usage_date.day, r.v) for r in spark.read.parquet(p).collect())
        assert got == [(1, 1), (2, 20), (2, 21), (5, 5)]


def test_upsert_is_null_safe(spark):
    old = spark.createDataFrame([(None, 1), (1, 1), (2, 1)], "k int, v int")
    new = spark.createDataFrame([(None, 2), (2, 2), (3, 2)], "k int, v int")
    assert sorted(map(str, ((r.k, r.v) for r in sinks.upsert(old, new, ["k"]).collect()))) == sorted(map(str, [(1, 1), (None, 2), (2, 2), (3, 2)]))
    assert sinks.upsert(old, new, ["k"], update=False).count() == 4


def test_append_and_empty(spark, tmp_path):
    p = str(tmp_path / "log")
    sinks.empty_table(spark, "a int, b string", p)
    assert spark.read.parquet(p).columns == ["a", "b"]
    assert sinks.append(spark.sql("SELECT 1 AS a, 'x' AS b"), p) == 1
    assert sinks.append_merged(spark, p, spark.sql("SELECT 2 AS a, 3 AS c"), str(tmp_path / "next")) == 2


def test_streaming_replaces_days(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    batch(spark, (1, 1), (2, 2)).write.parquet(src)
    stream = spark.readStream.schema("usage_date date, v int").parquet(src)
    for n in range(2):
        q = late_usage.replace_days_writer(stream, out, str(tmp_path / f"c{n}")).trigger(availableNow=True).start()
        q.awaitTermination(60)
        assert q.exception() is None
    assert sorted((r.usage_date.day, r.v) for r in spark.read.parquet(out).collect()) == [(1, 1), (2, 2)]


def test_latest_and_small(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", None)], "k string, t int")
    assert {(r.k, r.t) for r in facts.latest(df, ["k"], "t").collect()} == {("a", 2), ("b", None)}
    assert [facts.sized(df, 3)[1], facts.sized(df, 2)[1], facts.sized(df, 3, 1)[1]] == [True, False, False]
    assert sorted(map(str, facts.small(df, 1).collect())) == sorted(map(str, df.collect()))


def test_severe_anomalies_are_not_crowded_out(spark):
    from ledgerflow.plans import reports

    rows = [(date(2024, 1, 30), "team", f"t{i}", 3.0, "low") for i in range(60)] + [(date(2024, 1, 20), "team", "late", 9.0, "critical")]
    found = spark.createDataFrame(rows, "usage_date date, dimension string, dim_value string, score double, severity string")
    assert [r.dim_value for r in reports.newest_anomalies(reports.severe(found)).collect()] == ["late"]


def test_severe_anomalies_match_sql(spark):
    import duckdb

    from ledgerflow.plans import registry

    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf}/events.parquet')")
    cols = ["usage_date", "dimension", "dim_value", "score", "severity"]
    want = con.sql(registry.ORACLE_SQL["d8_severe_anomalies"]).fetchall()
    got = [tuple(r) for r in registry.QUERIES["d8_severe_anomalies"](spark, sf).select(*cols).collect()]
    assert [(*r[:3], r[4]) for r in got] == [(*r[:3], r[4]) for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want])
