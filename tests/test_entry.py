"""The driver's contract: names, SQL and column names of all queries agree, results match DuckDB on small data."""

from __future__ import annotations

import decimal
from collections import defaultdict

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerflow.operators import facts
from ledgerflow.plans import model, registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None:
        return "NULL"
    if isinstance(v, (float, decimal.Decimal)):
        return repr(round(float(v), 6) + 0.0)
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_core_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLE_SQL)
    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


#: Queries that between them run every operator; the driver compares all of them at sf0.01.
CHOSEN = ["p1_normalise_keys", "p3_normalise_maps", "p6_sku_classes", "p11_priced_usage", "p13_entities", "p15_dimensions", "j1_price_tranches", "a2_cost_daily", "a4_dim_sku", "a6_dim_entity", "a7_job_runs", "a10_job_run_cost", "a11_query_activity", "a13_tag_coverage", "w1_latest_clusters", "w6_kpis", "t5_anomalies", "t5_anomalies_plain", "t6_gap_fill", "t14_forecast", "t11_seasonal_naive", "t12_moving_average", "b6_budget_status", "c3_chargeback", "c3_chargeback_none", "r11_recommendations", "q9_quality_checks", "l11_admitted", "s4_usage_ingest", "s13_upsert", "s16_ingest_window", "v2_tag_inventory", "e14d_outside_validity", "j7_entity_configuration", "j11_warehouse_catalog", "w7_latest_budgets", "t15_budget_with_forecast", "a16_cost_series", "l15_reloaded_alerts", "s17_recorded_marks", "d26_alert_log"]


@pytest.mark.parametrize("name", CHOSEN)
def test_matches_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(map(plain, r)) for r in df.select(*cols).collect())
    rel = duck.sql(registry.ORACLE_SQL[name])
    assert sorted(rel.columns) == cols
    want = sorted(tuple(map(plain, r)) for r in duck.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in cols)} FROM ({registry.ORACLE_SQL[name]})").fetchall())
    assert got == want


def test_untagged_by_resource_is_over_all_days(spark, duck):
    cost, days = defaultdict(float), set()
    for r in model.fact(spark, SF).filter("is_untagged").select("usage_date", "entity_name", "entity_type", "workspace_id", "total_cost_usd").collect():
        cost[r.entity_name, r.entity_type, r.workspace_id] += r.total_cost_usd
        days.add(str(r.usage_date))
    assert min(days) < model.last_days(30)[0] and max(days) > model.last_days(30)[1]
    first = sorted(cost.items(), key=lambda x: (-round(x[1], 6), x[0][0] or "", x[0][1:]))[:50]
    got = registry.QUERIES["d22_untagged_by_resource"](spark, SF).collect()
    assert [tuple(r)[:3] for r in got] == [k for k, _ in first]
    assert [r.cost for r in got] == pytest.approx([v for _, v in first])
    for name in ("d22_untagged_by_resource", "d22_untagged_30_days"):
        test_matches_sql(spark, duck, name)


def test_untagged_by_type_is_over_all_days(spark, duck):
    cost, records, days = defaultdict(lambda: defaultdict(float)), defaultdict(int), set()
    sources = [f"{d}_source" for d in facts.DIMS]
    for r in model.priced(spark, SF).select("usage_date", "entity_type", "entity_id", "workspace_id", "sku_name", "billing_origin_product", "list_cost_usd", *sources).collect():
        if all(r[x] != "usage" for x in sources):
            cost[r.entity_type][r.entity_id, r.workspace_id, r.sku_name, r.billing_origin_product] += r.list_cost_usd
            records[r.entity_type] += 1
            days.add(str(r.usage_date))
    assert min(days) < model.last_days(90)[0] and max(days) > model.last_days(90)[1]
    got = registry.QUERIES["d33_untagged_by_type"](spark, SF).collect()
    assert {r.entity_type: r.records for r in got} == records
    # the view rounds each resource to cents
    assert {r.entity_type: r.cost for r in got} == pytest.approx({t: sum(round(v, 2) for v in c.values()) for t, c in cost.items()}, abs=0.02)
    for name in ("d33_untagged_by_type", "d33_untagged_90_days"):
        test_matches_sql(spark, duck, name)
