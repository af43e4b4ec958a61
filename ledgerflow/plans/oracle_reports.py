"""DuckDB SQL of the report queries."""

from __future__ import annotations

from ledgerflow.plans.oracle_analytics import ADMITTED, FOUND, anomalies, chargeback
from ledgerflow.plans.oracle_analytics import _CHANNEL as CHANNEL
from ledgerflow.plans.oracle_analytics import STATUS
from ledgerflow.plans.oracle_facts import COVERAGE, FACT, HOURS, KPI, PRICED, RUN_COST, RUNS, USAGE, WAREHOUSE_COST, WAREHOUSES, rnd, usd

COST = usd("total_cost_usd")


def since(days: int, as_of: str = "2001-08-01") -> str:
    return f"usage_date BETWEEN DATE '{as_of}' - {days - 1} AND DATE '{as_of}'"


def pct(num: str, den: str, digits: int = 2, empty: str = "NULL") -> str:
    return f"CASE WHEN {den} > 0 THEN {rnd(f'({num} / {den})', digits)} ELSE {empty} END"


def coverage(days: int, keys: str) -> str:
    return f"WITH {COVERAGE}, g AS (SELECT {keys}, {usd('attributed_cost_usd')} AS a, {usd('total_cost_usd')} AS t FROM coverage WHERE {since(days)} GROUP BY ALL) SELECT {keys}, {pct('a * 100', 't')} AS coverage_pct FROM g"


_LINES = chargeback("proportional", "proportional", 0.05)
_JOBS = f"""{PRICED}, {RUN_COST}, {RUNS}, labels AS (SELECT workspace_id, CAST(o_custkey AS VARCHAR) AS job_id, max(team) AS team, max(cost_center) AS cost_center FROM tagged WHERE l_returnflag = 'R' GROUP BY 1, 2),
  jr AS (SELECT coalesce(c_name, r.job_id) AS job, coalesce(team, 'SIN_ASIGNAR') AS team, coalesce(cost_center, 'SIN_ASIGNAR') AS cost_center, is_failed, duration_minutes, coalesce(run_cost_usd, 0) AS cost FROM runs r LEFT JOIN customer ON r.job_id = CAST(c_custkey AS VARCHAR) AND r.workspace_id = CAST(c_nationkey AS VARCHAR)
    LEFT JOIN run_cost k ON r.workspace_id = k.workspace_id AND r.job_id = k.job_id AND r.run_id = k.run_id LEFT JOIN labels l ON r.workspace_id = l.workspace_id AND r.job_id = l.job_id WHERE run_date BETWEEN DATE '2001-08-01' - 29 AND DATE '2001-08-01')"""
_WAREHOUSE = f"""{WAREHOUSE_COST}, {WAREHOUSES}, w AS (SELECT coalesce(warehouse_name, warehouse_id) AS warehouse, warehouse_size, warehouse_type, {COST} AS cost, CAST(sum(query_count) AS BIGINT) AS queries, {rnd(HOURS, 2)} AS hours, max(auto_stop_minutes) AS auto_stop_minutes
  FROM house LEFT JOIN warehouses USING (workspace_id, warehouse_id) WHERE {since(30)} GROUP BY 1, 2, 3)"""
_TAGS = f"""{PRICED}, tags AS (
  SELECT usage_date, total_cost_usd, 'costcenter' AS key, 'cost_center' AS dimension, 'Cost-Center' AS tag_key, CASE WHEN o_custkey % 11 = 0 THEN '  ' ELSE c_mktsegment END AS tag_value FROM tagged WHERE NOT bare
  UNION ALL SELECT usage_date, total_cost_usd, 'equipo', 'team', 'equipo', CASE WHEN s_nationkey % 6 = 0 THEN 'n/a' ELSE 'team-' || (s_nationkey % 4) END FROM tagged WHERE NOT bare
  UNION ALL SELECT usage_date, total_cost_usd, 'env', 'environment', 'ENV', CASE l_linenumber % 4 WHEN 0 THEN 'prod' WHEN 1 THEN 'Desarrollo' WHEN 2 THEN 'staging' ELSE 'lab' END FROM tagged WHERE NOT bare
  UNION ALL SELECT usage_date, total_cost_usd, 'ticket', NULL, CASE WHEN l_linenumber % 2 = 0 THEN 'Ticket' ELSE 'ticket-' END, 'T' || (l_linenumber % 3) FROM tagged WHERE NOT bare)"""
_INVENTORY = f"{_TAGS}, inv AS (SELECT key, dimension, string_agg(DISTINCT tag_key, ',' ORDER BY tag_key) AS spellings, count(DISTINCT tag_value) AS distinct_values, {COST} AS cost FROM tags GROUP BY 1, 2)"
# only a record's own tags resolve a dimension here: cost centre, team and environment, if the record is not bare
_OWN = {"cost_center": "NOT bare AND o_custkey % 11 <> 0", "team": "NOT bare AND s_nationkey % 6 <> 0", "environment": "NOT bare", "project": "false", "application": "false", "owner": "false"}


def untagged(where: str = "true") -> str:
    return f"""{PRICED}, un AS (SELECT entity_type, entity_id, workspace_id, sku_name, billing_origin_product, count(*) AS records, min(usage_date) AS first_seen, max(usage_date) AS last_seen, {rnd(usd("list_cost_usd"), 2)} AS list_cost_usd, CAST(max(CASE WHEN bare THEN 0 ELSE 4 END) AS BIGINT) AS tag_count
  FROM tagged WHERE {where} AND {" AND ".join(f"NOT ({x})" for x in _OWN.values())} GROUP BY 1, 2, 3, 4, 5)"""


_UNTAGGED = untagged(since(90))
_BLOCKS = " UNION ALL ".join(
    f"SELECT usage_date, workspace_id, '{d}' AS dimension, {rnd(usd('list_cost_usd'), 2)} AS total_cost_usd, {rnd(usd(f'CASE WHEN {x} THEN list_cost_usd ELSE 0 END'), 2)} AS attributed_cost_usd, count(DISTINCT CASE WHEN {x} THEN entity_id END) AS attributed_entities, count(DISTINCT entity_id) AS total_entities FROM tagged WHERE {since(90)} GROUP BY 1, 2"
    for d, x in _OWN.items()
)

ORACLE_SQL = {
    "d2_latest_kpi": f"WITH {KPI} SELECT usage_date, total_cost_usd, mtd_cost_usd, {rnd('(coalesce(dod_change, 0) * 100)', 2)} AS dod_pct, {rnd('(coalesce(serverless_ratio, 0) * 100)', 2)} AS serverless_pct FROM kpi ORDER BY usage_date DESC LIMIT 1",
    "d3_daily_cost": f"WITH {KPI} SELECT usage_date, total_cost_usd, avg_7d_usd, avg_28d_usd FROM kpi WHERE {since(90)}",
    "d4_cost_by_team": f"WITH {FACT} SELECT team, {COST} AS cost FROM fact WHERE {since(30)} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15",
    "d6_budget_now": f"WITH {STATUS} SELECT budget_id, scope, status, consumed_pct, projected_pct FROM status",
    "d7_actual_and_forecast": f"""WITH org AS (SELECT CAST(ts AS DATE) AS usage_date, {usd("value")} AS cost FROM events GROUP BY 1), m AS (SELECT avg(cost) AS v, max(usage_date) AS last FROM (SELECT * FROM org ORDER BY usage_date DESC LIMIT 7))
      SELECT usage_date, cost AS amount, 'Real' AS series FROM org WHERE {since(60, '2024-01-30')} UNION ALL SELECT CAST(last + CAST(h AS INT) AS DATE), {rnd("v", 4)}, 'Pronostico' FROM (SELECT v, last, unnest(range(1, 46)) AS h FROM m)""",
    "d8_recent_anomalies": f"WITH {anomalies(True, 'mad', None)} SELECT usage_date, dimension, dim_value, score, severity FROM anomalies WHERE {since(14, '2024-01-30')} ORDER BY usage_date DESC, abs(score) DESC, dimension, dim_value LIMIT 50",
    "d8_severe_anomalies": f"WITH {anomalies(True, 'mad', None)} SELECT usage_date, dimension, dim_value, score, severity FROM anomalies WHERE {since(14, '2024-01-30')} AND severity IN ('high', 'critical') ORDER BY usage_date DESC, abs(score) DESC, dimension, dim_value LIMIT 50",
    "d9_cost_by_entity": f"WITH {FACT} SELECT entity_key, entity_type, team, cost_center, environment, {COST} AS cost FROM fact WHERE {since(30)} GROUP BY ALL ORDER BY cost DESC, entity_key, team, cost_center, environment LIMIT 25",
    "d10_latest_chargeback": f"WITH {_LINES} SELECT year_month, unit, direct_usd, total_usd, pct_of_total FROM lines WHERE year_month = (SELECT max(year_month) FROM lines)",
    "d11_chargeback_year": f"WITH {_LINES} SELECT year_month, unit, total_usd FROM lines WHERE year_month >= '2000-09'",
    "d12_monthly_by_sku": f"WITH {FACT} SELECT year_month, sku_group, {COST} AS cost, sum(usage_quantity) AS dbus FROM fact WHERE usage_date >= DATE '2000-08-01' GROUP BY 1, 2",
    "d13_cost_by_workspace": f"WITH {FACT} SELECT workspace_id, CASE WHEN CAST(workspace_id AS INT) % 4 <> 0 THEN 'NATION_' || workspace_id END AS workspace_name, {COST} AS cost FROM fact WHERE {since(30)} GROUP BY 1",
    "d14_coverage_by_day": coverage(60, "usage_date, dimension"),
    "d15_costly_jobs": f"WITH {_JOBS} SELECT job, team, cost_center, count(*) AS runs, count(*) FILTER (is_failed) AS failures, {rnd('avg(duration_minutes)', 2)} AS avg_minutes, {rnd(usd('cost'), 2)} AS cost, {rnd('(' + usd('cost') + ' / count(*))', 4)} AS cost_per_run FROM jr GROUP BY 1, 2, 3 ORDER BY cost DESC, job, team, cost_center LIMIT 30",
    "d16_warehouses": f"WITH {_WAREHOUSE} SELECT warehouse, warehouse_size, warehouse_type, cost, queries, hours, {pct('cost', 'queries', 4)} AS cost_per_query, auto_stop_minutes FROM w ORDER BY cost DESC, warehouse, warehouse_size, warehouse_type LIMIT 30",
    "d17_detail": f"WITH {FACT} SELECT usage_date, workspace_id, entity_key, sku_name, {COST} AS cost FROM fact WHERE {since(7)} GROUP BY 1, 2, 3, 4 ORDER BY cost DESC, usage_date, workspace_id, entity_key, sku_name LIMIT 500",
    "d18_savings_total": f"""WITH {FOUND} SELECT {usd("savings_usd")} AS savings_usd, {usd("CASE WHEN confidence = 'alta' THEN savings_usd END")} AS high_confidence_usd, count(*) AS findings, count(DISTINCT entity_key) AS entities FROM found""",
    "d20_recommendations": f"WITH {FOUND} SELECT entity_key, workspace_id, rule_id, savings_usd, severity FROM found ORDER BY savings_usd DESC, entity_key, workspace_id, rule_id LIMIT 200",
    "d21_shares": f"WITH {KPI} SELECT usage_date, {rnd('(serverless_ratio * 100)', 2)} AS serverless_pct, {rnd('(all_purpose_ratio * 100)', 2)} AS all_purpose_pct, {rnd('(allocated_ratio * 100)', 2)} AS coverage_pct, cost_per_dbu FROM kpi WHERE {since(90)}",
    "d22_untagged_by_resource": f"WITH {FACT} SELECT entity_name, entity_type, workspace_id, {COST} AS cost FROM fact WHERE is_untagged GROUP BY 1, 2, 3 ORDER BY cost DESC, entity_name NULLS FIRST, entity_type, workspace_id LIMIT 50",
    "d22_untagged_30_days": f"WITH {FACT} SELECT entity_name, entity_type, workspace_id, {COST} AS cost FROM fact WHERE {since(30)} AND is_untagged GROUP BY 1, 2, 3 ORDER BY cost DESC, entity_name NULLS FIRST, entity_type, workspace_id LIMIT 50",
    "d23_unstable_jobs": f"WITH {_JOBS} SELECT job, team, count(*) AS runs, count(*) FILTER (is_failed) AS failures, {rnd('(count(*) FILTER (is_failed) / count(*) * 100)', 1)} AS failure_pct, {rnd(usd('CASE WHEN is_failed THEN cost ELSE 0 END'), 2)} AS failed_cost FROM jr GROUP BY 1, 2 HAVING count(*) FILTER (is_failed) > 0 ORDER BY failed_cost DESC, job, team LIMIT 30",
    "d24_cluster_config": f"""WITH {FACT}, c AS (SELECT entity_id AS cluster_id, {COST} AS cost FROM fact WHERE entity_type = 'CLUSTER' GROUP BY 1),
      g AS (SELECT CAST(user_id AS VARCHAR) AS cluster_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
      SELECT cluster_id, cost, k % 10 AS worker_count, (k % 6 + 11) || '.3.x-scala2.12' AS dbr_version, CASE WHEN k % 5 <> 0 THEN (k * 3) % 200 END AS auto_termination_minutes FROM c LEFT JOIN g USING (cluster_id) ORDER BY cost DESC, cluster_id LIMIT 100""",
    "d25_run_log": "SELECT event_id, ts AS finished_at, event_type AS status FROM events WHERE ts >= TIMESTAMP '2024-01-24' ORDER BY ts DESC, event_id DESC LIMIT 200",
    "d26_alert_log": f"WITH {ADMITTED} SELECT TIMESTAMP '2024-01-31' AS created_at, rule, severity, subject, fingerprint, outcome, CASE WHEN outcome = 'dispatched' THEN array_to_string({CHANNEL}, ',') ELSE '' END AS channels FROM admitted ORDER BY outcome, fingerprint, subject LIMIT 200",
    "d27_coverage_by_dimension": coverage(30, "dimension"),
    "d29_empty_tags": f"WITH {PRICED} SELECT {COST} AS cost, {usd('CASE WHEN bare THEN total_cost_usd END')} AS cost_without_tags, count(DISTINCT entity_key) AS entities FROM tagged",
    "v1_usage_live": f"WITH {PRICED} SELECT record_id, usage_date, entity_type, entity_id, sku_name, unit_price, list_cost_usd FROM tagged WHERE {since(90)}",
    "v2_tag_inventory": f"WITH {_INVENTORY} SELECT * FROM inv",
    "v3_coverage_live": f"WITH {PRICED}, por AS ({_BLOCKS}) SELECT usage_date, workspace_id, dimension, total_cost_usd, attributed_cost_usd, {rnd('(total_cost_usd - attributed_cost_usd)', 2)} AS unattributed_cost_usd, {pct('100.0 * attributed_cost_usd', 'total_cost_usd', 2, '100.0')} AS coverage_pct, attributed_entities, total_entities FROM por",
    "v4_untagged_live": f"WITH {_UNTAGGED} SELECT * FROM un",
    "d31_tag_inventory_top": f"WITH {_INVENTORY} SELECT key, coalesce(dimension, 'NO RECONOCIDA') AS dimension, cost FROM inv ORDER BY cost DESC, key LIMIT 50",
    "d32_unresolved": f"WITH {_UNTAGGED} SELECT entity_type, entity_id, sku_name, billing_origin_product, records, first_seen, last_seen, list_cost_usd FROM un ORDER BY list_cost_usd DESC, entity_type, entity_id NULLS FIRST, workspace_id, sku_name, billing_origin_product NULLS FIRST LIMIT 100",
    "d33_untagged_by_type": f"WITH {untagged()} SELECT entity_type, {rnd(usd('list_cost_usd'), 2)} AS cost, CAST(sum(records) AS BIGINT) AS records FROM un GROUP BY 1",
    "d33_untagged_90_days": f"WITH {_UNTAGGED} SELECT entity_type, {rnd(usd('list_cost_usd'), 2)} AS cost FROM un GROUP BY 1",
    "e1_daily": f"WITH {FACT} SELECT usage_date, {COST} AS cost FROM fact WHERE {since(30)} GROUP BY 1",
    "e2_teams": f"WITH {FACT} SELECT team, cost_center, environment, {COST} AS cost, count(DISTINCT entity_key) AS entities FROM fact WHERE {since(30)} GROUP BY 1, 2, 3 ORDER BY cost DESC, team, cost_center, environment LIMIT 20",
    "e3_one_day": f"WITH {FACT} SELECT sku_group, entity_key, team, {COST} AS cost FROM fact WHERE usage_date = DATE '2001-07-15' GROUP BY 1, 2, 3 ORDER BY cost DESC, sku_group, entity_key, team LIMIT 50",
    "e7_invoice": f"WITH {PRICED} SELECT strftime(usage_date, '%Y-%m') AS year_month, {usd('list_cost_usd')} AS list_usd, {usd('discount_usd')} AS discount_usd, {usd('effective_cost_usd')} AS effective_usd FROM tagged GROUP BY 1",
    "e8_attribution": f"WITH {PRICED} SELECT project, project_source, count(*) AS records, {COST} AS cost FROM tagged GROUP BY 1, 2",
    "e10_values_of_key": f"WITH {_TAGS} SELECT tag_value, count(*) AS records FROM tags WHERE key = 'equipo' GROUP BY 1",
    "e11_unknown_keys": f"WITH {_TAGS} SELECT tag_key, count(*) AS records FROM tags WHERE dimension IS NULL GROUP BY 1",
    "e9_tag_keys": f"WITH {_TAGS} SELECT key, dimension, string_agg(DISTINCT tag_key, ',' ORDER BY tag_key) AS spellings, count(DISTINCT tag_value) AS distinct_values, {usd(f'CASE WHEN {since(30)} THEN total_cost_usd END')} AS cost_30_days FROM tags GROUP BY 1, 2",
    "d30_unknown_keys_top": f"WITH {_TAGS} SELECT key, count(*) AS records, {COST} AS cost FROM tags WHERE dimension IS NULL GROUP BY 1 ORDER BY cost DESC, key LIMIT 30",
    "e13_empty_tag_share": f"WITH {USAGE} SELECT count(*) AS records, count(*) FILTER (bare) AS without_tags, {rnd('(count(*) FILTER (bare) * 100.0 / count(*))', 4)} AS without_tags_pct FROM usage",
    "e14e_copy_against_source": f"WITH {PRICED} SELECT 'copy' AS side, count(*) AS tranches, count(DISTINCT sku) AS skus FROM prices UNION ALL SELECT 'source', count(*), count(DISTINCT sku) FROM prices UNION ALL SELECT 'usage', count(*), count(DISTINCT sku_name) FROM usage",
    "e15c_sample": f"WITH {FACT} SELECT usage_date, sku_group, entity_type, team, cost_center, {COST} AS cost, CAST(sum(record_count) AS BIGINT) AS records FROM fact WHERE {since(30)} GROUP BY 1, 2, 3, 4, 5 ORDER BY cost DESC, usage_date, sku_group, entity_type, team, cost_center LIMIT 50",
    "e12_keys_by_resource": "SELECT 'CLUSTER' AS resource, 'Owner' AS k, count(DISTINCT CAST(json_extract(props, '$.k') AS INTEGER) % 5) AS values FROM events UNION ALL SELECT 'JOB', 'Proyecto', count(DISTINCT c_custkey % 3) FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT 'WAREHOUSE', 'Team', count(DISTINCT (s_suppkey + n) % 3) FROM supplier, (VALUES (0), (1)) v(n)",
    "e14b_unpriced_share": f"WITH {PRICED} SELECT count(*) AS records, count(*) FILTER (price_missing) AS unpriced, {rnd('(count(*) FILTER (price_missing) * 100.0 / count(*))', 4)} AS unpriced_pct, {rnd('(sum(CASE WHEN price_missing THEN usage_quantity ELSE 0 END) * 100 / sum(usage_quantity))', 4)} AS quantity_pct FROM tagged",
    "e14c_unpriced_in_list": f"WITH {PRICED} SELECT sku_name, coalesce(tranches, 0) AS tranches, coalesce(clouds, '') AS clouds FROM (SELECT DISTINCT sku_name FROM tagged WHERE price_missing) LEFT JOIN (SELECT sku AS sku_name, string_agg(DISTINCT cloud, ',' ORDER BY cloud) AS clouds, count(*) AS tranches FROM prices GROUP BY 1) USING (sku_name)",
    "e14d_outside_validity": f"WITH {PRICED}, p AS (SELECT sku_name, min(usage_date) AS first_use, max(usage_date) AS last_use FROM tagged WHERE price_missing GROUP BY 1), v AS (SELECT sku AS sku_name, CAST(min(a) AS DATE) AS valid_from, CAST(max(coalesce(b, TIMESTAMP '9999-12-31')) AS DATE) AS valid_to FROM prices GROUP BY 1) SELECT * FROM p JOIN v USING (sku_name) WHERE first_use < valid_from OR last_use >= valid_to",
    "e14f_missing_skus": f"WITH {PRICED} SELECT DISTINCT sku_name FROM usage EXCEPT SELECT sku FROM prices",
    "e15a_freshness": "SELECT 'lineitem' AS table_name, count(*) AS rows, min(CAST(l_shipdate AS DATE)) AS first_day, max(CAST(l_shipdate AS DATE)) AS last_day FROM lineitem UNION ALL SELECT 'orders', count(*), min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)) FROM orders UNION ALL SELECT 'events', count(*), min(CAST(ts AS DATE)), max(CAST(ts AS DATE)) FROM events",
    "e15b_lag": f"WITH {FACT} SELECT CAST(date_diff('day', max(usage_date), DATE '2001-12-01') AS INT) AS lag_days, count(*) FILTER ({since(30)}) AS recent_rows FROM fact",
    "e16_month_by_team": f"WITH {FACT} SELECT team, {COST} AS cost FROM fact WHERE year_month = '2001-07' GROUP BY 1",
    "e17_job_averages": f"WITH {PRICED}, {RUN_COST}, {RUNS} SELECT job_id, count(*) AS runs, {rnd('(' + usd('run_cost_usd') + ' / count(*))', 4)} AS avg_cost, {rnd('avg(duration_minutes)', 4)} AS avg_minutes FROM runs JOIN run_cost USING (workspace_id, job_id, run_id) GROUP BY 1",
    "e18_no_owner": f"WITH {FACT} SELECT workspace_id, {COST} AS cost, count(DISTINCT entity_key) AS entities FROM fact WHERE owner = 'SIN_ASIGNAR' GROUP BY 1",
}
