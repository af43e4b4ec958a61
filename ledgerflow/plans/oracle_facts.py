"""DuckDB SQL of the fact queries, written apart from the DataFrame code."""

from __future__ import annotations

USAGE = """
usage AS (
  SELECT row_number() OVER () AS rid, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS record_id, 'acct-1' AS account_id,
    CAST(CASE WHEN l_returnflag = 'R' THEN c_nationkey ELSE s_nationkey END AS VARCHAR) AS workspace_id, CASE s_nationkey % 3 WHEN 0 THEN 'AZURE' WHEN 1 THEN 'AWS' ELSE 'GCP' END AS cloud,
    CASE p_type WHEN 'ECONOMY' THEN 'PREMIUM_JOBS_COMPUTE_(PHOTON)' WHEN 'LARGE' THEN 'PREMIUM_SQL_PRO_COMPUTE_US_EAST'
      WHEN 'MEDIUM' THEN 'PREMIUM_SERVERLESS_SQL_COMPUTE' WHEN 'PROMO' THEN 'PREMIUM_ALL_PURPOSE_COMPUTE'
      WHEN 'SMALL' THEN 'ENTERPRISE_DLT_CORE_COMPUTE' ELSE 'UNKNOWN_ADDON' END AS sku_name,
    CASE p_size % 7 WHEN 0 THEN 'JOBS' WHEN 1 THEN 'SQL' END AS product,
    CAST(l_shipdate AS DATE) AS usage_date, l_shipdate + INTERVAL 1 HOUR AS usage_end_time, l_quantity AS usage_quantity,
    l_returnflag, o_custkey, l_orderkey, l_suppkey, l_partkey, l_linenumber, s_nationkey, c_mktsegment, c_name, 'DBU' AS usage_unit,
    o_custkey % 13 = 0 AS bare, CASE WHEN l_linenumber = 1 THEN 'user-' || (o_custkey % 9) END AS run_as
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey)"""

PRICED = (
    USAGE
    + """,
prices(sku, cloud, a, b, price) AS (VALUES
  ('PREMIUM_JOBS_COMPUTE_(PHOTON)', '', TIMESTAMP '1994-01-01', TIMESTAMP '1998-01-01', 0.15::DOUBLE),
  ('PREMIUM_JOBS_COMPUTE_(PHOTON)', '', TIMESTAMP '1998-01-01', TIMESTAMP '2000-06-01', 0.18),
  ('PREMIUM_JOBS_COMPUTE_(PHOTON)', '', TIMESTAMP '1999-01-01', NULL, 0.22),
  ('PREMIUM_SQL_PRO_COMPUTE_US_EAST', 'AWS', TIMESTAMP '1994-01-01', NULL, 0.55),
  ('PREMIUM_SQL_PRO_COMPUTE_US_EAST', 'AZURE', TIMESTAMP '1994-01-01', NULL, 0.60),
  ('PREMIUM_SERVERLESS_SQL_COMPUTE', '', TIMESTAMP '1994-01-01', TIMESTAMP '1997-01-01', 0.70),
  ('PREMIUM_SERVERLESS_SQL_COMPUTE', '', TIMESTAMP '1997-01-01', TIMESTAMP '2001-01-01', 0.72),
  ('PREMIUM_SERVERLESS_SQL_COMPUTE', '', TIMESTAMP '2001-01-01', NULL, 0.80),
  ('PREMIUM_ALL_PURPOSE_COMPUTE', '', TIMESTAMP '1994-01-01', TIMESTAMP '1998-06-01', 0.40),
  ('PREMIUM_ALL_PURPOSE_COMPUTE', '', TIMESTAMP '1998-06-01', TIMESTAMP '2001-09-01', 0.50),
  ('ENTERPRISE_DLT_CORE_COMPUTE', '', TIMESTAMP '1994-01-01', NULL, 0.30)),
tranche AS (
  SELECT u.*, p.price AS unit_price, p.a AS price_start_time FROM usage u LEFT JOIN prices p
    ON u.sku_name = p.sku AND (p.cloud = '' OR p.cloud = u.cloud) AND u.usage_end_time >= p.a AND (p.b IS NULL OR u.usage_end_time < p.b)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY p.a DESC NULLS LAST) = 1),
classed AS (
  SELECT *, CASE WHEN product IN ('JOBS', 'SQL') THEN CASE WHEN sku_name LIKE '%SERVERLESS%' THEN 'SERVERLESS_' || product ELSE product END
      WHEN sku_name = 'PREMIUM_JOBS_COMPUTE_(PHOTON)' THEN 'JOBS' WHEN sku_name LIKE 'PREMIUM_SQL%' THEN 'SQL'
      WHEN sku_name LIKE '%SERVERLESS%' THEN 'SERVERLESS_SQL' WHEN sku_name LIKE '%ALL_PURPOSE%' THEN 'ALL_PURPOSE'
      WHEN sku_name LIKE '%DLT%' THEN 'DLT' ELSE 'OTHER' END AS sku_group,
    sku_name LIKE '%SERVERLESS%' AS is_serverless, sku_name LIKE '%PHOTON%' AS is_photon, unit_price IS NULL AS price_missing,
    CASE WHEN sku_name LIKE '%SQL%' AND cloud IN ('AWS', 'GCP') THEN 'sql-aws' WHEN product = 'JOBS' THEN 'jobs'
      WHEN sku_name LIKE 'PREMIUM\\_%' ESCAPE '\\' THEN 'all' ELSE 'sin_descuento' END AS discount_rule,
    round(usage_quantity * coalesce(unit_price, 0), 6) AS list_cost_usd
  FROM tranche),
discounted AS (
  SELECT *, CASE WHEN sku_group LIKE 'SERVERLESS%' THEN 'SERVERLESS' WHEN sku_group IN ('ALL_PURPOSE', 'JOBS', 'DLT', 'SQL') THEN sku_group ELSE 'OTHER' END AS compute_family,
    CASE discount_rule WHEN 'sql-aws' THEN 0.25::DOUBLE WHEN 'jobs' THEN 0.10 WHEN 'all' THEN 0.05 ELSE 0.0 END AS discount_pct FROM classed),
effective AS (SELECT *, round(list_cost_usd * discount_pct, 6) AS discount_usd, round(list_cost_usd - round(list_cost_usd * discount_pct, 6), 6) AS effective_cost_usd FROM discounted),
costed AS (
  SELECT *, round(effective_cost_usd * CASE compute_family WHEN 'ALL_PURPOSE' THEN 0.85::DOUBLE WHEN 'JOBS' THEN 0.85 WHEN 'DLT' THEN 0.70 WHEN 'SQL' THEN 0.60 WHEN 'SERVERLESS' THEN 0.0 ELSE 0.60 END, 6) AS infra_cost_usd FROM effective),
latest_cluster AS (
  SELECT CAST(user_id AS VARCHAR) AS cluster_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, event_type FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
priced AS (
  SELECT c.* EXCLUDE (product), product AS billing_origin_product, round(effective_cost_usd + infra_cost_usd, 6) AS total_cost_usd,
    CASE WHEN l_returnflag = 'R' THEN 'JOB' WHEN l_returnflag = 'A' THEN 'WAREHOUSE' WHEN l_partkey % 10 <> 0 THEN 'CLUSTER' ELSE 'UNKNOWN' END AS entity_type,
    CASE WHEN l_returnflag = 'R' THEN CAST(o_custkey AS VARCHAR) WHEN l_returnflag = 'A' THEN CAST(l_suppkey AS VARCHAR) WHEN l_partkey % 10 <> 0 THEN CAST(l_partkey % 150 AS VARCHAR) END AS entity_id,
    CASE WHEN bare OR o_custkey % 11 = 0 THEN 'SIN_ASIGNAR' ELSE c_mktsegment END AS cost_center,
    CASE WHEN bare OR o_custkey % 11 = 0 THEN 'none' ELSE 'usage' END AS cost_center_source,
    CASE WHEN bare OR s_nationkey % 6 = 0 THEN 'SIN_ASIGNAR' ELSE 'team-' || (s_nationkey % 4) END AS team,
    CASE WHEN bare OR s_nationkey % 6 = 0 THEN 'none' ELSE 'usage' END AS team_source,
    CASE WHEN l_returnflag = 'R' AND o_custkey % 2 = 0 THEN 'proj-' || (o_custkey % 3) WHEN workspace_id = '3' THEN 'core' ELSE 'SIN_ASIGNAR' END AS project,
    CASE WHEN l_returnflag = 'R' AND o_custkey % 2 = 0 THEN 'job' WHEN workspace_id = '3' THEN 'workspace' ELSE 'none' END AS project_source,
    CASE WHEN bare THEN 'SIN_ASIGNAR' WHEN l_linenumber % 4 = 0 THEN 'PRD' WHEN l_linenumber % 4 = 1 THEN 'DEV' WHEN l_linenumber % 4 = 2 THEN 'QA' ELSE 'lab' END AS environment, CASE WHEN bare THEN 'none' ELSE 'usage' END AS environment_source,
    CASE WHEN workspace_id = '7' THEN 'billing' ELSE 'SIN_ASIGNAR' END AS application, CASE WHEN workspace_id = '7' THEN 'workspace' ELSE 'none' END AS application_source,
    CASE WHEN l_returnflag = 'N' AND l_partkey % 10 <> 0 AND lc.k IS NOT NULL THEN 'own-' || (lc.k % 5) ELSE 'SIN_ASIGNAR' END AS owner,
    CASE WHEN l_returnflag = 'N' AND l_partkey % 10 <> 0 AND lc.k IS NOT NULL THEN 'cluster' ELSE 'none' END AS owner_source,
    CASE WHEN l_returnflag = 'R' THEN c_name WHEN l_returnflag = 'N' AND l_partkey % 10 <> 0 AND lc.k IS NOT NULL THEN 'cluster-' || lc.cluster_id
      WHEN l_returnflag = 'N' AND l_partkey % 10 = 0 THEN NULL WHEN l_returnflag = 'A' THEN CAST(l_suppkey AS VARCHAR) ELSE CAST(l_partkey % 150 AS VARCHAR) END AS entity_name,
    coalesce(run_as, CASE WHEN l_returnflag = 'R' AND o_custkey % 3 <> 0 THEN 'svc-' || (o_custkey % 4) END, 'admin-' || (lc.k % 3)) AS owner_resolved
  FROM costed c LEFT JOIN latest_cluster lc ON l_returnflag = 'N' AND l_partkey % 10 <> 0 AND lc.cluster_id = CAST(l_partkey % 150 AS VARCHAR)),
tagged AS (SELECT *, entity_type || ':' || coalesce(entity_id, 'SIN_ID') AS entity_key,
    (cost_center_source <> 'none')::INT + (team_source <> 'none')::INT + (project_source <> 'none')::INT + (environment_source <> 'none')::INT + (application_source <> 'none')::INT + (owner_source <> 'none')::INT AS tags_resolved FROM priced)"""
)


def rnd(expr: str, digits: int) -> str:
    return f"round({expr} + sign({expr}) * 1e-9, {digits})"


def usd(expr: str) -> str:
    return f"CAST(sum(CAST(coalesce({expr}, 0) AS DECIMAL(20,6))) AS DOUBLE)"


DIMS = "cost_center, team, project, environment, application, owner"
_MEASURES = ("list_cost_usd", "discount_usd", "effective_cost_usd", "infra_cost_usd", "total_cost_usd")
_SUMS = ", ".join(f"{usd(m)} AS {m}" for m in _MEASURES)
FACT = (
    PRICED
    + f""",
fact AS (
  SELECT usage_date, account_id, workspace_id, cloud, sku_name, sku_group, compute_family, is_serverless, entity_type, entity_id, entity_key, {DIMS}, {_SUMS},
    sum(usage_quantity) AS usage_quantity, max(usage_unit) AS usage_unit, max(entity_name) AS entity_name, max(owner_resolved) AS owner_resolved, count(*) AS record_count, count(*) FILTER (price_missing) AS records_without_price,
    bool_or(tags_resolved = 0) AS is_untagged, bool_or(tags_resolved = 6) AS is_fully_tagged, bool_or(is_photon) AS is_photon, strftime(usage_date, '%Y-%m') AS year_month
  FROM tagged GROUP BY ALL)"""
)
_COVERAGE = "UNION ALL".join(f" SELECT usage_date, workspace_id, entity_key, total_cost_usd, '{d}' AS dimension, {d} AS value FROM fact " for d in DIMS.split(", "))
COVERAGE = (
    FACT
    + f""", long AS ({_COVERAGE}),
cov AS (SELECT usage_date, workspace_id, dimension, {usd("total_cost_usd")} AS total_cost_usd, {usd("CASE WHEN value <> 'SIN_ASIGNAR' THEN total_cost_usd END")} AS attributed_cost_usd,
  count(DISTINCT entity_key) AS entities, count(DISTINCT CASE WHEN value <> 'SIN_ASIGNAR' THEN entity_key END) AS attributed_entities FROM long GROUP BY ALL),
coverage AS (SELECT *, round(total_cost_usd - attributed_cost_usd, 6) AS unattributed_cost_usd, CASE WHEN total_cost_usd > 0 THEN {rnd("attributed_cost_usd / total_cost_usd", 6)} ELSE 1.0 END AS coverage_ratio FROM cov)"""
)
KPI = (
    FACT
    + f""", base AS (SELECT usage_date, {usd("total_cost_usd")} AS total_cost_usd, {usd("list_cost_usd")} AS list_cost_usd, {usd("discount_usd")} AS discount_usd,
  sum(usage_quantity) AS dbus, count(DISTINCT entity_key) AS entities, count(DISTINCT workspace_id) AS workspaces,
  {usd("CASE WHEN sku_group = 'ALL_PURPOSE' THEN total_cost_usd END")} AS all_purpose_cost_usd, {usd("CASE WHEN compute_family = 'SERVERLESS' THEN total_cost_usd END")} AS serverless_cost_usd,
  {usd("CASE WHEN is_photon THEN total_cost_usd END")} AS photon_cost_usd, {usd("CASE WHEN cost_center = 'SIN_ASIGNAR' THEN total_cost_usd END")} AS unallocated_cost_usd FROM fact GROUP BY 1),
lagged AS (SELECT *, lag(total_cost_usd, 1) OVER d AS l1, lag(total_cost_usd, 7) OVER d AS l7,
  CAST(sum(CAST(total_cost_usd AS DECIMAL(20,6))) OVER (d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DOUBLE) / count(*) OVER (d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS m7,
  CAST(sum(CAST(total_cost_usd AS DECIMAL(20,6))) OVER (d ROWS BETWEEN 27 PRECEDING AND CURRENT ROW) AS DOUBLE) / count(*) OVER (d ROWS BETWEEN 27 PRECEDING AND CURRENT ROW) AS m28,
  CAST(sum(CAST(total_cost_usd AS DECIMAL(20,6))) OVER (PARTITION BY date_trunc('month', usage_date) ORDER BY usage_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS mtd_cost_usd
  FROM base WINDOW d AS (ORDER BY usage_date)),
kpi AS (SELECT * EXCLUDE (l1, l7, m7, m28), CASE WHEN l1 > 0 THEN {rnd("(total_cost_usd - l1) / l1", 4)} END AS dod_change, CASE WHEN l7 > 0 THEN {rnd("(total_cost_usd - l7) / l7", 4)} END AS wow_change,
  {rnd("m7", 4)} AS avg_7d_usd, {rnd("m28", 4)} AS avg_28d_usd,
  CASE WHEN total_cost_usd > 0 THEN {rnd("serverless_cost_usd / total_cost_usd", 4)} END AS serverless_ratio, CASE WHEN total_cost_usd > 0 THEN {rnd("all_purpose_cost_usd / total_cost_usd", 4)} END AS all_purpose_ratio,
  CASE WHEN total_cost_usd > 0 THEN {rnd("photon_cost_usd / total_cost_usd", 4)} END AS photon_ratio, CASE WHEN total_cost_usd > 0 THEN {rnd("(total_cost_usd - unallocated_cost_usd) / total_cost_usd", 4)} ELSE 1.0 END AS allocated_ratio,
  CASE WHEN dbus > 0 THEN {rnd("total_cost_usd / dbus", 4)} END AS cost_per_dbu FROM lagged)"""
)
RUNS = """
periods AS (SELECT CAST(c_nationkey AS VARCHAR) AS workspace_id, CAST(o_custkey AS VARCHAR) AS job_id, CAST(o_orderkey AS VARCHAR) AS run_id, n, o_orderdate + to_minutes(n * 60) AS a, o_orderdate + to_minutes(n * 60) + to_minutes(o_custkey % 50 + 1) AS b,
  CASE WHEN n = o_orderkey % 3 THEN CASE WHEN o_orderstatus = 'F' THEN 'FAILED' WHEN o_orderkey % 17 = 0 THEN 'CANCELED' ELSE 'SUCCEEDED' END END AS result_state
  FROM (SELECT *, unnest(range(0, o_orderkey % 3 + 1)) AS n FROM orders JOIN customer ON o_custkey = c_custkey)),
runs AS (SELECT workspace_id, job_id, run_id, CAST(min(a) AS DATE) AS run_date, max(result_state) AS result_state, max(result_state) = 'FAILED' AS is_failed, max(result_state) = 'SUCCEEDED' AS is_success,
  max(result_state) = 'CANCELED' AS is_cancelled, round(date_diff('second', min(a), max(b)) / 60.0, 4) AS duration_minutes, 'c' || arg_min(n, a) AS first_compute_id FROM periods GROUP BY 1, 2, 3)"""
ACTIVITY = f"""
queries AS (SELECT CAST(event_id AS VARCHAR) AS statement_id, ts - INTERVAL 8218 DAY AS start_time, CAST(s_nationkey AS VARCHAR) AS workspace_id, CAST(user_id % 20 AS VARCHAR) AS warehouse_id, 'user-' || (user_id % 7) AS executed_by,
  CASE WHEN event_type <> 'error' THEN 'FINISHED' WHEN user_id % 2 = 0 THEN 'FAILED' ELSE 'query_failed' END AS execution_status, CAST(round(value * 100) AS BIGINT) AS total_duration_ms,
  CASE WHEN event_id % 5 <> 0 THEN event_id % 1000 END AS waiting_ms, CASE WHEN event_id % 7 <> 0 THEN event_id * 10 END AS read_bytes, event_id % 91 AS produced_rows FROM events LEFT JOIN supplier ON s_suppkey = user_id % 20),
activity AS (SELECT CAST(start_time AS DATE) AS query_date, workspace_id, warehouse_id, executed_by, count(*) AS query_count, CAST(sum(coalesce(total_duration_ms, 0)) AS BIGINT) AS total_ms, CAST(sum(coalesce(waiting_ms, 0)) AS BIGINT) AS queue_ms,
  CAST(sum(coalesce(read_bytes, 0)) AS BIGINT) AS read_bytes, CAST(sum(coalesce(produced_rows, 0)) AS BIGINT) AS produced_rows, round(avg(total_duration_ms), 4) AS avg_ms, round(quantile_cont(CAST(total_duration_ms AS DOUBLE), 0.95), 4) AS p95_ms,
  count(*) FILTER (contains(upper(coalesce(execution_status, '')), 'FAIL')) AS failed_queries, count(DISTINCT statement_id) AS distinct_statements, {rnd("(sum(coalesce(total_duration_ms, 0)) / 3600000.0)", 4)} AS active_hours FROM queries GROUP BY 1, 2, 3, 4)"""
CLUSTERS = """
clusters AS (SELECT CAST(user_id % 25 AS VARCHAR) AS workspace_id, CAST(user_id AS VARCHAR) AS cluster_id, k, k % 10 AS worker_count, CASE WHEN k % 3 = 0 THEN k % 4 END AS min_autoscale_workers, CASE WHEN k % 3 = 0 THEN k % 8 END AS max_autoscale_workers, k % 3 = 0 AND k % 8 > k % 4 AS is_autoscale,
  k % 10 = 0 AND NOT (k % 3 = 0 AND k % 8 > k % 4) AS is_single_node, event_type = 'error' AS is_deleted, CASE WHEN k % 5 <> 0 THEN (k * 3) % 200 END AS auto_termination_minutes, (k % 6 + 11) || '.3.x-scala2.12' AS dbr_version,
  'driver-' || (k % 3) AS driver_node_type, 'worker-' || (k % 4) AS worker_node_type, CASE WHEN k % 2 = 0 THEN 'UI' ELSE 'JOB' END AS cluster_source, CASE WHEN k % 7 = 0 THEN 'policy-' || k END AS policy_id
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1))"""
CLUSTER_CONFIG = "worker_count, min_autoscale_workers, max_autoscale_workers, is_autoscale, is_single_node, auto_termination_minutes, dbr_version, driver_node_type, worker_node_type, cluster_source, policy_id"
WAREHOUSES = """
warehouses AS (SELECT CAST(s_nationkey AS VARCHAR) AS workspace_id, CAST(s_suppkey AS VARCHAR) AS warehouse_id, s_name AS warehouse_name, CASE (s_suppkey + 1) % 3 WHEN 0 THEN 'Small' WHEN 1 THEN 'Medium' ELSE 'Large' END AS warehouse_size,
  CASE (s_suppkey + 1) % 3 WHEN 0 THEN 'PRO' WHEN 1 THEN 'CLASSIC' ELSE 'pro_serverless' END AS warehouse_type, CAST((s_suppkey + 1) % 4 * 10 AS INT) AS auto_stop_minutes, CAST((s_suppkey + 1) % 2 + 1 AS INT) AS min_clusters, CAST((s_suppkey + 1) % 5 + 2 AS INT) AS max_clusters,
  s_suppkey % 9 = 0 AS is_deleted, (s_suppkey + 1) % 3 = 2 AS is_serverless FROM supplier)"""
CONFIG = "warehouse_size, warehouse_type, auto_stop_minutes, min_clusters, max_clusters"
RUN_COST = f"run_cost AS (SELECT workspace_id, entity_id AS job_id, CAST(l_orderkey AS VARCHAR) AS run_id, {usd('total_cost_usd')} AS run_cost_usd, sum(usage_quantity) AS dbus FROM tagged WHERE entity_type = 'JOB' GROUP BY 1, 2, 3)"

HOURS = "CAST(sum(CAST(active_hours AS DECIMAL(20,4))) AS DOUBLE)"
WAREHOUSE_COST = f"""{PRICED}, {ACTIVITY}, c AS (SELECT usage_date, workspace_id, CAST(l_suppkey AS VARCHAR) AS warehouse_id, {DIMS}, {_SUMS}, sum(usage_quantity) AS usage_quantity, max(sku_group) AS sku_group, max(is_serverless) AS is_serverless FROM tagged WHERE l_returnflag = 'A' GROUP BY ALL),
q AS (SELECT query_date AS usage_date, workspace_id, warehouse_id, CAST(sum(query_count) AS BIGINT) AS query_count, CAST(sum(failed_queries) AS BIGINT) AS failed_queries, count(DISTINCT executed_by) AS distinct_users, {rnd(HOURS, 4)} AS active_hours,
  {rnd("avg(avg_ms)", 4)} AS avg_ms, CAST(sum(read_bytes) AS BIGINT) AS read_bytes FROM activity GROUP BY 1, 2, 3),
house AS (SELECT *, CASE WHEN query_count > 0 THEN {rnd("total_cost_usd / query_count", 6)} END AS cost_per_query, 'WAREHOUSE:' || warehouse_id AS entity_key FROM c LEFT JOIN q USING (usage_date, workspace_id, warehouse_id))"""

ORACLE_SQL = {
    "p1_normalise_keys": """SELECT p_partkey, regexp_replace(lower(p_brand || '_' || p_name), '[^a-z0-9]', '', 'g') AS key, CASE WHEN p_size % 5 IN (0, 1) THEN NULL ELSE p_type END AS value FROM part""",
    "p3_normalise_maps": """SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN 'cc' || (c_custkey % 5) ELSE c_mktsegment END AS costcenter,
      CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'prod' END AS env, CAST(CASE WHEN c_custkey % 7 = 0 THEN 0 ELSE 2 END AS BIGINT) AS n_keys FROM customer""",
    "p6_sku_classes": f"WITH {PRICED} SELECT sku_name, billing_origin_product, sku_group, compute_family, is_serverless, is_photon, count(*) AS records FROM tagged GROUP BY ALL",
    "p11_priced_usage": f"WITH {PRICED} SELECT record_id, unit_price, price_missing, discount_pct, discount_rule, {', '.join(_MEASURES)} FROM tagged",
    "p13_entities": f"WITH {PRICED} SELECT record_id, entity_type, entity_id, entity_key, entity_name FROM tagged",
    "p15_dimensions": f"WITH {PRICED} SELECT record_id, {DIMS}, {', '.join(d + '_source' for d in DIMS.split(', '))}, tags_resolved, tags_resolved = 6 AS is_fully_tagged, tags_resolved = 0 AS is_untagged FROM tagged",
    "p9_many_discounts": f"""WITH {PRICED}, rules AS (SELECT i, CAST(i % 40 AS VARCHAR) AS ws, ['premium#_%', '%sql%', 'enterprise#_dlt#_core#_compute', '%compute'][i % 4 + 1] AS sku, (i % 97) || '%' AS e1, '_' || (i % 10) AS e2, i % 50 / 100 AS pct FROM (SELECT unnest(range(1000)) AS i)),
      best AS (SELECT rid, min(i) AS i FROM tagged t JOIN rules r ON t.workspace_id = ws AND lower(t.sku_name) LIKE sku ESCAPE '#' AND (t.entity_id LIKE e1 OR t.entity_id LIKE e2) GROUP BY 1)
      SELECT record_id, CASE WHEN b.i IS NULL THEN 'sin_descuento' ELSE 'rule-' || b.i END AS discount_rule, coalesce(r.pct, 0.0) AS discount_pct, round(list_cost_usd * coalesce(r.pct, 0.0), 6) AS discount_usd FROM tagged LEFT JOIN best b USING (rid) LEFT JOIN rules r ON r.i = b.i""",
    "j1_many_tranches": f"""WITH {USAGE}, p AS (SELECT ['PREMIUM_JOBS_COMPUTE_(PHOTON)', 'PREMIUM_SQL_PRO_COMPUTE_US_EAST', 'ENTERPRISE_DLT_CORE_COMPUTE'][o_orderkey % 3 + 1] AS sku, ['', 'AWS', 'AZURE', 'GCP'][o_orderkey % 4 + 1] AS pc, o_orderdate + to_seconds(o_orderkey % 86400) AS a,
      CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate + to_seconds(o_orderkey % 86400) + to_hours(CAST(o_orderkey % 400 + 1 AS INT)) END AS b, o_orderkey % 100000 / 1e5 AS price FROM orders)
      SELECT record_id, sku_name, cloud, a AS price_start_time, price AS unit_price FROM usage LEFT JOIN p ON sku_name = sku AND (pc = '' OR pc = cloud) AND usage_end_time >= a AND (b IS NULL OR usage_end_time < b)
      QUALIFY row_number() OVER (PARTITION BY rid ORDER BY a DESC NULLS LAST, pc DESC, b DESC NULLS LAST, price DESC) = 1""",
    "j1_price_tranches": f"WITH {PRICED} SELECT sku_name, cloud, price_start_time, unit_price, count(*) AS records, sum(usage_quantity) AS quantity FROM tranche GROUP BY ALL",
    "a2_cost_daily": f"WITH {FACT} SELECT * FROM fact",
    "a3_cost_monthly": f"WITH {FACT} SELECT year_month, account_id, workspace_id, sku_group, compute_family, entity_type, {DIMS}, {_SUMS}, sum(usage_quantity) AS usage_quantity, count(DISTINCT entity_key) AS distinct_entities, count(DISTINCT usage_date) AS active_days, CAST(date_trunc('month', min(usage_date)) AS DATE) AS month_start FROM fact GROUP BY ALL",
    "d1_dim_date": """SELECT d AS date_key, CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month, CAST(day(d) AS INT) AS day, CAST(weekofyear(d) AS INT) AS week_of_year, CAST(dayofweek(d) + 1 AS INT) AS day_of_week,
      strftime(d, '%Y-%m') AS year_month, dayofweek(d) IN (0, 6) AS is_weekend, CAST(date_trunc('month', d) AS DATE) AS month_start, last_day(d) AS month_end, d = last_day(d) AS is_month_end, d > DATE '2001-08-01' AS is_future
      FROM (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM (SELECT min(CAST(l_shipdate AS DATE)) AS a, max(CAST(l_shipdate AS DATE)) + 90 AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey))""",
    "a4_dim_sku": f"WITH {PRICED} SELECT sku_name, cloud, max(sku_group) AS sku_group, max(unit_price) AS max_unit_price, arg_max(unit_price, usage_end_time) FILTER (unit_price IS NOT NULL) AS latest_unit_price, min(usage_date) AS first_seen, max(usage_date) AS last_seen, {usd('total_cost_usd')} AS lifetime_cost_usd FROM tagged GROUP BY 1, 2",
    "a5_dim_workspace": f"WITH {FACT} SELECT workspace_id, CASE WHEN CAST(workspace_id AS INT) % 4 <> 0 THEN 'NATION_' || workspace_id ELSE 'ws-' || workspace_id END AS workspace_name, min(usage_date) AS first_seen, max(usage_date) AS last_seen, {usd('total_cost_usd')} AS lifetime_cost_usd FROM fact GROUP BY 1, 2",
    "a6_dim_entity": f"WITH {FACT} SELECT entity_key, workspace_id, max(entity_type) AS entity_type, max(entity_name) AS entity_name, max(owner_resolved) AS owner_resolved, max(sku_group) AS primary_sku_group, max(is_serverless) AS is_serverless, max(is_photon) AS is_photon, {', '.join(f'max({d}) AS {d}' for d in DIMS.split(', '))}, count(DISTINCT usage_date) AS active_days, min(usage_date) AS first_seen, max(usage_date) AS last_seen, {usd('total_cost_usd')} AS lifetime_cost_usd, CAST(date_diff('day', max(usage_date), DATE '2001-08-01') AS INT) AS days_since_activity FROM fact GROUP BY 1, 2",
    "a7_job_runs": f"WITH {RUNS} SELECT * FROM runs",
    "j5_named_runs": f"WITH {RUNS} SELECT workspace_id, job_id, run_id, c_name AS job_name, CASE WHEN c_custkey % 3 <> 0 THEN 'svc-' || (c_custkey % 4) END AS job_run_as, duration_minutes FROM runs LEFT JOIN customer ON job_id = CAST(c_custkey AS VARCHAR) AND workspace_id = CAST(c_nationkey AS VARCHAR)",
    "a8_run_cost": f"WITH {PRICED}, {RUN_COST} SELECT * FROM run_cost",
    "a10_job_run_cost": f"""WITH {PRICED}, {RUN_COST}, {RUNS}, jt AS (SELECT workspace_id, entity_id AS job_id, max(project) AS project, max(cost_center) AS cost_center FROM tagged WHERE entity_type = 'JOB' GROUP BY 1, 2)
      SELECT workspace_id, job_id, run_id, c.run_cost_usd IS NOT NULL AS has_cost, coalesce(c.run_cost_usd, 0) AS run_cost_usd, CASE WHEN duration_minutes > 0 THEN {rnd("coalesce(c.run_cost_usd, 0) / duration_minutes", 6)} END AS cost_per_minute,
      coalesce(project, 'SIN_ASIGNAR') AS project, coalesce(cost_center, 'SIN_ASIGNAR') AS cost_center FROM runs LEFT JOIN run_cost c USING (workspace_id, job_id, run_id) LEFT JOIN jt USING (workspace_id, job_id)""",
    "a11_query_activity": f"WITH {ACTIVITY} SELECT * FROM activity",
    "a11_monthly_p95": f"""WITH {ACTIVITY} SELECT strftime(start_time, '%Y-%m') AS span, workspace_id, warehouse_id, count(*) AS queries, quantile_disc(total_duration_ms, 0.5) AS p50_ms, quantile_disc(total_duration_ms, 0.95) AS p95_ms FROM queries GROUP BY 1, 2, 3
      UNION ALL SELECT 'all', workspace_id, warehouse_id, count(*), quantile_disc(total_duration_ms, 0.5), quantile_disc(total_duration_ms, 0.95) FROM queries GROUP BY 2, 3""",
    "a14_entities_by_span": f"""WITH {FACT} SELECT 'day' AS span, usage_date AS first_day, count(DISTINCT entity_key) AS entities FROM fact GROUP BY 1, 2 UNION ALL SELECT 'month', CAST(date_trunc('month', usage_date) AS DATE), count(DISTINCT entity_key) FROM fact GROUP BY 1, 2
      UNION ALL SELECT 'quarter', CAST(date_trunc('quarter', usage_date) AS DATE), count(DISTINCT entity_key) FROM fact GROUP BY 1, 2""",
    "s13_partition_merge": "WITH o AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderkey AS k, o_orderstatus AS v FROM orders) SELECT k, CASE WHEN month IN ('1999-03', '2001-02') AND k % 2 = 0 THEN 'N' ELSE v END AS v, month FROM o WHERE k % 3 <> 0 OR (month IN ('1999-03', '2001-02') AND k % 2 = 0)",
    "a12_warehouse_cost": f"WITH {WAREHOUSE_COST} SELECT * FROM house",
    "j11_warehouse_catalog": f"WITH {WAREHOUSE_COST}, {WAREHOUSES} SELECT usage_date, workspace_id, warehouse_id, {DIMS}, total_cost_usd, query_count, warehouse_name, {CONFIG} FROM house LEFT JOIN warehouses USING (workspace_id, warehouse_id)",
    "j7_entity_configuration": f"""WITH {FACT}, {CLUSTERS}, {WAREHOUSES}, e AS (SELECT entity_key, workspace_id, max(entity_type) AS entity_type, {usd("total_cost_usd")} AS lifetime_cost_usd FROM fact GROUP BY 1, 2)
      SELECT entity_key, e.workspace_id, entity_type, lifetime_cost_usd, {CLUSTER_CONFIG}, {CONFIG}
      FROM e LEFT JOIN clusters g ON entity_key = 'CLUSTER:' || cluster_id AND e.workspace_id = g.workspace_id LEFT JOIN warehouses w ON entity_key = 'WAREHOUSE:' || w.warehouse_id AND e.workspace_id = w.workspace_id""",
    "p17_owners": f"WITH {PRICED} SELECT entity_type, owner_resolved, count(*) AS records FROM tagged GROUP BY 1, 2",
    "p20_warehouses": f"WITH {WAREHOUSES} SELECT * FROM warehouses",
    "a13_tag_coverage": f"WITH {COVERAGE} SELECT * FROM coverage",
    "w1_latest_clusters": f"WITH {CLUSTERS} SELECT cluster_id, worker_count, is_autoscale, is_single_node, is_deleted, auto_termination_minutes, dbr_version FROM clusters",
    "w6_kpis": f"WITH {KPI} SELECT * FROM kpi",
    "d5_cost_by_sku_group": f"WITH {PRICED} SELECT sku_group, {usd('total_cost_usd')} AS total_cost_usd, sum(usage_quantity) AS dbus FROM tagged GROUP BY 1",
    "d5_sku_groups_30_days": f"WITH {PRICED} SELECT sku_group, {usd('total_cost_usd')} AS total_cost_usd, sum(usage_quantity) AS dbus FROM tagged WHERE usage_date BETWEEN DATE '2001-08-01' - 29 AND DATE '2001-08-01' GROUP BY 1",
    "l9_fingerprints": "SELECT o_orderkey, substr(sha256('RULE|' || o_orderpriority || '|' || CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS VARCHAR) ELSE '' END), 1, 16) AS fingerprint FROM orders",
    "s4_usage_ingest": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, CAST(l_shipdate AS DATE) AS usage_date FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '2001-01-01' AND DATE '2001-03-31' AND l_returnflag <> 'R'",
    "s13_upsert": "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN 'N' ELSE o_orderstatus END AS v FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 <> 0",
    "s16_ingest_window": "SELECT CAST(max(CAST(o_orderdate AS DATE)) - 7 AS DATE) AS first_day, DATE '2001-12-31' AS last_day, 'mark' AS kind FROM orders WHERE o_orderpriority = '1-URGENT' UNION ALL SELECT CAST(DATE '2001-12-31' - 400 AS DATE), DATE '2001-12-31', 'initial'",
    "s5_job_run_ingest": f"WITH {RUNS} SELECT workspace_id, job_id, run_id, CAST(a AS DATE) AS run_date, a AS period_start_time, result_state FROM periods WHERE CAST(a AS DATE) BETWEEN DATE '2001-01-01' AND DATE '2001-03-31'",
    "s6_task_run_ingest": "SELECT CAST(l_shipdate AS DATE) AS run_date, 'task-' || l_linenumber AS task_key, CASE WHEN l_returnflag = 'R' THEN 'FAILED' ELSE 'SUCCEEDED' END AS result_state, count(*) AS tasks FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '2001-01-01' AND DATE '2001-03-31' GROUP BY 1, 2, 3",
    "s7_query_ingest": f"WITH {ACTIVITY} SELECT statement_id, CAST(start_time AS DATE) AS query_date, workspace_id, warehouse_id, execution_status FROM queries WHERE CAST(start_time AS DATE) BETWEEN DATE '2001-07-05' AND DATE '2001-07-15'",
    "s8_snapshots": "SELECT 'prices' AS source, CAST(11 AS BIGINT) AS rows UNION ALL SELECT 'clusters', count(*) FROM events UNION ALL SELECT 'warehouses', 2 * count(*) FROM supplier UNION ALL SELECT 'jobs', count(*) FROM customer UNION ALL SELECT 'node_types', count(*) FROM part UNION ALL SELECT 'workspaces', count(*) FROM nation",
    "s17_recorded_marks": "SELECT 'orders' AS source_key, max(CAST(o_orderdate AS DATE)) AS watermark_date FROM orders UNION ALL SELECT 'lineitem', max(CAST(l_shipdate AS DATE)) FROM lineitem",
    "s17_high_water_marks": "SELECT o_orderpriority AS source_key, max(CAST(o_orderdate AS DATE)) AS watermark_date FROM orders GROUP BY 1",
}
