"""DuckDB SQL of the analytics queries."""

from __future__ import annotations

from ledgerflow.plans.oracle_facts import ACTIVITY, CLUSTERS, COVERAGE, DIMS, FACT, HOURS, PRICED, RUNS, rnd, usd

SERIES = """
series AS (SELECT dimension, dim_value, usage_date, CAST(sum(v) AS DOUBLE) AS cost FROM (
  SELECT 'event_type' AS dimension, event_type AS dim_value, CAST(ts AS DATE) AS usage_date, CAST(value AS DECIMAL(20,6)) AS v FROM events
  UNION ALL SELECT 'user_group', 'u' || (user_id % 10), CAST(ts AS DATE), CAST(value AS DECIMAL(20,6)) FROM events) GROUP BY 1, 2, 3)"""

POINTS = (
    SERIES
    + """,
points AS (SELECT *, count(*) OVER s AS n, CAST(sum(CAST(cost AS DECIMAL(20,6))) OVER s AS DOUBLE) / count(*) OVER s AS mean,
  row_number() OVER (PARTITION BY dimension, dim_value ORDER BY usage_date) - 1 AS i FROM series WINDOW s AS (PARTITION BY dimension, dim_value))"""
)


def anomalies(dow: bool, method: str, last_n: int | None, threshold: float = 2.0, pct: float = 0.2) -> str:
    same = "AND dayofweek(b.usage_date) = dayofweek(a.usage_date)" if dow else ""
    least = 3 if dow else 14
    start = "14" if last_n is None else f"greatest(14, a.n - {last_n})"
    if method == "mad":
        score = """CASE WHEN mad > 0 THEN 0.6745 * (cost - med) / mad WHEN aad > 0 THEN 0.6745 * (cost - med) / aad WHEN sd > 0 THEN (cost - med) / sd
          WHEN abs(cost - med) <= 1e-9 THEN 0 WHEN cost > med THEN 99 ELSE -99 END"""
        expected = "med"
    else:
        score, expected = "CASE WHEN sd > 0 THEN (cost - avg) / sd ELSE 0 END", "avg"
    return (
        POINTS
        + f""",
based AS (SELECT a.dimension, a.dim_value, a.usage_date, a.cost, count(*) AS k, median(b.cost) AS med, mad(b.cost) AS mad, avg(b.cost) AS avg, stddev_pop(b.cost) AS sd, list(b.cost) AS l
  FROM points a JOIN series b ON a.dimension = b.dimension AND a.dim_value = b.dim_value AND b.usage_date BETWEEN a.usage_date - 28 AND a.usage_date - 1 {same}
  WHERE a.n >= 15 AND a.mean >= 20 AND a.i >= {start} GROUP BY ALL HAVING count(*) >= {least}),
scored AS (SELECT *, {expected} AS expected, {score} AS score FROM (SELECT *, list_avg(list_transform(l, lambda x: abs(x - med))) AS aad FROM based)),
judged AS (SELECT *, CASE WHEN expected > 0 THEN (cost - expected) / expected WHEN cost > 0 THEN 1 ELSE 0 END AS pct FROM scored),
anomalies AS (SELECT dimension, dim_value, usage_date, {rnd("cost", 4)} AS actual, {rnd("expected", 4)} AS expected, {rnd("score", 4)} AS score, {rnd("pct", 6)} AS pct_change,
  CASE WHEN cost > expected THEN 'SPIKE' ELSE 'DROP' END AS direction, CASE WHEN abs(score) >= 8 THEN 'critical' WHEN abs(score) >= 6 THEN 'high' WHEN abs(score) >= 4.5 THEN 'medium' ELSE 'low' END AS severity,
  CAST(k AS INT) AS baseline_points FROM judged WHERE abs(score) >= {threshold} AND abs(pct) >= {pct})"""
    )


FILLED = """
span AS (SELECT dimension, dim_value, min(usage_date) AS a, max(usage_date) AS b FROM {src} GROUP BY 1, 2),
days AS (SELECT dimension, dim_value, b, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM span),
dense AS (SELECT q.dimension, q.dim_value, q.b, q.d, coalesce(s.cost, 0) AS v, row_number() OVER (PARTITION BY q.dimension, q.dim_value ORDER BY q.d) AS i, count(*) OVER (PARTITION BY q.dimension, q.dim_value) AS history
  FROM days q LEFT JOIN {src} s ON q.dimension = s.dimension AND q.dim_value = s.dim_value AND q.d = s.usage_date),
kept AS (SELECT *, row_number() OVER (PARTITION BY dimension, dim_value ORDER BY d) AS j FROM dense WHERE i > history - {train})"""


def forecasts(method: str, weekly: bool, horizon: int) -> str:
    index = "CASE WHEN c < 2 OR m <= 0 THEN 1.0 ELSE least(3.0, greatest(0.2, mm / m)) END" if weekly else "1.0"
    if method == "holt":
        base = "greatest(0, l + b * 0.92 * (1 - pow(0.92, h)) / (1 - 0.92))"
        fitted = "f"
    elif method == "seasonal_naive":
        base, fitted = "greatest(0, x[greatest(0, len(x) - 7) + 1 + (h - 1) % least(7, len(x))])", "w.x"
    else:
        base, fitted = "list_avg(x[greatest(1, len(x) - 6):])", "w.x"
    return (
        SERIES
        + ","
        + FILLED.format(src="series", train=120)
        + f""",
means AS (SELECT dimension, dim_value, avg(v) AS m FROM kept GROUP BY 1, 2),
dows AS (SELECT dimension, dim_value, dayofweek(d) AS w, count(*) AS c, avg(v) AS mm FROM kept GROUP BY 1, 2, 3),
idx AS (SELECT dimension, dim_value, w, {index} AS ix FROM (SELECT k.dimension, k.dim_value, w.w, coalesce(c, 0) AS c, mm, m FROM means k CROSS JOIN (SELECT unnest(range(0, 7)) AS w) w LEFT JOIN dows USING (dimension, dim_value, w))),
xs AS (SELECT k.dimension, k.dim_value, any_value(k.b) AS last, list(v / ix ORDER BY d) AS x FROM kept k JOIN idx ON k.dimension = idx.dimension AND k.dim_value = idx.dim_value AND dayofweek(d) = w WHERE history >= 21 GROUP BY 1, 2),
walk AS (SELECT dimension, dim_value, 1 AS k, x, x[1] AS l, x[2] - x[1] AS b, [x[1]] AS f FROM xs
  UNION ALL SELECT dimension, dim_value, k + 1, x, 0.35 * x[k + 1] + 0.65 * (l + 0.92 * b), 0.12 * (0.35 * x[k + 1] + 0.65 * (l + 0.92 * b) - l) + 0.88 * 0.92 * b, list_append(f, l + 0.92 * b) FROM walk WHERE k < len(x)),
fit AS (SELECT w.dimension, w.dim_value, xs.last, w.x, l, b, {fitted} AS fv FROM walk w JOIN xs USING (dimension, dim_value) WHERE k = len(w.x)),
err AS (SELECT *, list_transform(list_zip(x, fv), lambda z: z[1] - z[2]) AS e, list_filter(list_transform(list_zip(x, fv), lambda z: CASE WHEN z[1] > 0 THEN abs((z[1] - z[2]) / z[1]) END), lambda z: z IS NOT NULL) AS p FROM fit),
stat AS (SELECT *, list_stddev_pop(e) AS sigma, CASE WHEN len(p) >= 3 THEN list_avg(p) END AS mape FROM err),
ahead AS (SELECT *, unnest(range(1, {horizon + 1})) AS h FROM stat),
est AS (SELECT a.*, CAST(last + CAST(h AS INT) AS DATE) AS fd, ({base}) * ix AS est, 1.96 * sigma * sqrt(h) * ix AS margin FROM ahead a JOIN idx ON a.dimension = idx.dimension AND a.dim_value = idx.dim_value AND dayofweek(last + CAST(h AS INT)) = w)
SELECT dimension, dim_value, fd AS forecast_date, CAST(h AS INT) AS step, {rnd("est", 4)} AS expected_cost, {rnd("greatest(0, est - margin)", 4)} AS lower, {rnd("(est + margin)", 4)} AS upper, {rnd("sigma", 6)} AS sigma, {rnd("mape", 6)} AS mape FROM est"""
    )


STATUS = (
    FACT
    + f""",
budget(budget_id, amount, scope, period, thresholds, crit, warn, a, b) AS (VALUES
  ('org', 6000.0::DOUBLE, 'ORGANIZACION', 'month', [50.0::DOUBLE, 80, 90, 100], 90.0::DOUBLE, 50.0::DOUBLE, DATE '2001-07-01', DATE '2001-07-31'),
  ('org-quarter', 20000.0, 'ORGANIZACION', 'quarter', [50.0, 80, 90, 100], 90.0, 50.0, DATE '2001-07-01', DATE '2001-09-30'),
  ('sql', 1500.0, 'sku_group=*SQL*', 'month', [50.0, 80, 90, 100], 90.0, 50.0, DATE '2001-07-01', DATE '2001-07-31'),
  ('team-1', 600.0, 'environment=PRD & team=[''team-1'', ''team-2'']', 'month', [50.0, 80, 90, 100], 90.0, 50.0, DATE '2001-07-01', DATE '2001-07-31'),
  ('year', 20000.0, 'cost_center=BUILDING', 'year', [70.0, 95], 70.0, 70.0, DATE '2001-01-01', DATE '2001-12-31')),
spent AS (SELECT budget_id, {usd("total_cost_usd")} AS actual, count(DISTINCT usage_date) AS days, max(usage_date) AS last FROM budget JOIN fact ON usage_date BETWEEN a AND DATE '2001-07-20'
  AND CASE budget_id WHEN 'sql' THEN sku_group LIKE '%SQL%' WHEN 'team-1' THEN team IN ('team-1', 'team-2') AND environment = 'PRD' WHEN 'year' THEN cost_center = 'BUILDING' ELSE true END GROUP BY 1),
st1 AS (SELECT b.*, coalesce(actual, 0) AS act, coalesce(days, 0) AS days, date_diff('day', a, b.b) + 1 AS total_days, date_diff('day', a, DATE '2001-07-20') + 1 AS elapsed, greatest(0, date_diff('day', coalesce(last, a - 1), b.b)) AS remaining FROM budget b LEFT JOIN spent USING (budget_id)),
st2 AS (SELECT *, CASE WHEN days > 0 THEN act / days ELSE 0 END AS rate FROM st1),
st3 AS (SELECT *, {rnd("(act + rate * remaining)", 4)} AS projected, {rnd("(act / amount * 100)", 4)} AS consumed_pct FROM st2),
st4 AS (SELECT *, {rnd("(projected / amount * 100)", 4)} AS projected_pct FROM st3),
status AS (SELECT budget_id, scope, period, a AS period_start, b AS period_end, amount, {rnd("act", 4)} AS actual, projected, consumed_pct, projected_pct, {rnd("(amount - projected)", 4)} AS variance,
  CAST(elapsed AS INT) AS elapsed_days, CAST(remaining AS INT) AS remaining_days, CAST(total_days AS INT) AS total_days, {rnd("(elapsed / total_days * 100)", 4)} AS progress_pct,
  CASE WHEN remaining > 0 THEN {rnd("(greatest(0, amount - act) / remaining)", 4)} ELSE 0 END AS required_daily,
  CAST(CASE WHEN amount - act <= 0 THEN 0 WHEN rate > 0 THEN floor((amount - act) / rate + 1e-9) END AS INT) AS days_to_exhaustion,
  list_max(list_filter(thresholds, lambda t: t <= consumed_pct)) AS threshold_reached,
  CASE WHEN consumed_pct >= 100 THEN 'EXCEEDED' WHEN consumed_pct >= crit OR projected_pct >= 100 THEN 'CRITICAL' WHEN consumed_pct >= warn OR projected_pct >= crit THEN 'WARNING' ELSE 'OK' END AS status,
  projected_pct <= 100 AS on_track FROM st4)"""
)


def chargeback(shared: str, none: str, overhead: float) -> str:
    def part(pool: str, how: str) -> str:
        if how == "none":
            return "0"
        even = f"{pool} / units"
        return even if how == "even" else f"CASE WHEN weights > 0 THEN {pool} * greatest(0, cost) / weights ELSE {even} END"

    left_s = "true" if shared == "none" else "units = 0"
    left_n = "true" if none == "none" else "units = 0"
    return (
        FACT
        + f""",
kinds AS (SELECT year_month, cost_center, entity_key, total_cost_usd, CASE WHEN entity_key LIKE 'WAREHOUSE:1%' OR regexp_matches(coalesce(entity_name, ''), '0000000.7$') THEN 'shared' WHEN cost_center = 'SIN_ASIGNAR' THEN 'unallocated' ELSE 'direct' END AS kind FROM fact WHERE total_cost_usd <> 0),
lines0 AS (SELECT year_month, kind, CASE WHEN kind = 'direct' THEN cost_center END AS unit, {usd("total_cost_usd")} AS cost, count(DISTINCT entity_key) AS entities FROM kinds GROUP BY ALL),
pools AS (SELECT year_month, greatest(0, coalesce(sum(cost) FILTER (kind = 'shared'), 0)) AS s, greatest(0, coalesce(sum(cost) FILTER (kind = 'unallocated'), 0)) AS n, count(*) FILTER (kind = 'direct') AS units, coalesce(sum(greatest(0, cost)) FILTER (kind = 'direct'), 0) AS weights FROM lines0 GROUP BY 1),
lines1 AS (SELECT year_month, unit, entities, cost AS direct, {part("s", shared)} AS shared, {part("n", none)} AS none FROM lines0 JOIN pools USING (year_month) WHERE kind = 'direct'
  UNION ALL SELECT year_month, CASE kind WHEN 'shared' THEN 'COSTO_COMPARTIDO' ELSE 'SIN_ASIGNAR' END, entities, 0, CASE kind WHEN 'shared' THEN cost ELSE 0 END, CASE kind WHEN 'unallocated' THEN cost ELSE 0 END
  FROM lines0 JOIN pools USING (year_month) WHERE cost > 0 AND ((kind = 'shared' AND {left_s}) OR (kind = 'unallocated' AND {left_n}))),
lines2 AS (SELECT year_month, unit, entities, {rnd("direct", 4)} AS direct_usd, {rnd("shared", 4)} AS shared_usd, {rnd("none", 4)} AS unallocated_usd, {rnd(f"((direct + shared + none) * {overhead})", 4)} AS overhead_usd, {rnd(f"((direct + shared + none) * (1 + {overhead}))", 4)} AS total_usd FROM lines1),
lines AS (SELECT *, CASE WHEN t > 0 THEN {rnd("(total_usd / t)", 6)} ELSE 0 END AS pct_of_total FROM (SELECT *, sum(total_usd) OVER (PARTITION BY year_month) AS t FROM lines2))"""
    )


_LINE_COLUMNS = "year_month, unit, entities, direct_usd, shared_usd, unallocated_usd, overhead_usd, total_usd, pct_of_total"

PROFILES = (
    FACT
    + f", {ACTIVITY}, {RUNS}, {CLUSTERS}"
    + f""",
recent AS (SELECT entity_key, workspace_id, max(entity_type) AS entity_type, max(entity_id) AS entity_id, max(entity_name) AS entity_name, max(owner_resolved) AS owner, max(sku_group) AS sku_group, {usd("total_cost_usd")} AS cost_usd,
  {usd("CASE WHEN is_untagged THEN total_cost_usd ELSE 0.0 END")} AS untagged_cost_usd, max(usage_date) AS last_activity, max(is_photon) AS is_photon, max(is_serverless) AS is_serverless, {", ".join(f"max({d}) AS {'dim_' if d == 'owner' else ''}{d}" for d in DIMS.split(", "))}
  FROM fact WHERE usage_date BETWEEN DATE '2001-08-01' - 365 AND DATE '2001-08-01' GROUP BY 1, 2),
jobstat AS (SELECT workspace_id, 'JOB:' || job_id AS entity_key, count(*) AS run_count, count(*) FILTER (is_failed) AS failed_runs, {rnd("avg(duration_minutes)", 4)} AS avg_minutes, max(run_date) AS last_run_date FROM runs WHERE run_date BETWEEN DATE '2001-08-01' - 365 AND DATE '2001-08-01' GROUP BY 1, 2),
house AS (SELECT workspace_id, 'WAREHOUSE:' || warehouse_id AS entity_key, CAST(sum(query_count) AS BIGINT) AS query_count, {rnd(HOURS, 4)} AS active_hours FROM activity WHERE query_date BETWEEN DATE '2001-08-01' - 365 AND DATE '2001-08-01' GROUP BY 1, 2),
profiles AS (SELECT r.*, 365 AS analysis_days, CAST(date_diff('day', last_activity, DATE '2001-08-01') AS INT) AS days_since_activity, worker_count, auto_termination_minutes, dbr_version, is_autoscale, run_count, failed_runs, avg_minutes, last_run_date, query_count, active_hours
  FROM recent r LEFT JOIN clusters c ON r.entity_key = 'CLUSTER:' || cluster_id AND r.workspace_id = c.workspace_id LEFT JOIN jobstat j ON r.entity_key = j.entity_key AND r.workspace_id = j.workspace_id LEFT JOIN house h ON r.entity_key = h.entity_key AND r.workspace_id = h.workspace_id),
monthly AS (SELECT *, cost_usd / 365 * 30 AS m FROM profiles)"""
)
_RULES = [
    ("NO_AUTOTERMINATION", "entity_type = 'CLUSTER' AND NOT is_serverless AND auto_termination_minutes NOT BETWEEN 1 AND 60", "m * 0.15 * CASE WHEN auto_termination_minutes = 0 THEN 2 ELSE 1 END", "CASE WHEN auto_termination_minutes = 0 THEN 'media' ELSE 'baja' END"),
    ("ALL_PURPOSE_FOR_JOBS", "sku_group = 'ALL_PURPOSE' AND run_count >= 5", "m * 0.45", "'alta'"),
    ("LEGACY_RUNTIME", "CAST(split_part(dbr_version, '.', 1) AS INT) < 14", "m * 0.10", "'baja'"),
    ("FAILED_RUN_WASTE", "failed_runs >= 2 AND failed_runs / run_count >= 0.15", "m * failed_runs / run_count", "'media'"),
    ("ZOMBIE_ENTITY", "days_since_activity >= 14 AND cost_usd > 0", "m", "'alta'"),
    ("NO_AUTOSCALE", "entity_type = 'CLUSTER' AND NOT coalesce(is_autoscale, false) AND worker_count >= 4", "m * 0.15", "'baja'"),
    ("OVERSIZED_WAREHOUSE", "entity_type = 'WAREHOUSE' AND active_hours > 0 AND query_count / active_hours <= 60", "m * 0.40", "'media'"),
    ("SERVERLESS_CANDIDATE", "NOT is_serverless AND run_count >= 5 AND avg_minutes <= 200", "m * 0.25", "'baja'"),
    ("UNTAGGED_SPEND", "untagged_cost_usd >= 100", "0", "'alta'"),
    ("PHOTON_OPPORTUNITY", "NOT is_photon AND sku_group IN ('JOBS', 'SQL', 'DLT') AND m >= 20", "m * 0.12", "'baja'"),
]
_FIRED = " UNION ALL ".join(f"SELECT entity_key, workspace_id, entity_type, '{r}' AS rule_id, {rnd('m', 4)} AS monthly_cost_usd, {rnd(f'greatest(0, {s})', 2)} AS savings_usd, {c} AS confidence FROM monthly WHERE {w}" for r, w, s, c in _RULES)
FOUND = (
    PROFILES
    + f""", fired AS ({_FIRED}),
found AS (SELECT entity_key, workspace_id, entity_type, rule_id, monthly_cost_usd, savings_usd, CASE WHEN monthly_cost_usd > 0 THEN {rnd("(savings_usd / monthly_cost_usd)", 4)} ELSE 0 END AS savings_pct, confidence,
  CASE WHEN savings_usd >= 1000 THEN 'critical' WHEN savings_usd >= 300 THEN 'high' WHEN savings_usd >= 100 THEN 'medium' ELSE 'low' END AS severity FROM fired WHERE savings_usd >= 1 OR rule_id = 'UNTAGGED_SPEND')"""
)
CHECKS = f"""
q AS (SELECT max(usage_date) AS last, count(*) AS n, count(*) FILTER (total_cost_usd < 0) AS neg, count(*) FILTER (total_cost_usd IS NULL) AS nul, count(*) FILTER (sku_name NOT LIKE 'UNKNOWN\\_%' ESCAPE '\\') AS due,
  count(*) FILTER (sku_name NOT LIKE 'UNKNOWN\\_%' ESCAPE '\\' AND NOT price_missing) AS found, {usd("total_cost_usd")} AS cost, {usd("CASE WHEN cost_center <> 'SIN_ASIGNAR' THEN total_cost_usd END")} AS cc, {usd("CASE WHEN team <> 'SIN_ASIGNAR' THEN total_cost_usd END")} AS tm FROM tagged),
dup AS (SELECT count(*) AS r FROM (SELECT record_id FROM tagged GROUP BY 1 HAVING count(*) > 1)),
obs AS (SELECT date_diff('day', last, DATE '2001-11-05') * 24 AS lag, nul / n AS nulls, n, neg, {rnd("(found / due)", 6)} AS pm, {rnd("(cc / cost)", 6)} AS cc, {rnd("(tm / cost)", 6)} AS tm, r FROM q, dup),
checks AS (SELECT 'freshness' AS check_name, lag <= 36 AS passed, CAST(lag AS DOUBLE) AS observed, 36.0::DOUBLE AS threshold, 'error' AS severity FROM obs
  UNION ALL SELECT 'null_ratio', nulls <= 0.001, nulls, 0.001, 'error' FROM obs UNION ALL SELECT 'row_count', n >= 1, n, 1, 'error' FROM obs UNION ALL SELECT 'negative_cost', neg <= 0, neg, 0, 'error' FROM obs
  UNION ALL SELECT 'price_match', pm >= 0.98, pm, 0.98, 'error' FROM obs UNION ALL SELECT 'tag_coverage_cost_center', cc >= 0.8, cc, 0.8, 'warning' FROM obs UNION ALL SELECT 'tag_coverage_team', tm >= 0.8, tm, 0.8, 'warning' FROM obs
  UNION ALL SELECT 'duplicate_keys', r = 0, r, 0, 'error' FROM obs)"""


def alert(rule: str, severity: str, subject: str, value: str, threshold: str, source: str, parts: str | None = None) -> str:
    return f"SELECT '{rule}' AS rule, {severity} AS severity, {subject} AS subject, {rnd(f'CAST({value} AS DOUBLE)', 4)} AS value, {rnd(f'CAST({threshold} AS DOUBLE)', 4)} AS threshold, substr(sha256('{rule}|' || {parts or subject}), 1, 16) AS fingerprint FROM {source}"


_ANOMALY_ALERT = alert("COST_ANOMALY", "severity", "dimension || '=' || dim_value", "actual", "expected", "anomalies WHERE direction = 'SPIKE'", "dimension || '=' || dim_value || '|' || usage_date")
_SPIKE = "(SELECT usage_date, cost, count(*) OVER b AS n, CAST(sum(CAST(cost AS DECIMAL(20,6))) OVER b AS DOUBLE) / 7 AS mean, max(usage_date) OVER () AS last FROM ({}) WINDOW b AS (ORDER BY usage_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)) WHERE usage_date = last AND n = 7 AND mean > 0 AND (cost - mean) / mean >= {} AND cost >= 1"
_SPIKE_LEVEL = "CASE WHEN (cost - mean) / mean >= 1 THEN 'critical' ELSE 'high' END"
_FACT_TOTALS = f"SELECT usage_date, {usd('total_cost_usd')} AS cost FROM fact GROUP BY 1"
_ORDER_TOTALS = f"SELECT CAST(o_orderdate AS DATE) AS usage_date, {usd('o_totalprice')} AS cost FROM orders GROUP BY 1"
_STATUS_TAIL = STATUS[len(FACT) :]
_COVERAGE_TAIL = COVERAGE[len(FACT) :]
_BUDGET_ALERTS = " UNION ALL ".join(
    [
        alert("BUDGET_THRESHOLD", "CASE WHEN consumed_pct >= 100 THEN 'critical' WHEN consumed_pct >= 90 THEN 'high' WHEN consumed_pct >= 80 THEN 'medium' ELSE 'low' END", "budget_id", "consumed_pct", "threshold_reached", "status WHERE threshold_reached IS NOT NULL", "budget_id || '|' || period_start || '|' || CAST(threshold_reached AS INT)"),
        alert("FORECAST_OVERRUN", "CASE WHEN (projected - amount) / amount >= 0.2 THEN 'high' ELSE 'medium' END", "budget_id", "(projected - amount) / amount", "0.05", "status WHERE amount > 0 AND consumed_pct < 100 AND (projected - amount) / amount >= 0.05", "budget_id || '|' || period_start"),
    ]
)
_ALERTS = " UNION ALL ".join(
    [
        _BUDGET_ALERTS,
        _ANOMALY_ALERT,
        alert("DAILY_SPEND_SPIKE", _SPIKE_LEVEL, "CAST(usage_date AS VARCHAR)", "cost", "(mean * 1.01)", _SPIKE.format(_FACT_TOTALS, 0.01)),
        alert("NEW_EXPENSIVE_ENTITY", "CASE WHEN lc >= 60 THEN 'high' ELSE 'medium' END", "entity_key || '@' || workspace_id", "lc", "20", f"(SELECT entity_key, workspace_id, min(usage_date) AS f, {usd('total_cost_usd')} AS lc FROM fact GROUP BY 1, 2) WHERE date_diff('day', f, DATE '2001-08-01') <= 60 AND lc >= 20"),
        alert("TAG_COVERAGE_DROP", "CASE WHEN r < 0.99 * 0.75 THEN 'high' ELSE 'medium' END", "'dimension=' || dimension", "r", "0.99", f"(SELECT dimension, {usd('attributed_cost_usd')} / {usd('total_cost_usd')} AS r FROM coverage WHERE dimension = 'cost_center' AND usage_date = DATE '2001-08-01' GROUP BY 1) WHERE r < 0.99", "dimension || '|2001-08'"),
        alert("DATA_QUALITY", "'high'", "check_name", "observed", "threshold", "checks WHERE NOT passed AND severity = 'error'"),
    ]
)

ADMITTED = (
    anomalies(True, "mad", None)
    + f""", raw AS ({_ANOMALY_ALERT} UNION ALL {_ANOMALY_ALERT} AND dimension = 'event_type'),
marked AS (SELECT *, row_number() OVER (PARTITION BY fingerprint ORDER BY list_position(['low', 'medium', 'high', 'critical'], severity) DESC, rule, subject, fingerprint) AS f FROM raw),
whyd AS (SELECT *, CASE WHEN f > 1 THEN 'duplicate' WHEN fingerprint < '4' THEN 'cooldown' END AS why FROM marked),
admitted AS (SELECT *, coalesce(why, CASE WHEN row_number() OVER (PARTITION BY why IS NULL ORDER BY list_position(['low', 'medium', 'high', 'critical'], severity) DESC, rule, subject, fingerprint) > 3 THEN 'cap' END, 'dispatched') AS outcome FROM whyd)"""
)
_CHANNEL = "list_filter(['pager', 'chat', 'table'], lambda c: c = 'table' OR (c = 'chat' AND severity IN ('high', 'critical')) OR (c = 'pager' AND severity = 'critical'))"

ORACLE_SQL = {
    "a16_series": f"WITH {SERIES} SELECT * FROM series",
    "t5_anomalies": f"WITH {anomalies(True, 'mad', None)} SELECT * FROM anomalies",
    "t5_incremental_anomalies": " UNION ALL ".join(f"SELECT * FROM (WITH {anomalies(True, 'mad', None).replace('FROM events', f'FROM (SELECT * FROM events WHERE CAST(ts AS DATE) <= DATE {last})')} SELECT * FROM anomalies WHERE usage_date BETWEEN DATE {first} AND DATE {last})" for first, last in (("'2024-01-26'", "'2024-01-26'"), ("'2024-01-27'", "'2999-12-31'"))),
    "q7_repeated_keys": "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "t5_anomalies_plain": f"WITH {anomalies(False, 'zscore', 10)} SELECT * FROM anomalies",
    "t6_gap_fill": f"WITH {SERIES}, part AS (SELECT * FROM series WHERE day(usage_date) % 3 <> 0 OR dim_value = 'click'), {FILLED.format(src='part', train=20)} SELECT dimension, dim_value, CAST(history AS INT) AS history, CAST(j - 1 AS INT) AS i, v AS cost FROM kept",
    "t14_forecast": f"WITH RECURSIVE {forecasts('holt', True, 45)}",
    "t11_seasonal_naive": f"WITH RECURSIVE {forecasts('seasonal_naive', False, 10)}",
    "t12_moving_average": f"WITH RECURSIVE {forecasts('moving_average', False, 5)}",
    "b6_budget_status": f"WITH {STATUS} SELECT * FROM status",
    "b2_many_budgets": f"""WITH {FACT}, b AS (SELECT i, 'b' || i AS budget_id, 5.0 + i % 100 AS amount, ['month', 'quarter', 'year'][i % 3 + 1] AS period, [DATE '2001-07-01', DATE '2001-07-01', DATE '2001-01-01'][i % 3 + 1] AS a, [DATE '2001-07-31', DATE '2001-09-30', DATE '2001-12-31'][i % 3 + 1] AS e,
        i % 5 AS kind, 'JOB:' || i AS job, 'team-' || (i % 3) AS t, ['P', 'D', 'Q'][i % 3 + 1] AS v FROM (SELECT unnest(range(10000)) AS i)),
      f AS (SELECT usage_date, entity_key, team, sku_group, environment, total_cost_usd AS c FROM fact WHERE usage_date BETWEEN DATE '2001-01-01' AND DATE '2001-07-20'), d AS (SELECT usage_date, {usd("c")} AS c FROM f GROUP BY 1), s AS (SELECT usage_date, team, environment, {usd("c")} AS c FROM f WHERE sku_group LIKE '%SQL%' GROUP BY 1, 2, 3),
      m AS (SELECT i, usage_date, c FROM b JOIN f ON kind < 3 AND entity_key = job AND usage_date >= a UNION ALL SELECT i, usage_date, c FROM b JOIN s ON kind = 3 AND (team = t OR team LIKE 'SIN#_%' ESCAPE '#') AND environment LIKE v || '%' AND usage_date >= a UNION ALL SELECT i, usage_date, c FROM b JOIN d ON kind = 4 AND usage_date >= a),
      w AS (SELECT i, {usd("c")} AS act, count(DISTINCT usage_date) AS days, max(usage_date) AS last FROM m GROUP BY 1),
      x AS (SELECT b.*, coalesce(act, 0) AS act, coalesce(act / days, 0) * greatest(0, date_diff('day', coalesce(last, a - 1), e)) AS rest FROM b LEFT JOIN w USING (i)),
      y AS (SELECT *, {rnd("(act + rest)", 4)} AS projected, {rnd("(act / amount * 100)", 4)} AS consumed_pct FROM x), z AS (SELECT *, {rnd("(projected / amount * 100)", 4)} AS projected_pct FROM y)
      SELECT budget_id, CASE WHEN kind < 3 THEN 'entity_key=' || job WHEN kind = 3 THEN 'environment=' || v || '* & sku_group=*SQL* & team=[' || chr(39) || t || chr(39) || ', ' || chr(39) || 'SIN_*' || chr(39) || ']' ELSE 'ORGANIZACION' END AS scope, period, {rnd("act", 4)} AS actual, consumed_pct, projected,
        CASE WHEN consumed_pct >= 100 THEN 'EXCEEDED' WHEN consumed_pct >= 90 OR projected_pct >= 100 THEN 'CRITICAL' WHEN consumed_pct >= 50 OR projected_pct >= 90 THEN 'WARNING' ELSE 'OK' END AS status FROM z""",
    "w7_latest_budgets": f"WITH {STATUS} SELECT *, DATE '2001-07-20' AS as_of_date FROM status",
    "t15_budget_with_forecast": f"""WITH d AS (SELECT CAST(ts AS DATE) AS usage_date, event_type, value FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-20'), o AS (SELECT usage_date, {usd("value")} AS cost FROM d GROUP BY 1),
      m AS (SELECT {rnd("avg(cost)", 4)} AS v FROM (SELECT cost FROM o ORDER BY usage_date DESC LIMIT 7)),
      b AS (SELECT 'org' AS budget_id, 'ORGANIZACION' AS scope, 90000.0::DOUBLE AS amount, {usd("value")} AS act, count(DISTINCT usage_date) AS days FROM d UNION ALL SELECT 'clicks', 'team=click', 20000.0, {usd("value")}, count(DISTINCT usage_date) FROM d WHERE event_type = 'click'),
      r AS (SELECT *, act / days AS rate, CASE budget_id WHEN 'org' THEN 11 * (SELECT v FROM m) ELSE 11 * act / days END AS rest FROM b),
      p AS (SELECT *, {rnd("(act + rest)", 4)} AS projected, {rnd("(act / amount * 100)", 4)} AS consumed_pct FROM r), q AS (SELECT *, {rnd("(projected / amount * 100)", 4)} AS projected_pct FROM p)
      SELECT budget_id, scope, 'month' AS period, DATE '2024-01-01' AS period_start, DATE '2024-01-31' AS period_end, amount, {rnd("act", 4)} AS actual, projected, consumed_pct, projected_pct, {rnd("(amount - projected)", 4)} AS variance, 20 AS elapsed_days, 11 AS remaining_days, 31 AS total_days, {rnd("(20 / 31 * 100)", 4)} AS progress_pct,
      {rnd("(greatest(0, amount - act) / 11)", 4)} AS required_daily, CAST(CASE WHEN amount - act <= 0 THEN 0 ELSE floor((amount - act) / rate + 1e-9) END AS INT) AS days_to_exhaustion, list_max(list_filter([50.0::DOUBLE, 80, 90, 100], lambda t: t <= consumed_pct)) AS threshold_reached,
      CASE WHEN consumed_pct >= 100 THEN 'EXCEEDED' WHEN consumed_pct >= 90 OR projected_pct >= 100 THEN 'CRITICAL' WHEN consumed_pct >= 50 OR projected_pct >= 90 THEN 'WARNING' ELSE 'OK' END AS status, projected_pct <= 100 AS on_track FROM q""",
    "a16_cost_series": f"WITH {FACT} " + " UNION ALL ".join(f"SELECT '{d}' AS dimension, {d} AS dim_value, usage_date, {usd('total_cost_usd')} AS cost FROM fact GROUP BY 2, 3" for d in ("team", "sku_group", "environment")),
    "q10_tables": "SELECT 'table_exists' AS check_name, t AS table_name, n > 0 AS passed, CAST(n > 0 AS DOUBLE) AS observed, CAST(1 AS DOUBLE) AS threshold, 'error' AS severity FROM (SELECT 'lineitem' AS t, count(*) AS n FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'absent', 0)",
    "q5_unpriced_usage": f"WITH {PRICED} SELECT sku_name, billing_origin_product, usage_unit, cloud, count(*) AS records, sum(usage_quantity) AS quantity, min(usage_date) AS first_seen, max(usage_date) AS last_seen FROM tagged WHERE price_missing GROUP BY 1, 2, 3, 4",
    "l15_reloaded_alerts": f"WITH {STATUS}, {anomalies(True, 'mad', None)} {_BUDGET_ALERTS} UNION ALL {_ANOMALY_ALERT} AND severity IN ('high', 'critical') AND usage_date >= DATE '2024-01-30' - 8",
    "c3_chargeback": f"WITH {chargeback('proportional', 'proportional', 0.05)} SELECT {_LINE_COLUMNS} FROM lines",
    "c3_chargeback_none": f"WITH {chargeback('none', 'even', 0.0)} SELECT {_LINE_COLUMNS} FROM lines",
    "c4_reconciliation": f"WITH {chargeback('proportional', 'proportional', 0.05)}, a AS (SELECT year_month, {usd('total_usd')} AS allocated FROM lines GROUP BY 1), b AS (SELECT year_month, {usd('total_cost_usd')} AS source FROM fact GROUP BY 1) SELECT year_month, source, allocated, abs(allocated - source * 1.05) <= greatest(0.01, abs(source * 1.05) * 1e-6) AS reconciles FROM b JOIN a USING (year_month)",
    "c5_showback": f"WITH {chargeback('proportional', 'proportional', 0.05)}, r AS (SELECT *, row_number() OVER (PARTITION BY year_month ORDER BY total_usd DESC, unit) AS n FROM lines) SELECT year_month, {usd('total_usd')} AS total_usd, count(*) AS units, {usd('shared_usd')} AS shared_usd, {usd('unallocated_usd')} AS unallocated_usd, string_agg(unit, ',' ORDER BY n) FILTER (n <= 3) AS top_units FROM r GROUP BY 1",
    "a15_entity_profiles": f"WITH {PROFILES} SELECT * FROM profiles",
    "r11_recommendations": f"WITH {FOUND} SELECT * FROM found",
    "r12_savings": f"WITH {FOUND} SELECT rule_id, count(*) AS findings, {usd('savings_usd')} AS savings_usd, {usd("CASE WHEN confidence = 'alta' THEN savings_usd END")} AS high_confidence_usd, count(DISTINCT entity_key) AS entities FROM found GROUP BY 1",
    "q9_quality_checks": f"WITH {PRICED}, {CHECKS} SELECT * FROM checks",
    "q8_quality_summary": f"WITH {PRICED}, {CHECKS} SELECT count(*) AS total, count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed, count(*) FILTER (NOT passed AND severity = 'error') AS blocking FROM checks",
    "q5_unpriced_skus": f"WITH {PRICED} SELECT sku_name, count(*) AS records, sum(usage_quantity) AS quantity, min(usage_date) AS first_seen, max(usage_date) AS last_seen FROM tagged WHERE price_missing GROUP BY 1 ORDER BY records DESC, sku_name LIMIT 10",
    "l10_alerts": f"WITH {FACT}{_STATUS_TAIL}{_COVERAGE_TAIL}, {anomalies(True, 'mad', None)}, {CHECKS} {_ALERTS}",
    "l4_daily_spike": alert("DAILY_SPEND_SPIKE", _SPIKE_LEVEL, "CAST(usage_date AS VARCHAR)", "cost", "(mean * (1 - 0.9))", _SPIKE.format(_ORDER_TOTALS, -0.9)),
    "l7_pipeline_health": alert("PIPELINE_HEALTH", "'critical'", "stages", "n", "0", "(SELECT string_agg(DISTINCT 'stage-' || (user_id % 5), ',' ORDER BY 'stage-' || (user_id % 5)) AS stages, count(*) AS n FROM events WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-30') WHERE n > 0"),
    "l11_admitted": f"WITH {ADMITTED} SELECT rule, severity, subject, fingerprint, outcome, CASE WHEN outcome = 'dispatched' THEN array_to_string({_CHANNEL}, ',') ELSE '' END AS channels FROM admitted",
    "l13_routes": f"WITH {ADMITTED} SELECT fingerprint, severity, unnest({_CHANNEL}) AS channel FROM admitted WHERE outcome = 'dispatched'",
    "l16_digest": f"WITH {ADMITTED} SELECT severity, outcome, count(*) AS alerts FROM admitted GROUP BY 1, 2",
}
