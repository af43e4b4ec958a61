"""Queries on pricing, attribution, facts, dimensions, coverage and KPIs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.exprs import blank_to_null, fingerprint, money, normalise_key, normalise_map
from ledgerflow.operators import facts, rollups
from ledgerflow.operators.facts import DIMS, MEASURES
from ledgerflow.plans import model
from ledgerflow.sources import readers, sinks, stored
from ledgerflow.sources import tables as T


def p1_normalise_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = T.read(spark, sf_dir, "part")
    raw = F.concat(F.lit(" "), F.col("p_brand"), F.lit("_"), F.col("p_name"), F.lit("- "))
    blank = F.when(F.col("p_size") % 5 == 0, "N/A").when(F.col("p_size") % 5 == 1, " none ").otherwise(F.concat(F.lit(" "), F.col("p_type")))
    return p.select("p_partkey", normalise_key(raw).alias("key"), blank_to_null(blank).alias("value"))


def p3_normalise_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = T.read(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    tags = F.when(k % 7 != 0, F.create_map(F.lit("Cost-Center"), F.when(k % 3 == 0, "-").otherwise(F.col("c_mktsegment")), F.lit("cost_center"), F.concat(F.lit("cc"), (k % 5).cast("string")), F.lit("ENV"), F.lit(" prod ")))
    m = normalise_map(tags)
    return c.select("c_custkey", F.element_at(m, "costcenter").alias("costcenter"), F.element_at(m, "env").alias("env"), F.size(m).cast("long").alias("n_keys"))


def p6_sku_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = model.priced(spark, sf_dir)
    return p.groupBy("sku_name", "billing_origin_product", "sku_group", "compute_family", "is_serverless", "is_photon").agg(F.count(F.lit(1)).alias("records"))


def p11_priced_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ("record_id", "unit_price", "price_missing", "discount_pct", "discount_rule", *MEASURES)
    return model.priced(spark, sf_dir).select(*cols)


def p13_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.priced(spark, sf_dir).select("record_id", "entity_type", "entity_id", "entity_key", "entity_name")


def p15_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.priced(spark, sf_dir).select("record_id", *DIMS, *[f"{d}_source" for d in DIMS], "tags_resolved", "is_fully_tagged", "is_untagged")


#: Discount rules by the hundred, of literals, prefixes and globs, on three keys; the first that fits counts.
MANY_DISCOUNTS = tuple(
    {"name": f"rule-{i}", "match": {"workspace_id": str(i % 40), "sku_name": ("PREMIUM_*", "*sql*", "ENTERPRISE_DLT_CORE_COMPUTE", "*COMPUTE")[i % 4], "entity_id": [f"{i % 97}*", f"?{i % 10}"]}, "discount_pct": i % 50 / 100} for i in range(1000)
)


def p9_many_discounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A thousand discount rules by the index of predicates."""
    return model.priced(spark, sf_dir, discounts=MANY_DISCOUNTS).select("record_id", "discount_rule", "discount_pct", "discount_usd")


def _many_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A price list with a tranche for each order: overlapping ones of all lengths, some without an end, for one cloud or all."""
    o = T.read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    sku = F.element_at(F.array(*map(F.lit, ("PREMIUM_JOBS_COMPUTE_(PHOTON)", "PREMIUM_SQL_PRO_COMPUTE_US_EAST", "ENTERPRISE_DLT_CORE_COMPUTE"))), (k % 3 + 1).cast("int"))
    start = F.col("o_orderdate") + F.make_dt_interval(secs=(k % 86_400).cast("decimal(18,6)"))
    cloud = F.element_at(F.array(*map(F.lit, ("", "aws", "AZURE", "gcp"))), (k % 4 + 1).cast("int"))
    end = F.when(k % 11 != 0, start + F.make_dt_interval(hours=(k % 400 + 1).cast("int")))
    return o.select(sku.alias("sku_name"), F.lit("DBU").alias("usage_unit"), cloud.alias("cloud"), start.alias("price_start_time"), end.alias("price_end_time"), (k % 100_000 / 1e5).alias("pricing"))


def j1_many_tranches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage priced from a list of as many tranches as there are orders, by the interval index."""
    p = facts.with_price(T.usage(spark, sf_dir), _many_prices(spark, sf_dir))
    return p.select("record_id", "sku_name", "cloud", "price_start_time", "unit_price")


def j1_price_tranches(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = facts.with_price(T.usage(spark, sf_dir), T.prices(spark))
    return p.groupBy("sku_name", "cloud", "price_start_time", "unit_price").agg(F.count(F.lit(1)).alias("records"), F.sum("usage_quantity").alias("quantity"))


def a2_cost_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.fact(spark, sf_dir)


def a3_cost_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.cost_monthly(model.fact(spark, sf_dir))


def d1_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.dim_date(T.usage(spark, sf_dir), T.AS_OF)


def a4_dim_sku(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.dim_sku(model.priced(spark, sf_dir))


def a5_dim_workspace(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = T.read(spark, sf_dir, "nation").filter("n_nationkey % 4 <> 0").select(F.col("n_nationkey").cast("string").alias("workspace_id"), F.col("n_name").alias("workspace_name"))
    return facts.dim_workspace(model.fact(spark, sf_dir), names)


def a6_dim_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.dim_entity(model.fact(spark, sf_dir), T.AS_OF)


def a7_job_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = model.runs(spark, sf_dir)
    return runs.select("workspace_id", "job_id", "run_id", "run_date", "result_state", "is_failed", "is_success", "is_cancelled", "duration_minutes", F.get("compute_ids", F.lit(0)).alias("first_compute_id"))


def a8_run_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.run_cost(model.priced(spark, sf_dir))


def a10_job_run_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = facts.job_run_cost(model.runs(spark, sf_dir), model.priced(spark, sf_dir))
    return runs.select("workspace_id", "job_id", "run_id", "has_cost", "run_cost_usd", "cost_per_minute", "project", "cost_center")


def a11_query_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.activity(spark, sf_dir)


def a11_monthly_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p95 of query times by warehouse and month, and by warehouse over all, from stored daily counts of each duration."""
    daily = stored.written(rollups.duration_counts(T.query_history(spark, sf_dir)))
    month = F.date_format("query_date", "yyyy-MM")
    by = lambda span: rollups.exact_quantiles(daily, {"span": span, "workspace_id": F.col("workspace_id"), "warehouse_id": F.col("warehouse_id")}, {"p50_ms": "0.5", "p95_ms": "0.95"})
    return by(month).unionByName(by(F.lit("all")))


def a14_entities_by_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct entities by day, month and quarter, from stored daily bitmaps; the last year's entities are numbered after those before."""
    daily = stored.written(model.fact(spark, sf_dir).select("usage_date", "entity_key"))
    old = daily.filter("usage_date < DATE '2000-08-01'")
    numbers = stored.written(rollups.entity_numbers(old))
    numbers = stored.written(rollups.entity_numbers(daily, known=numbers))
    maps = stored.written(rollups.entity_bitmaps(daily, numbers))
    day = F.col("usage_date")
    spans = {"day": day, "month": F.trunc(day, "MM"), "quarter": F.trunc(day, "QUARTER")}
    counts = [rollups.merged_counts(maps, {"span": F.lit(name), "first_day": first}) for name, first in spans.items()]
    return reduce(DataFrame.unionByName, counts)


def a12_warehouse_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.warehouse_cost(model.priced(spark, sf_dir), model.activity(spark, sf_dir))


def a13_tag_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.tag_coverage(model.fact(spark, sf_dir))


def j5_named_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = facts.job_runs(T.run_periods(spark, sf_dir), T.jobs(spark, sf_dir))
    return runs.select("workspace_id", "job_id", "run_id", "job_name", "job_run_as", "duration_minutes")


def j7_entity_configuration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entity dimension with the configuration of its clusters and warehouses."""
    e = facts.dim_entity(model.fact(spark, sf_dir), T.AS_OF, model.clusters(spark, sf_dir), model.warehouses(spark, sf_dir))
    return e.select("entity_key", "workspace_id", "entity_type", "lifetime_cost_usd", *facts.CLUSTER_CONFIG, *facts.WAREHOUSE_CONFIG)


def j11_warehouse_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = facts.warehouse_cost(model.priced(spark, sf_dir), model.activity(spark, sf_dir), model.warehouses(spark, sf_dir))
    return w.select("usage_date", "workspace_id", "warehouse_id", *DIMS, "total_cost_usd", "query_count", "warehouse_name", *facts.WAREHOUSE_CONFIG)


def p17_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = model.priced(spark, sf_dir)
    return p.groupBy("entity_type", "owner_resolved").agg(F.count(F.lit(1)).alias("records"))


def p20_warehouses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.warehouses(spark, sf_dir).select("workspace_id", "warehouse_id", "warehouse_name", *facts.WAREHOUSE_CONFIG, "is_deleted", "is_serverless")


def w1_latest_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.clusters(spark, sf_dir).select("cluster_id", "worker_count", "is_autoscale", "is_single_node", "is_deleted", "auto_termination_minutes", "dbr_version")


def w6_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.kpis(model.fact(spark, sf_dir))


def _by_sku_group(priced: DataFrame) -> DataFrame:
    return priced.groupBy("sku_group").agg(money(F.col("total_cost_usd")).alias("total_cost_usd"), F.sum("usage_quantity").alias("dbus"))


def d5_cost_by_sku_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_sku_group(model.priced(spark, sf_dir))


def d5_sku_groups_30_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_sku_group(model.priced(spark, sf_dir, model.last_days(30)))


def l9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.read(spark, sf_dir, "orders").select("o_orderkey", fingerprint(F.lit("RULE"), F.col("o_orderpriority"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_custkey"))).alias("fingerprint"))


def s4_usage_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window of usage rows without the excluded workspaces, tolerant of missing columns."""
    src = readers.read_source(spark, [f"{sf_dir}/absent.parquet", f"{sf_dir}/lineitem.parquet"])
    rows = readers.ingest_days(src, "l_shipdate", "usage_date", "2001-01-01", "2001-03-31")
    kept = readers.select_existing(rows, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "usage_date", "not_there"])
    return readers.exclude(kept, "l_returnflag", ["R"])


def s13_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order statuses merged by key: later ones replace earlier ones."""
    o = T.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("v"))
    return sinks.upsert(o.filter("k % 3 <> 0"), o.filter("k % 2 = 0").withColumn("v", F.lit("N")), ["k"])


def s13_partition_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order statuses by month, merged in place: a batch for two months rewrites these two only."""
    o = T.read(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("v"))
    path = stored.scratch_path(spark, "statuses")
    sinks.overwrite(o.filter("k % 3 <> 0").repartition("month"), path, ["month"])
    batch = o.filter("month IN ('1999-03', '2001-02') AND k % 2 = 0").withColumn("v", F.lit("N"))
    sinks.merge_partitions(batch, path, ["month", "k"], ["month"])
    return spark.read.schema("k long, v string, month string").parquet(path)


def s16_ingest_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = T.read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("source_key"), F.to_date("o_orderdate").alias("watermark_date"))
    return readers.ingest_window(marks, "1-URGENT", "2001-12-31").withColumn("kind", F.lit("mark")).unionByName(readers.ingest_window(marks, "none", "2001-12-31").withColumn("kind", F.lit("initial")))


def s17_high_water_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = T.read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("source_key"), F.to_date("o_orderdate").alias("watermark_date"))
    return readers.high_water_marks(marks)


def s17_recorded_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks appended to a table of marks, and the highest of each source read back."""
    path = stored.scratch_path(spark, "marks")
    for table, stamp in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("orders", "o_orderdate")):
        sinks.record_mark(T.read(spark, sf_dir, table).agg(F.to_date(F.max(stamp)).alias("watermark_date")), table, path)
    return readers.high_water_marks(spark.read.parquet(path))


def s5_job_run_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readers.ingest_days(T.run_periods(spark, sf_dir), "period_start_time", "run_date", "2001-01-01", "2001-03-31")
    return rows.select("workspace_id", "job_id", "run_id", "run_date", "period_start_time", "result_state")


def s6_task_run_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readers.ingest_days(T.task_periods(spark, sf_dir), "period_start_time", "run_date", "2001-01-01", "2001-03-31")
    return rows.groupBy("run_date", "task_key", "result_state").agg(F.count(F.lit(1)).alias("tasks"))


def s7_query_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readers.ingest_days(T.query_history(spark, sf_dir).drop("query_date"), "start_time", "query_date", "2001-07-05", "2001-07-15")
    return rows.select("statement_id", "query_date", "workspace_id", "warehouse_id", "execution_status")


def s8_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full snapshots of the configuration tables, each overwritten; rows of each as read back."""
    root = stored.scratch_path(spark, "snapshots")
    tables = {"prices": T.prices(spark), "clusters": T.cluster_history(spark, sf_dir), "warehouses": T.warehouse_history(spark, sf_dir), "jobs": T.jobs(spark, sf_dir), "node_types": T.read(spark, sf_dir, "part"), "workspaces": T.read(spark, sf_dir, "nation")}
    for name, df in tables.items():
        sinks.overwrite(readers.with_audit(df, "run-1", name), f"{root}/{name}")
    counts = [spark.read.parquet(f"{root}/{name}").groupBy(F.col("_source").alias("source")).agg(F.count(F.lit(1)).alias("rows")) for name in tables]
    return reduce(DataFrame.unionByName, counts)


QUERIES = {n: f for n, f in list(globals().items()) if n.split("_")[0][:1] in "pjadwls" and n.split("_")[0][1:].isdigit()}
