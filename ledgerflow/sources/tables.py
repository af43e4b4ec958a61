"""Model tables as DataFrames over the TPC-H-like Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.sources.readers import ingest_days, spread
from ledgerflow.sources.stored import small

#: (sku, unit, cloud or '', start, end or null, default, effective and promotional list price): tranches, one overlapping.
PRICES = (
    ("PREMIUM_JOBS_COMPUTE_(PHOTON)", "DBU", "", "1994-01-01", "1998-01-01", 0.15, None, None),
    ("PREMIUM_JOBS_COMPUTE_(PHOTON)", "DBU", "", "1998-01-01", "2000-06-01", 0.20, 0.18, 0.10),
    ("PREMIUM_JOBS_COMPUTE_(PHOTON)", "DBU", "", "1999-01-01", None, 0.22, None, 0.10),
    ("PREMIUM_SQL_PRO_COMPUTE_US_EAST", "DBU", "aws", "1994-01-01", None, 0.55, None, None),
    ("PREMIUM_SQL_PRO_COMPUTE_US_EAST", "DBU", "AZURE", "1994-01-01", None, 0.60, None, None),
    ("PREMIUM_SERVERLESS_SQL_COMPUTE", "DBU", "", "1994-01-01", "1997-01-01", 0.70, None, None),
    ("PREMIUM_SERVERLESS_SQL_COMPUTE", "DBU", "", "1997-01-01", "2001-01-01", 0.75, 0.72, None),
    ("PREMIUM_SERVERLESS_SQL_COMPUTE", "DBU", "", "2001-01-01", None, 0.80, None, None),
    ("PREMIUM_ALL_PURPOSE_COMPUTE", "DBU", "", "1994-01-01", "1998-06-01", 0.40, None, None),
    ("PREMIUM_ALL_PURPOSE_COMPUTE", "DBU", "", "1998-06-01", "2001-09-01", 0.55, 0.50, None),
    ("ENTERPRISE_DLT_CORE_COMPUTE", "DBU", "", "1994-01-01", None, None, None, 0.30),
)
#: Discount rules, the first that fits counts.
DISCOUNTS = (
    {"name": "sql-aws", "match": {"sku_name": "*SQL*", "cloud": ["AWS", "GCP"]}, "discount_pct": 0.25},
    {"name": "jobs", "match": {"billing_origin_product": "JOBS"}, "discount_pct": 0.10},
    {"name": "all", "match": {"sku_name": "PREMIUM_*"}, "discount_pct": 0.05},
)
WORKSPACE_DEFAULTS = {"3": {"project": "core"}, "7": {"application": "billing"}}
AS_OF = "2001-08-01"
#: Days by which queries are moved back, from the days of events into those of usage.
QUERY_SHIFT = 8218


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def usage(spark: SparkSession, sf_dir: str, days: tuple[str, str] | None = None) -> DataFrame:
    """One usage record for each line item, of a range of days if given: its filter reaches the scan."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_shipdate")
    if days is not None:
        lines = ingest_days(lines, "l_shipdate", "usage_date", *days).drop("usage_date")
    lines = spread(lines)
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    suppliers = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    # orders, customers and parts grow with the lines and are joined by shuffle unless Spark finds them small: customers meet
    # the fewer orders first, and lines the parts while they are narrow
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    joined = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(small(suppliers), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    sku = (
        F.when(F.col("p_type") == "ECONOMY", "PREMIUM_JOBS_COMPUTE_(PHOTON)")
        .when(F.col("p_type") == "LARGE", "PREMIUM_SQL_PRO_COMPUTE_US_EAST")
        .when(F.col("p_type") == "MEDIUM", "PREMIUM_SERVERLESS_SQL_COMPUTE")
        .when(F.col("p_type") == "PROMO", "PREMIUM_ALL_PURPOSE_COMPUTE")
        .when(F.col("p_type") == "SMALL", "ENTERPRISE_DLT_CORE_COMPUTE")
        .otherwise("UNKNOWN_ADDON")
    )
    flag, nation = F.col("l_returnflag"), F.col("s_nationkey")
    tags = F.when(F.col("o_custkey") % 13 == 0, F.create_map().cast("map<string,string>")).otherwise(
        F.create_map(
            F.lit("Cost-Center"), F.when(F.col("o_custkey") % 11 == 0, "  ").otherwise(F.col("c_mktsegment")),
            F.lit("equipo"), F.when(nation % 6 == 0, "n/a").otherwise(F.concat(F.lit("team-"), (nation % 4).cast("string"))),
            F.lit("ENV"), F.element_at(F.array(*map(F.lit, ("prod", "Desarrollo", "staging", "lab"))), (F.col("l_linenumber") % 4 + 1).cast("int")),
            F.when(F.col("l_linenumber") % 2 == 0, "Ticket").otherwise("ticket-"), F.concat(F.lit("T"), (F.col("l_linenumber") % 3).cast("string")),
        )
    )
    metadata = F.struct(
        F.when(flag == "R", F.col("o_custkey").cast("string")).alias("job_id"),
        F.when(flag == "R", F.col("l_orderkey").cast("string")).alias("job_run_id"),
        F.when(flag == "A", F.col("l_suppkey").cast("string")).alias("warehouse_id"),
        F.when((flag == "N") & (F.col("l_partkey") % 10 != 0), (F.col("l_partkey") % 150).cast("string")).alias("cluster_id"),
    )
    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("record_id"),
        F.lit("acct-1").alias("account_id"),
        F.when(flag == "R", F.col("c_nationkey")).otherwise(nation).cast("string").alias("workspace_id"),
        F.element_at(F.array(*map(F.lit, ("AZURE", "AWS", "GCP"))), (nation % 3 + 1).cast("int")).alias("cloud"),
        sku.alias("sku_name"),
        F.when(F.col("p_size") % 7 == 0, "JOBS").when(F.col("p_size") % 7 == 1, "SQL").alias("billing_origin_product"),
        F.lit("DBU").alias("usage_unit"),
        F.to_date("l_shipdate").alias("usage_date"),
        (F.col("l_shipdate") + F.expr("interval 1 hour")).alias("usage_end_time"),
        F.col("l_quantity").alias("usage_quantity"),
        F.when(F.col("l_linenumber") == 1, F.concat(F.lit("user-"), (F.col("o_custkey") % 9).cast("string"))).alias("run_as"),
        tags.alias("custom_tags"),
        metadata.alias("usage_metadata"),
    )


def prices(spark: SparkSession) -> DataFrame:
    schema = "sku_name string, usage_unit string, cloud string, price_start string, price_end string, `default` double, effective double, promotional double"
    p = spark.createDataFrame(list(PRICES), schema)
    stamp = lambda c: F.col(c).cast("timestamp_ntz")
    only = lambda c: F.struct(F.col(c).alias("default"))
    pricing = F.struct(only("effective").alias("effective_list"), F.col("default").alias("default"), only("promotional").alias("promotional"))
    return p.select("sku_name", "usage_unit", "cloud", stamp("price_start").alias("price_start_time"), stamp("price_end").alias("price_end_time"), pricing.alias("pricing"))


def cluster_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configuration snapshots of clusters, many for each."""
    k = F.get_json_object("props", "$.k").cast("int")
    return read(spark, sf_dir, "events").select(
        (F.col("user_id") % 25).cast("string").alias("workspace_id"),
        F.col("user_id").cast("string").alias("cluster_id"),
        "event_id",
        F.col("ts").alias("change_time"),
        F.concat(F.lit("cluster-"), F.col("user_id").cast("string")).alias("cluster_name"),
        F.concat(F.lit("admin-"), (k % 3).cast("string")).alias("owned_by"),
        (k % 10).alias("worker_count"),
        F.when(k % 3 == 0, k % 4).alias("min_autoscale_workers"),
        F.when(k % 3 == 0, k % 8).alias("max_autoscale_workers"),
        F.when(k % 5 == 0, F.lit(None)).otherwise((k * 3) % 200).cast("int").alias("auto_termination_minutes"),
        F.concat((k % 6 + 11).cast("string"), F.lit(".3.x-scala2.12")).alias("dbr_version"),
        F.concat(F.lit("driver-"), (k % 3).cast("string")).alias("driver_node_type"),
        F.concat(F.lit("worker-"), (k % 4).cast("string")).alias("worker_node_type"),
        F.when(k % 2 == 0, "UI").otherwise("JOB").alias("cluster_source"),
        F.when(k % 7 == 0, F.concat(F.lit("policy-"), k.cast("string"))).alias("policy_id"),
        F.create_map(F.lit("Owner"), F.concat(F.lit("own-"), (k % 5).cast("string"))).alias("tags"),
        (F.col("event_type") == "error").alias("is_deleted"),
    )


def warehouse_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configuration snapshots of warehouses, two for each supplier."""
    s = read(spark, sf_dir, "supplier").withColumn("n", F.explode(F.array(F.lit(0), F.lit(1))))
    k = F.col("s_suppkey") + F.col("n")
    named = lambda names, by: F.element_at(F.array(*map(F.lit, names)), (by % len(names) + 1).cast("int"))
    return s.select(
        F.col("s_nationkey").cast("string").alias("workspace_id"),
        F.col("s_suppkey").cast("string").alias("warehouse_id"),
        F.col("s_name").alias("warehouse_name"),
        named(("PRO", "CLASSIC", "pro_serverless"), k).alias("warehouse_type"),
        named(("Small", "Medium", "Large"), k).alias("warehouse_size"),
        (k % 2 + 1).alias("min_clusters"),
        (k % 5 + 2).alias("max_clusters"),
        (k % 4 * 10).alias("auto_stop_minutes"),
        F.create_map(F.lit("Team"), F.concat(F.lit("t"), (k % 3).cast("string"))).alias("tags"),
        (F.lit("2001-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=F.col("n"))).alias("change_time"),
        F.when(F.col("s_suppkey") % 9 == 0, F.lit("2001-06-01").cast("timestamp_ntz")).alias("delete_time"),
    )


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    tags = F.when(c % 2 == 0, F.create_map(F.lit("Proyecto"), F.concat(F.lit("proj-"), (c % 3).cast("string"))))
    owner = F.when(c % 3 != 0, F.concat(F.lit("svc-"), (c % 4).cast("string")))
    return read(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("workspace_id"), c.cast("string").alias("job_id"), F.col("c_name").alias("job_name"), owner.alias("run_as"), tags.alias("tags"))


def run_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of job runs: one run for each order, with one to three periods."""
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    o = read(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    part = o.withColumn("n", F.explode(F.sequence(F.lit(0), (F.col("o_orderkey") % 3).cast("int"))))
    minutes = (F.col("o_custkey") % 50 + 1).cast("int")
    state = F.when(F.col("o_orderstatus") == "F", "FAILED").when(F.col("o_orderkey") % 17 == 0, "CANCELED").otherwise("SUCCEEDED")
    start = F.col("o_orderdate") + F.make_dt_interval(mins=F.col("n") * 60)
    return part.select(
        F.col("c_nationkey").cast("string").alias("workspace_id"),
        F.col("o_custkey").cast("string").alias("job_id"),
        F.col("o_orderkey").cast("string").alias("run_id"),
        start.alias("period_start_time"),
        (start + F.make_dt_interval(mins=minutes)).alias("period_end_time"),
        F.when(F.col("n") == F.col("o_orderkey") % 3, state).alias("result_state"),
        F.array(F.concat(F.lit("c"), F.col("n").cast("string"))).alias("compute_ids"),
    )


def task_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks of job runs: one for each line item."""
    li = read(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").cast("string").alias("parent_run_id"), F.concat(F.lit("task-"), F.col("l_linenumber").cast("string")).alias("task_key"), F.col("l_shipdate").alias("period_start_time"), F.when(F.col("l_returnflag") == "R", "FAILED").otherwise("SUCCEEDED").alias("result_state"))


def query_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries on warehouses of the first suppliers, on days of the usage."""
    suppliers = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    e = read(spark, sf_dir, "events").join(suppliers, F.col("user_id") % 20 == F.col("s_suppkey"), "left")
    start = F.col("ts") - F.make_dt_interval(days=F.lit(QUERY_SHIFT))
    return e.select(
        F.col("event_id").cast("string").alias("statement_id"),
        F.to_date(start).alias("query_date"),
        start.alias("start_time"),
        F.col("s_nationkey").cast("string").alias("workspace_id"),
        (F.col("user_id") % 20).cast("string").alias("warehouse_id"),
        F.concat(F.lit("user-"), (F.col("user_id") % 7).cast("string")).alias("executed_by"),
        F.when(F.col("event_type") != "error", "FINISHED").when(F.col("user_id") % 2 == 0, "FAILED").otherwise("query_failed").alias("execution_status"),
        F.round(F.col("value") * 100).cast("long").alias("total_duration_ms"),
        F.when(F.col("event_id") % 5 != 0, F.col("event_id") % 1000).alias("waiting_for_compute_duration_ms"),
        F.when(F.col("event_id") % 7 != 0, F.col("event_id") * 10).alias("read_bytes"),
        (F.col("event_id") % 91).alias("produced_rows"),
    )


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily cost series of two dimensions, from events: (dimension, dim_value, usage_date, cost)."""
    e = read(spark, sf_dir, "events").select(F.to_date("ts").alias("usage_date"), "event_type", F.concat(F.lit("u"), (F.col("user_id") % 10).cast("string")).alias("user_group"), F.col("value").cast("decimal(20,6)").alias("v"))
    long = e.unpivot(["usage_date", "v"], ["event_type", "user_group"], "dimension", "dim_value")
    return long.groupBy("dimension", "dim_value", "usage_date").agg(F.sum("v").cast("double").alias("cost"))
