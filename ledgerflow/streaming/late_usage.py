"""Structured Streaming front end for late usage and for alert cooldown."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def daily_cost_stream(usage: DataFrame, stamp: str = "usage_end_time", late: str = "7 days") -> DataFrame:
    """Cost of each day and SKU group; a day closes once the watermark has passed it."""
    day = F.window(stamp, "1 day")
    return usage.withWatermark(stamp, late).groupBy(day.alias("w"), "sku_group").agg(F.sum("total_cost_usd").alias("cost"), F.count(F.lit(1)).alias("records")).select(F.to_date("w.start").alias("usage_date"), "sku_group", "cost", "records")


def first_alerts(alerts: DataFrame, stamp: str = "created_at", cooldown: str = "24 hours") -> DataFrame:
    """Alerts whose fingerprint did not come before within the cooldown."""
    return alerts.withWatermark(stamp, cooldown).dropDuplicatesWithinWatermark(["fingerprint"])


def replace_days_writer(stream: DataFrame, path: str, checkpoint: str, day: str = "usage_date") -> DataStreamWriter:
    """Micro-batches of whole days that replace what the table holds for them; reruns change nothing."""

    def write(batch: DataFrame, _: int) -> None:
        # one write; partitions of days that the batch lacks are not touched
        batch.repartition(day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
