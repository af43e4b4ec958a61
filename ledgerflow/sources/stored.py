"""Intermediate tables in the shared checkpoint folder: they cut a plan, and outlive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. A temporary one is made only for a local master, where all tasks see it."""
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, removed when the session ends."""
    text = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(text)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return text


#: Rows and stored bytes of a price or configuration table up to which it is broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 16 << 20
#: Bytes of input, as Catalyst adds them up, that need no measuring.
KNOWN_BYTES = 4 << 20
#: Bytes of input from which work is large: shuffled rows then take more disk than tables stored between the steps.
LARGE_BYTES = 64 << 20


def source_bytes(df: DataFrame) -> int:
    """Bytes of the tables that ``df`` reads, as Catalyst knows them."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


class Scratch:
    """Tables written for the work at hand. Each goes when the session ends, or all at once by ``drop``."""

    def __init__(self):
        self._tables: list = []

    def written(self, df: DataFrame) -> DataFrame:
        """``df`` computed once, written as Parquet below the shared folder, and read again.

        Spark removes the shuffle files behind the table when the driver collects its garbage; after large work it is asked to.
        """
        path = scratch_path(df.sparkSession, "table")
        df.write.parquet(path)
        self._tables.append((df.sparkSession, path))
        if source_bytes(df) >= LARGE_BYTES:
            df.sparkSession._jvm.System.gc()
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def size(self) -> int:
        """Bytes of the tables as stored."""
        total = 0
        for spark, text in self._tables:
            path = spark._jvm.org.apache.hadoop.fs.Path(text)
            total += path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
        return total

    def adopt(self, other: Scratch) -> None:
        """Take over the tables of ``other``."""
        self._tables += other._tables

    def drop(self) -> None:
        """Remove the tables; nothing may read them any more."""
        for spark, text in self._tables:
            path = spark._jvm.org.apache.hadoop.fs.Path(text)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        self._tables.clear()


def written(df: DataFrame) -> DataFrame:
    """One table that stays until the session ends."""
    return Scratch().written(df)


def sized(df: DataFrame, most: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """``df``, and whether its rows and bytes are few.

    A table that Catalyst knows to come from little input is few as it is. Any other is computed once,
    stored and measured.
    """
    if most >= BROADCAST_ROWS and int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= min(most_bytes, KNOWN_BYTES):
        return df, True
    scratch = Scratch()
    table = scratch.written(df)
    return table, scratch.size() <= most_bytes and table.count() <= most


def small(df: DataFrame, most: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, with a broadcast hint if it is small."""
    table, few = sized(df, most, most_bytes)
    return F.broadcast(table) if few else table
