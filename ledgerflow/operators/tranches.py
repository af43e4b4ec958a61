"""An interval index over price tranches, for price lists of any length.

The tranche that counts at a time is the one, of those valid then, with the latest start. For each
SKU, unit and cloud a sweep over the starts turns tranches into elementary intervals, which do not
overlap and each name one tranche. The time line of a SKU and unit is cut into equal buckets, about one
for every eight intervals, and each interval is filed under the buckets it touches. As the intervals of
a cloud are disjoint, this is at most one more row for each bucket. A usage record finds its bucket by
arithmetic, meets it by an equi-join and picks among the few intervals there: no range join, and no
SKU whose tranches all meet each of its records.

A tranche for the record's own cloud and one for all clouds (an empty one) compete by start; of equal
starts the own cloud's counts, then of one cloud the one that ends last, one without an end after all
others, then the one of the higher price. Tranches without a start, or that end before they start,
are never valid.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# functions travel to the workers by value, which so need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Intervals that share a bucket, on average.
PER_BUCKET = 8
_EPOCH = "1970-01-01"
_FOREVER = (1 << 62) - 1
_INTERVALS = "p_sku string, p_unit string, p_cloud string, start long, stop long, since long, price double"


def micros(c: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"), c)


def sweep(tranches: Iterator[tuple[int, int, float | None]]) -> Iterator[tuple[int, int, int, float | None]]:
    """(start, stop, start of the tranche, price) of the elementary intervals of tranches sorted by start.

    Of those that share a start the last one given counts as the latest. Open tranches wait on a stack; one that
    ends no later than a newer one is never seen again and goes, so that ends fall from the bottom to the top.
    """
    stack: list[tuple[int, int, float | None]] = []
    now = 0

    def until(time: int) -> Iterator[tuple[int, int, int, float | None]]:
        nonlocal now
        while stack and now < time:
            start, stop, price = stack[-1]
            if stop > now:
                end = min(stop, time)
                yield now, end, start, price
                now = end
            if stop <= now:
                stack.pop()

    for start, stop, price in tranches:
        yield from until(start)
        now = start
        while stack and stack[-1][1] <= stop:
            stack.pop()
        stack.append((start, stop, price))
    yield from until(_FOREVER)


def elementary(prices: DataFrame) -> DataFrame:
    """Intervals (p_sku, p_unit, p_cloud, start, stop, since, price) of tranches (sku, unit, cloud, a, b, price); times in microseconds."""
    stop = F.coalesce(micros(F.col("b")), F.lit(_FOREVER))
    rows = prices.filter(F.col("a").isNotNull() & (F.col("b").isNull() | (F.col("b") > F.col("a"))))
    # the preferred one of a start comes last: a later end, an open end before any, a higher price
    preferred = F.when(F.col("b").isNull(), F.lit(-1)).otherwise(stop)
    rows = rows.select(F.col("sku").alias("p_sku"), F.col("unit").alias("p_unit"), F.col("cloud").alias("p_cloud"), micros(F.col("a")).alias("start"), stop.alias("stop"), preferred.alias("preferred"), "price")
    keys = ["p_sku", "p_unit", "p_cloud"]
    ordered = rows.repartition(*keys).sortWithinPartitions(*keys, "start", "preferred", F.asc_nulls_first("price"))
    names = [x.split()[0] for x in _INTERVALS.split(", ")]
    kinds = [pa.string()] * 3 + [pa.int64()] * 3 + [pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def all_rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(n).to_pylist() for n in ("p_sku", "p_unit", "p_cloud", "start", "stop", "price")), strict=True)

        rows = all_rows()
        row = next(rows, None)
        found: list[tuple] = []
        while row is not None:
            key = row[:3]

            def same() -> Iterator[tuple[int, int, float | None]]:
                nonlocal row
                while row is not None and row[:3] == key:
                    this, row = row, next(rows, None)
                    yield this[3:]

            for interval in sweep(same()):
                found.append((*key, *interval))
                if len(found) >= 8192:
                    yield _batch(found, names, kinds)
                    found = []
        if found:
            yield _batch(found, names, kinds)

    return ordered.mapInArrow(run, _INTERVALS)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def bucket(time: Column) -> Column:
    """The bucket of a time on the line from ``low``, in steps of ``width``, clamped to those that there are."""
    return F.greatest(F.lit(0), F.least(F.col("buckets") - 1, F.floor((time - F.col("low")) / F.col("width")).cast("long")))


def index(intervals: DataFrame, per_bucket: int = PER_BUCKET) -> tuple[DataFrame, DataFrame]:
    """(time lines, one row for each SKU and unit), (buckets with their intervals)."""
    keys = ["p_sku", "p_unit"]
    # open ends do not stretch the line: they are filed under its last bucket
    end = F.when(F.col("stop") < _FOREVER, F.col("stop")).otherwise(F.col("start"))
    lines = intervals.groupBy(*keys).agg(F.min("start").alias("low"), F.max(end).alias("high"), F.ceil(F.count(F.lit(1)) / per_bucket).cast("long").alias("buckets"))
    lines = lines.withColumn("width", F.greatest(F.lit(1), F.ceil((F.col("high") - F.col("low")) / F.col("buckets")).cast("long")))
    filed = intervals.join(lines, keys).withColumn("bucket", F.explode(F.sequence(bucket(F.col("start")), bucket(F.col("stop") - 1))))
    buckets = filed.groupBy(*keys, "bucket").agg(F.collect_list(F.struct("since", F.col("p_cloud").alias("cloud"), "start", "stop", "price")).alias("intervals"))
    return lines.select(*keys, "low", "width", "buckets"), buckets
