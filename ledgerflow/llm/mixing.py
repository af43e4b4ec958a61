"""Mixing sources to target weights: entropy balancing of token counts.

Sizes are summed by source. Targets share ``share`` of all words by weight, but stop at
``most`` times a source's size; the excess is shared again by weight (water filling over the
sources sorted by the level at which each one stops).

Among all rates of documents that meet the targets, entropy balancing takes those with the least
relative entropy against the corpus. They are exponential tilts: a document of x times its source's
mean size gets rate exp(lambda * x), at most ``most``, with one lambda for each source, the one
where the sum of size * rate meets the target. Newton steps on the convex dual find it: every step
is one distributed sum of size * rate and its derivative by source, over the table of how often
each size occurs, and a step that leaves the interval known to hold lambda is a bisection instead.
All sources step in parallel until each is within ``TOLERANCE`` of its target.

Rates become whole copies: every document gets floor(rate) copies, and one more by chance of the
rest. The chance is drawn from a hash of id and text: a document is taken where draw / rest is
smallest, until its source's words reach the target. Running sums over ranges of that quotient, then
within the one range where the target falls, give each source its last taken document; the
documents themselves are only compared with it and never shuffled.

A null text has size 0 and takes 0. A null source is a source of its own, sorted last. A
source without words has target 0. Repeated rows count each; rows that repeat both id and text
where the last taken document falls get the copy by a hash of their place in the table. Empty
input gives no rows. Reruns over one table agree, a repeated task with its first attempt too. Other
columns travel in one struct and may have any name; those named as one of the six new ones are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import Scratch, own, stable, with_own

#: Ranges of the quotient by which documents are taken, up to FAR; beyond it as many by hash.
RANGES, FAR = 4096, 4
#: Newton steps in one job, and jobs at most: bisection alone halves the interval with each step.
STEPS, ROUNDS = 3, 50
#: Distance of a source's words from its target at which its steps end, as a share of the target.
TOLERANCE = 1e-7
#: Sources that are broadcast, at most.
BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    r"""Number of ``[^\\x20\\x09-\\x0D]+`` in the text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """One row for each source with weight and target; ``sources`` has __key, source and source_size.

    Sources are rows already summed, one for each source; ordering them is one small window.
    """
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weighted = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((number - 1) % len(weights) + 1).cast("int")).cast("double"))
    level = Window.orderBy("stop", F.col("source").asc_nulls_last())
    ordered = weighted.withColumn("cap", F.col("source_size") * F.lit(float(most))).withColumn("stop", F.col("cap") / F.col("weight"))
    all_rows = Window.partitionBy()
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    sums = ordered.withColumns(
        {
            "place": F.row_number().over(level),
            "goal": F.sum("source_size").over(all_rows) * F.lit(float(share)),
            "capped": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
            "open_weight": F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        }
    )
    # the water level is where the first source stays below its own stop
    fill = (F.col("goal") - F.col("capped")) / F.col("open_weight")
    water = F.min(F.when(fill <= F.col("stop"), F.struct("place", fill.alias("fill")))).over(all_rows)["fill"]
    return sums.withColumn("water", water).select("__key", "source", "source_size", "weight", F.least("cap", F.coalesce(F.col("water") * F.col("weight"), F.col("cap"))).alias("target"))


def tilt(size: Column, mean: Column, rate_lambda: Column, most: float) -> Column:
    """exp(lambda * size / mean), at most ``most``; 0 for documents without words."""
    x = rate_lambda * size / mean
    return F.when(size <= 0, 0.0).when(x >= math.log(most), float(most)).otherwise(F.exp(x))


def solve(sizes: DataFrame, aims: DataFrame, most: float, scratch: Scratch, few: bool) -> DataFrame:
    """``aims`` (__key, source_size, target, mean, least) with lambda; ``sizes`` has __key, size and n."""
    total, target, least = F.col("source_size"), F.col("target"), F.col("least") / F.col("mean")
    # lambda at which the shortest document, and so every one, gets ``most``; and one at which no rate can be too low
    top, low = math.log(most) / least, F.log(target / total) / least
    inside = (target > 0) & (target < total * most * (1 - 1e-12))
    state = aims.withColumns({"lo": F.when(inside, F.least(low, F.lit(0.0))), "hi": F.when(inside, top), "lambda": F.when(inside, F.lit(0.0)).when(target > 0, top), "open": inside})
    known = ("source_size", "target", "mean", "least", "lo", "hi", "lambda", "open")
    state = scratch.written(state.select("__key", *known))
    for _ in range(ROUNDS):
        if state.filter("open").isEmpty():
            break
        for _ in range(STEPS):
            met = sizes.join(F.broadcast(state) if few else state, "__key")
            rate = tilt(F.col("size"), F.col("mean"), F.col("lambda"), most)
            words = F.col("n") * F.col("size") * rate
            slope = F.when(rate < most, words * F.col("size") / F.col("mean")).otherwise(0.0)
            s = met.groupBy("__key").agg(*[F.first(c).alias(c) for c in known], F.sum(words).alias("words"), F.sum(slope).alias("slope"))
            gap, here = F.col("words") - F.col("target"), F.col("lambda")
            lo, hi = F.when(gap < 0, here).otherwise(F.col("lo")), F.when(gap > 0, here).otherwise(F.col("hi"))
            step = here - F.try_divide(gap, F.col("slope"))
            then = F.when((step > lo) & (step < hi), step).otherwise((lo + hi) / 2)
            goes = F.col("open") & (F.abs(gap) > F.col("target") * TOLERANCE) & (then != here)
            s = s.withColumns({"__lo": lo, "__hi": hi, "__then": then, "__goes": goes})
            moved = {"lo": F.col("__lo"), "hi": F.col("__hi"), "lambda": F.when(F.col("__goes"), F.col("__then")).otherwise(here), "open": F.col("__goes")}
            state = s.select("__key", *[moved.get(c, F.col(c)).alias(c) for c in known])
        state = scratch.written(state)
    return state.select("__key", "source_size", "target", "mean", "lambda")


def _spread_draws(rows: DataFrame, aims: DataFrame, most: float, few: bool) -> DataFrame:
    """``rows`` (__key, __size, __draw, ...) with rate, whole copies, and where the document stands among those that may get one more."""
    met = rows.join(F.broadcast(aims) if few else aims, "__key")
    met = met.withColumn("__rate", F.coalesce(tilt(F.col("__size"), F.col("mean"), F.col("lambda"), most), F.lit(0.0)))
    met = met.withColumn("__whole", F.floor("__rate"))
    rest, u = F.col("__rate") - F.col("__whole"), (F.shiftrightunsigned("__draw", 11) + 0.5) / float(1 << 53)
    met = met.withColumn("__t", F.when((rest > 0) & (F.col("__whole") + 1 <= most), u / rest))
    near = F.floor(F.col("__t") * (RANGES // FAR))
    return met.withColumn("__range", F.when(F.col("__t") < FAR, near).otherwise(RANGES + F.shiftrightunsigned("__draw", 52)).cast("int"))


def mix(docs: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with size, source_size, target, rate, copies and taken."""
    new = ("size", "source_size", "target", "rate", "copies", "taken")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in new]
    text, source = F.col(f"`{text_col}`"), F.col(f"`{source_col}`").cast("string")
    scratch, docs = Scratch(), stable(docs)
    rows = docs.select(
        own(docs, kept),
        source.alias("__source"),
        F.when(source.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), source)).alias("__key"),
        word_count(text).alias("__size"),
        F.xxhash64(F.col(f"`{id_col}`").cast("string"), text).alias("__draw"),
        F.xxhash64(F.monotonically_increasing_id()).alias("__tie"),
    )
    # texts are read for this narrow table, and once more for the result
    narrow = scratch.written(rows.select("__key", "__source", "__size", "__draw"))
    sizes = scratch.written(narrow.groupBy("__key", F.col("__size").alias("size")).agg(F.count(F.lit(1)).alias("n"), F.first("__source").alias("source")))
    filled = F.when(F.col("size") > 0, F.col("n"))
    summed = sizes.groupBy("__key").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.first("source").alias("source"), (F.sum(F.col("n") * F.col("size")) / F.sum(filled)).alias("mean"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"))
    summed = scratch.written(summed)
    few = summed.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    aims = targets(summed.select("__key", "source", "source_size"), weights, share, most).join(summed.select("__key", "mean", "least"), "__key").drop("source", "weight")
    aims = scratch.written(solve(sizes, aims, most, scratch, few))

    placed = _spread_draws(narrow, aims, most, few)
    ranges = placed.groupBy("__key", "target", "__range").agg(F.sum(F.when(F.col("__t").isNotNull(), F.col("__size"))).alias("words"), F.sum(F.col("__whole") * F.col("__size")).alias("whole"))
    ranges = ranges.withColumns({"left": F.col("target") - F.sum("whole").over(Window.partitionBy("__key")), "upto": F.sum("words").over(Window.partitionBy("__key").orderBy("__range"))})
    # the range in which the target falls: its documents are looked at one by one, equal ones together
    cut = ranges.filter("words > 0 AND upto > left AND upto - words <= left").select("__key", F.col("__range").alias("__cut"), (F.col("left") - F.col("upto") + F.col("words")).alias("__left"))
    cut = scratch.written(cut)
    inside = placed.join(F.broadcast(cut) if few else cut, "__key").filter("__t IS NOT NULL AND __range = __cut")
    equal = inside.groupBy("__key", "__cut", "__left", "__t", "__draw").agg(F.sum("__size").alias("words"), F.max("__size").alias("one"), F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("words").over(Window.partitionBy("__key").orderBy("__t", "__draw").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # of a group of equal rows as many are taken as come nearest
    some = F.least(F.col("n"), F.greatest(F.lit(0), F.floor((F.col("__left") - before) / F.col("one") + 0.5)))
    counted = equal.withColumn("__some", some).filter("__some > 0")
    last = counted.groupBy("__key").agg(F.max(F.struct("__t", "__draw", (F.col("__some") / F.col("n")).alias("part"))).alias("__last"))
    marks = scratch.written(aims.join(cut.select("__key", "__cut"), "__key", "left").join(last, "__key", "left"))

    dealt = _spread_draws(rows, marks, most, few)
    here, end = F.struct(F.col("__t").alias("a"), F.col("__draw").alias("b")), F.struct(F.col("__last.__t").alias("a"), F.col("__last.__draw").alias("b"))
    tie = (F.shiftrightunsigned("__tie", 11) + 0.5) / float(1 << 53) < F.col("__last.part")
    taken = F.when(F.col("__t").isNull(), False).when(F.col("__cut").isNull() | (F.col("__range") < F.col("__cut")), True).when((F.col("__range") > F.col("__cut")) | F.col("__last").isNull(), False)
    one_more = taken.when(here < end, True).when(here == end, tie).otherwise(False)
    copies = (F.col("__whole") + one_more.cast("int")).cast("int")
    return dealt.select(*with_own(kept), F.col("__size").alias("size"), "source_size", "target", F.col("__rate").alias("rate"), copies.alias("copies"), (copies * F.col("__size")).cast("long").alias("taken"))
