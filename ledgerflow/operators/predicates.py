"""Many rules over many rows, as joins: an index from the values of the data to the rules they fit.

A rule maps keys to a glob or to alternative globs; every key must fit, a null value fits none, and a
rule without keys fits every row. Evaluated as Columns, each rule would sit in the plan of each row.
Here rules are rows of a table, so that the plan has one size whatever their number:

* rows are reduced to their distinct combinations of the keys that rules ask for, and these to
  distinct (key, value) pairs: rules meet each value once, however many rows have it;
* globs without wildcards are postings, met by an equi-join on (key, lowered value);
* other globs wait in a prefix table under the literal text before their first wildcard. A value
  looks its prefixes up, of the lengths that occur for its key, and only globs found there are
  compared with it. A glob that starts with a wildcard is compared with all distinct values of its key;
* values of a key that fit the same globs are one class, and rules meet the distinct combinations of
  classes: their number is that of the globs' overlaps and does not grow with the values;
* a combination fits a rule that is in the lists of its classes for all of the rule's keys. The lists are
  intersected in place: rules that fit one key only make no rows.

Matching is without regard to case, as ``exprs.matches_any`` has it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.exprs import glob_pattern
from ledgerflow.sources.stored import Scratch

Rule = Mapping[str, str | Sequence[str]]

#: Rules up to which Columns in the plan are the simpler way.
FEW_RULES = 32
#: Values of a key with a class up to which they are broadcast.
FEW_VALUES = 100_000

_SCHEMA = "rule long, key string, n_keys int, literal string, prefix string, length int, pattern string"


def literal_prefix(glob: str) -> str:
    """The text before the first wildcard."""
    ends = [glob.index(w) for w in "*?[" if w in glob]
    return glob[: min(ends)] if ends else glob


def conditions(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """One row for each alternative of each key of each rule; rules are numbered by their place."""
    rows = []
    for number, rule in enumerate(rules):
        for key, wanted in rule.items():
            for glob in [wanted] if isinstance(wanted, str) else wanted:
                prefix = literal_prefix(glob)
                rows.append((number, key, len(rule), glob.lower() if prefix == glob else None, prefix.lower(), len(prefix), glob_pattern(glob)))
    return spark.createDataFrame(rows, _SCHEMA)


def keys_of(rules: Sequence[Rule]) -> list[str]:
    return sorted({k for rule in rules for k in rule})


def combination(keys: Sequence[str]) -> dict[str, Column]:
    """Two hashes c1 and c2 that name a row's combination of values; nulls count as values."""
    parts = [p for k in keys for p in (F.col(k).cast("string"), F.col(k).isNull())]
    return {"c1": F.xxhash64(F.lit(0), *parts), "c2": F.xxhash64(F.lit(1), *parts)}


def matching(rows: DataFrame, rules: Sequence[Rule], scratch: Scratch | None = None) -> DataFrame:
    """(c1, c2, rule) of every rule that each combination of values in ``rows`` fits."""
    scratch, keys = scratch or Scratch(), keys_of(rules)
    combos, fits = _by_class(rows, rules, keys, scratch)
    every = _of_every(combos, rules)
    if not keys:
        return every
    found = combos.join(fits, ["r1", "r2"]).select("c1", "c2", F.explode("fits").alias("rule"))
    return found if every is None else found.unionByName(every)


def first_match(rows: DataFrame, rules: Sequence[Rule], scratch: Scratch | None = None) -> DataFrame:
    """(c1, c2, rule): the first rule that each combination fits; combinations that fit none are left out."""
    scratch, keys = scratch or Scratch(), keys_of(rules)
    combos, fits = _by_class(rows, rules, keys, scratch)
    every = _of_every(combos, rules)
    if not keys:
        return every.groupBy("c1", "c2").agg(F.min("rule").alias("rule"))
    first = fits.groupBy("r1", "r2").agg(F.min(F.array_min("fits")).alias("rule"))
    found = combos.join(first, ["r1", "r2"]).select("c1", "c2", "rule")
    return found if every is None else found.unionByName(every).groupBy("c1", "c2").agg(F.min("rule").alias("rule"))


def _of_every(combos: DataFrame, rules: Sequence[Rule]) -> DataFrame | None:
    """(c1, c2, rule) of the rules without keys; None if there are none."""
    whole = [n for n, rule in enumerate(rules) if not rule]
    return combos.select("c1", "c2", F.explode(F.array(*map(F.lit, whole)).cast("array<long>")).alias("rule")) if whole or not keys_of(rules) else None


def _by_class(rows: DataFrame, rules: Sequence[Rule], keys: Sequence[str], scratch: Scratch) -> tuple[DataFrame, DataFrame | None]:
    """The combinations (c1, c2, r1, r2), and (r1, r2, fits): the rules with keys that each combination of classes fits.

    A value's class is the smallest value of its key that fits the same globs, and null for values that fit none.
    """
    spark = rows.sparkSession
    named = rows.select(*[F.col(k).cast("string").alias(k) for k in keys])
    combos = scratch.written(named.distinct().withColumns(combination(keys)))
    if not keys:
        return combos, None
    asked = conditions(spark, rules)
    values = scratch.written(_long(combos, keys).select("key", "value").distinct())
    globs = scratch.written(asked.select("key", "literal", "prefix", "length", "pattern").distinct())
    equal = values.withColumn("literal", F.lower("value")).join(globs.filter("literal IS NOT NULL").select("key", "literal", "pattern"), ["key", "literal"])
    wild = globs.filter("literal IS NULL")
    cut = values.join(wild.select("key", "length").distinct(), "key").filter(F.char_length("value") >= F.col("length"))
    under = cut.withColumn("prefix", F.lower(F.substring("value", F.lit(1), F.col("length")))).join(wild.select("key", "length", "prefix", "pattern"), ["key", "length", "prefix"])
    found = [df.filter(F.rlike("value", F.col("pattern"))).select("key", "value", "pattern") for df in (equal, under)]
    met = scratch.written(found[0].unionByName(found[1]).groupBy("key", "value").agg(F.array_sort(F.collect_set("pattern")).alias("patterns")))
    classes = scratch.written(met.groupBy("key", "patterns").agg(F.min("value").alias("class")))
    class_of = scratch.written(met.join(classes, ["key", "patterns"]).select("key", "value", "class"))
    # a key of few values meets the combinations by a broadcast
    many = {r["key"] for r in class_of.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > FEW_VALUES).collect()}
    for k in keys:
        own = class_of.filter(F.col("key") == k).select(F.col("value").alias(k), F.col("class").alias(f"__{k}"))
        combos = combos.join(own if k in many else F.broadcast(own), k, "left")
    of_class = [F.col(f"__{k}").alias(k) for k in keys]
    named_class = combination(keys)
    combos = combos.select("c1", "c2", *of_class).select("c1", "c2", *keys, named_class["c1"].alias("r1"), named_class["c2"].alias("r2"))
    combos = scratch.written(combos)
    # rules that ask for the same keys have one shape; of a shape those fit that are in the lists of all its keys
    shapes = {tuple(sorted(rule)): n for n, rule in enumerate(rules) if rule}
    shape = spark.createDataFrame([(n, shapes[tuple(sorted(rule))]) for n, rule in enumerate(rules) if rule], "rule long, shape long")
    listed = asked.select("key", "pattern", "rule", "n_keys").join(shape, "rule")
    lists = classes.select("key", F.col("class").alias("value"), F.explode("patterns").alias("pattern")).join(listed, ["key", "pattern"])
    lists = scratch.written(lists.groupBy("key", "value", "shape").agg(F.collect_set("rule").alias("rules"), F.max("n_keys").alias("n_keys")))
    distinct = combos.select("r1", "r2", *keys).distinct()
    by_shape = _long(distinct, keys, "r1", "r2").join(lists, ["key", "value"]).groupBy("r1", "r2", "shape").agg(F.collect_list("rules").alias("lists"), F.max("n_keys").alias("n_keys"))
    full = by_shape.filter(F.size("lists") == F.col("n_keys"))
    fits = F.aggregate(F.slice("lists", 2, F.size("lists")), F.get("lists", F.lit(0)), F.array_intersect)
    return combos.select("c1", "c2", "r1", "r2"), scratch.written(full.select("r1", "r2", fits.alias("fits")).filter(F.size("fits") > 0))


def _long(rows: DataFrame, keys: Sequence[str], *names: str) -> DataFrame:
    """(names, key, value) of the values that are not null."""
    return rows.select(*names, F.inline(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).alias("value")) for k in keys]))).filter("value IS NOT NULL")
