"""URL filters: host-suffix and path-prefix expressions met with rules by hash prefix.

Each URL gives the host suffixes (at label borders) of up to as many labels as the deepest rule
host has, joined with the path prefixes of the lengths that rule paths have. An equi-join on the first 8 hex digits of the SHA-256 of an
expression finds candidate rules, the full digests confirm them, and the longest rule wins
(then the longest host, then block before allow). URLs without a rule get ``default``.

Each row keeps a number of its own through one pass, given where the rows have a fixed order, so that repeated rows stay apart. Other
columns travel in one struct and may have any name; host, path, rule and verdict are replaced.

Rules are broadcast while their count is at most ``broadcast_rules``; a larger list is joined
by shuffle. Null URLs and URLs without "://" have empty host and path and so no rule; repeated
rows are judged one by one; an empty rule list gives every URL the default.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm.common import literal_rows, own, stable, with_own

#: (verdict, host, path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Rules above which the rule table is not broadcast.
BROADCAST_RULES = 200_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return literal_rows(spark, ["verdict", "host", "path"], list(rules))


def filter_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow", broadcast_rules: int = BROADCAST_RULES) -> DataFrame:
    """``pages`` with host, path, rule and verdict."""
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    keyed = F.sha2(F.concat("host", "path"), 256)
    labels = F.size(F.split("host", r"\.", -1))
    ready = rules.distinct().select(F.col("verdict").alias("__r_verdict"), F.col("host").alias("__r_host"), F.concat("host", "path").alias("__r_rule"), F.length("path").alias("__r_len"), labels.alias("__r_labels"), keyed.alias("__r_digest"))
    ready = ready.withColumn("__r_key", F.substring("__r_digest", 1, 8))
    sizes = ready.agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set("__r_len")).alias("lengths"), F.coalesce(F.max("__r_labels"), F.lit(0)).alias("labels")).first()
    if sizes["n"] <= broadcast_rules:
        ready = F.broadcast(ready)

    url = F.col(f"`{url_col}`")
    after = F.when(F.instr(url, "://") > 0, F.expr(f"substring(`{url_col}`, instr(`{url_col}`, '://') + 3)")).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(F.coalesce(after, F.lit("")), r"^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(F.coalesce(after, F.lit("")), r"^[^/?#]*([^?#]*)", 1)
    base = stable(pages).select(own(pages, kept), F.monotonically_increasing_id().alias("__row"), host.alias("__host"), path.alias("__path"))
    # the end of the host that the deepest rule can reach, with the labels in front of it left out
    tail = F.substring_index("__host", ".", -max(1, sizes["labels"]))
    parts = F.split(tail, r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    suffixes = F.when(F.lit(sizes["labels"] > 0), suffixes).otherwise(F.array().cast("array<string>"))
    lengths = F.filter(F.array(*[F.lit(n) for n in sizes["lengths"]]).cast("array<int>"), lambda n: n <= F.length("__path"))
    prefixes = F.transform(lengths, lambda n: F.substring(F.col("__path"), F.lit(1), n))
    expressions = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    # only the first of a URL's rows carries the caller's columns
    opened = base.select("*", F.posexplode_outer(expressions).alias("__i", "__expression"))
    first = F.coalesce("__i", F.lit(0)) == 0
    opened = opened.withColumns({c: F.when(first, F.col(c)) for c in ("__page", "__host", "__path")})
    named = opened.withColumn("__digest", F.sha2("__expression", 256)).withColumn("__key", F.substring("__digest", 1, 8))
    met = named.join(ready, (F.col("__key") == F.col("__r_key")) & (F.col("__digest") == F.col("__r_digest")), "left")
    rank = F.struct(F.length("__r_rule").alias("a"), F.length("__r_host").alias("b"), (F.col("__r_verdict") == "block").cast("int").alias("c"))
    rule = F.max_by(F.struct("__r_rule", "__r_verdict"), F.when(F.col("__r_rule").isNotNull(), rank)).alias("__best")
    rows = met.groupBy("__row").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("__page", "__host", "__path")], rule)
    return rows.select(*with_own(kept), F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__best.__r_rule").alias("rule"), F.coalesce("__best.__r_verdict", F.lit(default)).alias("verdict"))
