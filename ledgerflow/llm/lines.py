"""Line deduplication: lines that many documents share stay only in the last of these documents.

A text is split at line feeds. A line's key is the line without the white space at its ends,
A-Z lowered. Keys of at least ``min_chars`` code points are exploded to 128-bit hashes and their
distinct documents counted; a key found in at least ``min_docs`` documents is common, and all its
lines go, except in the document with the largest id that holds it, where all of them stay.

Counting shuffles hashes and ids only, first by (hash, id) and then one partial count for each hash
and task, so a line that a third of all documents hold is no large group. The verdict joins back to
(row, position): AQE's skew join splits a frequent hash, and the aggregation above it is partial.
Texts are shuffled at most once, to meet the sorted positions that their row loses. They are put
together from the stretches between these positions, in time linear in the lines.

A row is known by two hashes of id and text, so that no row numbers are needed; rows that repeat
both lose the same lines. A null or empty text is one empty line. Rows that share an id are one
document; a null id counts as one document below all others. A text that loses all its lines
becomes empty. Columns named n_lines, n_dropped or kept_text are replaced. Empty input gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import own, with_own, written

#: The characters [\x20\x09-\x0D].
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NEW = ("n_lines", "n_dropped", "kept_text")


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def keyed_lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """(r1, r2, id, position, h1, h2) of the lines with a long enough key of rows (r1, r2, id, text)."""
    exploded = rows.select("r1", "r2", "id", F.posexplode(split_lines(F.translate("text", UPPER, LOWER))).alias("position", "line"))
    # a line that is too short as it stands is not stripped first
    keyed = exploded.filter(F.char_length("line") >= min_chars).withColumn("line", F.btrim("line", F.lit(SPACE)))
    return keyed.filter(F.char_length("line") >= min_chars).select("r1", "r2", "id", "position", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def common_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """(h1, h2, keeper) of the keys that at least ``min_docs`` documents hold."""
    held = lines.select("h1", "h2", "id").distinct()
    counted = held.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"), F.max("id").alias("keeper"))
    return counted.filter(F.col("docs") >= min_docs).select("h1", "h2", "keeper")


def dropped_positions(lines: DataFrame, common: DataFrame) -> DataFrame:
    """(r1, r2, dropped): the sorted positions that a row loses, for rows that lose any."""
    lost = lines.join(common, ["h1", "h2"]).filter(~F.col("id").eqNullSafe(F.col("keeper")))
    return lost.groupBy("r1", "r2").agg(F.sort_array(F.collect_set("position")).alias("dropped"))


def without(text: Column, dropped: Column) -> Column:
    """``text`` less the lines at the positions, made of the stretches between them."""
    lines = split_lines(text)
    bounds = F.concat(F.array(F.lit(-1)), dropped, F.array(F.size(lines)))

    def stretches(s: Column) -> Column:
        start = lambda j: F.get(s["bounds"], j)
        pieces = F.transform(F.sequence(F.lit(0), F.size(s["bounds"]) - 2), lambda j: F.slice(s["lines"], start(j) + 2, start(j + 1) - start(j) - 1))
        return F.array_join(F.flatten(pieces), "\n")

    # a lambda's variable holds lines and bounds, which are so computed once for each text
    return F.get(F.transform(F.array(F.struct(lines.alias("lines"), bounds.alias("bounds"))), stretches), F.lit(0))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """``docs`` with n_lines (before dropping), n_dropped and kept_text."""
    kept = [c for c in (docs.columns if keep is None else keep) if c not in NEW]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    ident = F.col(f"`{id_col}`")
    rows = docs.select(own(docs, kept), ident.alias("id"), text.alias("text"), F.xxhash64(ident, text).alias("r1"), F.xxhash64(F.lit(1), ident, text).alias("r2"))
    lines = keyed_lines(rows.select("r1", "r2", "id", "text"), min_chars)
    # stored first: the join deals its rows for nothing else, so that AQE can split a frequent hash
    dropped = dropped_positions(lines, written(common_lines(lines, min_docs)))
    joined = rows.join(dropped, ["r1", "r2"], "left")
    count = F.size(split_lines(F.col("text"))).cast("long")
    lost = F.coalesce(F.size("dropped"), F.lit(0))
    text_left = F.when(F.col("dropped").isNull(), F.col("text")).otherwise(without(F.col("text"), F.col("dropped")))
    return joined.select(*with_own(kept), count.alias("n_lines"), F.when(F.col("dropped").isNull(), F.lit(0)).otherwise(lost).cast("long").alias("n_dropped"), text_left.alias("kept_text"))


def contract(deduped: DataFrame) -> DataFrame:
    """The digest columns of a deduplicated ``documents`` table."""
    return deduped.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
