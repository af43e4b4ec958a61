"""License scans: diagonal voting of rolling word k-grams against templates.

Texts are lowered A-Z and cut into words. Hashes of all rolling k-grams of a text (k = 2 for
templates of 2 or 3 words, 5 for longer ones) that any template has are kept with their words,
then joined by hash and k with the template positions, the words confirming each match. Votes
are summed by document, template and offset diagonal (text position - template position).
Diagonals at most ``slack`` apart are merged, which allows for inserted and dropped words. A
merged group is verified when it covers at least ``least`` of the template's k-grams (all of
them on one diagonal for phrases of 2 or 3 words).

Phrases of 2 or 3 words count every place where they stand; their diagonals are exact places
and are not merged. Null and empty texts have no words and no labels; repeated rows are judged
one by one (each row keeps a number of its own through one pass, given where the rows have a fixed order).
Templates are lowered as texts are. All spans of a text meet in one row: a text of n words has n / 2 of them at most.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import literal_rows, own, stable, with_own

WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: (label, phrase): every place counts.
PHRASES = (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved"))
#: (label, text): opening sentences of common notices.
NOTICES = (
    ("mit", "Released under the MIT License."),
    ("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-text", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("bsd-text", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-text", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("mpl-2.0-text", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
SHORT, LONG = 2, 5
#: Distinct hashes that are checked before the join, and template rows that are broadcast, at most.
LISTED, BROADCAST_ROWS = 5_000, 200_000


def _words(text: str) -> list[str]:
    """Words as texts have them, which are lowered whole but for the Kelvin sign."""
    return re.findall(WORD_PATTERN, text.replace("\u212a", "\ufffc").lower())


def template_rows(phrases=PHRASES, notices=NOTICES) -> list[tuple]:
    """(template, label, base, k-grams, position, k, words) of each k-gram of each template."""
    rows = []
    for base, listed in ((True, phrases), (False, notices)):
        for number, (label, text) in enumerate(listed):
            words = _words(text)
            k = SHORT if len(words) < LONG else LONG
            grams = [words[i : i + k] for i in range(len(words) - k + 1)]
            if not grams or (base and k != SHORT):
                raise ValueError(f"a template needs two words at least, a phrase four at most: {text!r}")
            name = f"{'phrase' if base else 'notice'}-{number}-{label}"
            rows += [(name, label, base, len(grams), i, k, g) for i, g in enumerate(grams)]
    return rows


def template_table(spark: SparkSession, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """The k-grams of all templates with the hashes they are joined by."""
    return literal_rows(spark, ["template", "label", "base", "t_size", "t_pos", "t_k", "t_gram"], template_rows(phrases, notices)).withColumn("t_key", _key("t_k", "t_gram"))


def _key(k: str, gram: str) -> Column:
    """The hash of a k-gram: its words one by one, as rolled over a text."""
    short, long = (F.xxhash64(*[F.get(F.col(gram), F.lit(j)) for j in range(n)]) for n in (SHORT, LONG))
    return F.when(F.col(k) == SHORT, short).otherwise(long)


def _grams(words: Column, k: int, wanted: list[int] | None) -> Column:
    """Structs (pos, k, gram) of all rolling k-grams, or of those whose hash is wanted."""
    places = F.when(F.size(words) >= k, F.sequence(F.lit(1), F.size(words) - (k - 1))).otherwise(F.array().cast("array<int>"))
    if wanted is not None:
        places = F.filter(places, lambda i: F.xxhash64(*[F.get(words, i + (j - 1)) for j in range(k)]).isin(wanted))
    return F.transform(places, lambda i: F.struct((i - 1).alias("pos"), F.lit(k).alias("k"), F.slice(words, i, F.lit(k)).alias("gram")))


def scan_licenses(docs: DataFrame, templates: DataFrame | None = None, text_col: str = "text", least: float = 0.8, slack: int = 3, keep: list[str] | None = None, listed: int = LISTED, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` with n_words, spans (template, label, base, first, last, coverage), base_starts, base_labels, labels and score.

    ``templates`` come from ``template_table``. They are broadcast up to ``broadcast_rows`` rows and
    joined by shuffle beyond; up to ``listed`` distinct hashes are also checked before the join, so
    that only grams which meet a template leave their text. Other columns travel in one struct.
    """
    new = ("n_words", "spans", "base_starts", "base_labels", "labels", "score")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in new]
    templates = template_table(docs.sparkSession) if templates is None else templates
    keys = templates.select("t_k", "t_key").distinct().limit(listed + 1).collect()
    wanted = {k: sorted(r["t_key"] for r in keys if r["t_k"] == k) if len(keys) <= listed else None for k in (SHORT, LONG)}
    size = templates.limit(broadcast_rows + 1).count()
    templates = templates.select(*[F.col(c).alias(f"__{c}") for c in ("template", "label", "base", "t_size", "t_pos", "t_k", "t_gram", "t_key")])
    # the Kelvin sign is the one letter outside A-Z that lower() turns into ASCII
    text = F.replace(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), F.lit("\u212a"), F.lit("\ufffc"))
    cut = stable(docs).select(F.monotonically_increasing_id().alias("__row"), own(docs, kept), F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0)).alias("__words"))
    found = F.concat(*[_grams(F.col("__words"), k, wanted[k]) for k in (SHORT, LONG)])
    rolled = cut.select("__row", "__page", F.size("__words").cast("long").alias("__n"), found.alias("__grams"))
    # only the first of a text's rows carries the caller's columns
    opened = rolled.select("__row", "__page", "__n", F.posexplode_outer("__grams").alias("__i", "__g"))
    page = F.when(F.coalesce("__i", F.lit(0)) == 0, F.col("__page")).alias("__page")
    rows = opened.select("__row", page, "__n", F.col("__g.k").alias("__k"), F.col("__g.gram").alias("__gram"), F.col("__g.pos").alias("__pos"))
    same = (F.col("__key") == F.col("__t_key")) & (F.col("__k") == F.col("__t_k")) & (F.col("__gram") == F.col("__t_gram"))
    met = rows.withColumn("__key", _key("__k", "__gram")).join(F.broadcast(templates) if size <= broadcast_rows else templates, same, "left").withColumn("__diagonal", F.col("__pos") - F.col("__t_pos"))
    # all that follows is about one row of docs at a time, so one shuffle serves it
    met = met.repartition("__row")
    page = [F.first("__page", ignorenulls=True).alias("__page"), F.first("__n").alias("__n")]
    facts = [F.first(c).alias(c) for c in ("__label", "__base", "__t_size")]
    votes = met.groupBy("__row", "__template", "__diagonal").agg(*page, *facts, F.collect_set("__t_pos").alias("__votes"), F.min("__pos").alias("__first"), F.max(F.col("__pos") + F.col("__k") - 1).alias("__last"))
    by_place = Window.partitionBy("__row", "__template").orderBy("__diagonal")
    opens = F.when(F.col("__base") | (F.col("__diagonal") - F.lag("__diagonal").over(by_place) > slack), 1).otherwise(0)
    numbered = votes.withColumn("__opens", opens).withColumn("__group", F.sum("__opens").over(by_place))
    # a k-gram of the template counts once, on however many of the merged diagonals it was met
    distinct = F.size(F.array_distinct(F.flatten(F.collect_list("__votes"))))
    merged = numbered.groupBy("__row", "__template", "__group").agg(*page, *facts, distinct.alias("__votes"), F.min("__first").alias("__first"), F.max("__last").alias("__last"))
    coverage = F.col("__votes") / F.col("__t_size")
    verified = (F.col("__base") & (F.col("__votes") == F.col("__t_size"))) | (~F.col("__base") & (coverage >= least))
    named = [F.col(f"__{c}").alias(c) for c in ("template", "label", "base")]
    span = F.when(verified, F.struct(*named, F.col("__first").cast("long").alias("first"), F.col("__last").cast("long").alias("last"), coverage.alias("coverage")))
    per_doc = merged.groupBy("__row").agg(*page, F.array_sort(F.collect_list(span)).alias("__spans"), F.max(F.when(F.col("__template").isNotNull(), coverage)).alias("__best"))
    base = F.filter("__spans", lambda s: s["base"])
    return per_doc.select(
        *with_own(kept),
        F.col("__n").alias("n_words"),
        F.col("__spans").alias("spans"),
        F.array_sort(F.transform(base, lambda s: s["first"])).alias("base_starts"),
        F.array_sort(F.array_distinct(F.transform(base, lambda s: s["label"]))).alias("base_labels"),
        F.array_sort(F.array_distinct(F.transform("__spans", lambda s: s["label"]))).alias("labels"),
        F.coalesce("__best", F.lit(0.0)).alias("score"),
    )


def contract(scanned: DataFrame) -> DataFrame:
    """The digest columns of a scanned ``documents`` table."""
    starts = F.col("base_starts")
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.get(starts, F.lit(0)).alias("first_word"),
        F.get(starts, F.size(starts) - 1).alias("last_word"),
        F.concat_ws(",", "base_labels").alias("base_labels"),
        F.concat_ws(",", "labels").alias("labels"),
        "score",
    )
