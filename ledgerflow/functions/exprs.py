"""Scalar expressions shared by all operators; every one is a built-in Spark Column."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that count as blank.
BLANKS = ("", "null", "none", "n/a", "na", "-", "undefined")


def normalise_key(c: Column) -> Column:
    """Lower-cased key of letters and digits only: ``Cost-Center`` gives ``costcenter``; null gives ''."""
    return F.coalesce(F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]", ""), F.lit(""))


def blank_to_null(c: Column) -> Column:
    cut = F.trim(c)
    return F.when(~F.lower(cut).isin(*BLANKS), cut)


def normalise_map(tags: Column) -> Column:
    """Map with normalised keys; of several spellings the first that is not blank wins; null map: empty."""
    none = F.create_map().cast("map<string,string>")
    entries = F.transform(F.map_entries(F.coalesce(tags, none)), lambda e: F.struct(normalise_key(e["key"]).alias("key"), blank_to_null(e["value"]).alias("value")))
    full = F.filter(entries, lambda e: e["value"].isNotNull())
    keys = F.array_distinct(F.transform(full, lambda e: e["key"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.get(F.filter(full, lambda e: e["key"] == k), F.lit(0))["value"]))


def struct_field(df: DataFrame, path: str) -> Column:
    """Nested field, or null when the schema lacks it."""
    kind: T.DataType = df.schema
    for part in path.split("."):
        if not isinstance(kind, T.StructType) or part not in kind.fieldNames():
            return F.lit(None).cast("string")
        kind = kind[part].dataType
    return F.col(path)


def lookup(values: Mapping, key: Column) -> Column:
    """Value of a small literal mapping, null for a missing key."""
    if not values:
        return F.lit(None)
    return F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), key)


def glob_pattern(glob: str) -> str:
    """Anchored regular expression of a glob with ``*``, ``?`` and ``[set]``."""
    out, i = "", 0
    while i < len(glob):
        c = glob[i]
        end = glob.find("]", i + 2)
        if c == "[" and end > 0:
            body = glob[i + 1 : end].replace("\\", "\\\\")
            out += f"[{'^' + body[1:] if body[0] == '!' else body}]"
            i = end
        else:
            out += {"*": ".*", "?": "."}.get(c, re.escape(c))
        i += 1
    return f"(?is)^{out}$"


def matches_any(c: Column, globs: Iterable[str]) -> Column:
    """True where the value fits one of the globs; null fits none."""
    out = F.lit(False)
    for g in globs:
        out = out | F.coalesce(c.rlike(glob_pattern(g)), F.lit(False))
    return out


def scope_matches(scope: Mapping[str, str | list[str]]) -> Column:
    """All keys must fit, values of a list are alternatives, an empty scope fits all rows."""
    out = F.lit(True)
    for key, wanted in scope.items():
        out = out & matches_any(F.col(key).cast("string"), [wanted] if isinstance(wanted, str) else wanted)
    return out


def rounded(c: Column, digits: int) -> Column:
    """Half-up rounding that treats values within 1e-9 of a tie as ties, whatever their binary form."""
    return F.round(c + F.signum(c) * F.lit(1e-9), digits)


def ratio(num: Column, den: Column, digits: int = 4, otherwise: float | None = None) -> Column:
    return F.when(den > 0, rounded(num / den, digits)).otherwise(F.lit(otherwise))


def fixed(c: Column, digits: int = 6) -> Column:
    """Nearest multiple of 10**-digits, without a detour over decimals."""
    return F.rint(c * F.lit(float(10**digits))) / F.lit(float(10**digits))


def _millionths(c: Column) -> Column:
    return F.rint(F.coalesce(c, F.lit(0.0)) * 1e6).cast("long")


def money(c: Column) -> Column:
    """Exact sum of amounts with six decimals, as double: a sum of whole millionths, up to 9.2e12 in all."""
    return F.sum(_millionths(c)).cast("double") / 1e6


def money_alone(c: Column) -> Column:
    """``money`` of a group of one row."""
    return _millionths(c).cast("double") / 1e6


def money_if(cond: Column, c: Column) -> Column:
    return money(F.when(cond, c))


def fingerprint(*parts: Column) -> Column:
    """First 16 hex digits of the SHA-256 of the parts joined by a pipe; null as ''."""
    joined = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.substring(F.sha2(joined, 256), 1, 16)


def median_of(values: Column) -> Column:
    """Median of an array of doubles; null when empty."""
    s = F.array_sort(values)
    n = F.size(values)
    return F.when(n > 0, (F.get(s, ((n - 1) / 2).cast("int")) + F.get(s, (n / 2).cast("int"))) / 2)


def mean_of(values: Column) -> Column:
    return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values))


def pstdev_of(values: Column) -> Column:
    mean = mean_of(values)
    return F.sqrt(mean_of(F.transform(values, lambda x: (x - mean) * (x - mean))))
