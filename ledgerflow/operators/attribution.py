"""Consuming entity and business dimensions of usage records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.exprs import blank_to_null, lookup, normalise_key, struct_field

# Id field and entity type in order of precedence.
ENTITIES = (
    ("job_id", "JOB"),
    ("dlt_pipeline_id", "PIPELINE"),
    ("warehouse_id", "WAREHOUSE"),
    ("endpoint_id", "MODEL_ENDPOINT"),
    ("instance_pool_id", "INSTANCE_POOL"),
    ("cluster_id", "CLUSTER"),
    ("notebook_id", "NOTEBOOK"),
    ("app_id", "APP"),
    ("metastore_id", "METASTORE"),
)
# Accepted spellings of each dimension, the value for unresolved ones, canonical values.
ALIASES = {
    "cost_center": ("cost_center", "costcenter", "cc", "centro_costo", "centrocosto", "cost-center"),
    "team": ("team", "equipo", "squad", "area", "grupo"),
    "project": ("project", "proyecto", "initiative", "producto", "product"),
    "environment": ("environment", "env", "ambiente", "stage", "entorno"),
    "application": ("application", "app", "aplicacion", "sistema", "system"),
    "owner": ("owner", "responsable", "dueno", "contact", "email"),
}
UNALLOCATED = "SIN_ASIGNAR"
WITHOUT_ID = "SIN_ID"
VALUE_MAP = {
    "environment": {
        "prod": "PRD",
        "produccion": "PRD",
        "production": "PRD",
        "prd": "PRD",
        "qa": "QA",
        "staging": "QA",
        "stg": "QA",
        "test": "QA",
        "dev": "DEV",
        "desarrollo": "DEV",
        "development": "DEV",
        "sandbox": "DEV",
    }
}


def alias_index(aliases: Mapping[str, tuple[str, ...]] = ALIASES) -> dict[str, list[str]]:
    """Normalised alias keys of each dimension; the first declaration of an alias wins."""
    taken: set[str] = set()
    out: dict[str, list[str]] = {}
    for dimension, names in aliases.items():
        keys = [k for k in dict.fromkeys("".join(c for c in n.lower() if c.isascii() and c.isalnum()) for n in names) if k not in taken]
        taken.update(keys)
        out[dimension] = keys
    return out


def with_entity(df: DataFrame, prefix: str = "usage_metadata") -> DataFrame:
    """entity_type, entity_id and entity_key of the first id that is present."""
    found = F.coalesce(*[F.when(blank_to_null(struct_field(df, f"{prefix}.{field}")).isNotNull(), F.struct(F.lit(kind).alias("type"), blank_to_null(struct_field(df, f"{prefix}.{field}")).alias("id"))) for field, kind in ENTITIES])
    kind = F.coalesce(found["type"], F.lit("UNKNOWN"))
    return df.withColumns({"entity_type": kind, "entity_id": found["id"], "entity_key": F.concat_ws(":", kind, F.coalesce(found["id"], F.lit(WITHOUT_ID)))})


def canonical(value: Column, values: Mapping[str, str]) -> Column:
    return F.coalesce(lookup({"".join(c for c in k.lower() if c.isalnum()): v for k, v in values.items()}, normalise_key(value)), value) if values else value


#: Places of one dimension's aliases in the codes of ``tag_hits``.
_SPAN = 1000


def tag_hits(tags: Column, aliases: Mapping = ALIASES) -> Column:
    """Structs (code, place, value) of a map's entries whose key is an alias and whose value is not blank.

    The code is the dimension's number times a span plus the alias's rank, so that the smallest
    struct of a dimension is its best alias and, of several spellings of one, the first.
    """
    codes = {key: d * _SPAN + rank for d, keys in enumerate(alias_index(aliases).values()) for rank, key in enumerate(keys)}
    entry = lambda e, i: F.struct(lookup(codes, normalise_key(e["key"])).alias("code"), i.alias("place"), blank_to_null(e["value"]).alias("value"))
    return F.filter(F.transform(F.map_entries(tags), entry), lambda h: h["code"].isNotNull() & h["value"].isNotNull())


def best_hit(hits: Column, number: int) -> Column:
    return F.array_min(F.filter(hits, lambda h: h["code"].between(number * _SPAN, (number + 1) * _SPAN - 1)))["value"]


def resolved(df: DataFrame, tags: str, name: str, aliases: Mapping = ALIASES) -> DataFrame:
    """``df`` with the map column ``tags`` replaced by ``name``, a struct of the value of each dimension."""
    hits = df.withColumn("__hits", tag_hits(F.col(tags), aliases))
    return hits.withColumn(name, F.struct(*[best_hit(F.col("__hits"), i).alias(d) for i, d in enumerate(aliases)])).drop("__hits", *([tags] if tags != name else []))


def with_dimensions(df: DataFrame, defaults: Mapping[str, Mapping[str, str]] | None = None, aliases: Mapping = ALIASES, value_map: Mapping = VALUE_MAP) -> DataFrame:
    """Resolve every dimension: usage tags, then cluster tags, job tags, workspace default, else unallocated.

    Needs custom_tags and workspace_id. cluster_dims and job_dims are used if present: the tags of
    clusters and jobs, resolved on their own small tables before they met the usage.
    """
    ready = df.withColumn("__hits", tag_hits(F.col("custom_tags"), aliases))
    ready = ready.withColumns({f"__{d}": best_hit(F.col("__hits"), i) for i, d in enumerate(aliases)})
    others = [(c, name) for c, name in (("cluster_dims", "cluster"), ("job_dims", "job")) if c in df.columns]
    columns: dict[str, Column] = {}
    for dimension in aliases:
        values = [(F.col(f"__{dimension}"), "usage"), *[(F.col(f"{c}.{dimension}"), name) for c, name in others]]
        fixed = {ws: d[dimension] for ws, d in (defaults or {}).items() if d.get(dimension)}
        if fixed:
            values.append((lookup(fixed, F.col("workspace_id")), "workspace"))
        source = F.lit("none")
        for value, name in reversed(values):
            source = F.when(value.isNotNull(), F.lit(name)).otherwise(source)
        columns[dimension] = F.coalesce(canonical(F.coalesce(*[v for v, _ in values]), value_map.get(dimension, {})), F.lit(UNALLOCATED))
        columns[f"{dimension}_source"] = source
    out = ready.withColumns(columns).drop("__hits", *[f"__{d}" for d in aliases], *[c for c, _ in others])
    count = sum((F.col(f"{d}_source") != "none").cast("int") for d in aliases)
    out = out.withColumns({"tags_resolved": count, "tags_expected": F.lit(len(aliases))})
    return out.withColumns({"is_fully_tagged": F.col("tags_resolved") == F.col("tags_expected"), "is_untagged": F.col("tags_resolved") == 0})
