"""SKU classes, discounts, infrastructure factors and the price of a usage record."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow.functions.exprs import fixed, lookup, matches_any

# SKU patterns in order of precedence, matched without regard to case.
SKU_PATTERNS = (
    (r"SERVERLESS.*(SQL|DBSQL)", "SERVERLESS_SQL"),
    (r"(SQL|DBSQL).*SERVERLESS", "SERVERLESS_SQL"),
    (r"SERVERLESS.*(JOB|WORKFLOW|TASK)", "SERVERLESS_JOBS"),
    (r"(JOB|WORKFLOW).*SERVERLESS", "SERVERLESS_JOBS"),
    (r"SERVERLESS.*(DLT|PIPELINE)", "SERVERLESS_DLT"),
    (r"(DLT|PIPELINE).*SERVERLESS", "SERVERLESS_DLT"),
    (r"(REAL_TIME_INFERENCE|MODEL_SERVING|INFERENCE|VECTOR_SEARCH)", "MODEL_SERVING"),
    (r"(FINE_TUNING|MODEL_TRAINING|GPU.*TRAINING|MOSAIC)", "AI_TRAINING"),
    (r"(PREDICTIVE_OPTIMIZATION|LAKEHOUSE_MONITORING|MANAGED_STORAGE|ONLINE_TABLE)", "STORAGE_OPS"),
    (r"DLT|DELTA_LIVE|PIPELINE", "DLT"),
    (r"ALL_PURPOSE|INTERACTIVE|NOTEBOOK", "ALL_PURPOSE"),
    (r"(^|_)JOBS?(_|$)|AUTOMATED", "JOBS"),
    (r"SQL", "SQL"),
)
# Class of a billing product.
PRODUCT_GROUPS = {
    "ALL_PURPOSE": "ALL_PURPOSE",
    "INTERACTIVE": "ALL_PURPOSE",
    "NOTEBOOKS": "ALL_PURPOSE",
    "JOBS": "JOBS",
    "WORKFLOWS": "JOBS",
    "DLT": "DLT",
    "LAKEFLOW_PIPELINES": "DLT",
    "SQL": "SQL",
    "DBSQL": "SQL",
    "MODEL_SERVING": "MODEL_SERVING",
    "REAL_TIME_INFERENCE": "MODEL_SERVING",
    "VECTOR_SEARCH": "MODEL_SERVING",
    "AGENT_EVALUATION": "MODEL_SERVING",
    "FINE_TUNING": "AI_TRAINING",
    "MODEL_TRAINING": "AI_TRAINING",
    "PREDICTIVE_OPTIMIZATION": "STORAGE_OPS",
    "LAKEHOUSE_MONITORING": "STORAGE_OPS",
    "ONLINE_TABLES": "STORAGE_OPS",
}
# Cost of machines as a share of the unit cost, by compute family.
INFRA_FACTORS = {"ALL_PURPOSE": 0.85, "JOBS": 0.85, "DLT": 0.70, "SQL": 0.60, "SERVERLESS": 0.0, "OTHER": 0.60}
NO_DISCOUNT = "sin_descuento"


def has_token(token: str, *cols: Column) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | F.coalesce(F.upper(c).contains(token), F.lit(False))
    return out


def sku_group(sku: Column, product: Column) -> Column:
    serverless = has_token("SERVERLESS", sku, product)
    known = lookup(PRODUCT_GROUPS, F.upper(F.trim(product)))
    by_product = F.when(serverless & known.isin("SQL", "JOBS", "DLT"), F.concat(F.lit("SERVERLESS_"), known)).otherwise(known)
    by_sku = F.when(F.lit(False), F.lit(None).cast("string"))
    for pattern, group in SKU_PATTERNS:
        by_sku = by_sku.when(sku.rlike(f"(?i){pattern}"), F.lit(group))
    return F.coalesce(by_product, by_sku, F.when(serverless, F.lit("SERVERLESS_JOBS")).otherwise(F.lit("OTHER")))


def compute_family(group: Column) -> Column:
    return F.when(group.startswith("SERVERLESS"), F.lit("SERVERLESS")).when(group.isin("ALL_PURPOSE", "JOBS", "DLT", "SQL"), group).otherwise(F.lit("OTHER"))


def discount_struct(pct: Column | None = None, name: Column | None = None) -> Column:
    """struct(pct within 0 and 0.999, name); without a rule no discount."""
    share = F.lit(0.0) if pct is None else F.least(F.greatest(pct, F.lit(0.0)), F.lit(0.999))
    return F.struct(share.alias("pct"), (F.lit(NO_DISCOUNT) if name is None else name).alias("name"))


def discount(rules: Sequence[Mapping]) -> Column:
    """struct(pct, name) of the first rule that fits; every key of a rule must fit, null fits nothing."""
    out = discount_struct()
    for rule in reversed(rules):
        fits = F.lit(True)
        for key, wanted in rule.get("match", {}).items():
            fits = fits & matches_any(F.col(key), [wanted] if isinstance(wanted, str) else wanted)
        pct = min(max(float(rule["discount_pct"]), 0.0), 0.999)
        out = F.when(fits, F.struct(F.lit(pct).alias("pct"), F.lit(rule["name"]).alias("name"))).otherwise(out)
    return out


def infra_factor(family: Column, enabled: bool, factors: Mapping[str, float]) -> Column:
    if not enabled:
        return F.lit(0.0)
    return F.coalesce(lookup(factors, family), F.lit(float(factors.get("OTHER", 0.0))))


def priced_columns(rules: Sequence[Mapping], infra: bool, factors: Mapping[str, float] = INFRA_FACTORS, found: Column | None = None) -> list[dict[str, Column]]:
    """Column groups to add one after another to usage with ``unit_price`` and ``usage_quantity``; ``found`` is a discount known already."""
    list_cost = fixed(F.coalesce(F.col("usage_quantity"), F.lit(0.0)) * F.coalesce(F.col("unit_price"), F.lit(0.0)))
    return [
        {
            "sku_group": sku_group(F.col("sku_name"), F.col("billing_origin_product")),
            "is_serverless": has_token("SERVERLESS", F.col("sku_name"), F.col("billing_origin_product")),
            "is_photon": has_token("PHOTON", F.col("sku_name")),
            "price_missing": F.col("unit_price").isNull(),
            "__discount": discount(rules) if found is None else found,
            "list_cost_usd": list_cost,
        },
        {"compute_family": compute_family(F.col("sku_group")), "discount_pct": F.col("__discount.pct"), "discount_rule": F.col("__discount.name")},
        {"discount_usd": fixed(F.col("list_cost_usd") * F.col("discount_pct"))},
        {"effective_cost_usd": fixed(F.col("list_cost_usd") - F.col("discount_usd"))},
        {"infra_cost_usd": fixed(F.col("effective_cost_usd") * infra_factor(F.col("compute_family"), infra, factors))},
        {"total_cost_usd": fixed(F.col("effective_cost_usd") + F.col("infra_cost_usd"))},
    ]
