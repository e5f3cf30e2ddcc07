"""Silver tables: canonical names, types, defaults, first row per key, rejects with a reason."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.config import SOURCES
from plumbline.functions.casts import blank_to_null, to_date, to_int, to_money, to_timestamp
from plumbline.functions.names import canonicalize
from plumbline.operators.dedupe import reject_duplicates

# Texts that mean an active product.
ACTIVE_TEXT = ("true", "1", "yes", "active")

Rules = Callable[[DataFrame], dict[str, Column]]


def _text(df: DataFrame, name: str) -> Column:
    return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")


def _lower(df: DataFrame, name: str, default: str | None) -> Column:
    value = F.lower(blank_to_null(_text(df, name)))
    return value if default is None else F.coalesce(value, F.lit(default))


def ecommerce_rules(df: DataFrame) -> dict[str, Column]:
    return {
        "order_ts": to_timestamp(_text(df, "order_ts")),
        "amount": to_money(_text(df, "amount")),
        "quantity": to_int(_text(df, "quantity"), 1),
        "status": _lower(df, "status", "pending"),
        "campaign_id": F.coalesce(_text(df, "campaign_id"), F.lit("unknown")),
    }


def marketing_rules(df: DataFrame) -> dict[str, Column]:
    return {
        "campaign_date": to_date(_text(df, "campaign_date")),
        "spend": to_money(_text(df, "spend")),
        "impressions": to_int(_text(df, "impressions")),
        "clicks": to_int(_text(df, "clicks")),
        "channel": _lower(df, "channel", "unknown"),
    }


def behavior_rules(df: DataFrame) -> dict[str, Column]:
    return {
        "event_ts": to_timestamp(_text(df, "event_ts")),
        "event_type": _lower(df, "event_type", "unknown"),
    }


def product_rules(df: DataFrame) -> dict[str, Column]:
    active = (
        F.coalesce(_lower(df, "active_flag", None).isin(*ACTIVE_TEXT), F.lit(False))
        if "active_flag" in df.columns else F.lit(True)
    )
    return {"active_flag": active, "list_price": to_money(_text(df, "list_price"))}


def ops_rules(df: DataFrame) -> dict[str, Column]:
    return {
        "event_ts": to_timestamp(_text(df, "event_ts")),
        "runtime_seconds": to_int(_text(df, "runtime_seconds")),
        "status": _lower(df, "status", ""),
    }


def target_rules(df: DataFrame) -> dict[str, Column]:
    return {
        "revenue_target": to_money(_text(df, "revenue_target")),
        "orders_target": to_int(_text(df, "orders_target")),
    }


def crm_rules(df: DataFrame) -> dict[str, Column]:
    return {
        "created_ts": to_timestamp(_text(df, "created_ts")),
        "priority": _lower(df, "priority", "medium"),
        "status": _lower(df, "status", "open"),
    }


RULES: dict[str, Rules] = {
    "ecommerce_transactions": ecommerce_rules,
    "marketing_campaigns": marketing_rules,
    "customer_behavior": behavior_rules,
    "product_catalog": product_rules,
    "operational_logs": ops_rules,
    "targets_planning": target_rules,
    "crm_support": crm_rules,
}


def typed(df: DataFrame, source: str) -> DataFrame:
    """Canonical, typed columns; contract columns no file carried are added as NULL."""
    spec = SOURCES[source]
    canonical = canonicalize(df, spec.aliases)
    result = canonical.withColumns(RULES[source](canonical))
    absent = [column for column in spec.schema if column not in result.columns]
    return result.withColumns({column: F.lit(None).cast("string") for column in absent})


def standardize(df: DataFrame, source: str, order: list[str]) -> DataFrame:
    """Bronze rows -> silver rows with ``_reject_reason`` (NULL = accepted).

    ``order`` is the file order that decides which of several rows with one key is kept.
    """
    rows = typed(df, source)
    negative = (F.col("amount") < 0, "negative amount") if source == "ecommerce_transactions" else None
    marked = reject_duplicates(rows, SOURCES[source].primary_key, order, bad=negative)
    if source == "targets_planning":
        marked = marked.withColumn("target_date", to_date(F.col("target_date")))
    return marked


STANDARDIZERS: dict[str, Callable[[DataFrame, list[str]], DataFrame]] = {
    source: (lambda df, order, source=source: standardize(df, source, order)) for source in SOURCES
}
