"""Typed staging projections over the raw tables: cast, fold evolving columns, drop keyless rows.

No de-duplication happens here; see ``operators.standardize`` for the silver tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.casts import (
    blank_to_null, safe_cast_numeric, to_bool, to_date, to_int, to_timestamp,
)


def _first(df: DataFrame, *names: str) -> Column:
    """First non-blank of the columns that exist."""
    present = [blank_to_null(F.col(name).cast("string")) for name in names if name in df.columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")


def _marks(df: DataFrame) -> dict[str, Column]:
    return {
        "_ingest_batch_id": _first(df, "_ingest_batch_id"),
        "_source_file": _first(df, "_source_file"),
        "_ingested_at": to_timestamp(_first(df, "_ingested_at")),
    }


def _project(df: DataFrame, key: str, columns: dict[str, Column]) -> DataFrame:
    selected = {**columns, **_marks(df)}
    return (
        df.select(*[column.alias(name) for name, column in selected.items()])
        .where(F.col(key).isNotNull())
    )


def stg_ecommerce_transactions(raw: DataFrame) -> DataFrame:
    return _project(raw, "transaction_id", {
        "transaction_id": _first(raw, "transaction_id", "order_id"),
        "customer_id": _first(raw, "customer_id"),
        "product_id": _first(raw, "product_id"),
        "order_ts": to_timestamp(_first(raw, "order_ts", "order_timestamp")),
        "amount": safe_cast_numeric(_first(raw, "amount", "order_value")),
        "status": F.lower(F.coalesce(_first(raw, "status"), F.lit("pending"))),
        "quantity": to_int(_first(raw, "quantity"), 1),
        "campaign_id": F.coalesce(_first(raw, "campaign_id"), F.lit("unknown")),
        "coupon_code": _first(raw, "coupon_code"),
    })


def stg_marketing_campaigns(raw: DataFrame) -> DataFrame:
    return _project(raw, "campaign_id", {
        "campaign_id": _first(raw, "campaign_id"),
        "campaign_date": to_date(_first(raw, "campaign_date")),
        "channel": F.lower(F.coalesce(_first(raw, "channel", "channel_name"), F.lit("unknown"))),
        "spend": safe_cast_numeric(_first(raw, "spend", "spend_usd")),
        "impressions": to_int(_first(raw, "impressions"), None),
        "clicks": to_int(_first(raw, "clicks"), None),
    })


def stg_customer_behavior(raw: DataFrame) -> DataFrame:
    return _project(raw, "event_id", {
        "event_id": _first(raw, "event_id"),
        "customer_id": _first(raw, "customer_id", "user_id"),
        "event_ts": to_timestamp(_first(raw, "event_ts", "event_time")),
        "event_type": F.lower(_first(raw, "event_type")),
        "product_id": _first(raw, "product_id"),
        "session_id": _first(raw, "session_id"),
    })


def stg_product_catalog(raw: DataFrame) -> DataFrame:
    return _project(raw, "product_id", {
        "product_id": _first(raw, "product_id"),
        "product_name": _first(raw, "product_name"),
        "category": _first(raw, "category"),
        "active_flag": to_bool(_first(raw, "active_flag")),
        "list_price": safe_cast_numeric(_first(raw, "list_price")),
    })


def stg_operational_logs(raw: DataFrame) -> DataFrame:
    return _project(raw, "log_id", {
        "log_id": _first(raw, "log_id"),
        "service_name": _first(raw, "service_name"),
        "event_ts": to_timestamp(_first(raw, "event_ts")),
        "status": F.lower(_first(raw, "status")),
        "runtime_seconds": to_int(_first(raw, "runtime_seconds"), None),
    })


def stg_targets_planning(raw: DataFrame) -> DataFrame:
    return _project(raw, "target_date", {
        "target_date": to_date(_first(raw, "target_date")),
        "revenue_target": safe_cast_numeric(_first(raw, "revenue_target")),
        "orders_target": to_int(_first(raw, "orders_target"), None),
    })


def stg_crm_support(raw: DataFrame) -> DataFrame:
    return _project(raw, "ticket_id", {
        "ticket_id": _first(raw, "ticket_id"),
        "customer_id": _first(raw, "customer_id", "user_id"),
        "created_ts": to_timestamp(_first(raw, "created_ts")),
        "priority": F.lower(_first(raw, "priority")),
        "status": F.lower(_first(raw, "status")),
        "topic": _first(raw, "topic"),
    })


STAGING: dict[str, Callable[[DataFrame], DataFrame]] = {
    "ecommerce_transactions": stg_ecommerce_transactions,
    "marketing_campaigns": stg_marketing_campaigns,
    "customer_behavior": stg_customer_behavior,
    "product_catalog": stg_product_catalog,
    "operational_logs": stg_operational_logs,
    "targets_planning": stg_targets_planning,
    "crm_support": stg_crm_support,
}
