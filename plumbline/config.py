"""Sources, contracts, suites and reference lists.

Everything below is fixed configuration: results only match when these values do. Pass your
own objects of the same shape to the operators to check other sources.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class SourceSpec:
    """One source system and its contract."""

    name: str
    dataset: str
    owner: str
    domain: str
    criticality: str
    tier: str
    primary_key: str
    schema: dict[str, str]
    optional: tuple[str, ...] = ()
    renames: dict[str, str] = field(default_factory=dict)
    extra_aliases: dict[str, str] = field(default_factory=dict)
    null_thresholds: dict[str, float] = field(default_factory=dict)
    accepted_values: dict[str, tuple[str, ...]] = field(default_factory=dict)
    freshness_minutes: int = 1440
    compatibility: str = "backward_compatible"
    quarantine: bool = False
    downstream: tuple[str, ...] = ()

    @property
    def required(self) -> list[str]:
        return [column for column in self.schema if column not in self.optional]

    @property
    def aliases(self) -> dict[str, str]:
        return {**self.renames, **self.extra_aliases}

    @property
    def raw_columns(self) -> list[str]:
        """Column whitelist of the raw table: each column, the names it may arrive under, ingest marks."""
        columns: list[str] = []
        for column in self.schema:
            columns.append(column)
            columns += [old for old, new in self.renames.items() if new == column]
        return columns + ["_ingest_batch_id", "_source_file", "_ingested_at"]


def _zero(*columns: str, **others: float) -> dict[str, float]:
    return {**{column: 0.0 for column in columns}, **others}


# The seven source contracts.
SOURCES: dict[str, SourceSpec] = {
    spec.name: spec
    for spec in [
        SourceSpec(
            name="ecommerce_transactions", dataset="orders", owner="data-platform",
            domain="revenue", criticality="critical", tier="tier_1", primary_key="transaction_id",
            schema={
                "transaction_id": "string", "customer_id": "string", "product_id": "string",
                "order_ts": "timestamp", "amount": "decimal", "status": "string",
                "quantity": "integer", "campaign_id": "string", "coupon_code": "string",
            },
            optional=("quantity", "campaign_id", "coupon_code"),
            renames={"order_id": "transaction_id", "order_value": "amount", "order_timestamp": "order_ts"},
            extra_aliases={"user_id": "customer_id"},
            null_thresholds=_zero(
                "transaction_id", "product_id", "order_ts", "amount", "status", customer_id=0.05),
            accepted_values={"status": ("completed", "refunded", "failed", "pending")},
            freshness_minutes=1440, quarantine=True,
            downstream=(
                "gold_customer_analytics", "gold_revenue_analytics", "gold_marketing_attribution",
                "gold_product_performance", "gold_target_vs_actual"),
        ),
        SourceSpec(
            name="marketing_campaigns", dataset="campaign_spend", owner="growth-analytics",
            domain="marketing", criticality="high", tier="tier_2", primary_key="campaign_id",
            schema={
                "campaign_id": "string", "campaign_date": "date", "channel": "string",
                "spend": "decimal", "impressions": "integer", "clicks": "integer",
            },
            optional=("impressions", "clicks"),
            renames={"spend_usd": "spend", "channel_name": "channel"},
            null_thresholds=_zero("campaign_id", "campaign_date", "channel", "spend"),
            freshness_minutes=1440,
            downstream=("gold_marketing_attribution",),
        ),
        SourceSpec(
            name="customer_behavior", dataset="behavior_events", owner="product-analytics",
            domain="product", criticality="high", tier="tier_2", primary_key="event_id",
            schema={
                "event_id": "string", "customer_id": "string", "event_ts": "timestamp",
                "event_type": "string", "product_id": "string", "session_id": "string",
            },
            optional=("product_id", "session_id"),
            renames={"user_id": "customer_id", "event_time": "event_ts"},
            null_thresholds=_zero("event_id", "event_ts", "event_type", customer_id=0.02),
            freshness_minutes=360, quarantine=True,
            downstream=("gold_customer_analytics",),
        ),
        SourceSpec(
            name="product_catalog", dataset="products", owner="merchandising-analytics",
            domain="merchandising", criticality="high", tier="tier_2", primary_key="product_id",
            schema={
                "product_id": "string", "product_name": "string", "category": "string",
                "active_flag": "boolean", "list_price": "decimal",
            },
            optional=("list_price",),
            null_thresholds=_zero("product_id", "product_name", "category", "active_flag"),
            freshness_minutes=2880,
            downstream=("gold_product_performance",),
        ),
        SourceSpec(
            name="operational_logs", dataset="pipeline_service_logs", owner="data-platform",
            domain="platform_operations", criticality="critical", tier="tier_1", primary_key="log_id",
            schema={
                "log_id": "string", "service_name": "string", "event_ts": "timestamp",
                "status": "string", "runtime_seconds": "integer",
            },
            optional=("runtime_seconds",),
            null_thresholds=_zero("log_id", "service_name", "event_ts", "status"),
            accepted_values={"status": ("ok", "warning", "failed")},
            freshness_minutes=60, quarantine=True,
            downstream=("gold_operational_metrics",),
        ),
        SourceSpec(
            name="targets_planning", dataset="revenue_targets", owner="finance-analytics",
            domain="finance", criticality="critical", tier="tier_1", primary_key="target_date",
            schema={"target_date": "date", "revenue_target": "decimal", "orders_target": "integer"},
            null_thresholds=_zero("target_date", "revenue_target", "orders_target"),
            freshness_minutes=10080,
            downstream=("gold_revenue_analytics", "gold_target_vs_actual"),
        ),
        SourceSpec(
            name="crm_support", dataset="support_tickets", owner="support-operations",
            domain="support", criticality="medium", tier="tier_2", primary_key="ticket_id",
            schema={
                "ticket_id": "string", "customer_id": "string", "created_ts": "timestamp",
                "priority": "string", "status": "string", "topic": "string",
            },
            optional=("topic",),
            renames={"user_id": "customer_id"},
            null_thresholds=_zero("ticket_id", "created_ts", "priority", "status", customer_id=0.05),
            accepted_values={"priority": ("low", "medium", "high", "urgent")},
            freshness_minutes=1440,
            downstream=("gold_customer_analytics",),
        ),
    ]
}


@dataclass(frozen=True)
class Suite:
    """Quality checks of one table."""

    required: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    null_rates: dict[str, float] = field(default_factory=dict)
    accepted_values: dict[str, tuple[str, ...]] = field(default_factory=dict)
    non_negative: tuple[str, ...] = ()


# Quality suites of the silver tables.
QUALITY_SUITES: dict[str, Suite] = {
    "silver_ecommerce_transactions": Suite(
        required=("transaction_id", "customer_id", "product_id", "order_ts", "amount", "status"),
        unique=("transaction_id",),
        null_rates={"transaction_id": 0.0, "customer_id": 0.01, "amount": 0.02},
        accepted_values={"status": ("completed", "refunded", "failed", "pending")},
        non_negative=("amount",),
    ),
    "silver_marketing_campaigns": Suite(
        required=("campaign_id", "campaign_date", "channel", "spend"),
        unique=("campaign_id",),
        null_rates={"campaign_id": 0.0, "spend": 0.05},
        non_negative=("spend",),
    ),
    "silver_customer_behavior": Suite(
        required=("event_id", "customer_id", "event_ts", "event_type"),
        unique=("event_id",),
        null_rates={"event_id": 0.0, "customer_id": 0.05},
    ),
    "silver_product_catalog": Suite(
        required=("product_id", "product_name", "category", "active_flag"),
        unique=("product_id",),
        null_rates={"product_id": 0.0, "category": 0.02},
    ),
    "silver_operational_logs": Suite(
        required=("log_id", "service_name", "event_ts", "status"),
        unique=("log_id",),
        accepted_values={"status": ("ok", "warning", "failed")},
    ),
    "silver_targets_planning": Suite(
        required=("target_date", "revenue_target", "orders_target"),
        unique=("target_date",),
        non_negative=("revenue_target", "orders_target"),
    ),
    "silver_crm_support": Suite(
        required=("ticket_id", "customer_id", "created_ts", "priority", "status"),
        unique=("ticket_id",),
        accepted_values={"priority": ("low", "medium", "high", "urgent")},
    ),
}

# Declarative expectations (type, column, arguments).
EXPECTATIONS: dict[str, list[tuple[str, str, dict]]] = {
    "silver_ecommerce_transactions": [
        ("not_null", "transaction_id", {}),
        ("unique", "transaction_id", {}),
        ("not_null", "customer_id", {"mostly": 0.99}),
        ("between", "amount", {"min_value": 0}),
        ("in_set", "status", {"value_set": ["completed", "refunded", "failed", "pending"]}),
    ],
    "silver_marketing_campaigns": [
        ("not_null", "campaign_id", {}),
        ("unique", "campaign_id", {}),
        ("between", "spend", {"min_value": 0}),
        ("between", "clicks", {"min_value": 0}),
    ],
    "silver_operational_logs": [
        ("not_null", "log_id", {}),
        ("unique", "log_id", {}),
        ("in_set", "status", {"value_set": ["ok", "warning", "failed"]}),
        ("between", "runtime_seconds", {"min_value": 0}),
    ],
}

# Column tests of the warehouse models.
MODEL_TESTS: dict[str, list[tuple[str, str, dict]]] = {
    "stg_ecommerce_transactions": [
        ("not_null", "transaction_id", {}), ("unique", "transaction_id", {}),
        ("not_null", "customer_id", {}), ("not_null", "amount", {}),
        ("in_set", "status", {"value_set": ["completed", "refunded", "failed", "pending"]}),
    ],
    "stg_marketing_campaigns": [
        ("not_null", "campaign_id", {}), ("unique", "campaign_id", {}), ("not_null", "spend", {})],
    "stg_product_catalog": [("not_null", "product_id", {}), ("unique", "product_id", {})],
    "gold_revenue_analytics": [
        ("not_null", "order_date", {}), ("unique", "order_date", {}), ("not_null", "gross_revenue", {})],
    "gold_customer_analytics": [("not_null", "customer_id", {}), ("unique", "customer_id", {})],
    "dim_customer": [("not_null", "customer_id", {}), ("unique", "customer_id", {})],
    "dim_product": [("not_null", "product_id", {}), ("unique", "product_id", {})],
    "fact_orders": [("not_null", "transaction_id", {}), ("unique", "transaction_id", {})],
    "fact_marketing_spend": [("not_null", "campaign_id", {}), ("unique", "campaign_id", {})],
}

# Fixed values: (warn, error) age in hours per source.
FRESHNESS_HOURS: dict[str, tuple[int, int]] = {
    "ecommerce_transactions": (24, 48),
    "marketing_campaigns": (24, 48),
    "customer_behavior": (6, 12),
    "product_catalog": (48, 72),
    "operational_logs": (1, 2),
    "targets_planning": (168, 336),
    "crm_support": (24, 48),
}

# Marts held to the higher readiness target, and the two targets.
TIER_1_MARTS = (
    "gold_customer_analytics", "gold_revenue_analytics", "gold_operational_metrics",
    "gold_data_quality_summary", "gold_source_freshness",
)
READINESS_TARGET_TIER_1 = 0.95
READINESS_TARGET_OTHER = 0.90

CATALOG_FIELDS = (
    "dataset_name", "layer", "owner", "source_system", "refresh_frequency",
    "criticality_tier", "business_description", "downstream_usage",
)

# The data catalog, in the order of CATALOG_FIELDS.
CATALOG: list[tuple[str, ...]] = [
    ("gold_customer_analytics", "gold", "analytics-engineering",
     "ecommerce_transactions, customer_behavior, crm_support", "daily", "tier_1",
     "Customer-level revenue, engagement, and support health for retention reporting.",
     "executive retention dashboards, lifecycle marketing, support leadership"),
    ("gold_revenue_analytics", "gold", "finance-analytics",
     "ecommerce_transactions, targets_planning", "daily", "tier_1",
     "Trusted daily net revenue, order count, refund impact, and target attainment.",
     "CFO dashboard, board reporting, revenue operations"),
    ("gold_marketing_attribution", "gold", "growth-analytics",
     "marketing_campaigns, ecommerce_transactions", "daily", "tier_2",
     "Campaign spend, attributed revenue, CAC proxy, and ROAS by channel.",
     "marketing performance dashboard, budget planning"),
    ("gold_product_performance", "gold", "merchandising-analytics",
     "product_catalog, ecommerce_transactions", "daily", "tier_2",
     "Product-level orders, revenue, active status, and category performance.",
     "category management, assortment planning"),
    ("gold_operational_metrics", "gold", "data-platform",
     "operational_logs", "hourly", "tier_1",
     "Pipeline health, SLA misses, service failures, and operational readiness.",
     "data health dashboard, incident review, platform SLO reporting"),
    ("gold_target_vs_actual", "gold", "finance-analytics",
     "ecommerce_transactions, targets_planning", "daily", "tier_1",
     "Daily actual revenue and orders compared with finance planning targets.",
     "revenue operations, CFO dashboard, board reporting variance analysis"),
    ("gold_data_quality_summary", "gold", "data-governance",
     "all validated silver datasets", "per pipeline run", "tier_1",
     "Validation outcomes, failed checks, severity, and trendable quality posture.",
     "governance scorecards, incident triage"),
    ("gold_source_freshness", "gold", "data-platform",
     "ingestion metadata", "per pipeline run", "tier_1",
     "Source-level load recency, SLA status, row counts, and schema versions.",
     "freshness dashboard, alerting, stakeholder trust reporting"),
]


@dataclass(frozen=True)
class Classification:
    level: str
    pii: tuple[str, ...]
    sensitive: tuple[str, ...]
    retention: str
    access: str


# Data classification.
CLASSIFICATION: dict[str, Classification] = {
    "silver_ecommerce_transactions": Classification(
        "confidential", ("customer_id",), ("amount", "campaign_id"),
        "retain_7_years_for_finance_audit", "finance_analytics_and_data_platform"),
    "silver_customer_behavior": Classification(
        "confidential", ("customer_id", "session_id"), ("event_type", "product_id"),
        "retain_25_months_for_product_analytics", "product_analytics_and_data_platform"),
    "silver_crm_support": Classification(
        "restricted", ("customer_id", "ticket_id"), ("priority", "topic", "status"),
        "retain_3_years_for_customer_support", "support_operations_and_data_governance"),
    "gold_revenue_analytics": Classification(
        "confidential", (), ("gross_revenue", "revenue_target"),
        "retain_7_years_for_finance_audit", "executive_reporting_and_finance"),
    "gold_customer_analytics": Classification(
        "restricted", ("customer_id",), ("gross_revenue", "support_tickets", "customer_segment"),
        "retain_3_years_for_customer_analytics",
        "analytics_engineering_and_authorized_business_users"),
}

# Control recommended per classification.
CONTROLS = {
    "restricted": "row/column access policy, approval workflow, audit logging",
    "confidential": "role-based access, encryption, usage monitoring",
}
DEFAULT_CONTROL = "standard internal access"

# Data products (name, owner, tier, datasets, trust threshold, quality gate).
DATA_PRODUCTS: list[tuple[str, str, str, tuple[str, ...], float, str]] = [
    ("Revenue Intelligence", "finance-analytics", "tier_1",
     ("gold_revenue_analytics", "gold_target_vs_actual"), 90.0,
     "all critical checks pass, readiness >= 0.95, trust score >= 90, and reconciliation passes"),
    ("Customer Health", "analytics-engineering", "tier_1",
     ("gold_customer_analytics",), 90.0,
     "customer identity completeness and support join quality pass"),
    ("Growth Performance", "growth-analytics", "tier_2",
     ("gold_marketing_attribution",), 80.0,
     "campaign spend non-negative and attribution coverage monitored"),
    ("Platform Reliability", "data-platform", "tier_1",
     ("gold_operational_metrics", "gold_data_quality_summary", "gold_source_freshness"), 90.0,
     "no unresolved critical platform alerts and trust score >= 90"),
]
RECONCILED_DATASETS = ("gold_revenue_analytics", "gold_target_vs_actual", "gold_product_performance")

# The exception register (id, status, gate, expiry).
EXCEPTIONS: list[tuple[str, str, str, str]] = [
    ("EX-PLATFORM-001", "active", "high_alert_gate", "2026-12-31T23:59:59+00:00"),
]

# Notification routes per severity; unknown severities use the low route.
ROUTES: dict[str, tuple[str, ...]] = {
    "critical": ("pagerduty:data-platform-primary", "slack:#data-incidents"),
    "high": ("slack:#data-incidents",),
    "medium": ("slack:#data-quality",),
    "low": ("email:data-platform@example.com",),
}

# Seed of dataset tiers (dataset, tier, owner, SLA hours).
DATASET_TIERS: list[tuple[str, str, str, int]] = [
    ("gold_customer_analytics", "tier_1", "analytics-engineering", 24),
    ("gold_revenue_analytics", "tier_1", "finance-analytics", 24),
    ("gold_marketing_attribution", "tier_2", "growth-analytics", 24),
    ("gold_product_performance", "tier_2", "merchandising-analytics", 24),
    ("gold_operational_metrics", "tier_1", "data-platform", 1),
    ("gold_data_quality_summary", "tier_1", "data-governance", 1),
    ("gold_source_freshness", "tier_1", "data-platform", 1),
]

# Business metrics (name, kind, dataset, measure columns).
METRICS: list[dict[str, str]] = [
    {"name": "gross_revenue", "type": "sum", "dataset": "gold_revenue_analytics",
     "expression": "gross_revenue"},
    {"name": "completed_orders", "type": "sum", "dataset": "gold_revenue_analytics",
     "expression": "completed_orders"},
    {"name": "revenue_attainment", "type": "ratio", "dataset": "gold_revenue_analytics",
     "numerator": "gross_revenue", "denominator": "revenue_target"},
    {"name": "roas", "type": "ratio", "dataset": "gold_marketing_attribution",
     "numerator": "attributed_revenue", "denominator": "spend"},
    {"name": "dataset_readiness_score", "type": "average", "dataset": "observability.dataset_readiness",
     "expression": "readiness_score"},
]

# Mart inventory (dataset, business purpose, grain, key metrics).
MART_INVENTORY: list[tuple[str, str, str, str]] = [
    ("gold_customer_analytics", "Customer revenue, engagement, support, and retention signals",
     "one row per customer",
     "order count, gross revenue, refund count, behavior events, support tickets"),
    ("gold_revenue_analytics", "Daily revenue and target attainment", "one row per order date",
     "completed orders, gross revenue, refunds, failed orders, revenue attainment"),
    ("gold_marketing_attribution", "Campaign spend and attributed revenue",
     "one row per campaign/channel", "spend, attributed orders, attributed revenue, ROAS"),
    ("gold_product_performance", "Product and category sales performance", "one row per product",
     "order count, units sold, gross revenue"),
    ("gold_operational_metrics", "Platform health and service runtime signals",
     "one row per service", "event count, failure count, warning count, average runtime"),
    ("gold_target_vs_actual", "Actual revenue/orders versus planning targets",
     "one row per target date",
     "actual revenue, target revenue, actual orders, target orders, attainment"),
    ("gold_data_quality_summary", "Dataset quality posture", "one row per validated silver dataset",
     "row count, check count, failed check count, quality status"),
    ("gold_source_freshness", "Source load recency and schema version posture",
     "one row per source/layer load", "row count, schema version, freshness status"),
    ("fact_orders", "Order-level fact view for dimensional analysis",
     "one row per order/transaction", "quantity, amount, completed revenue"),
    ("fact_marketing_spend", "Campaign spend fact view", "one row per campaign/date",
     "spend, impressions, clicks"),
    ("dim_customer", "Customer dimension derived from customer analytics", "one row per customer",
     "customer segment, order count, support tickets, behavior events"),
    ("dim_product", "Product dimension derived from standardized product catalog",
     "one row per product", "product name, category, active flag, list price"),
]

# Column-name and value patterns of personal data.
PII_NAME_PATTERNS = (
    r"\bcustomer_id\b", r"\buser_id\b", r"\bticket_id\b", r"\bsession_id\b",
    r"\bemail\b", r"\bphone\b", r"\bname\b", r"\baddress\b",
)
PII_VALUE_PATTERNS = {
    "email": r"(?i)^[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}$",
    "phone": r"^\+?[0-9][0-9\-\s]{7,}$",
}
