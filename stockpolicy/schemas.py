"""Canonical sections, the published contract and the numeric types."""

from __future__ import annotations

# The interface of raw tables and of the published snapshot.
# Raw sections: canonical columns in table order (all text), and whether required.
SECTIONS = {
    "orders": (
        ("order_id", "status", "ordered_at", "received_at", "promised_at", "dispatched_at"),
        True,
    ),
    "order_lines": (
        ("order_id", "line_no", "product_id", "supplier_id", "unit_value", "quantity"),
        True,
    ),
    "products": (("product_id", "category"), True),
    "suppliers": (("supplier_id", "city", "region"), False),
    "category_labels": (("category", "label"), False),
}

# Columns the readiness check insists on; the others may be left unmapped.
READINESS_REQUIRED = {
    "orders": ("order_id", "status", "ordered_at", "received_at", "promised_at"),
    "order_lines": ("order_id", "line_no", "product_id", "supplier_id", "unit_value"),
    "products": ("product_id", "category"),
}

SERIES = ["category", "seller_id"]

QUANTITY = "decimal(18,4)"
DAYS = "decimal(10,3)"
SHARE = "decimal(6,4)"
MEAN_DAYS = "decimal(10,2)"

# The published snapshot: name and type, in order.
PUBLISHED = (
    ("calc_date", "date"),
    ("category", "string"),
    ("seller_id", "string"),
    ("abc", "string"),
    ("xyz", "string"),
    ("service_level", "double"),
    ("demand_mean", "double"),
    ("demand_sd", "double"),
    ("zero_week_share", "double"),
    ("observed_mean_days", DAYS),
    ("observed_sd_days", DAYS),
    ("promised_mean_days", DAYS),
    ("promised_sd_days", DAYS),
    ("pct_late", SHARE),
    ("ss_observed", "double"),
    ("ss_promised", "double"),
    ("naive_total_cover", "double"),
    ("model_total_target", "double"),
    ("cycle_observed", "double"),
    ("cycle_promised", "double"),
    ("rop_observed", "double"),
    ("supply_variance_share", "double"),
    ("weeks_since_last_sale", "double"),
    ("is_intermittent", "boolean"),
    ("is_stale", "boolean"),
    ("is_publishable", "boolean"),
    ("exclusion_reason", "string"),
)
PUBLISHED_KEY = ["calc_date", "category", "seller_id"]
