"""Profile of the raw tables, taken before any cleaning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpolicy.config import PolicyConfig
from stockpolicy.functions.columns import is_blank, percent, to_timestamp


def with_share(counts: DataFrame, n: str, digits: int) -> DataFrame:
    """Percent of the total. The total is a scalar, not a window over all groups."""
    total = counts.agg(F.sum(n)).scalar()
    return counts.withColumn("pct", percent(F.col(n), total, digits))


def profile_status(raw_orders: DataFrame) -> DataFrame:
    counts = raw_orders.groupBy("status").agg(F.count("*").alias("n"))
    return with_share(counts, "n", 2).orderBy(F.desc("n"), "status")


def profile_nulls(raw_orders: DataFrame) -> DataFrame:
    return raw_orders.agg(
        F.count("*").alias("total_orders"),
        F.count_if(is_blank("received_at")).alias("null_received"),
        F.count_if(is_blank("promised_at")).alias("null_promised"),
        F.count_if(is_blank("dispatched_at")).alias("null_dispatched"),
    )


def profile_contradictions(raw_orders: DataFrame, cfg: PolicyConfig) -> DataFrame:
    """Completed without receipt, received before dispatched, received not after ordered."""
    received = to_timestamp("received_at")
    return raw_orders.agg(
        F.count_if((F.col("status") == cfg.completed_status) & is_blank("received_at")).alias(
            "completed_not_received"
        ),
        F.count_if(received < to_timestamp("dispatched_at")).alias("received_before_dispatched"),
        F.count_if(received <= to_timestamp("ordered_at")).alias("received_not_after_ordered"),
    )


def profile_monthly(raw_orders: DataFrame, months: int = 8) -> DataFrame:
    """Orders of the first months."""
    month: Column = F.date_format(to_timestamp("ordered_at").cast("date"), "yyyy-MM")
    return (
        raw_orders.groupBy(month.alias("ym"))
        .agg(F.count("*").alias("orders"))
        .orderBy(F.asc_nulls_last("ym"))
        .limit(months)
    )


def profile_uncategorised(raw_products: DataFrame) -> DataFrame:
    return raw_products.agg(F.count_if(is_blank("category")).alias("uncategorised_products"))


def lines_per_product(raw_lines: DataFrame) -> DataFrame:
    """How many products have how many lines: the histogram of line counts."""
    per_product = raw_lines.groupBy("product_id").agg(F.count("*").alias("lines"))
    return per_product.groupBy("lines").agg(F.count("*").alias("products"))


def profile_product_thickness(raw_lines: DataFrame) -> DataFrame:
    """Whether products have enough lines for a standard deviation."""
    sizes = lines_per_product(raw_lines)
    lines, products = F.col("lines"), F.col("products")
    return sizes.agg(
        F.sum(products).alias("products_sold"),
        F.round(
            F.sum(lines * products).cast("decimal(20,0)") / F.sum(products).cast("decimal(20,0)"), 2
        ).alias("avg_lines"),
        F.percentile(lines, F.lit(0.5), products).alias("median_lines"),
        F.coalesce(F.sum(F.when(lines == 1, products)), F.lit(0)).alias("sold_exactly_once"),
        F.coalesce(F.sum(F.when(lines >= 20, products)), F.lit(0)).alias("sold_20_or_more"),
    )



# The key of each raw table that others join.
KEYS = {
    "orders": "order_id",
    "products": "product_id",
    "suppliers": "supplier_id",
    "category_labels": "category",
}


def profile_duplicate_keys(raw) -> DataFrame:
    """Per joined table: keys that occur more than once, and the rows beyond the first of each.

    A repeated product or label multiplies demand without any error.
    """
    parts = []
    for table, key in KEYS.items():
        if table in raw:
            counts = raw[table].filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
            parts.append(
                counts.agg(
                    F.count_if(F.col("n") > 1).alias("repeated_keys"),
                    F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_rows"),
                ).select(F.lit(table).alias("table_name"), F.lit(key).alias("key"), "repeated_keys", "extra_rows")
            )
    return reduce(DataFrame.unionByName, parts)
