"""Marts: order-line facts, dense weekly demand, duration statistics, seller versions.

Shuffles. Orders meet lines in one shuffle on order_id, and the result is aggregated
map-side to `product_rollup`: a row per product, seller, week and seller period. The series
rollup joins products to that smaller table, and seller versions are summed from it, so the
big join runs once and a hot product is folded before any second shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpolicy.config import PolicyConfig
from stockpolicy.functions.columns import date_col, date_lit, sd_from_sums, week_start
from stockpolicy.schemas import DAYS, MEAN_DAYS, QUANTITY, SERIES, SHARE


def weeks_from(first: Column | str, last: Column | str) -> Column:
    """Array of every seventh day from first to last."""
    return F.sequence(first, last, F.make_dt_interval(F.lit(7)))


def order_line_facts(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Lines of kept orders with their category; lines of unknown products fall out."""
    lines = orders.join(items, "order_id", "inner")
    return lines.join(products.select("product_id", "category"), "product_id", "inner").select(
        "order_id",
        "item_seq",
        "product_id",
        "category",
        "seller_id",
        "purchase_date",
        "purchase_week",
        F.col("delivered_at").cast("date").alias("delivered_date"),
        "observed_fulfil_days",
        "promised_fulfil_days",
        "price",
        "qty",
    )


def day_sums() -> list:
    observed = F.col("observed_fulfil_days").cast("bigint")
    promised = F.col("promised_fulfil_days").cast("bigint")
    return [
        F.count("*").alias("n_lines"),
        F.sum(observed).alias("observed_sum"),
        F.sum(observed * observed).alias("observed_sq"),
        F.count(promised).alias("promised_n"),
        F.sum(promised).alias("promised_sum"),
        F.sum(promised * promised).alias("promised_sq"),
        F.count_if(observed > promised).alias("late_lines"),
    ]


DAY_SUMS = [
    "n_lines",
    "observed_sum",
    "observed_sq",
    "promised_n",
    "promised_sum",
    "promised_sq",
    "late_lines",
]


def sum_of_sums() -> list:
    """Adds partial duration sums up; the squares go to decimal, which cannot wrap."""
    return [
        F.sum(F.col(c).cast("decimal(20,0)") if c.endswith("_sq") else F.col(c)).alias(c)
        for c in DAY_SUMS
    ]


def weekly_rollup(facts: DataFrame, *extra_keys: str) -> DataFrame:
    """Units, revenue and integer duration sums per series and week."""
    return facts.groupBy(*SERIES, "purchase_week", *extra_keys).agg(
        F.sum("qty").alias("units"),
        F.sum(F.col("price") * F.col("qty")).alias("revenue"),
        *day_sums(),
    )


def period_start(cfg: PolicyConfig) -> Column:
    """First day of the configured period that the purchase falls in."""
    starts = cfg.period_starts
    valid_from = date_lit(starts[0])
    for start in starts[1:]:
        valid_from = F.when(F.col("purchase_date") >= date_lit(start), date_lit(start)).otherwise(
            valid_from
        )
    return valid_from


def product_rollup(orders: DataFrame, items: DataFrame, cfg: PolicyConfig) -> DataFrame:
    """Orders joined to lines, reduced to a row per product, seller, week and seller period."""
    lines = orders.join(items, "order_id", "inner").withColumn("valid_from", period_start(cfg))
    return lines.groupBy("product_id", "seller_id", "purchase_week", "valid_from").agg(
        F.sum("qty").alias("units"),
        F.sum(F.col("price") * F.col("qty")).alias("revenue"),
        *day_sums(),
    )


def series_rollup(by_product: DataFrame, products: DataFrame) -> DataFrame:
    """`weekly_rollup` from sums by product: the same numbers, also where products repeat."""
    joined = by_product.join(products.select("product_id", "category"), "product_id", "inner")
    return joined.groupBy(*SERIES, "purchase_week").agg(
        F.sum("units").alias("units"), F.sum("revenue").alias("revenue"), *sum_of_sums()
    )


def weekly_sales(rollup: DataFrame) -> DataFrame:
    return rollup.select(*SERIES, "purchase_week", "units", "revenue")


def modelled_series(sales: DataFrame, cfg: PolicyConfig) -> DataFrame:
    """First and last sale week of each series thick enough to model."""
    return (
        sales.groupBy(*SERIES)
        .agg(
            F.min("purchase_week").alias("first_week"),
            F.max("purchase_week").alias("last_week"),
            F.count("*").alias("active_weeks"),
            F.sum("units").alias("total_units"),
        )
        .filter(
            (F.col("active_weeks") >= cfg.min_weeks_history)
            & (F.col("total_units") >= cfg.min_units_history)
        )
        .select(*SERIES, "first_week", "last_week")
    )


def calendar_spine(series: DataFrame) -> DataFrame:
    """Every week between a series' first and last sale week."""
    return series.select(
        *SERIES, F.explode(weeks_from("first_week", "last_week")).alias("purchase_week")
    )


def fct_demand_weekly(
    sales: DataFrame, cfg: PolicyConfig, spine_end: dt.date | None = None
) -> DataFrame:
    """Dense weekly demand of the modelled series; weeks without a sale are 0.

    Each sale week also emits the empty weeks up to the next one, so the spine
    needs no join and `sales` is computed once. A window partition holds one
    row per week, so it is bounded by the calendar however hot the series is.
    With `spine_end` the spine runs on to that date's week instead of ending at
    the series' own last sale.
    """
    series = Window.partitionBy(*SERIES)
    following = F.date_sub(F.lead("purchase_week").over(series.orderBy("purchase_week")), 7)
    last = F.col("purchase_week")
    if spine_end is not None:
        last = F.greatest(last, week_start(date_col(spine_end)))
    kept = (
        sales.withColumns(
            {
                "fill_to": F.coalesce(following, last),
                "active_weeks": F.count("*").over(series),
                "total_units": F.sum("units").over(series),
            }
        )
        .filter(
            (F.col("active_weeks") >= cfg.min_weeks_history)
            & (F.col("total_units") >= cfg.min_units_history)
        )
        .withColumn("week", F.explode(weeks_from("purchase_week", "fill_to")))
    )
    sold = F.col("week") == F.col("purchase_week")
    zero = F.lit(0)
    return kept.select(
        *SERIES,
        F.col("week").alias("purchase_week"),
        F.coalesce(F.when(sold, F.col("units")), zero).cast(QUANTITY).alias("units"),
        F.coalesce(F.when(sold, F.col("revenue")), zero).cast("decimal(38,8)").alias("revenue"),
    )


def duration_stats(sums: DataFrame) -> DataFrame:
    """Mean, sd and late share from summed integer moments."""
    n, promised_n = F.col("n_lines"), F.nullif(F.col("promised_n"), F.lit(0))

    def mean(total: str, count: Column) -> Column:
        return (F.col(total) / count).cast(DAYS)

    def sd(prefix: str, count: Column) -> Column:
        return sd_from_sums(
            F.coalesce(count, F.lit(0)),
            F.coalesce(f"{prefix}_sum", F.lit(0)),
            F.coalesce(f"{prefix}_sq", F.lit(0)),
        ).cast(DAYS)

    return sums.withColumns(
        {
            "n_deliveries": n,
            "observed_mean_days": mean("observed_sum", n),
            "observed_sd_days": sd("observed", n),
            "promised_mean_days": mean("promised_sum", promised_n),
            "promised_sd_days": sd("promised", promised_n),
            "pct_late": (F.col("late_lines") / n).cast(SHARE),
        }
    ).drop(*DAY_SUMS)


def fulfilment_stats(rollup: DataFrame, cfg: PolicyConfig) -> DataFrame:
    """Promised against observed days per series, weighted by line."""
    sums = rollup.groupBy(*SERIES).agg(*sum_of_sums())
    return duration_stats(sums.filter(F.col("n_lines") >= cfg.min_deliveries))


def dim_seller(by_product: DataFrame, sellers: DataFrame | None) -> DataFrame:
    """Type-2 seller versions from `product_rollup`, one per period with deliveries.

    `valid_to` is inclusive and NULL for the current version. The key is the first 60 bits of a
    hash of seller and start date, so a rerun assigns the same keys.
    """
    periods = by_product.groupBy("seller_id", "valid_from").agg(
        (F.sum("observed_sum") / F.sum("n_lines")).cast(MEAN_DAYS).alias("avg_fulfil_days")
    )
    following = F.lead("valid_from").over(
        Window.partitionBy("seller_id").orderBy("valid_from")
    )
    versions = periods.withColumn("next_from", following)
    if sellers is None:
        nothing = F.lit(None).cast("string")
        versions = versions.withColumns({"state": nothing, "city": nothing})
    else:
        versions = versions.join(sellers.select("seller_id", "state", "city"), "seller_id", "left")
    named = F.concat_ws("|", F.coalesce("seller_id", F.lit("")), F.col("valid_from").cast("string"))
    key = F.conv(F.substring(F.md5(named), 1, 15), 16, 10).cast("bigint")
    return versions.select(
        key.alias("seller_key"),
        "seller_id",
        "state",
        "city",
        "avg_fulfil_days",
        "valid_from",
        F.date_sub("next_from", 1).alias("valid_to"),
        F.col("next_from").isNull().alias("is_current"),
    )


def assert_unique_keys(dim: DataFrame) -> None:
    """Fails when two versions have one key, by a hash collision or a repeated seller. Runs a job."""
    bad = dim.groupBy("seller_key").agg(F.count("*").alias("n")).filter("n > 1").take(1)
    if bad:
        raise ValueError(f"seller key {bad[0]['seller_key']} is not unique")
