"""Segmentation: ABC by cumulative revenue, XYZ by variability, service level by class."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpolicy.config import PolicyConfig
from stockpolicy.functions.session import stored_by, stored_count
from stockpolicy.schemas import SERIES

AMOUNT = "decimal(28,6)"
ROWS_PER_RANGE = 200_000


def cumulative_share(
    df: DataFrame, value: str, ties: list[str], by: list[str] | tuple = (), buckets: int | None = None
) -> DataFrame:
    """Running share of `value`, largest first: `cum_share_before` and `cum_share`.

    A window ordered over everything would put all rows into one task. Instead:

    1. store the rows, because ranging reads them twice (sample, then shuffle); the same
       write counts them;
    2. range them on (by, value desc, ties), as many ranges as the rows need (ROWS_PER_RANGE),
       and `buckets` at least: a fixed number alone would let a task grow with the table.
       Ranges stay balanced when a third of the rows carry the same value, because the ties
       differ. This is the one shuffle of the rows: they are stored in buckets by range, so
       Spark knows where each range lies;
    3. sum per range. This table has one row per range and `by` group, so its
       running total is small;
    4. running sum inside each range, plus the range's offset.

    Sums are decimal, so the result does not depend on the order of addition.
    When the total is zero the shares are 0 and `cum_share_before` is NULL.
    Runs jobs (steps 1 and 2). Ties must make the order total.
    """
    by = list(by)
    order = [F.desc(value), *ties]
    amount = F.coalesce(F.col(value), F.lit(0)).cast(AMOUNT)
    source, rows = stored_count(df.withColumn("_amount", amount), "amounts")
    n = max(buckets or 1, math.ceil(rows / ROWS_PER_RANGE))
    groups = Window.partitionBy(*by)
    if n == 1:  # one range needs no ranging: its rows fit a task, and there is no offset
        so_far = groups.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        sums = {"_upto": F.sum("_amount").over(so_far), "_total": F.sum("_amount").over(groups)}
        return _with_shares(source.withColumns(sums))
    ranges = source.repartitionByRange(n, *by, *order).withColumn("_range", F.spark_partition_id())
    ranged = stored_by(ranges, "_range", n, "ranges")
    earlier = groups.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(*by, "_range")
        .agg(F.sum("_amount").alias("_range_sum"))
        .select(
            *by,
            "_range",
            F.coalesce(F.sum("_range_sum").over(earlier), F.lit(0)).alias("_offset"),
            F.sum("_range_sum").over(groups).alias("_total"),
        )
    )
    inside = F.sum("_amount").over(
        Window.partitionBy(*by, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    joined = ranged.withColumn("_inside", inside).join(offsets, [*by, "_range"])
    return _with_shares(joined.withColumn("_upto", F.col("_offset") + F.col("_inside")))


def _with_shares(sums: DataFrame) -> DataFrame:
    """Shares from `_amount`, its running sum `_upto` and `_total`; helper columns fall away."""
    total = F.nullif(F.col("_total").cast("double"), F.lit(0.0))
    return sums.withColumns(
        {
            "cum_share_before": (F.col("_upto") - F.col("_amount")).cast("double") / total,
            "cum_share": F.coalesce(F.col("_upto").cast("double") / total, F.lit(0.0)),
        }
    ).drop("_amount", "_range", "_offset", "_total", "_upto", "_inside")


def abc_class(before: Column, cfg: PolicyConfig) -> Column:
    """Class by the share reached before the series; NULL (no revenue at all) is C."""
    return (
        F.when(before < cfg.abc_thresholds["A"], F.lit("A"))
        .when(before < cfg.abc_thresholds["B"], F.lit("B"))
        .otherwise(F.lit("C"))
    )


def classify_abc(
    df: DataFrame, cfg: PolicyConfig, by: list[str] | tuple = (), buckets: int | None = None
) -> DataFrame:
    """ABC on the exclusive cumulative share, so the largest series is always A.

    Equal revenues are ordered by category and seller. Missing revenue counts
    as zero. Runs a job; see `cumulative_share`.
    """
    ranked = df.withColumn(
        "annualised_revenue", F.coalesce(F.col("annualised_revenue").cast("double"), F.lit(0.0))
    )
    shares = cumulative_share(ranked, "annualised_revenue", SERIES, by, buckets)
    return shares.withColumn("abc", abc_class(F.col("cum_share_before"), cfg)).drop(
        "cum_share_before"
    )


def classify_xyz(df: DataFrame, cfg: PolicyConfig) -> DataFrame:
    """XYZ on cv, inclusive limits; an undefined cv is Z."""
    cv = F.col("cv")
    return df.withColumn(
        "xyz",
        F.when(cv <= cfg.xyz_thresholds["X"], F.lit("X"))
        .when(cv <= cfg.xyz_thresholds["Y"], F.lit("Y"))
        .otherwise(F.lit("Z")),
    )


def with_service_level(df: DataFrame, cfg: PolicyConfig) -> DataFrame:
    level = F.lit(None).cast("double")
    for name, value in cfg.service_levels.items():
        level = F.when(F.col("abc") == name, F.lit(float(value))).otherwise(level)
    return df.withColumn("service_level", level)
