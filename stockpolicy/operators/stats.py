"""Per-series statistics over the trailing window that ends at a calculation date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpolicy.functions.columns import date_col, ratio
from stockpolicy.schemas import SERIES

WEEKS_PER_YEAR = 52


def in_window(calc_date: dt.date | str | Column, weeks: int) -> Column:
    day, week = date_col(calc_date), F.col("purchase_week")
    return (week <= day) & (week > F.date_sub(day, 7 * weeks))


def trailing_demand(fct: DataFrame, calc_date: dt.date | str, weeks: int) -> DataFrame:
    """Fact rows of the window anchored on `calc_date`; a plain range predicate."""
    return fct.filter(in_window(calc_date, weeks))


def _demand_aggs(units: Column) -> list:
    value = units.cast("double")
    return [
        F.count(value).alias("weeks"),
        F.avg(value).alias("demand_mean"),
        F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("demand_sd"),
        F.avg((units == 0).cast("int")).alias("zero_week_share"),
    ]


def _cv() -> Column:
    return F.when(F.col("demand_mean") > 0, ratio(F.col("demand_sd"), F.col("demand_mean")))


def annualise(revenue: Column, weeks: int) -> Column:
    return revenue.cast("double") / F.lit(float(weeks)) * F.lit(float(WEEKS_PER_YEAR))


def aggregate_window(units: Column, revenue: Column) -> list:
    """Demand statistics and revenue of the rows given; NULL units are outside the window."""
    return [*_demand_aggs(units), F.sum(revenue).alias("window_revenue")]


def finish_window(aggregated: DataFrame, weeks: int) -> DataFrame:
    """Drops series without a row in the window; adds cv and annualised revenue."""
    return aggregated.filter(F.col("weeks") > 0).withColumns(
        {"cv": _cv(), "annualised_revenue": annualise(F.col("window_revenue"), weeks)}
    )


def demand_stats(window: DataFrame) -> DataFrame:
    """Weeks, mean, sample sd, zero-week share and cv; zero weeks count."""
    return (
        window.groupBy(*SERIES).agg(*_demand_aggs(F.col("units"))).withColumn("cv", _cv())
    )


def annualised_revenue(window: DataFrame, weeks: int) -> DataFrame:
    """Window revenue, scaled to a year by the same denominator for every series."""
    return (
        window.groupBy(*SERIES)
        .agg(F.sum("revenue").alias("window_revenue"))
        .withColumn("annualised_revenue", annualise(F.col("window_revenue"), weeks))
    )


def series_activity(fct: DataFrame, calc_date: dt.date | str) -> DataFrame:
    """Last week with a sale, over the whole history up to `calc_date`."""
    return (
        fct.filter(F.col("purchase_week") <= date_col(calc_date))
        .groupBy(*SERIES)
        .agg(F.max(F.when(F.col("units") > 0, F.col("purchase_week"))).alias("last_sale_week"))
    )


def series_inputs(fct: DataFrame, calc_date: dt.date | str, weeks: int) -> DataFrame:
    """`demand_stats`, `annualised_revenue` and `series_activity` in one aggregate.

    One scan and one shuffle instead of three of each and two joins. Series
    without a row in the window are left out, as the inner join would do.
    """
    inside = in_window(calc_date, weeks)
    week = F.col("purchase_week")
    aggregated = (
        fct.filter(week <= date_col(calc_date))
        .groupBy(*SERIES)
        .agg(
            *aggregate_window(F.when(inside, F.col("units")), F.when(inside, F.col("revenue"))),
            F.max(F.when(F.col("units") > 0, week)).alias("last_sale_week"),
        )
    )
    return finish_window(aggregated, weeks)
