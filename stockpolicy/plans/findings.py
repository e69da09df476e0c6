"""Findings on a published snapshot, and the review datasets built from them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpolicy.functions.columns import date_lit, ratio, sd_of_moments
from stockpolicy.functions.session import stored
from stockpolicy.operators.quantile import exact_percentile
from stockpolicy.plans.profile import with_share
from stockpolicy.schemas import QUANTITY, SERIES
from stockpolicy.sources.snapshots import latest_snapshot


def _snapshot(params: DataFrame, calc_date: dt.date | str | None) -> DataFrame:
    """One date only: snapshots must not be mixed. Default is the latest."""
    if calc_date is None:
        return latest_snapshot(params)
    return params.filter(F.col("calc_date") == date_lit(calc_date))


def published(params: DataFrame, calc_date: dt.date | str | None = None) -> DataFrame:
    return _snapshot(params, calc_date).filter("is_publishable")


def _double(c: str) -> Column:
    return F.col(c).cast("double")


def _pct_above(num: Column, den: Column) -> Column:
    """Percent by which num exceeds den."""
    return (ratio(num, den) - 1) * 100


def f0_population(params: DataFrame, calc_date=None) -> DataFrame:
    status = F.coalesce("exclusion_reason", F.lit("PUBLISHED")).alias("status")
    counts = _snapshot(params, calc_date).groupBy(status).agg(F.count("*").alias("n"))
    return with_share(counts, "n", 1).orderBy(F.desc("n"), "status")


def f1_duration_gap(params: DataFrame, calc_date=None) -> DataFrame:
    """Promised against observed; `pad_ratio` is the mean of the per-series ratios."""
    promised, observed = F.col("promised_mean_days"), F.col("observed_mean_days")
    return published(params, calc_date).agg(
        F.round(F.avg(_double("promised_mean_days")), 1).alias("promised_mean_d"),
        F.round(F.avg(_double("observed_mean_days")), 1).alias("observed_mean_d"),
        F.round(F.avg(_double("promised_sd_days")), 2).alias("promised_sd_d"),
        F.round(F.avg(_double("observed_sd_days")), 2).alias("observed_sd_d"),
        F.round(F.avg(ratio(promised, observed)), 2).alias("pad_ratio"),
        F.count_if(promised > observed).alias("series_padded"),
        F.count("*").alias("series"),
    )


def f2_inventory_position(params: DataFrame, calc_date=None) -> DataFrame:
    cycle_p, cycle_o = F.sum("cycle_promised"), F.sum("cycle_observed")
    stock_p, stock_o = F.sum("ss_promised"), F.sum("ss_observed")
    total_p = F.sum(F.col("cycle_promised") + F.col("ss_promised"))
    total_o = F.sum(F.col("cycle_observed") + F.col("ss_observed"))
    return published(params, calc_date).agg(
        F.round(cycle_p).alias("cycle_promised"),
        F.round(cycle_o).alias("cycle_observed"),
        F.round(stock_p).alias("ss_promised"),
        F.round(stock_o).alias("ss_observed"),
        F.round(total_p).alias("total_promised"),
        F.round(total_o).alias("total_observed"),
        F.round(_pct_above(total_p, total_o), 1).alias("pct_overstated"),
    )


def f3_variance_drivers(params: DataFrame, calc_date=None) -> DataFrame:
    live = stored(published(params, calc_date).select("supply_variance_share"), "live")
    share = F.col("supply_variance_share")
    median = exact_percentile(live, "supply_variance_share", 0.5).select("value").scalar()
    return live.agg(
        F.min(share).alias("low"),
        F.max(share).alias("high"),
        F.count_if(share > 0.5).alias("majority_supply_driven"),
        F.count("*").alias("series"),
    ).select(
        F.round(median * 100, 1).alias("median_pct_supply"),
        F.round(F.col("low") * 100, 1).alias("min_pct"),
        F.round(F.col("high") * 100, 1).alias("max_pct"),
        "majority_supply_driven",
        "series",
    )


def f4_flat_rule_gap(params: DataFrame, calc_date=None) -> DataFrame:
    """Flat cover against the model target by class, total against total."""
    naive, model = F.col("naive_total_cover"), F.col("model_total_target")
    return (
        published(params, calc_date)
        .groupBy("abc")
        .agg(
            F.count("*").alias("series"),
            F.round(F.sum(naive)).alias("naive_total"),
            F.round(F.sum(model)).alias("model_total"),
            F.round(_pct_above(F.sum(naive), F.sum(model)), 1).alias("gap_pct"),
            F.count_if(naive < model).alias("under"),
            F.count_if(naive > model).alias("over"),
        )
        .orderBy("abc")
    )


def f5_abc_xyz_grid(params: DataFrame, calc_date=None) -> DataFrame:
    return (
        published(params, calc_date)
        .groupBy("abc")
        .agg(
            *(F.count_if(F.col("xyz") == c).alias(c.lower()) for c in ("X", "Y", "Z")),
            F.count("*").alias("total"),
        )
        .orderBy("abc")
    )


def f6_freshness(params: DataFrame, calc_date=None) -> DataFrame:
    return published(params, calc_date).agg(
        F.round(F.max("weeks_since_last_sale"), 1).alias("oldest_weeks_since_sale"),
        F.round(F.avg("weeks_since_last_sale"), 1).alias("avg_weeks_since_sale"),
    )


def f7_least_consistent(params: DataFrame, calc_date=None, n: int = 8) -> DataFrame:
    """Top n A/B series by observed sd. A top-k, never a full sort."""
    return (
        published(params, calc_date)
        .filter(F.col("abc").isin("A", "B"))
        .orderBy(F.desc("observed_sd_days"), "category", "seller_id")
        .limit(n)
        .select(
            F.substring("seller_id", 1, 8).alias("seller"),
            "category",
            "abc",
            F.col("observed_mean_days").alias("mean_d"),
            F.col("observed_sd_days").alias("sd_d"),
            F.round(F.col("pct_late") * 100, 0).alias("pct_late"),
            F.round("model_total_target", 0).alias("target_units"),
        )
    )


def ranked_weeks(fct: DataFrame) -> DataFrame:
    """Weeks of each series by units, largest first. At most one row per week and series."""
    by_size = Window.partitionBy(*SERIES).orderBy(F.desc("units"), "purchase_week")
    return fct.select(*SERIES, "purchase_week", "units").withColumn(
        "rn", F.row_number().over(by_size)
    )


def f8_outlier_sensitivity(params: DataFrame, fct: DataFrame, calc_date=None) -> DataFrame:
    """How much of a series' demand sd is its single largest week.

    From one aggregate of the fact: count, sum, sum of squares and maximum are exact decimals, so
    taking the largest week out of them is exact too, and no window orders the weeks.
    """
    units = F.col("units").cast(QUANTITY)
    moments = fct.groupBy(*SERIES).agg(
        F.count(units).alias("n"),
        F.sum(units).alias("s"),
        F.sum(units * units).alias("ss"),
        F.max(units).alias("top"),
    )
    n, s, ss, top = (F.col(c) for c in ("n", "s", "ss", "top"))
    spread = moments.select(
        *SERIES,
        sd_of_moments(n, s, ss).alias("sd_all"),
        sd_of_moments(n - 1, s - top, ss - top * top).alias("sd_ex"),
    )
    live = published(params, calc_date).select(*SERIES)
    drop = (1 - ratio(F.col("sd_ex"), F.col("sd_all"))) * 100
    return spread.join(live, SERIES, "inner").agg(
        F.round(F.avg(drop), 1).alias("pct_of_sigma_from_single_week")
    )


def review_grid(params: DataFrame, calc_date=None) -> DataFrame:
    """Segment totals with bar lengths relative to the largest total.

    `supply_share` is the plain mean over the series of a segment. The window
    spans the whole grid, which has at most nine rows.
    """
    grid = (
        published(params, calc_date)
        .groupBy("abc", "xyz")
        .agg(
            F.count("*").alias("series"),
            F.sum("model_total_target").alias("required"),
            F.sum("naive_total_cover").alias("naive"),
            F.avg("supply_variance_share").alias("supply_share"),
        )
    )
    largest = F.max(F.greatest("required", "naive")).over(Window.partitionBy(F.lit(1)))
    return grid.select(
        "abc",
        "xyz",
        "series",
        F.round("required", 1).alias("required"),
        F.round("naive", 1).alias("naive"),
        F.round("supply_share", 3).alias("supply_share"),
        F.round(_pct_above(F.col("naive"), F.col("required")), 1).alias("gap_pct"),
        F.round(ratio(F.col("required"), largest) * 100, 1).alias("required_bar"),
        F.round(ratio(F.col("naive"), largest) * 100, 1).alias("naive_bar"),
    ).orderBy("abc", "xyz")


def review_worst(params: DataFrame, calc_date=None, n: int = 10) -> DataFrame:
    return f7_least_consistent(params, calc_date, n).select(
        "seller",
        F.replace("category", F.lit("_"), F.lit(" ")).alias("category"),
        "abc",
        F.col("mean_d").alias("mean"),
        F.col("sd_d").alias("sd"),
        F.col("pct_late").alias("late"),
        F.col("target_units").alias("ss"),
    )


def review_tiles(params: DataFrame, calc_date=None) -> DataFrame:
    """The headline numbers in one row. The columns they need are stored once, then read."""
    columns = """promised_mean_days observed_mean_days cycle_promised ss_promised cycle_observed
        ss_observed supply_variance_share naive_total_cover model_total_target""".split()
    live = stored(published(params, calc_date).select(*columns), "live")
    promised, observed = F.col("promised_mean_days"), F.col("observed_mean_days")
    total_p = F.sum(F.col("cycle_promised") + F.col("ss_promised"))
    total_o = F.sum(F.col("cycle_observed") + F.col("ss_observed"))
    share = F.col("supply_variance_share")
    median = exact_percentile(live, "supply_variance_share", 0.5).select("value").scalar()
    return live.agg(
        F.avg(ratio(promised, observed)).alias("pad"),
        F.avg(promised.cast("double")).alias("promised"),
        F.avg(observed.cast("double")).alias("observed"),
        _pct_above(total_p, total_o).alias("overstated"),
        F.count_if(F.col("naive_total_cover") < F.col("model_total_target")).alias("short_series"),
        F.count("*").alias("series"),
        F.min(share).alias("low"),
        F.max(share).alias("high"),
    ).select(
        F.round("pad", 2).alias("pad_ratio"),
        F.round("promised", 1).alias("promised_mean_d"),
        F.round("observed", 1).alias("observed_mean_d"),
        F.round("overstated", 1).alias("pct_overstated"),
        "short_series",
        "series",
        F.round(median * 100, 1).alias("median_pct_supply"),
        F.round(F.col("low") * 100, 0).alias("min_pct"),
        F.round(F.col("high") * 100, 0).alias("max_pct"),
    )
