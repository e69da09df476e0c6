"""Parameters as of many calculation dates in one job.

A fact enters the window of some date and leaves it again 26 weeks later, so it is two
signed entries on the line of dates, whatever the number of dates. Entries of a series
are summed per date, and a running total over these sums is what each date sees.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpolicy.config import PolicyConfig
from stockpolicy.functions.columns import date_lit, sd_of_moments
from stockpolicy.functions.session import stored
from stockpolicy.operators.marts import DAY_SUMS, duration_stats, weekly_rollup
from stockpolicy.operators.policy import freshness_columns, policy_columns
from stockpolicy.operators.stats import finish_window
from stockpolicy.schemas import QUANTITY, SERIES

DATED = ["calc_date", *SERIES]
SQUARE, MONEY = "decimal(38,8)", "decimal(38,8)"


def _sorted_dates(dates) -> list[dt.date]:
    days = sorted({d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d)) for d in dates})
    if not days:
        raise ValueError("no calculation dates given")
    return days


def first_date(day: str, days: list[dt.date]) -> Column:
    """Place in the sorted `days` of the first one that is not before the expression `day`.

    len(days) where there is none. Halved step by step, so a row costs the logarithm of the
    number of dates and no join.
    """

    def search(low: int, high: int) -> str:
        if low == high:
            return str(low)
        middle = (low + high) // 2
        return f"IF({day} <= DATE'{days[middle]}', {search(low, middle)}, {search(middle + 1, high)})"

    return F.expr(search(0, len(days)))


def running_totals(
    entries: DataFrame, days: list[dt.date], sums: list[str], least: tuple | list = (), most: tuple | list = ()
) -> DataFrame:
    """What each date sees of each series: sums, minima and maxima of the entries up to it.

    entries: series, `at` (place of the first date that counts the entry) and the columns named.
    They are summed per series and date before any window, which then holds a row per date
    with news; a date without news repeats the last one. Dates before the first entry have no row.
    """
    folds = [(F.sum, sums), (F.min, least), (F.max, most)]
    per_date = (
        entries.filter(F.col("at") < len(days))
        .groupBy(*SERIES, "at")
        .agg(*(fold(c).alias(c) for fold, columns in folds for c in columns))
    )
    ordered = Window.partitionBy(*SERIES).orderBy("at")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    until = F.coalesce(F.lead("at").over(ordered), F.lit(len(days))) - 1
    calendar = F.array(*(date_lit(d) for d in days))
    totals = per_date.select(
        *SERIES,
        F.slice(calendar, F.col("at") + 1, until - F.col("at") + 1).alias("seen"),
        *(fold(c).over(so_far).alias(c) for fold, columns in folds for c in columns),
    )
    return totals.withColumn("calc_date", F.explode("seen")).drop("seen")


def _signed(sign: int, at: Column, sums: dict[str, Column], rest: dict[str, Column]) -> Column:
    """An entry that adds or takes away `sums`; `rest` counts once, when the fact enters."""
    once = (c if sign > 0 else F.nullif(c, c) for c in rest.values())
    return F.struct(
        at.alias("at"),
        *((c if sign > 0 else -c).alias(name) for name, c in sums.items()),
        *(c.alias(name) for name, c in zip(rest, once)),
    )


def entries_of(
    facts: DataFrame, enters: Column, leaves: Column, sums: dict[str, Column], rest: dict[str, Column]
) -> DataFrame:
    """Two rows per fact: at the date that first sees it and at the one that no longer does."""
    both = F.array(_signed(1, enters, sums, rest), _signed(-1, F.greatest(enters, leaves), sums, rest))
    return facts.select(*SERIES, F.inline(both))


def _window_stats(totals: DataFrame, weeks: int) -> DataFrame:
    """Mean, sample sd and zero share from `weeks`, `s`, `ss` and `zeros`."""
    n, s = F.col("weeks"), F.col("s")
    made = totals.filter(n > 0).withColumns(
        {
            "demand_mean": s.cast("double") / n,
            "demand_sd": F.coalesce(sd_of_moments(n, s, F.col("ss")), F.lit(0.0)),
            "zero_week_share": F.col("zeros").cast("double") / n,
        }
    )
    return finish_window(made, weeks).drop("s", "ss", "zeros")


def params_history(
    fct: DataFrame, fulfilment: DataFrame, dates, cfg: PolicyConfig
) -> DataFrame:
    """`params_from_marts` for each date, keyed by calc_date as well. Runs a job (ABC).

    Fulfilment statistics and series floors come from the whole history, as in
    a single run; `params_history_as_of` looks back only.
    """
    days, weeks = _sorted_dates(dates), cfg.demand_window_weeks
    units, week = F.col("units").cast(QUANTITY), F.col("purchase_week")
    sums = {
        "weeks": F.lit(1).cast("bigint"),
        "s": units.cast("decimal(28,4)"),
        "ss": (units * units).cast(SQUARE),
        "zeros": (units == 0).cast("bigint"),
        "window_revenue": F.col("revenue").cast(MONEY),
    }
    entries = entries_of(
        fct.filter(week <= date_lit(days[-1])),
        first_date("purchase_week", days),
        first_date(f"date_add(purchase_week, {7 * weeks})", days),
        sums,
        {"last_sale_week": F.when(units > 0, week)},
    )
    totals = running_totals(entries, days, list(sums), most=["last_sale_week"])
    joined = _window_stats(totals, weeks).join(fulfilment, SERIES, "inner")
    return policy_columns(
        freshness_columns(joined, F.col("calc_date"), cfg), cfg, by=["calc_date"]
    )


def _known_rollup(facts: DataFrame, days: list[dt.date]) -> DataFrame:
    """Weekly rollup split by `known`, the place of the first date by which the line was received.

    A line is received after it was bought, so by that date both are known. Lines that no
    date sees fall out. Stored, so the line-level join behind it runs once.
    """
    known = first_date("greatest(delivered_date, purchase_date)", days)
    dated = facts.withColumn("known", known).filter(F.col("known") < len(days))
    return stored(weekly_rollup(dated, "known"), "known")


def _entries_as_of(known: DataFrame, days: list[dt.date], weeks: int) -> tuple[DataFrame, list[str]]:
    """Entries of late-known sales, and the names of those that are summed.

    A week whose units grow from u to v by lines known later adds v - u, and v*v - u*u to the
    squares, when these become known. All of a week's entries leave the window together.
    """
    of_week = Window.partitionBy(*SERIES, "purchase_week").orderBy("known")
    so_far = of_week.rowsBetween(Window.unboundedPreceding, 0)
    units = F.coalesce("units", F.lit(0)).cast(QUANTITY)
    now, before = F.col("now").cast(QUANTITY), (F.col("now") - F.col("units")).cast(QUANTITY)
    week = F.col("purchase_week")
    # One shuffle by series serves the weeks, the sums per date and the running totals.
    steps = (
        known.repartition(*SERIES)
        .withColumn("units", units)
        .withColumns({"now": F.sum("units").over(so_far), "first": F.row_number().over(of_week) == 1})
    )
    window_sums = {
        "s": F.col("units").cast("decimal(28,4)"),
        "ss": (now * now - before * before).cast(SQUARE),
        "sold_weeks": (now != 0).cast("bigint") - (before != 0).cast("bigint"),
        "window_revenue": F.coalesce("revenue", F.lit(0)).cast(MONEY),
    }
    totals = {
        c: F.col(c).cast("decimal(30,0)") if c.endswith("_sq") else F.col(c) for c in DAY_SUMS
    } | {
        "active_weeks": F.col("first").cast("bigint"),
        "total_units": F.col("units").cast("decimal(28,4)"),
        "first_week": week,
        "last_week": week,
        "last_sale_week": F.when(F.col("units") > 0, week),
    }
    leaves = first_date(f"date_add(purchase_week, {7 * weeks})", days)
    return entries_of(steps, F.col("known"), leaves, window_sums, totals), [*window_sums, *DAY_SUMS, "active_weeks", "total_units"]


def params_history_as_of(facts: DataFrame, dates, cfg: PolicyConfig) -> DataFrame:
    """Like `params_history`, but each date sees only what was known by then. Runs jobs.

    A date's facts are the lines bought and received by it; demand, spine, floors and
    durations all come from these. Weeks without a sale are counted, not made: they lie
    between a series' first and last known sale week and inside the window.
    """
    days, weeks = _sorted_dates(dates), cfg.demand_window_weeks
    entries, sums = _entries_as_of(_known_rollup(facts, days), days, weeks)
    totals = running_totals(entries, days, sums, least=["first_week"], most=["last_week", "last_sale_week"])
    modelled = totals.filter(
        (F.col("n_lines") >= cfg.min_deliveries)
        & (F.col("active_weeks") >= cfg.min_weeks_history)
        & (F.col("total_units") >= cfg.min_units_history)
    )
    monday = F.date_sub("calc_date", F.weekday("calc_date"))
    opens = F.greatest("first_week", F.date_sub(monday, 7 * (weeks - 1)))
    n = (F.datediff("last_week", opens) / 7 + 1).cast("bigint")
    counted = modelled.withColumn("weeks", n).withColumn("zeros", F.col("weeks") - F.col("sold_weeks"))
    inputs = duration_stats(_window_stats(counted, weeks)).drop("sold_weeks", "first_week", "last_week")
    return policy_columns(
        freshness_columns(inputs, F.col("calc_date"), cfg), cfg, by=["calc_date"]
    )
