"""Column expressions: blanks, weeks, time-zone-free timestamps, exact moments."""

from __future__ import annotations

import datetime as dt
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

TIMESTAMP = "timestamp_ntz"
# A whole date, and a time after it or nothing. Spark's cast alone would also take a bare
# year, a year and month, and padded text.
WHOLE_DATE = r"^\d{4}-\d{2}-\d{2}([ T]\S.*)?$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def is_blank(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit("")) == ""


def to_timestamp(c: Column | str) -> Column:
    """Text to timestamp without zone; blank, malformed and partial dates become NULL."""
    return F.when(col(c).rlike(WHOLE_DATE), col(c).try_cast(TIMESTAMP))


def to_number(c: Column | str, type_: str) -> Column:
    """Text to a number; blank and malformed become NULL."""
    return col(c).try_cast(type_)


def timestamp_lit(d: dt.date) -> Column:
    return F.lit(d.isoformat()).cast(TIMESTAMP)


def date_lit(d: dt.date | str) -> Column:
    return F.lit(str(d)).cast("date")


def date_col(value: dt.date | str | Column) -> Column:
    """A date literal, or the column itself when the date differs per row."""
    return value if isinstance(value, Column) else date_lit(value)


def week_start(d: Column) -> Column:
    """Monday of the week of a DATE. Pure date arithmetic, no session time zone."""
    return F.date_sub(d, F.weekday(d))


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(col(end).cast("date"), col(start).cast("date"))


def ratio(num: Column, den: Column) -> Column:
    """num/den as double, NULL when the denominator is zero or NULL."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column, digits: int) -> Column:
    """Exact decimal percentage of two counts, rounded half up."""
    share = (part * 100).cast("decimal(20,0)") / F.nullif(whole.cast("decimal(20,0)"), F.lit(0))
    return F.round(share, digits)


def sd_from_sums(n: Column, total: Column, squares: Column) -> Column:
    """Sample sd from integer sums; 0 when there are fewer than two values.

    The numerator n*sum(x^2) - sum(x)^2 is evaluated in decimal(38,0), so it is
    exact and does not depend on the order in which partitions were merged.
    """
    n, total = n.cast("decimal(19,0)"), total.cast("decimal(19,0)")
    squares = squares.cast("decimal(30,0)")
    spread = (n * squares - total * total).cast("double")
    pairs = n.cast("double") * (n.cast("double") - 1)
    return F.when(n > 1, F.sqrt(spread / pairs)).otherwise(F.lit(0.0))


def sd_of_moments(n: Column, total: Column, squares: Column) -> Column:
    """Sample sd from exact sums of values and squares; NULL when there are fewer than two values."""
    s, ss = total.cast("double"), squares.cast("double")
    spread = F.greatest(ss - s * s / n, F.lit(0.0)) / (n - 1)
    return F.when(n > 1, F.sqrt(spread))


def z_value(service_level: float) -> float:
    """Standard normal quantile of a service level."""
    return NormalDist().inv_cdf(float(service_level))


def z_factor(service_level: Column, levels) -> Column:
    """Service level to z. The few configured levels become literals; no UDF."""
    out = F.lit(None).cast("double")
    for level in sorted(set(levels)):
        out = F.when(service_level == F.lit(float(level)), F.lit(z_value(level))).otherwise(out)
    return out
