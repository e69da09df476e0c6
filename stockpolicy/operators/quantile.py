"""Exact percentiles by rank selection over order-preserving bits.

A double's 64 bits, read as a number, sort like the double. So a histogram over the
leading bits finds the interval that holds a rank; the values inside it are counted one by one
and a second histogram, over the bits that follow, narrows them to at most a million
neighbours before any are ordered. Many columns, groups and percentiles share these passes, and
their number is fixed whatever the rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpolicy.functions.session import stored

# 64 bits as 24 + 20 + 20: a histogram has 2^24 intervals at most, and 2^20 inside one of them.
MIDDLE, LAST = 20, 20


def ordered_bits(value: Column) -> Column:
    """The bits of a double as a long that sorts like it. Zero has one sign; NULL stays NULL."""
    positive = F.when(value == 0, F.lit(0.0)).otherwise(value)
    raw = F.call_function("java_method", F.lit("java.lang.Double"), F.lit("doubleToLongBits"), positive)
    bits = raw.cast("bigint")
    flipped = bits.bitwiseXOR(F.lit(2**63 - 1).cast("bigint"))
    return F.when(value.isNotNull(), F.when(bits < 0, flipped).otherwise(bits))


def from_bits(bits: Column) -> Column:
    """The double of `ordered_bits`."""
    raw = F.when(bits < 0, bits.bitwiseXOR(F.lit(2**63 - 1).cast("bigint"))).otherwise(bits)
    value = F.call_function("java_method", F.lit("java.lang.Double"), F.lit("longBitsToDouble"), raw)
    return F.when(bits.isNotNull(), value.cast("double"))


def _long(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """(by, column, bits): one row per value that is not NULL."""
    cells = F.array(
        *(F.struct(F.lit(c).alias("column"), ordered_bits(F.col(c).cast("double")).alias("bits")) for c in columns)
    )
    return df.select(*by, F.inline(cells)).filter(F.col("bits").isNotNull())


def _same(keys: list[str], left: str, right: str) -> Column:
    """Equal keys, where NULL is a group like any other."""
    return reduce(Column.__and__, (F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys))


def _narrowed(counts: DataFrame, ranks: DataFrame, keys: list[str], digit: str) -> DataFrame:
    """For each rank of `ranks` (keys, p, side, rank) its digit, and the rank inside it.

    counts: (keys, digit, n). The running total is over the digits of one group, whose number is
    bounded by the digit's width.
    """
    order = Window.partitionBy(*keys).orderBy(digit)
    upto = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    steps = counts.withColumn("upto", upto).withColumn("below", F.col("upto") - F.col("n"))
    inside = (F.col("r.rank") >= F.col("s.below")) & (F.col("r.rank") < F.col("s.upto"))
    joined = ranks.alias("r").join(steps.alias("s"), _same(keys, "r", "s") & inside)
    kept = [F.col(f"r.{c}") for c in ranks.columns if c != "rank"]
    return joined.select(*kept, F.col(f"s.{digit}"), (F.col("r.rank") - F.col("s.below")).alias("rank"))


def exact_percentiles(
    df: DataFrame, columns: list[str], shares: list[float], by: list[str] | tuple = ()
) -> DataFrame:
    """(by, column, p, value, n): interpolated percentiles of the non-null values, per group.

    The values are stored once, so `df` is computed once, and read twice: for the histogram and for
    the values in the intervals that hold a wanted rank. Groups without values have no row.
    Runs two jobs; nothing comes to the driver.
    """
    by = list(by)
    keys = [*by, "column"]
    values = stored(_long(df, columns, by), "values")
    lead, middle = F.shiftright("bits", MIDDLE + LAST), F.shiftright("bits", LAST)
    histogram = values.groupBy(*keys, lead.alias("lead")).agg(F.count("*").alias("n"))
    sizes = histogram.groupBy(*keys).agg(F.sum("n").alias("size"))
    at = F.explode(F.array(*(F.lit(float(p)) for p in shares))).alias("p")
    place = F.col("p") * (F.col("size") - 1)
    both = F.array(*(F.struct(F.lit(i).alias("side"), f(place).cast("bigint").alias("rank")) for i, f in enumerate((F.floor, F.ceil))))
    ranks = sizes.select(*keys, "size", at).select(*keys, "size", "p", F.inline(both))
    first = stored(_narrowed(histogram, ranks, keys, "lead"), "ranks")

    # Second reading: only the values of the wanted intervals, counted by their bits.
    wanted = first.select(*keys, "lead").distinct()
    held = values.withColumn("lead", lead).alias("v").join(wanted.alias("w"), _same([*keys, "lead"], "v", "w"))
    near = stored(
        held.groupBy(*(F.col(f"v.{k}") for k in keys), F.col("v.lead"), F.col("v.bits")).agg(F.count("*").alias("n")),
        "near",
    ).withColumn("middle", middle)
    in_lead = [*keys, "lead"]
    second = _narrowed(near.groupBy(*in_lead, "middle").agg(F.sum("n").alias("n")), first, in_lead, "middle")
    in_middle = [*in_lead, "middle"]
    neighbours = near.alias("v").join(second.select(*in_middle).distinct().alias("w"), _same(in_middle, "v", "w")).select("v.*")
    exact = _narrowed(neighbours, second, in_middle, "bits").withColumn("value", from_bits(F.col("bits")))
    low, high = (F.max(F.when(F.col("side") == i, F.col("value"))) for i in (0, 1))
    between = F.col("p") * (F.col("n") - 1) - F.floor(F.col("p") * (F.col("n") - 1))
    return (
        exact.groupBy(*keys, "p", F.col("size").alias("n"))
        .agg(low.alias("low"), high.alias("high"))
        .select(*keys, "p", (F.col("low") + (F.col("high") - F.col("low")) * between).alias("value"), "n")
    )


def exact_percentile(df: DataFrame, value: str, p: float) -> DataFrame:
    """One row: the interpolated percentile of the non-null values, and their count. Runs two jobs.

    Without values the percentile is NULL and the count 0.
    """
    found = exact_percentiles(df, [value], [p])
    return found.agg(F.max("value").alias("value"), F.coalesce(F.max("n"), F.lit(0)).alias("n"))
