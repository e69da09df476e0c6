"""Layer tables: overwritten as a whole, so a rerun reproduces them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_layer(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    fmt: str = "parquet",
    measures: dict[str, Column] | None = None,
) -> dict:
    """Truncate and load. Runs a job. Must not overwrite a path the plan reads.

    Returns `measures`, aggregates observed by the job that writes.
    """
    seen = Observation()
    if measures:
        df = df.observe(seen, *(c.alias(name) for name, c in measures.items()))
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if fmt == "csv":
        # Spark trims values by default; text is written as it is.
        writer = writer.option("header", True)
        for side in ("Leading", "Trailing"):
            writer = writer.option(f"ignore{side}WhiteSpace", False)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(fmt).save(path)
    return dict(seen.get) if measures else {}


def write_fact(df: DataFrame, path: str) -> None:
    """Weekly fact partitioned by year of week. Runs a job.

    Rebalancing lets adaptive execution choose the number and size of files;
    sorting by week inside them makes min/max pruning work for window scans.
    """
    by_year = df.withColumn("week_year", F.year("purchase_week")).hint("rebalance", "week_year")
    write_layer(
        by_year.sortWithinPartitions("week_year", "purchase_week", "category", "seller_id"),
        path,
        ["week_year"],
    )


def read_fact(
    spark: SparkSession, path: str, first: dt.date | None = None, last: dt.date | None = None
) -> DataFrame:
    """The weekly fact, optionally only weeks from `first` to `last`.

    The bounds prune year folders, then row groups by the week's min/max.
    """
    df = spark.read.parquet(path)
    for bound, keep in ((first, ">="), (last, "<=")):
        if bound is not None:
            day = f"date'{bound}'"
            df = df.filter(f"week_year {keep} year({day}) and purchase_week {keep} {day}")
    return df.drop("week_year")


def write_small(df: DataFrame, path: str, fmt: str) -> None:
    """One-file export of a report of a few rows, as CSV or JSON. Runs a job."""
    write_layer(df.coalesce(1), path, fmt=fmt)
