"""Quality gates between compute and publish."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockpolicy.config import PolicyConfig


MEASURES = ("total", "published", "negative", "out_of_range", "missing")


class DataQualityError(Exception):
    """At least one gate failed; nothing may be published."""


def _publishable(params: DataFrame) -> Column:
    return F.col("is_publishable") if "is_publishable" in params.columns else F.lit(True)


def measures(params: DataFrame, cfg: PolicyConfig) -> dict[str, Column]:
    """What the gates look at, as aggregates by name: for a group-by, or to be observed on a write."""
    live = _publishable(params)
    stock, days = F.col("ss_observed"), F.col("observed_mean_days")
    return {
        "total": F.count("*"),
        "published": F.count_if(live),
        "negative": F.count_if(live & (stock < 0)),
        "out_of_range": F.count_if(live & ((days <= 0) | (days > cfg.max_duration_days))),
        "missing": F.count_if(live & (stock.isNull() | F.isnan(stock))),
    }


def gates_of(spark: SparkSession, measured: dict[str, int], before: int | None, cfg: PolicyConfig) -> DataFrame:
    """`run_gates` from measures that are known already, and the rows of the snapshot to compare with."""
    row = {name: measured[name] for name in MEASURES} | {"before": before or None}
    schema = ", ".join(f"{name} bigint" for name in row)
    return _gates(spark.createDataFrame([tuple(row.values())], schema), cfg)


def run_gates(params: DataFrame, previous: DataFrame | None, cfg: PolicyConfig) -> DataFrame:
    """One row per gate: check, value, threshold, passed. One pass over the parameters.

    `previous` is the latest published snapshot, or None before the first one.
    All gates but the row count look at the publishable series only. An absent
    or empty snapshot has no drop to measure, and passes.
    """
    before = F.lit(None).cast("bigint")
    if previous is not None:
        before = previous.agg(F.count("*")).scalar()
    return _gates(_counts(params, cfg).withColumn("before", F.nullif(before, F.lit(0))), cfg)


def run_gates_by_date(
    params: DataFrame, published: dict[dt.date, int] | None, cfg: PolicyConfig
) -> DataFrame:
    """`run_gates` for each calc_date of `params`, in one aggregate: calc_date and the gate's columns.

    The row count of a date is held against the date before it, be that one of `params` or
    one of `published` (date to rows) that `params` doesn't replace. One row per date and gate.
    """
    counts = _counts(params, cfg, "calc_date").withColumn("new", F.lit(True))
    if published:
        rows = params.sparkSession.createDataFrame(list(published.items()), "calc_date date, total bigint")
        kept = rows.join(counts.select("calc_date"), "calc_date", "left_anti")
        counts = counts.unionByName(kept.withColumn("new", F.lit(False)), allowMissingColumns=True)
    earlier = F.lag("total").over(Window.orderBy("calc_date"))  # a row per date
    dated = counts.withColumn("before", F.nullif(earlier, F.lit(0))).filter("new")
    return _gates(dated, cfg, "calc_date")


def _counts(params: DataFrame, cfg: PolicyConfig, *by: str) -> DataFrame:
    return params.groupBy(*by).agg(*(c.alias(name) for name, c in measures(params, cfg).items()))


def _gates(counts: DataFrame, cfg: PolicyConfig, *by: str) -> DataFrame:
    def number(c: Column) -> Column:
        return c.cast("double")

    total, published = number(F.col("total")), number(F.col("published"))
    null_pct = F.coalesce(
        number(F.col("missing")) / F.nullif(published, F.lit(0.0)) * 100, F.lit(0.0)
    )
    drop_pct = (number(F.col("before")) - total) / number(F.col("before")) * 100

    def gate(name: str, value: Column, threshold: Column, passed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check"),
            value.alias("value"),
            threshold.alias("threshold"),
            F.coalesce(passed, F.lit(True)).alias("passed"),
        )

    zero = F.lit(0.0)
    negative, out_of_range = number(F.col("negative")), number(F.col("out_of_range"))
    max_null = F.lit(float(cfg.max_null_pct))
    max_drop = F.lit(float(cfg.max_row_drop_pct))
    return counts.select(
        *by,
        F.inline(
            F.array(
                gate("publishable series", published, total, F.lit(True)),
                gate("negative safety stock", negative, zero, negative == 0),
                gate("fulfilment duration out of range", out_of_range, zero, out_of_range == 0),
                gate("null parameters pct", null_pct, max_null, null_pct < max_null),
                gate("row count drop pct", drop_pct, max_drop, drop_pct <= max_drop),
            )
        ),
    )


def enforce(gates: DataFrame) -> None:
    """Raises with every failed gate listed. Runs a job; only failed gates are collected."""
    failed = gates.filter(~F.col("passed")).collect()
    if failed:
        date = (lambda r: f"{r['calc_date']} ") if "calc_date" in gates.columns else (lambda r: "")
        listing = "; ".join(
            f"{date(r)}{r['check']}: {r['value']:g} (limit {r['threshold']:g})" for r in failed
        )
        raise DataQualityError(f"not published, {len(failed)} gate(s) closed: {listing}")
