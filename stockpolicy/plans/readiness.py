"""Whether an extract can drive the model, checked on the whole extract before loading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpolicy.config import Mapping, PolicyConfig
from stockpolicy.functions.columns import to_timestamp, week_start
from stockpolicy.schemas import READINESS_REQUIRED
from stockpolicy.sources.extracts import good_lines, survey, to_canonical

OK, WARN, FAIL = "OK", "WARN", "FAIL"
DATE_COLUMNS = ("ordered_at", "received_at", "promised_at")


class InputNotReadyError(Exception):
    """The extract cannot support the model."""


def check_sources(
    spark: SparkSession, directory: str, mapping: Mapping, multiline: bool = True
) -> tuple[dict[str, DataFrame], list[str]]:
    """Canonical frames of the required sections, and every contract problem found."""
    sources, problems = survey(spark, directory, mapping, READINESS_REQUIRED, multiline)
    raw = {}
    for s in sources:
        present = {c: name for c, name in s.spec.columns.items() if name in s.lines.columns}
        raw[s.section] = good_lines(to_canonical(s.lines, s.section, type(s.spec)(s.spec.file, present)))
    return raw, problems


def _bad_dates() -> dict[str, Column]:
    return {
        c: F.count_if(F.col(c).isNotNull() & to_timestamp(c).isNull()).alias(c)
        for c in DATE_COLUMNS
    }


def unparseable(raw_orders: DataFrame) -> DataFrame:
    """Per date column: values that are present but will not parse."""
    counts = raw_orders.agg(*_bad_dates().values())
    return counts.unpivot([], list(DATE_COLUMNS), "column_name", "unparseable")


def status_values(raw_orders: DataFrame) -> DataFrame:
    return raw_orders.filter(F.col("status").isNotNull()).groupBy("status").agg(
        F.count("*").alias("n")
    )


def _usable_aggs(cfg: PolicyConfig) -> list[Column]:
    """Orders with a measurable duration, and the whole days of history they span / 7."""
    ordered, received = to_timestamp("ordered_at"), to_timestamp("received_at")
    usable = (F.col("status") == cfg.completed_status) & (received > ordered)
    first, last = F.min(F.when(usable, ordered)), F.max(F.when(usable, ordered))
    whole_days = F.floor(F.timestamp_diff("SECOND", first, last) / F.lit(86400))
    return [
        F.count_if(usable).alias("usable_orders"),
        (whole_days / F.lit(7.0)).alias("span_weeks"),
        first.cast("date").alias("first_day"),
        last.cast("date").alias("last_day"),
    ]


def usable_orders(raw_orders: DataFrame, cfg: PolicyConfig) -> DataFrame:
    return raw_orders.agg(*_usable_aggs(cfg))


def product_grain(raw_lines: DataFrame, raw_products: DataFrame) -> DataFrame:
    """Lines per product after joining products, where a repeated product counts its lines again.

    Lines and products are counted by product first, so the join is between one row per
    product on both sides.
    """
    lines, products = F.col("lines"), F.col("products")
    named = raw_lines.filter(F.col("product_id").isNotNull())
    sold = named.groupBy("product_id").agg(F.count("*").alias("sold"))
    listed = raw_products.groupBy("product_id").agg(F.count("*").alias("copies"))
    merged = sold.join(listed, "product_id", "left").select(
        (F.col("sold") * F.coalesce("copies", F.lit(1))).alias("lines")
    )
    return merged.groupBy("lines").agg(F.count("*").alias("products")).agg(
        F.percentile(lines, F.lit(0.5), products).alias("median_lines"),
        F.coalesce(F.sum(F.when(lines == 1, products)), F.lit(0)).alias("sold_exactly_once"),
        F.coalesce(F.sum(products), F.lit(0)).alias("products_sold"),
    )


def series_grain(
    raw_lines: DataFrame, raw_products: DataFrame, raw_orders: DataFrame, cfg: PolicyConfig
) -> DataFrame:
    """Series with enough distinct active weeks, over all orders, whatever their status.

    Weeks are made distinct by a first aggregation, map-side, so that no task
    holds the weeks of a hot series as a set.
    """
    week = week_start(to_timestamp("ordered_at").cast("date"))
    dated = raw_orders.select("order_id", week.alias("week")).filter(F.col("week").isNotNull())
    categorised = raw_products.filter(F.col("category").isNotNull())
    return (
        raw_lines.filter(F.col("supplier_id").isNotNull())
        .select("order_id", "product_id", "supplier_id")
        .join(dated, "order_id", "inner")
        .join(categorised.select("product_id", "category"), "product_id", "inner")
        .select("category", "supplier_id", "week")
        .distinct()
        .groupBy("category", "supplier_id")
        .agg(F.count("*").alias("weeks"))
        .agg(F.count_if(F.col("weeks") >= cfg.min_weeks_history).alias("viable_series"))
    )


def grain_verdict(product: DataFrame, series: DataFrame, cfg: PolicyConfig) -> DataFrame:
    median = product.select("median_lines").scalar()
    return series.select(
        F.when(median >= cfg.min_lines_per_product, "product")
        .when(F.col("viable_series") >= cfg.min_viable_series, "category+supplier")
        .otherwise("none")
        .alias("grain"),
        median.alias("median_lines"),
        "viable_series",
    )


def _check(name: str, value: Column, level: Column | None = None, detail: Column | None = None):
    return F.struct(
        F.lit(name).alias("check"),
        (F.lit(OK) if level is None else level).alias("level"),
        value.cast("double").alias("value"),
        (F.lit(None) if detail is None else detail).cast("string").alias("detail"),
    )


def _level(bad: Column, when_bad: str) -> Column:
    return F.when(bad, F.lit(when_bad)).otherwise(F.lit(OK))


def _rows(one_row: DataFrame, *checks: Column) -> DataFrame:
    return one_row.select(F.inline(F.array(*checks)))


def input_readiness(raw: dict[str, DataFrame], cfg: PolicyConfig) -> DataFrame:
    """All data checks as rows: check, level, value, detail.

    The order checks share one pass; the status values, the line counts and the
    series each need a grouping of their own.
    """
    orders, lines, products = raw["orders"], raw["order_lines"], raw["products"]
    usable, span = F.col("usable_orders"), F.col("span_weeks")
    seen = status_values(orders).orderBy("status").limit(8)
    seen = seen.agg(F.concat_ws(", ", F.array_sort(F.collect_list("status")))).scalar()
    done = F.col("completed")
    days = F.concat_ws(" to ", F.col("first_day").cast("string"), F.col("last_day").cast("string"))
    order_checks = _rows(
        orders.agg(
            *_bad_dates().values(),
            F.count_if(F.col("status") == cfg.completed_status).alias("completed"),
            *_usable_aggs(cfg),
        ),
        *(
            _check(f"unparseable {c}", F.col(c), _level(F.col(c) > 0, WARN))
            for c in DATE_COLUMNS
        ),
        _check("completed status", done, _level(done == 0, FAIL), seen),
        _check("usable orders", usable, _level(usable < cfg.min_usable_orders, FAIL)),
        _check("history weeks", span, _level(span < cfg.min_span_weeks, WARN), days),
    ).filter((F.col("check") != "history weeks") | F.col("value").isNotNull())
    product = product_grain(lines, products)
    product_checks = _rows(
        product,
        _check("median lines per product", F.col("median_lines")),
        _check("products sold exactly once", F.col("sold_exactly_once")),
        _check("products sold", F.col("products_sold")),
    )
    grain = F.col("grain")
    series_checks = _rows(
        grain_verdict(product, series_grain(lines, products, orders, cfg), cfg),
        _check("viable series", F.col("viable_series"), _level(grain == "none", FAIL), grain),
    )
    return order_checks.unionByName(product_checks).unionByName(series_checks)


def overall_verdict(readiness: DataFrame) -> DataFrame:
    """FAIL if any check failed, else WARN if any warned, else OK."""
    fails = F.count_if(F.col("level") == FAIL)
    warns = F.count_if(F.col("level") == WARN)
    return readiness.agg(
        F.when(fails > 0, FAIL).when(warns > 0, WARN).otherwise(OK).alias("verdict"),
        fails.alias("failed"),
        warns.alias("warned"),
    )


def require_ready(readiness: DataFrame) -> None:
    """Raises with every failed check. Runs a job; only failed rows are collected."""
    failed = readiness.filter(F.col("level") == FAIL).collect()
    if failed:
        listing = "; ".join(f"{r['check']}={r['value']:g}" for r in failed)
        raise InputNotReadyError(f"{len(failed)} readiness check(s) failed: {listing}")
