"""Registered queries: each runs one operator over the whole fixture."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.fixture import (
    CALC_DATE,
    CFG,
    FACT_FROM,
    HISTORY_DATES,
    PREVIOUS_DATE,
    STRICT,
    RawTables,
    broken_line_texts,
)
from checks.workspace import ensure_workspace
from stockpolicy.config import Mapping as SourceMapping
from stockpolicy.config import SourceSpec
from stockpolicy.functions.session import scratch_path, stored
from stockpolicy.operators import gates, marts, policy, quantile, segment, staging, stats
from stockpolicy.plans import findings, history, profile, readiness
from stockpolicy.schemas import SERIES
from stockpolicy.sources import extracts, layers, snapshots

# Foreign column names, as an ERP extract would have them.
FOREIGN = {
    "orders": {
        "order_id": "PO_NUMBER",
        "status": "PO_STATUS",
        "ordered_at": "PO_RELEASE_DT",
        "received_at": "GR_POSTING_DT",
        "promised_at": "CONFIRMED_DLV_DT",
        "dispatched_at": "GI_DT",
    },
    "order_lines": {
        "order_id": "PO_NUMBER",
        "line_no": "PO_ITEM",
        "product_id": "MATNR",
        "supplier_id": "LIFNR",
        "unit_value": "NET_PRICE",
        "quantity": "MENGE",
    },
    "products": {"product_id": "MATNR", "category": "MATKL"},
}


def to_foreign(df: DataFrame, section: str) -> DataFrame:
    return df.withColumnsRenamed(FOREIGN[section])


class Tables:
    """The fixture's layers, all lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str, raw: Mapping[str, DataFrame] | None = None):
        self.spark, self.sf_dir = spark, sf_dir
        self.raw = RawTables(spark, sf_dir) if raw is None else raw

    @cached_property
    def typed(self) -> DataFrame:
        return staging.typed_orders(self.raw["orders"])

    @cached_property
    def orders(self) -> DataFrame:
        return staging.staging_orders(self.typed, CFG)

    @cached_property
    def items(self) -> DataFrame:
        return staging.staging_order_items(self.raw["order_lines"])

    @cached_property
    def products(self) -> DataFrame:
        return staging.staging_products(self.raw["products"], self.raw["category_labels"])

    @cached_property
    def sellers(self) -> DataFrame:
        return staging.staging_sellers(self.raw["suppliers"])

    @cached_property
    def facts(self) -> DataFrame:
        return marts.order_line_facts(self.orders, self.items, self.products)

    @cached_property
    def by_product(self) -> DataFrame:
        return marts.product_rollup(self.orders, self.items, CFG)

    @cached_property
    def rollup(self) -> DataFrame:
        return marts.series_rollup(self.by_product, self.products)

    @cached_property
    def dim_seller(self) -> DataFrame:
        return marts.dim_seller(self.by_product, self.sellers)

    @cached_property
    def sales(self) -> DataFrame:
        return marts.weekly_sales(self.rollup)

    @cached_property
    def stored(self) -> DataFrame:
        """The rollup as a stored mart: demand and durations both build on it."""
        return stored(self.rollup, "rollup")

    @cached_property
    def fct(self) -> DataFrame:
        return marts.fct_demand_weekly(marts.weekly_sales(self.stored), CFG)

    @cached_property
    def fulfilment(self) -> DataFrame:
        return marts.fulfilment_stats(self.stored, CFG)

    @cached_property
    def demand(self) -> DataFrame:
        """The weekly fact straight from the lines, for plans that need nothing else."""
        return marts.fct_demand_weekly(self.sales, CFG)

    @cached_property
    def window(self) -> DataFrame:
        return stats.trailing_demand(self.demand, CALC_DATE, CFG.demand_window_weeks)

    @cached_property
    def series(self) -> DataFrame:
        """Joined per-series inputs, before classification."""
        inputs = stats.series_inputs(self.fct, CALC_DATE, CFG.demand_window_weeks)
        return policy.freshness_columns(
            inputs.join(self.fulfilment, SERIES, "inner"), CALC_DATE, CFG
        )

    def params_at(self, calc_date) -> DataFrame:
        return policy.params_from_marts(self.fct, self.fulfilment, CFG, calc_date)

    @cached_property
    def params(self) -> DataFrame:
        return self.params_at(CALC_DATE)

    @cached_property
    def published(self) -> DataFrame:
        return snapshots.to_published(self.params, CALC_DATE)

    @cached_property
    def two_dates(self) -> DataFrame:
        """Two snapshots, stored: some queries read them several times."""
        return stored(snapshots.to_published(self.history([PREVIOUS_DATE, CALC_DATE])), "two_dates")

    def history(self, dates) -> DataFrame:
        return history.params_history(self.fct, self.fulfilment, dates, CFG)


def comparable(df: DataFrame) -> DataFrame:
    """Numbers as doubles at six places and timestamps as text, like the oracle's."""

    def column(name: str, type_: str):
        if type_ == "double" or type_.startswith("decimal"):
            return F.round(F.col(name).cast("double"), 6).alias(name)
        if type_.startswith("timestamp"):
            return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)
        return F.col(name)

    return df.select(*(column(name, type_) for name, type_ in df.dtypes))


def _scan_mapped_csv(t: Tables) -> DataFrame:
    """Order lines as a foreign extract, with a file of lines that are too short or too long."""
    folder = scratch_path(t.spark, "extract")
    foreign = to_foreign(t.raw["order_lines"], "order_lines")
    layers.write_layer(foreign, f"{folder}/good", fmt="csv")
    header = t.spark.createDataFrame([(",".join(foreign.columns), 0)], "line string, at int")
    lines = header.unionByName(broken_line_texts(t.raw["order_lines"]).withColumn("at", F.lit(1)))
    layers.write_layer(lines.coalesce(1).sortWithinPartitions("at").select("line"), f"{folder}/broken", fmt="text")
    mapping = SourceMapping({"order_lines": SourceSpec("lines", FOREIGN["order_lines"])})
    return extracts.scan_mapped(t.spark, f"{folder}/*", "order_lines", mapping, keep_broken=True)


def _layer_overwritten(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "layer")
    layers.write_layer(t.raw["products"].unionByName(t.raw["products"]), path)
    layers.write_layer(t.raw["products"], path)
    return t.spark.read.parquet(path)


def _stored_fact_window(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "fact")
    layers.write_fact(t.fct, path)
    return layers.read_fact(t.spark, path, FACT_FROM, CALC_DATE)


def _exported_exclusions(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "export")
    audit = staging.exclusions(t.raw["orders"], CFG).withColumn("recorded_at", F.current_timestamp())
    layers.write_small(audit, path, "csv")
    found = t.spark.read.schema("step string, reason string, rows_removed bigint, recorded_at timestamp")
    rows = found.option("header", True).csv(path)
    age = F.timestamp_diff("SECOND", F.col("recorded_at"), F.current_timestamp())
    return rows.withColumn("recorded", age.between(0, 86400)).drop("recorded_at")


def _exported_review(t: Tables) -> DataFrame:
    path, grid = scratch_path(t.spark, "export"), findings.review_grid(t.published)
    layers.write_small(grid, path, "json")
    return t.spark.read.schema(grid.schema).json(path)


def _snapshot_rows(t: Tables) -> DataFrame:
    """Rows of each date as the pointer of the published table names them."""
    path = scratch_path(t.spark, "buffer_params")
    dates = [PREVIOUS_DATE, CALC_DATE]
    snapshots.publish_replace(snapshots.to_published(t.history(dates)), path, dates)
    rows = snapshots.snapshot_rows(t.spark, path)
    return t.spark.createDataFrame(list(rows.items()), "calc_date date, n_rows bigint")


def _line_value_share(t: Tables) -> DataFrame:
    """The running share over single lines, in seven ranges at least."""
    lines = t.items.withColumn("line_value", F.col("price") * F.col("qty"))
    shares = segment.cumulative_share(lines, "line_value", ["order_id", "item_seq"], buckets=7)
    return shares.select("order_id", "item_seq", "line_value", "cum_share_before", "cum_share")


def _canonical(t: Tables, section: str, drop: str | None = None) -> DataFrame:
    columns = {c: s for c, s in FOREIGN[section].items() if c != drop}
    foreign = to_foreign(t.raw[section], section).withColumn("UNMAPPED", F.lit("x"))
    return extracts.to_canonical(foreign, section, SourceSpec(section, columns))


def _republished(t: Tables, publish) -> DataFrame:
    """Two dates published, then the second one again with other values and fewer keys."""
    path = scratch_path(t.spark, "buffer_params")
    two = snapshots.to_published(t.history([PREVIOUS_DATE, CALC_DATE]))
    snapshots.publish_replace(two, path, [PREVIOUS_DATE, CALC_DATE])
    rerun = (
        snapshots.latest_snapshot(snapshots.read_snapshots(t.spark, path))
        .filter(F.col("abc") == "A")
        .withColumn("naive_total_cover", F.col("demand_mean") * 3)
    )
    publish(rerun, path)  # read from the current commit, written to another
    return snapshots.read_snapshots(t.spark, path).select(
        "calc_date", *SERIES, "abc", "ss_observed", "naive_total_cover"
    )


def _upsert(t: Tables) -> DataFrame:
    return _republished(t, lambda df, path: snapshots.publish_upsert(df, path, CALC_DATE))


def _gates(t: Tables) -> DataFrame:
    both = t.two_dates
    earlier = snapshots.latest_snapshot(both, before=CALC_DATE)
    return gates.run_gates(snapshots.latest_snapshot(both), earlier, CFG)


def _volume_gate(t: Tables) -> DataFrame:
    live = t.published.filter("is_publishable")
    return gates.run_gates(live, t.published, CFG).filter(F.col("check") == "row count drop pct")


def _series_grain(t: Tables) -> DataFrame:
    raw = t.raw
    return readiness.series_grain(raw["order_lines"], raw["products"], raw["orders"], CFG)


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    # Sources
    "scan_mapped_csv": lambda t: extracts.good_lines(_scan_mapped_csv(t)),
    "quarantine_lines": lambda t: extracts.broken_lines({"order_lines": _scan_mapped_csv(t)}),
    "layer_overwritten": _layer_overwritten,
    "canonical_orders": lambda t: _canonical(t, "orders"),
    "canonical_order_lines": lambda t: _canonical(t, "order_lines", drop="quantity"),
    "raw_row_counts": lambda t: extracts.raw_row_counts(t.raw),
    # Staging
    "typed_orders": lambda t: t.typed,
    "quarantine_orders": lambda t: staging.quarantine(t.raw),
    "staging_orders": lambda t: t.orders,
    "exclusions": lambda t: staging.exclusions(t.raw["orders"], CFG),
    "exclusion_waterfall": lambda t: staging.exclusion_waterfall(t.typed, CFG),
    "staging_products": lambda t: t.products,
    "staging_order_items": lambda t: t.items,
    "staging_sellers": lambda t: t.sellers,
    # Profile
    "profile_status": lambda t: profile.profile_status(t.raw["orders"]),
    "profile_nulls": lambda t: profile.profile_nulls(t.raw["orders"]),
    "profile_contradictions": lambda t: profile.profile_contradictions(t.raw["orders"], CFG),
    "profile_monthly": lambda t: profile.profile_monthly(t.raw["orders"]),
    "profile_uncategorised": lambda t: profile.profile_uncategorised(t.raw["products"]),
    "profile_product_thickness": lambda t: profile.profile_product_thickness(t.raw["order_lines"]),
    "profile_duplicate_keys": lambda t: profile.profile_duplicate_keys(t.raw),
    "line_value_share": _line_value_share,
    "seller_percentiles": lambda t: quantile.exact_percentiles(
        t.items, ["price", "qty"], [0.1, 0.5, 0.9], ["seller_id"]
    ),
    "line_value_percentile": lambda t: quantile.exact_percentile(t.items, "price", 0.9),
    # Readiness
    "readiness_unparseable": lambda t: readiness.unparseable(t.raw["orders"]),
    "readiness_status": lambda t: readiness.status_values(t.raw["orders"]),
    "readiness_usable": lambda t: readiness.usable_orders(t.raw["orders"], CFG),
    "readiness_product_grain": lambda t: readiness.product_grain(t.raw["order_lines"], t.raw["products"]),
    "readiness_series_grain": _series_grain,
    "readiness_grain_verdict": lambda t: readiness.grain_verdict(
        readiness.product_grain(t.raw["order_lines"], t.raw["products"]), _series_grain(t), CFG
    ),
    "input_readiness": lambda t: readiness.input_readiness(t.raw, CFG),
    "readiness_overall": lambda t: readiness.overall_verdict(readiness.input_readiness(t.raw, CFG)),
    # Marts
    "order_line_facts": lambda t: t.facts,
    "weekly_sales": lambda t: t.sales,
    "modelled_series": lambda t: marts.modelled_series(t.sales, CFG),
    "calendar_spine": lambda t: marts.calendar_spine(marts.modelled_series(t.sales, CFG)),
    "fct_demand_weekly": lambda t: t.demand,
    "fct_demand_to_calc_date": lambda t: marts.fct_demand_weekly(t.sales, CFG, CALC_DATE),
    "stored_fact_window": _stored_fact_window,
    "fulfilment_stats": lambda t: marts.fulfilment_stats(t.rollup, CFG),
    "dim_seller": lambda t: t.dim_seller.drop("seller_key"),
    "dim_seller_keys": lambda t: t.dim_seller,
    # Series statistics
    "trailing_demand": lambda t: t.window,
    "demand_stats": lambda t: stats.demand_stats(t.window),
    "series_activity": lambda t: stats.series_activity(t.demand, CALC_DATE),
    "annualised_revenue": lambda t: stats.annualised_revenue(t.window, CFG.demand_window_weeks),
    # Segmentation
    "cumulative_revenue_share": lambda t: segment.cumulative_share(
        t.series, "annualised_revenue", SERIES
    ).select(*SERIES, "annualised_revenue", "cum_share_before", "cum_share"),
    "abc_classes": lambda t: segment.classify_abc(t.series, CFG).select(
        *SERIES, "cum_share", "abc"
    ),
    "xyz_classes": lambda t: segment.classify_xyz(t.series, CFG).select(*SERIES, "cv", "xyz"),
    # Policy
    "series_freshness": lambda t: t.series.select(
        *SERIES, "last_sale_week", "weeks_since_last_sale", "is_stale"
    ),
    "z_factors": lambda t: t.params.select(*SERIES, "abc", "service_level", "z"),
    "safety_stock": lambda t: t.params.select(*SERIES, "ss_observed", "ss_promised"),
    "reorder_point": lambda t: t.params.select(
        *SERIES, "cycle_observed", "cycle_promised", "rop_observed", "rop_promised"
    ),
    "variance_decomposition": lambda t: t.params.select(
        *SERIES,
        "observed_demand_term",
        "observed_supply_term",
        "promised_demand_term",
        "promised_supply_term",
        "supply_variance_share",
    ),
    "flat_cover_baseline": lambda t: t.params.select(
        *SERIES, "naive_total_cover", "model_total_target"
    ),
    "publishability": lambda t: t.params.select(
        *SERIES,
        "zero_week_share",
        "is_intermittent",
        "is_stale",
        "is_publishable",
        "exclusion_reason",
    ),
    "buffer_params": lambda t: t.published,
    "run_summary": lambda t: policy.run_summary(t.params),
    "buffer_params_history": lambda t: snapshots.to_published(t.history(HISTORY_DATES)),
    "buffer_params_history_as_of": lambda t: snapshots.to_published(
        history.params_history_as_of(t.facts, HISTORY_DATES, CFG)
    ),
    # Gates and snapshots
    "quality_gates": _gates,
    "volume_gate": _volume_gate,
    "closed_gates": lambda t: gates.run_gates(t.published, None, STRICT).filter("NOT passed"),
    "snapshot_rows": _snapshot_rows,
    "backfill_gates": lambda t: gates.run_gates_by_date(t.history(HISTORY_DATES), None, CFG),
    "snapshot_upsert": _upsert,
    "snapshot_replace": lambda t: _republished(t, lambda df, path: snapshots.publish_replace(df, path, [CALC_DATE])),
    "latest_snapshot": lambda t: snapshots.latest_snapshot(t.two_dates),
    # Findings and review datasets
    "finding_population": lambda t: findings.f0_population(t.published),
    "finding_duration_gap": lambda t: findings.f1_duration_gap(t.published),
    "finding_inventory_position": lambda t: findings.f2_inventory_position(t.published),
    "finding_variance_drivers": lambda t: findings.f3_variance_drivers(t.published),
    "finding_flat_rule_gap": lambda t: findings.f4_flat_rule_gap(t.published),
    "finding_abc_xyz_grid": lambda t: findings.f5_abc_xyz_grid(t.published),
    "finding_freshness": lambda t: findings.f6_freshness(t.published),
    "finding_least_consistent": lambda t: findings.f7_least_consistent(t.published),
    "finding_outlier_sensitivity": lambda t: findings.f8_outlier_sensitivity(t.published, t.fct),
    "ranked_weeks": lambda t: findings.ranked_weeks(t.demand),
    "review_grid": lambda t: findings.review_grid(t.published),
    "review_worst": lambda t: findings.review_worst(t.published),
    "review_tiles": lambda t: findings.review_tiles(t.published),
    "exported_exclusions": _exported_exclusions,
    "exported_review": _exported_review,
}


def _bind(run: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: comparable(run(Tables(ensure_workspace(spark), sf_dir)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bind(run) for name, run in QUERIES.items()}
