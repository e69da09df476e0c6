"""The whole run: extract -> raw -> staging -> marts -> gates -> dated snapshot.

Each layer is written to shared storage and read back, so a later stage can be
rerun alone and nothing upstream is computed twice.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpolicy.config import Mapping, PolicyConfig
from stockpolicy.operators import marts as M
from stockpolicy.operators import staging as S
from stockpolicy.operators.gates import enforce, gates_of, measures, run_gates_by_date
from stockpolicy.operators.policy import SUMMARY, params_from_marts, require_nonempty, summary_measures
from stockpolicy.plans.findings import review_grid, review_tiles, review_worst
from stockpolicy.plans.history import params_history, params_history_as_of
from stockpolicy.schemas import SECTIONS
from stockpolicy.sources.extracts import BROKEN, assert_counts, broken_lines, good_lines, load_raw, path_exists
from stockpolicy.sources.layers import read_fact, write_fact, write_layer, write_small
from stockpolicy.sources import snapshots


def stage(raw: dict[str, DataFrame], cfg: PolicyConfig) -> dict[str, DataFrame]:
    """Lazy staging tables from raw ones."""
    typed = S.typed_orders(raw["orders"])
    tables = {
        "orders": S.staging_orders(typed, cfg),
        "order_items": S.staging_order_items(raw["order_lines"]),
        "products": S.staging_products(raw["products"], raw.get("category_labels")),
        "exclusions": S.exclusions(raw["orders"], cfg),
        "exclusion_waterfall": S.exclusion_waterfall(typed, cfg),
        "quarantine": S.quarantine(raw),
    }
    if "suppliers" in raw:
        tables["sellers"] = S.staging_sellers(raw["suppliers"])
    return tables


def _read_dir(spark: SparkSession, root: str, layer: str, names) -> dict[str, DataFrame]:
    found = {}
    for name in names:
        path = f"{root}/{layer}/{name}"
        if path_exists(spark, path):
            found[name] = spark.read.parquet(path)
    return found


class Warehouse:
    """Layer tables below one root folder, on any file system Spark can reach."""

    def __init__(self, spark: SparkSession, root: str, cfg: PolicyConfig):
        self.spark, self.root, self.cfg = spark, root.rstrip("/"), cfg

    @property
    def snapshots_path(self) -> str:
        return f"{self.root}/mart/buffer_params"

    def load(
        self, directory: str, mapping: Mapping, multiline: bool = True, na_values=()
    ) -> dict[str, int]:
        """Extract to raw, checking the line counts that the writes have seen.

        `na_values` are texts that mean a missing value, beside the empty one. With
        `multiline` each file is read by one task. Lines of a wrong width are stored beside the
        others, counted with them, and read by `broken_lines` only.
        """
        counts = {}
        for section, df in load_raw(self.spark, directory, mapping, multiline, na_values).items():
            lines = {"lines": F.count("*"), "broken": F.count(BROKEN)}
            counts[section] = write_layer(df, f"{self.root}/raw/{section}", measures=lines)
        assert_counts({s: n["lines"] - n["broken"] for s, n in counts.items()}, {})
        expected = {name: spec.expected_rows for name, spec in mapping.sections.items()}
        return assert_counts({s: n["lines"] for s, n in counts.items()}, expected)

    def _lines(self) -> dict[str, DataFrame]:
        return _read_dir(self.spark, self.root, "raw", SECTIONS)

    def raw(self) -> dict[str, DataFrame]:
        return {section: good_lines(df) for section, df in self._lines().items()}

    def broken_lines(self) -> DataFrame:
        """(table_name, line) of all lines whose number of fields was not the header's."""
        return broken_lines(self._lines())

    def build_staging(self) -> None:
        write_layer(self.broken_lines(), f"{self.root}/staging/quarantine_lines")
        for name, df in stage(self.raw(), self.cfg).items():
            if name == "exclusions":
                df = df.withColumn("recorded_at", F.current_timestamp())
            write_layer(df, f"{self.root}/staging/{name}")

    def staging(self) -> dict[str, DataFrame]:
        names = ("orders", "order_items", "products", "sellers", "exclusions", "exclusion_waterfall")
        return _read_dir(self.spark, self.root, "staging", (*names, "quarantine", "quarantine_lines"))

    def build_marts(self) -> None:
        staging = self.staging()
        lines = M.product_rollup(staging["orders"], staging["order_items"], self.cfg)
        by_product = self._keep(lines, "product_weekly")
        sums = self._keep(M.series_rollup(by_product, staging["products"]), "series_weekly")
        fct = M.fct_demand_weekly(M.weekly_sales(sums), self.cfg, self.cfg.spine_end)
        write_fact(fct, f"{self.root}/mart/fct_demand_weekly")
        write_layer(M.fulfilment_stats(sums, self.cfg), f"{self.root}/mart/fulfilment_stats")
        sellers = self._keep(M.dim_seller(by_product, staging.get("sellers")), "dim_seller")
        M.assert_unique_keys(sellers)

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/mart/{name}"
        write_layer(df, path)
        return self.spark.read.parquet(path)

    def demand(self, last: dt.date | str | None = None) -> DataFrame:
        return read_fact(self.spark, f"{self.root}/mart/fct_demand_weekly", last=last)

    def fulfilment(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/mart/fulfilment_stats")

    def snapshots(self) -> DataFrame:
        return snapshots.read_snapshots(self.spark, self.snapshots_path)

    def run(self, calc_date: dt.date | str, mode: str = "replace", against: str = "latest") -> dict:
        """Computes, checks and publishes one date. Nothing is published if a gate fails.

        One job computes the parameters: it writes them beside the current snapshots and observes
        what the summary and the gates need. Then a pointer switches to them.

        The row count is held against the `latest` snapshot, or the latest one `before` the date.
        """
        if mode not in ("replace", "upsert"):
            raise ValueError(f"unknown publish mode '{mode}'")
        if against not in ("latest", "before"):
            raise ValueError(f"unknown snapshot to compare with '{against}'")
        fct, fulfilment = self.demand(last=calc_date), self.fulfilment()
        require_nonempty(fct, fulfilment)
        path = self.snapshots_path
        out = snapshots.to_published(params_from_marts(fct, fulfilment, self.cfg, calc_date), calc_date)
        watched = measures(out, self.cfg) | summary_measures()
        staged = snapshots.stage(out, path, watched)
        try:
            if not staged.measures["computed"]:
                raise ValueError(f"nothing to publish: no series on {calc_date}")
            known = snapshots.snapshot_rows(self.spark, path)
            day = dt.date.fromisoformat(str(calc_date))
            earlier = [d for d in known if against == "latest" or d < day]
            before = known[max(earlier)] if earlier else None
            enforce(gates_of(self.spark, staged.measures, before, self.cfg))
            if mode == "upsert":
                snapshots.publish_upsert(staged.read(), path, calc_date)
            else:
                snapshots.assert_dates(staged, [calc_date])
                snapshots.switch(staged)
        except Exception:
            staged.discard()
            raise
        if mode == "upsert":
            staged.discard()
        return {name: staged.measures[name] for name in SUMMARY}

    def backfill(self, dates, as_of: bool = False) -> None:
        """Computes, checks and publishes many dates in one go, replacing their snapshots.

        With `as_of` each date sees only what was known by then; this joins orders to lines
        once more, because the stored rollup does not keep the day of receipt. All gates hold for
        each date alone, the row count against the date before it. A date without rows
        is an error. The parameters are computed by the write of the staged rows and checked
        there; nothing is published if a gate of any date fails.
        """
        dates = list(dates)
        if as_of:
            staging = self.staging()
            facts = M.order_line_facts(
                staging["orders"], staging["order_items"], staging["products"]
            )
            params = params_history_as_of(facts, dates, self.cfg)
        else:
            latest = max(str(d) for d in dates)
            params = params_history(self.demand(last=latest), self.fulfilment(), dates, self.cfg)
        path = self.snapshots_path
        staged = snapshots.stage(snapshots.to_published(params), path)
        try:
            snapshots.assert_dates(staged, dates)
            known = snapshots.snapshot_rows(self.spark, path)
            enforce(run_gates_by_date(staged.read(), known, self.cfg))
            snapshots.switch(staged)
        except Exception:
            staged.discard()
            raise

    def export(self, directory: str, calc_date: dt.date | str | None = None) -> None:
        """The exclusion audit as CSV and the review datasets as JSON, one small file each."""
        params = self.snapshots()
        write_small(self.staging()["exclusions"], f"{directory}/exclusions", "csv")
        write_small(review_grid(params, calc_date), f"{directory}/review_grid", "json")
        write_small(review_worst(params, calc_date), f"{directory}/review_worst", "json")
        write_small(review_tiles(params, calc_date), f"{directory}/review_tiles", "json")
