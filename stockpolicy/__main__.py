"""Command line: python -m stockpolicy check|load|profile|marts|run|backfill|findings|export."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from stockpolicy.config import Mapping, PolicyConfig
from stockpolicy.plans import findings, profile, readiness
from stockpolicy.plans.warehouse import Warehouse


def _reports(wh: Warehouse, calc_date: str | None) -> dict:
    params = wh.snapshots()
    return {
        "population": findings.f0_population(params, calc_date),
        "promised vs observed": findings.f1_duration_gap(params, calc_date),
        "inventory position": findings.f2_inventory_position(params, calc_date),
        "variance drivers": findings.f3_variance_drivers(params, calc_date),
        "flat rule vs model": findings.f4_flat_rule_gap(params, calc_date),
        "ABC x XYZ": findings.f5_abc_xyz_grid(params, calc_date),
        "freshness": findings.f6_freshness(params, calc_date),
        "least consistent": findings.f7_least_consistent(params, calc_date),
        "outlier sensitivity": findings.f8_outlier_sensitivity(params, wh.demand(), calc_date),
    }


def _profiles(wh: Warehouse) -> dict:
    raw = wh.raw()
    return {
        "status": profile.profile_status(raw["orders"]),
        "missing timestamps": profile.profile_nulls(raw["orders"]),
        "contradictions": profile.profile_contradictions(raw["orders"], wh.cfg),
        "first months": profile.profile_monthly(raw["orders"]),
        "uncategorised": profile.profile_uncategorised(raw["products"]),
        "lines per product": profile.profile_product_thickness(raw["order_lines"]),
        "repeated keys": profile.profile_duplicate_keys(raw),
    }


def _show(reports: dict) -> None:
    for title, df in reports.items():
        print(f"=== {title} ===")
        df.show(100, truncate=False)


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="stockpolicy")
    p.add_argument("step", choices=["check", "load", "profile", "marts", "run", "backfill", "findings", "export"])
    p.add_argument("--root", help="warehouse folder")
    p.add_argument("--dir", help="folder of the CSV extract, or to export to")
    p.add_argument("--mapping", help="mapping YAML")
    p.add_argument("--config", help="settings YAML")
    p.add_argument("--calc-date", help="date the parameters are computed as of")
    p.add_argument("--dates", nargs="+", help="dates to backfill")
    p.add_argument("--as-of", action="store_true", help="each date sees only what was known by then")
    p.add_argument("--mode", default="replace", choices=["replace", "upsert"])
    p.add_argument("--against", default="latest", choices=["latest", "before"], help="snapshot of the row-count gate")
    p.add_argument("--na-values", nargs="*", default=(), help="texts that mean a missing value")
    p.add_argument("--no-multiline", action="store_true", help="no line breaks inside values")
    a = p.parse_args(argv)

    spark = SparkSession.builder.appName("stockpolicy").getOrCreate()
    cfg = PolicyConfig.from_yaml(a.config) if a.config else PolicyConfig()
    mapping = Mapping.from_yaml(a.mapping) if a.mapping else None
    if mapping:
        cfg = cfg.with_(completed_status=mapping.completed_status)

    if a.step == "check":
        raw, problems = readiness.check_sources(spark, a.dir, mapping, not a.no_multiline)
        if problems:
            print("\n".join(problems))
            return 1
        report = readiness.input_readiness(raw, cfg).persist()
        report.show(50, truncate=False)
        return int(readiness.overall_verdict(report).first()["verdict"] == readiness.FAIL)

    wh = Warehouse(spark, a.root, cfg)
    if a.step == "load":
        print(wh.load(a.dir, mapping, not a.no_multiline, a.na_values))
    elif a.step == "profile":
        _show(_profiles(wh))
    elif a.step == "marts":
        wh.build_staging()
        wh.build_marts()
    elif a.step == "run":
        if not a.calc_date:
            p.error("run needs --calc-date")
        print(wh.run(a.calc_date, a.mode, a.against))
    elif a.step == "backfill":
        if not a.dates:
            p.error("backfill needs --dates")
        wh.backfill(a.dates, a.as_of)
    elif a.step == "export":
        wh.export(a.dir, a.calc_date)
    else:
        _show(_reports(wh, a.calc_date))
    return 0


if __name__ == "__main__":
    sys.exit(main())
