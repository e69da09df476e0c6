"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The raw purchase-order tables are derived and stored first (`raw_tables`, a line of its own).
Each query then runs once after a warm-up, from these to a sink that
discards the rows. `--plans` also prints the executed plans to stderr.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import time

from checks.compare import session
from checks.fixture import CALC_DATE, RawTables
from checks.queries import QUERIES, Tables, comparable
from checks.workspace import ensure_workspace
from stockpolicy.functions.session import stored
from stockpolicy.sources.snapshots import to_published

HEADLINE = [
    "exclusion_waterfall",
    "readiness_series_grain",
    "profile_product_thickness",
    "order_line_facts",
    "weekly_sales",
    "fct_demand_weekly",
    "fulfilment_stats",
    "dim_seller",
    "cumulative_revenue_share",
    "buffer_params",
    "buffer_params_history",
    "buffer_params_history_as_of",
    "quality_gates",
    "snapshot_replace",
    "finding_variance_drivers",
    "finding_outlier_sensitivity",
    "review_tiles",
]


def history_52_weeks(t):
    dates = [CALC_DATE - dt.timedelta(7 * i) for i in range(52)]
    return to_published(t.history(dates))


def run(query, spark, sf_dir, raw, show_plan=False) -> float:
    start = time.perf_counter()
    df = comparable(query(Tables(spark, sf_dir, raw)))
    df.write.format("noop").mode("overwrite").save()
    took = time.perf_counter() - start
    if show_plan:
        print(df._jdf.queryExecution().explainString(
            df._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        ), file=sys.stderr)
    return took


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = ensure_workspace(session())
    todo = {name: QUERIES[name] for name in HEADLINE} | {"history_52_weeks": history_52_weeks}
    start = time.perf_counter()
    raw = {name: stored(df, name) for name, df in RawTables(spark, sf_dir).items()}
    times = {"raw_tables": round(time.perf_counter() - start, 3)}
    run(QUERIES["buffer_params"], spark, sf_dir, raw)
    times |= {name: round(run(q, spark, sf_dir, raw, "--plans" in sys.argv), 3) for name, q in todo.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
