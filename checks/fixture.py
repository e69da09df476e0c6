"""Raw purchase-order tables derived from the driver's star schema.

Durations, defects and missing values come from the keys by integer
arithmetic, so that Spark and the SQL oracle derive the same rows. Every
column is text, as in a raw extract.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockpolicy.config import PolicyConfig

CALC_DATE = dt.date(2001, 7, 31)
PREVIOUS_DATE = dt.date(2001, 7, 24)
HISTORY_DATES = [
    dt.date(2000, 6, 30),
    dt.date(2000, 12, 31),
    dt.date(2001, 3, 31),
    dt.date(2001, 6, 27),
    PREVIOUS_DATE,
    CALC_DATE,
]
STOPPED_FROM = dt.date(2001, 4, 9)

CFG = PolicyConfig(
    completed_status="F",
    start_date=dt.date(1995, 7, 1),
    period_starts=(dt.date(1995, 7, 1), dt.date(1998, 1, 1)),
)

# A fact window that crosses a year, and gates that most series fail.
FACT_FROM = dt.date(2000, 11, 1)
STRICT = CFG.with_(max_duration_days=1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deals rows out to all cores: one file with one row group is read by a single task."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def _plus_days(ts: Column, days: Column) -> Column:
    return (ts + F.make_dt_interval(days.cast("int"))).cast("string")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, ordered = F.col("o_orderkey"), F.col("o_orderdate")
    took = F.when(key % 101 == 0, F.lit(0)).otherwise((key * 37) % 23 + 3)
    quoted = (key * 11) % 15 + 14
    return table(spark, sf_dir, "orders").select(
        key.cast("string").alias("order_id"),
        F.col("o_orderstatus").alias("status"),
        _plus_days(ordered, F.lit(0)).alias("ordered_at"),
        F.when(key % 97 == 0, F.lit(None))
        .when(key % 499 == 0, "not-a-date")
        .when(key % 503 == 0, "2001")
        .when(key % 509 == 0, "2001-3")
        .when(key % 521 == 0, " 2001-01-02 ")
        .otherwise(_plus_days(ordered, took))
        .alias("received_at"),
        _plus_days(ordered, quoted).alias("promised_at"),
        F.when(key % 5 == 0, F.lit(None))
        .when(key % 89 == 0, _plus_days(ordered, took + 3))
        .otherwise(_plus_days(ordered, F.floor(took / 2)))
        .alias("dispatched_at"),
    )


def raw_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spread(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"
        )
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    bucket = F.floor(F.sqrt("l_suppkey"))
    stopped = (
        (bucket >= 7)
        & (F.col("p_type") == "PROMO")
        & (F.col("o_orderdate").cast("date") >= F.lit(STOPPED_FROM))
    )
    # Price per unit, rounded half up in whole cents.
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    unit_cents = F.expr("(2 * cents + qty) div (2 * qty)")
    unit_value = (unit_cents.cast("decimal(18,0)") / 100).cast("decimal(18,2)")
    supplier = F.when(stopped, bucket - 5).otherwise(bucket)
    lines = lines.withColumns({"cents": cents, "qty": F.col("l_quantity").cast("bigint")})
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("l_orderkey").cast("string").alias("order_id"),
            F.col("l_linenumber").cast("string").alias("line_no"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.concat(F.lit("S"), supplier.cast("string")).alias("supplier_id"),
            unit_value.cast("string").alias("unit_value"),
            F.when(F.col("l_linenumber") != 7, F.col("qty").cast("string")).alias(
                "quantity"
            ),
        )
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some products are listed twice."""
    twice = F.when(F.col("p_partkey") % 61 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.when(F.col("p_partkey") % 50 != 0, F.col("p_type")).alias("category"),
        F.explode(twice).alias("copy"),
    ).drop("copy")


def raw_category_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_type")
    label = F.when(kind == "LARGE", "").otherwise(F.concat(F.lower(kind), F.lit("_goods")))
    kinds = table(spark, sf_dir, "part").select(kind).distinct()
    return kinds.filter(kind != "ECONOMY").select(kind.alias("category"), label.alias("label"))


def raw_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    bucket = F.floor(F.sqrt("s_suppkey"))
    first = (
        table(spark, sf_dir, "supplier")
        .groupBy(bucket.alias("bucket"))
        .agg(F.min_by("s_nationkey", "s_suppkey").alias("n_nationkey"))
        .filter("bucket > 0")
    )
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    regions = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (
        first.join(nations, "n_nationkey")
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat(F.lit("S"), F.col("bucket").cast("string")).alias("supplier_id"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("region"),
        )
    )


RAW = {
    "orders": raw_orders,
    "order_lines": raw_order_lines,
    "products": raw_products,
    "suppliers": raw_suppliers,
    "category_labels": raw_category_labels,
}


def broken_line_texts(raw_lines: DataFrame) -> DataFrame:
    """(line): lines of the order-line extract that lost their end, or have a field too many."""
    key = F.col("order_id").cast("bigint")
    end = F.when(key % 2 == 0, F.lit("")).otherwise(F.lit(",x,S1,1.00,1,extra"))
    chosen = raw_lines.filter((F.col("line_no") == "1") & (key % 251 == 0))
    return chosen.select(F.concat("order_id", F.lit(","), "line_no", end).alias("line"))


class RawTables(Mapping):
    """Raw section to frame; each is built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir, self._built = spark, sf_dir, {}

    def __getitem__(self, section: str) -> DataFrame:
        if section not in self._built:
            self._built[section] = RAW[section](self._spark, self._sf_dir)
        return self._built[section]

    def __iter__(self):
        return iter(RAW)

    def __len__(self) -> int:
        return len(RAW)
