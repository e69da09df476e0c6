import datetime as dt
from decimal import Decimal

import pytest
from support import plan_of
from pyspark.sql import functions as F

from stockpolicy.config import PolicyConfig
from stockpolicy.operators import marts, staging

CFG = PolicyConfig(min_weeks_history=2, min_units_history=5)
SALES = "category string, seller_id string, purchase_week string, units decimal(28,4), revenue decimal(38,8)"


def sales(spark, rows):
    df = spark.createDataFrame(
        [(c, s, w, Decimal(u), Decimal(u * 2)) for c, s, w, u in rows], SALES
    )
    return df.withColumn("purchase_week", F.col("purchase_week").cast("date"))


ROWS = [
    ("a", "s", "2018-01-01", 3),
    ("a", "s", "2018-01-22", 4),
    ("a", "s", "2018-01-29", 1),
    ("a", "thin", "2018-01-01", 50),
    ("a", "few", "2018-01-01", 1),
    ("a", "few", "2018-01-08", 1),
    ("b", "s", "2017-12-25", 2),
    ("b", "s", "2018-01-08", 3),
]


def test_floors(spark):
    got = {(r["category"], r["seller_id"]) for r in marts.modelled_series(sales(spark, ROWS), CFG).collect()}
    assert got == {("a", "s"), ("b", "s")}


def test_gap_fill_equals_spine_join(spark):
    df = sales(spark, ROWS)
    spine = marts.calendar_spine(marts.modelled_series(df, CFG))
    key = ["category", "seller_id", "purchase_week"]
    want = spine.join(df, key, "left").select(
        *key, F.coalesce("units", F.lit(0)).alias("units"), F.coalesce("revenue", F.lit(0)).alias("revenue")
    )
    dense = marts.fct_demand_weekly(df, CFG)
    assert dense.exceptAll(want).isEmpty() and want.exceptAll(dense).isEmpty()
    weeks = [r["purchase_week"] for r in dense.filter("category = 'a'").orderBy("purchase_week").collect()]
    assert weeks == [dt.date(2018, 1, 1) + dt.timedelta(7 * i) for i in range(5)]


def test_density_on_the_fixture(tables):
    ext = tables.fct.groupBy("category", "seller_id").agg(
        F.count("*").alias("n"),
        F.countDistinct("purchase_week").alias("distinct_weeks"),
        (F.datediff(F.max("purchase_week"), F.min("purchase_week")) / 7 + 1).alias("span"),
    )
    assert ext.filter("n <> span or n <> distinct_weeks").isEmpty()


def test_spine_can_run_on_to_a_date(spark):
    dense = marts.fct_demand_weekly(sales(spark, ROWS), CFG, dt.date(2018, 2, 14))
    last = dense.groupBy("category").agg(F.max("purchase_week").alias("w")).collect()
    assert {r["w"] for r in last} == {dt.date(2018, 2, 12)}
    early = marts.fct_demand_weekly(sales(spark, ROWS), CFG, dt.date(2018, 1, 2))
    assert early.exceptAll(marts.fct_demand_weekly(sales(spark, ROWS), CFG)).isEmpty()


FACTS = (
    "category string, seller_id string, purchase_week int, observed_fulfil_days int,"
    " promised_fulfil_days int, price decimal(18,4), qty decimal(18,4)"
)


def test_duration_statistics(spark):
    one = Decimal(1)
    rows = [("a", "s", i % 2, d, 10, one, one) for i, d in enumerate([5, 7, 7, 20])]
    rows += [("a", "u", 1, 4, None, one, one), ("a", "v", 1, 4, None, one, one), ("a", "v", 1, 6, 5, one, one)]
    rollup = marts.weekly_rollup(spark.createDataFrame(rows, FACTS))
    got = {r["seller_id"]: r for r in marts.fulfilment_stats(rollup, CFG.with_(min_deliveries=1)).collect()}
    s = got["s"]
    assert (s["n_deliveries"], s["observed_mean_days"], s["pct_late"]) == (4, Decimal("9.750"), Decimal("0.2500"))
    assert s["observed_sd_days"] == Decimal("6.898") and s["promised_sd_days"] == 0
    assert got["u"]["observed_sd_days"] == 0 and got["u"]["promised_mean_days"] is None
    assert got["u"]["pct_late"] == 0  # no promise, not late
    assert (got["v"]["promised_mean_days"], got["v"]["promised_sd_days"]) == (5, 0)
    kept = marts.fulfilment_stats(rollup, CFG.with_(min_deliveries=2)).collect()
    assert {r["seller_id"] for r in kept} == {"s", "v"}


def test_means_round_half_up(spark):
    one = Decimal(1)
    rows = [("a", "s", 1, d, d, one, one) for d in [0] * 15 + [1]]  # 0.0625
    rollup = marts.weekly_rollup(spark.createDataFrame(rows, FACTS))
    assert marts.fulfilment_stats(rollup, CFG).first()["observed_mean_days"] == Decimal("0.063")


def _orders(spark, rows):
    return spark.createDataFrame(
        rows, "order_id string, delivered_at string, purchase_date string, observed_fulfil_days int, promised_fulfil_days int"
    ).selectExpr(
        "order_id", "cast(delivered_at as timestamp_ntz) delivered_at", "cast(purchase_date as date) purchase_date",
        "date_sub(cast(purchase_date as date), weekday(cast(purchase_date as date))) purchase_week",
        "observed_fulfil_days", "promised_fulfil_days",
    )


def _items(spark, rows):
    return spark.createDataFrame(
        rows, "order_id string, item_seq string, product_id string, seller_id string, price decimal(18,4), qty decimal(18,4)"
    )


def test_facts_drop_unknown_products_and_fan_out_on_repeated_ones(spark):
    orders = _orders(spark, [("1", "2018-01-05", "2018-01-01", 4, 6)])
    one = Decimal(1)
    items = _items(spark, [("1", "1", p, "s", one, one) for p in ("p", "q", "gone")] + [("2", "1", "p", "s", one, one)])
    products = spark.createDataFrame([("p", "x"), ("q", "y"), ("q", "z")], "product_id string, category string")
    facts = marts.order_line_facts(orders, items, products)
    assert sorted((r["product_id"], r["category"]) for r in facts.collect()) == [("p", "x"), ("q", "y"), ("q", "z")]


def test_rollup_by_product_equals_rollup_of_facts(spark):
    orders = _orders(spark, [("1", "2018-01-05", "2018-01-01", 4, 6), ("2", "2018-01-09", "2018-01-02", 7, None)])
    items = _items(spark, [(o, str(k), p, "s", Decimal(k + 1), Decimal(2)) for o in "12" for k, p in enumerate(("p", "q", "q", "gone"))])
    products = spark.createDataFrame([("p", "x"), ("q", "x"), ("q", "z")], "product_id string, category string")
    straight = marts.weekly_rollup(marts.order_line_facts(orders, items, products))
    folded = marts.series_rollup(marts.product_rollup(orders, items, PolicyConfig()), products)

    def rows(df):
        return {(r["category"], r["purchase_week"]): {k: v and int(v) for k, v in r.asDict().items() if k not in ("category", "seller_id", "purchase_week")} for r in df.collect()}

    assert rows(straight) == rows(folded) and len(rows(folded)) == 2


def test_seller_versions(spark):
    orders = _orders(
        spark,
        [
            ("1", "2017-02-05", "2017-02-01", 4, 6),
            ("2", "2017-12-31", "2017-12-31", 9, 6),
            ("3", "2018-01-05", "2018-01-01", 4, 6),
            ("4", "2016-01-05", "2016-01-01", 5, 6),
        ],
    )
    one = Decimal(1)
    items = _items(spark, [("1", "1", "p", "s", one, one), ("2", "1", "p", "s", one, one), ("2", "2", "p", "s", one, one),
                           ("3", "1", "p", "s", one, one), ("4", "1", "p", "t", one, one)])
    sellers = spark.createDataFrame([("s", "city", "st")], "seller_id string, city string, state string")
    dim = marts.dim_seller(marts.product_rollup(orders, items, PolicyConfig()), sellers)
    marts.assert_unique_keys(dim)
    rows = {(r["seller_id"], r["valid_from"].year): r for r in dim.collect()}
    assert set(rows) == {("s", 2017), ("s", 2018), ("t", 2017)}
    old, new = rows["s", 2017], rows["s", 2018]
    assert old["avg_fulfil_days"] == Decimal("7.33")
    assert (old["valid_to"], old["is_current"]) == (dt.date(2017, 12, 31), False)
    assert (new["valid_to"], new["is_current"]) == (None, True)
    assert rows["t", 2017]["state"] is None and rows["t", 2017]["is_current"]
    again = marts.dim_seller(marts.product_rollup(orders, items.repartition(5), PolicyConfig()), sellers)
    assert {r["seller_key"] for r in again.collect()} == {r["seller_key"] for r in rows.values()}
    assert len({r["seller_key"] for r in rows.values()}) == 3
    bare = marts.dim_seller(marts.product_rollup(orders, items, PolicyConfig()), None)
    with pytest.raises(ValueError, match="not unique"):
        marts.assert_unique_keys(dim.unionByName(dim))
    assert bare.columns == dim.columns and bare.filter("city is not null").isEmpty()


@pytest.fixture
def no_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k in settings:
        spark.conf.unset(k)


def test_hot_product_is_split_and_nothing_is_lost(spark, no_broadcast):
    """A third of the lines share one product; tables too large to broadcast."""
    n = 60_000
    lines = spark.range(0, n, 1, 8).selectExpr(
        "cast(id % 20000 as string) order_id", "cast(id as string) line_no",
        "if(id % 3 = 0, 'hot', cast(xxhash64(id) % 5000 as string)) product_id", "concat('S', id % 4) supplier_id",
        "'2.5' unit_value", "cast(1 + id % 3 as string) quantity",
    )
    orders = spark.range(20000).selectExpr(
        "cast(id as string) order_id", "'delivered' status",
        "cast(date_add(date'2018-01-01', int(id % 60)) as string) ordered_at",
        "cast(date_add(date'2018-01-04', int(id % 60)) as string) received_at",
        "cast(date_add(date'2018-01-09', int(id % 60)) as string) promised_at", "cast(null as string) dispatched_at",
    )
    products = spark.range(-5000, 5001).selectExpr("cast(id as string) product_id", "concat('c', abs(id % 3)) category")
    hot = spark.createDataFrame([("hot", "hot")], "product_id string, category string")
    rollup = marts.weekly_rollup(
        marts.order_line_facts(
            staging.staging_orders(staging.typed_orders(orders), CFG),
            staging.staging_order_items(lines),
            staging.staging_products(products.unionByName(hot)),
        )
    )
    plan = plan_of(rollup)
    assert "SortMergeJoin(skew=true)" in plan
    assert "Broadcast" not in plan and "SinglePartition" not in plan
    got = rollup.groupBy().agg(F.sum("units").alias("u"), F.sum("n_lines").alias("n")).first()
    assert (got["u"], got["n"]) == (n * 2, n)
