"""The ranged running total against a plain sequential one."""

import random

import pytest
from support import plan_of

from stockpolicy.config import PolicyConfig
from stockpolicy.operators.segment import classify_abc, classify_xyz, cumulative_share

CFG = PolicyConfig()
SCHEMA = "category string, seller_id string, annualised_revenue double"


def expected(rows):
    total = sum(round(r[2] * 100) for r in rows)
    run, out = 0, {}
    for c, s, v in sorted(rows, key=lambda r: (-r[2], r[0], r[1])):
        before, run = run, run + round(v * 100)
        out[c, s] = (before / total, run / total)
    return out


@pytest.mark.parametrize("buckets", [1, 5, 16])
def test_running_share_with_a_hot_tie(spark, buckets):
    """A third of the rows carry one value, and it still spreads over the ranges."""
    rnd = random.Random(buckets)
    rows = [
        (f"c{rnd.randrange(7)}", f"s{i}", 50.0 if i % 3 == 0 else round(rnd.expovariate(0.01), 2))
        for i in range(3000)
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    out = cumulative_share(df, "annualised_revenue", ["category", "seller_id"], buckets=buckets)
    want = expected(rows)
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        before, upto = want[r["category"], r["seller_id"]]
        assert r["cum_share_before"] == pytest.approx(before, abs=1e-12)
        assert r["cum_share"] == pytest.approx(upto, abs=1e-12)


def test_hot_tie_is_split_over_ranges(spark):
    df = spark.range(6000).selectExpr(
        "'c' category", "cast(id as string) seller_id",
        "double(if(id % 3 = 0, 50, id % 101)) annualised_revenue",
    )
    ranged = df.repartitionByRange(8, df.annualised_revenue.desc(), "category", "seller_id")
    sizes = [len(p) for p in ranged.rdd.glom().collect()]
    assert max(sizes) < 2 * 6000 / 8


def test_running_share_per_group(spark):
    rows = [("a", str(i), float(i)) for i in range(50)] + [("b", str(i), 1.0) for i in range(4)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = cumulative_share(df, "annualised_revenue", ["seller_id"], by=["category"], buckets=6)
    for group in ("a", "b"):
        part = [r for r in rows if r[0] == group]
        want = expected(part)
        for r in out.filter(f"category = '{group}'").collect():
            got = (r["cum_share_before"], r["cum_share"])
            assert got == pytest.approx(want[group, r["seller_id"]], abs=1e-12)


def test_only_the_offsets_meet_in_one_partition(spark):
    df = spark.range(5000).selectExpr(
        "'c' category", "cast(id as string) seller_id", "double(id) annualised_revenue"
    )
    plan = plan_of(cumulative_share(df, "annualised_revenue", ["category", "seller_id"], buckets=3))
    assert plan.count("SinglePartition") == 1


def test_ranges_are_not_shuffled_again(spark):
    """The stored ranges carry their buckets: the rows' window needs no exchange, only the few offsets have one."""
    df = spark.range(60_000).selectExpr(
        "'c' category", "cast(id as string) seller_id", "double(id % 977) annualised_revenue"
    )
    plan = plan_of(cumulative_share(df, "annualised_revenue", ["category", "seller_id"], buckets=6))
    exchanges = [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line and "Reused" not in line]
    assert len(exchanges) == 1 and "SinglePartition" in exchanges[0], plan
    assert "Bucketed: true" in plan and "InMemoryTableScan" not in plan


def test_few_rows_make_few_ranges(spark, tmp_path):
    df = spark.range(500).selectExpr("'c' category", "cast(id as string) seller_id", "double(id) annualised_revenue")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        out = cumulative_share(df, "annualised_revenue", ["category", "seller_id"])
        assert "ranges" not in plan_of(out) and out.count() == 500
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_a_fixed_number_of_ranges_grows_with_the_rows(spark, monkeypatch):
    """`buckets` is the least number of ranges: no range, so no task, holds more than its rows."""
    monkeypatch.setattr("stockpolicy.operators.segment.ROWS_PER_RANGE", 100)
    rows = [("c", f"s{i}", float(i % 37)) for i in range(1000)]
    out = cumulative_share(spark.createDataFrame(rows, SCHEMA), "annualised_revenue", ["category", "seller_id"], buckets=2)
    assert "out of 10" in plan_of(out)
    want = expected(rows)
    for r in out.collect():
        assert (r["cum_share_before"], r["cum_share"]) == pytest.approx(want["c", r["seller_id"]], abs=1e-12)


def test_no_revenue_at_all(spark):
    df = spark.createDataFrame([("a", "1", 0.0), ("a", "2", None)], SCHEMA)
    got = classify_abc(df, CFG).collect()
    assert [(r["abc"], r["cum_share"]) for r in got] == [("C", 0.0)] * 2


def test_empty_input(spark):
    assert classify_abc(spark.createDataFrame([], SCHEMA), CFG).count() == 0


def test_ties_are_ordered_by_key(spark):
    df = spark.createDataFrame([("b", "1", 50.0), ("a", "2", 50.0), ("a", "1", 50.0)], SCHEMA)
    got = {(r["category"], r["seller_id"]): r["abc"] for r in classify_abc(df, CFG).collect()}
    assert got == {("a", "1"): "A", ("a", "2"): "A", ("b", "1"): "A"}
    cut = CFG.with_(abc_thresholds={"A": 0.3, "B": 0.6})
    got = {(r["category"], r["seller_id"]): r["abc"] for r in classify_abc(df, cut).collect()}
    assert got == {("a", "1"): "A", ("a", "2"): "B", ("b", "1"): "C"}


def test_xyz_limits_are_inclusive(spark):
    df = spark.createDataFrame([(0.5,), (0.51,), (1.0,), (1.01,), (None,)], "cv double")
    assert [r["xyz"] for r in classify_xyz(df, CFG).collect()] == ["X", "Y", "Y", "Z", "Z"]
