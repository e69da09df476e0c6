import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from stockpolicy.config import PolicyConfig
from stockpolicy.operators.gates import (
    DataQualityError,
    enforce,
    gates_of,
    measures,
    run_gates,
    run_gates_by_date,
)

CFG = PolicyConfig()
SCHEMA = "ss_observed double, observed_mean_days double, is_publishable boolean"
GOOD = (5.0, 12.0, True)


def gates(spark, rows, previous=None):
    before = None if previous is None else spark.range(previous)
    df = run_gates(spark.createDataFrame(rows, SCHEMA), before, CFG)
    return {r["check"]: r for r in df.collect()}


def failed(got):
    return [name for name, r in got.items() if not r["passed"]]


def test_clean_run(spark):
    got = gates(spark, [GOOD] * 9 + [(-1.0, 999.0, False)], previous=10)
    assert list(got) == [
        "publishable series",
        "negative safety stock",
        "fulfilment duration out of range",
        "null parameters pct",
        "row count drop pct",
    ]
    assert failed(got) == []
    assert (got["publishable series"]["value"], got["publishable series"]["threshold"]) == (9, 10)


@pytest.mark.parametrize(
    "row, gate",
    [
        ((-0.1, 12.0, True), "negative safety stock"),
        ((5.0, 0.0, True), "fulfilment duration out of range"),
        ((5.0, 365.5, True), "fulfilment duration out of range"),
        ((None, 12.0, True), "null parameters pct"),
        ((float("nan"), 12.0, True), "null parameters pct"),
    ],
)
def test_one_bad_row(spark, row, gate):
    assert failed(gates(spark, [GOOD] * 10 + [row])) == [gate]


def test_few_nulls_and_missing_durations_pass(spark):
    assert failed(gates(spark, [GOOD] * 40 + [(None, 12.0, True), (5.0, None, True)])) == []


@pytest.mark.parametrize("previous, ok", [(None, True), (0, True), (10, True), (9, True), (11, True), (12, False)])
def test_row_count(spark, previous, ok):
    got = gates(spark, [GOOD] * 10, previous)
    assert got["row count drop pct"]["passed"] is ok


def test_frame_without_flag_and_empty_frame(spark):
    df = spark.createDataFrame([(-1.0, 5.0)], "ss_observed double, observed_mean_days double")
    bad = [r["check"] for r in run_gates(df, None, CFG).filter("not passed").collect()]
    assert bad == ["negative safety stock"]
    assert failed(gates(spark, [])) == []


def test_enforce_lists_every_failure(spark):
    rows = spark.createDataFrame([(-1.0, 400.0, True)] * 2, SCHEMA)
    with pytest.raises(DataQualityError, match=r"3 gate.*negative.*2.*range.*2.*drop") as e:
        enforce(run_gates(rows, spark.range(100), CFG))
    assert "98" in str(e.value)
    enforce(run_gates(spark.createDataFrame([GOOD], SCHEMA), None, CFG))


def test_gates_of_observed_measures(spark):
    """Measures observed on a write give the gates that a pass over the rows gives."""
    rows = spark.createDataFrame([GOOD] * 8 + [(-1.0, 400.0, True), (None, 3.0, False)], SCHEMA)
    seen = Observation()
    rows.observe(seen, *(c.alias(n) for n, c in measures(rows, CFG).items())).write.format("noop").mode("overwrite").save()
    for before in (None, 0, 12):
        known = gates_of(spark, seen.get, before, CFG).collect()
        assert known == run_gates(rows, None if before is None else spark.range(before), CFG).collect()


def test_a_snapshot_passes_against_itself(tables):
    got = run_gates(tables.published, tables.published, CFG).collect()
    assert all(r["passed"] for r in got)


def test_each_date_is_held_alone(spark):
    """Rows without stock on one date fail, however many good rows other dates have."""
    good = [("2018-01-01", *GOOD)] * 1000 + [("2018-01-08", *GOOD)] * 980
    bad = [("2018-01-15", None, 12.0, True)] * 40
    df = spark.createDataFrame(good + bad, "calc_date string, " + SCHEMA).withColumn("calc_date", F.to_date("calc_date"))
    failed = {(str(r["calc_date"]), r["check"]) for r in run_gates_by_date(df, None, CFG).filter("not passed").collect()}
    assert failed == {("2018-01-15", "null parameters pct"), ("2018-01-15", "row count drop pct")}
    earlier = df.filter("calc_date = '2018-01-01'").withColumn("calc_date", F.lit("2018-01-12").cast("date"))
    counts = {r["calc_date"]: r["n"] for r in df.unionByName(earlier).groupBy("calc_date").agg(F.count("*").alias("n")).collect()}
    again = run_gates_by_date(df.filter("calc_date = '2018-01-08'"), counts, CFG)
    drop = again.filter("check = 'row count drop pct'").first()
    assert drop["value"] == pytest.approx(2.0)
