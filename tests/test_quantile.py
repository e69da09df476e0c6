import numpy as np
import pytest
from pyspark.sql import functions as F

from stockpolicy.operators import quantile
from stockpolicy.operators.quantile import exact_percentile, exact_percentiles


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("kind", ["normal", "ties", "few", "one"])
def test_exact_percentile_is_exact(spark, p, kind):
    rng = np.random.default_rng(7)
    values = {
        "normal": rng.normal(size=4001),
        "ties": np.where(rng.random(3000) < 0.4, 1.5, rng.integers(0, 40, 3000)).astype(float),
        "few": np.array([3.0, 1.0, 2.0, 10.0]),
        "one": np.array([4.25]),
    }[kind]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    r = exact_percentile(df, "v", p).first()
    assert r["n"] == len(values)
    assert r["value"] == pytest.approx(float(np.quantile(values, p)), abs=1e-12)


def test_exact_percentile_of_nothing(spark):
    r = exact_percentile(spark.createDataFrame([(None,)], "v double"), "v", 0.5).first()
    assert (r["value"], r["n"]) == (None, 0)


def test_neighbours_are_told_apart(spark):
    """Values that differ in the last bits only: no histogram interval separates the first ones."""
    steps = float(np.nextafter(1.0, 2.0) - 1.0)
    values = [1.0 + i * steps for i in range(3001)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    for p in (0.0, 0.5, 1.0):
        assert exact_percentile(df, "v", p).first()["value"] == values[int(p * 3000)]


def test_bits_sort_like_the_values(spark):
    values = [float("-inf"), -1e300, -2.0, -5e-324, -0.0, 0.0, 5e-324, 1.5, 1e300, float("inf")]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = df.select("v", quantile.ordered_bits(F.col("v")).alias("b")).collect()
    bits = [r["b"] for r in got[:-1]]
    assert got[-1]["b"] is None and bits == sorted(bits) and bits[4] == bits[5]
    back = df.select("v", quantile.from_bits(quantile.ordered_bits(F.col("v"))).alias("w")).collect()
    assert all(r["v"] == r["w"] for r in back)


def test_many_columns_groups_and_shares_at_once(spark):
    rng = np.random.default_rng(5)
    rows = [(g, float(rng.normal()), float(rng.integers(0, 9)) if i % 4 else None) for i in range(900) for g in ("x", None)]
    df = spark.createDataFrame(rows, "g string, a double, b double")
    shares = [0.0, 0.1, 0.5, 0.99]
    got = {(r["g"], r["column"], r["p"]): (r["value"], r["n"]) for r in exact_percentiles(df, ["a", "b"], shares, ["g"]).collect()}
    assert len(got) == 2 * 2 * 4
    for g in ("x", None):
        for i, c in enumerate("ab", 1):
            own = np.array([r[i] for r in rows if r[0] == g and r[i] is not None])
            for p in shares:
                assert got[g, c, p] == (pytest.approx(np.quantile(own, p), abs=1e-12), len(own))


def test_the_input_is_computed_once(spark):
    """The values are stored, and the stored ones are read twice: a counter sees each row once."""
    seen = spark.sparkContext.accumulator(0)

    def count(it):
        for part in it:
            seen.add(len(part))
            yield part

    df = spark.range(1000).selectExpr("double(id) v").mapInPandas(count, "v double")
    assert exact_percentile(df, "v", 0.5).first()["value"] == 499.5
    assert seen.value == 1000
