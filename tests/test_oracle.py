"""Every registered query of the core against SQL, at the scale of the correctness check."""

import pytest
from support import SMOKE, plan_of

import __spark_entry__ as entry
from checks.compare import compare, connect
from checks.fixture import RawTables
from checks.queries import QUERIES, Tables, comparable
from stockpolicy.functions.session import stored

SMALL = "/root/testdata/sf0.01"
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.fixture(scope="module")
def small(spark):
    """One set of layers for all queries; raw tables and stored marts are made once."""
    raw = {name: stored(df, name) for name, df in RawTables(spark, SMALL).items()}
    return Tables(spark, SMALL, raw)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, small, name):
    def run(spark, sf_dir):
        return comparable(QUERIES[name](small))

    assert compare(spark, con, SMALL, run, ORACLE[name]) is None


def test_every_oracle_has_a_query():
    assert set(QUERIES) <= set(ORACLE)
    assert set(ORACLE) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 23 and len(df.columns) == 27


@pytest.mark.parametrize("name", ["fct_demand_weekly", "fulfilment_stats", "dim_seller", "buffer_params"])
def test_plans_stay_distributed_and_in_the_jvm(spark, name):
    plan = plan_of(entry.queries()[name](spark, SMOKE))
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    # Only the few range offsets of the running total may meet in one partition.
    assert plan.count("SinglePartition") <= (1 if name == "buffer_params" else 0)


@pytest.mark.parametrize(
    "sf, kept, excluded, modelled, dense, durations, population",
    [
        ("0.001", 429, [8, 13, 42, 1007], 26, 7838, 26, [2, 21]),
        ("0.01", 4399, [55, 134, 345, 10067], 68, 21186, 68, [4, 5, 24, 34]),
        ("0.1", 44377, [490, 1322, 3678, 100290], 223, 70268, 223, [5, 6, 50, 160]),
    ],
)
def test_fixture_anchors(sf, kept, excluded, modelled, dense, durations, population):
    con = connect(f"/root/testdata/sf{sf}")

    def rows(name):
        return con.execute(ORACLE[name]).fetchall()

    assert len(rows("staging_orders")) == kept
    assert sorted(r[2] for r in rows("exclusions")) == excluded
    assert len(rows("modelled_series")) == modelled
    assert len(rows("fct_demand_weekly")) == dense
    assert len(rows("fulfilment_stats")) == durations
    assert sorted(r[1] for r in rows("finding_population")) == population
