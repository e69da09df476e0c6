import datetime as dt
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from support import SMOKE, plan_of

from checks.fixture import CFG
from stockpolicy.operators import marts, policy
from stockpolicy.plans import history
from stockpolicy.schemas import PUBLISHED
from stockpolicy.sources.snapshots import to_published

DATES = [dt.date(2000, 6, 30), dt.date(2001, 6, 27), dt.date(2001, 7, 31)]


def rows(df):
    return {(r["calc_date"], r["category"], r["seller_id"]): r for r in df.collect()}


def same(a, b):
    a, b = rows(a), rows(b)
    assert a.keys() == b.keys() and a
    for k in a:
        for name, type_ in PUBLISHED:
            want = pytest.approx(b[k][name]) if type_ == "double" else b[k][name]
            assert a[k][name] == want, (k, name)


def test_many_dates_equal_single_runs(tables):
    many = to_published(tables.history(DATES))
    singles = [to_published(tables.params_at(d), d) for d in DATES]
    same(many, reduce(DataFrame.unionByName, singles))


def test_as_of_equals_marts_built_from_the_past_only(spark, tables):
    facts = tables.facts
    many = to_published(history.params_history_as_of(facts, DATES, CFG))
    parts = []
    for d in DATES:
        seen = facts.filter(f"delivered_date <= date'{d}' AND purchase_date <= date'{d}'")
        rollup = marts.weekly_rollup(seen)
        fct = marts.fct_demand_weekly(marts.weekly_sales(rollup), CFG)
        fulfilment = marts.fulfilment_stats(rollup, CFG)
        parts.append(to_published(policy.params_from_marts(fct, fulfilment, CFG, d), d))
    same(many, reduce(DataFrame.unionByName, parts))


def test_first_date(spark):
    days = [dt.date(2020, 1, d) for d in (3, 4, 9, 20)]
    df = spark.sql("SELECT explode(sequence(date'2020-01-01', date'2020-01-22')) day")
    for r in df.select("day", history.first_date("day", days).alias("at")).collect():
        assert r["at"] == sum(d < r["day"] for d in days)
    assert df.limit(1).select(history.first_date("day", [])).first()[0] == 0


@pytest.mark.parametrize("dates", [DATES, [dt.date(2001, 1, 1) + dt.timedelta(i) for i in range(120)]])
def test_facts_are_not_spread_over_dates(tables, dates):
    """However many dates: two entries a fact, and no join with the dates."""
    plan = plan_of(tables.history(dates))
    assert "Range" not in plan.split("FileScan")[0] and "LocalTableScan" not in plan
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_entries_are_two_per_fact(tables):
    days = [dt.date(2000, 1, 1) + dt.timedelta(i) for i in range(400)]
    fct = tables.fct
    entries = history.entries_of(
        fct, history.first_date("purchase_week", days), history.first_date("date_add(purchase_week, 182)", days),
        {"n": F.lit(1)}, {"last": F.col("purchase_week")},
    )
    assert entries.count() == 2 * fct.count()
    assert entries.agg(F.sum("n"), F.count("last")).first() == (0, fct.count())


def test_many_daily_dates_equal_single_runs(tables):
    """Dates between weeks, before the first sale and long after the last one."""
    days = [dt.date(1995, 1, 1), dt.date(2001, 7, 29), dt.date(2001, 7, 30), dt.date(2001, 7, 31), dt.date(2010, 1, 1)]
    many = to_published(tables.history(days))
    singles = [to_published(tables.params_at(d), d) for d in days]
    same(many, reduce(DataFrame.unionByName, singles))


def test_dates_are_needed(tables):
    with pytest.raises(ValueError, match="no calculation dates"):
        history.params_history(tables.demand, tables.fulfilment, [], CFG)


def test_smoke_folder_is_used(tables):
    assert tables.sf_dir == SMOKE
