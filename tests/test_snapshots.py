import datetime as dt

import pytest
from pyspark.sql import functions as F

from stockpolicy.functions.session import scratch_path
from stockpolicy.schemas import PUBLISHED
from stockpolicy.sources import layers
from stockpolicy.sources import snapshots as S

D1, D2 = "2018-08-24", "2018-08-31"


def frame(spark, date, sellers, target=1.0, **columns):
    """Published rows with the given sellers and everything else empty."""
    values = {"category": F.lit("c"), "seller_id": F.col("s"), "model_total_target": F.lit(target)}
    values |= {k: F.lit(v) for k, v in columns.items()}
    df = spark.createDataFrame([(s,) for s in sellers], "s string").select(
        *(values.get(n, F.lit(None)).cast(t).alias(n) for n, t in PUBLISHED)
    )
    return S.to_published(df, date)


def content(spark, path):
    rows = S.read_snapshots(spark, path).collect()
    return sorted((str(r["calc_date"]), r["seller_id"], r["model_total_target"]) for r in rows)


@pytest.fixture
def path(spark):
    return scratch_path(spark, "snapshots")


def test_replace_is_idempotent_and_touches_one_date(spark, path):
    assert not S.snapshot_exists(spark, path)
    S.publish_replace(frame(spark, D1, "ab"), path, [D1])
    S.publish_replace(frame(spark, D2, "abc"), path, [D2])
    first = content(spark, path)
    S.publish_replace(frame(spark, D2, "abc"), path, [D2])
    assert content(spark, path) == first and S.snapshot_exists(spark, path)
    S.publish_replace(frame(spark, D2, "a", 9.0), path, [D2])
    assert content(spark, path) == [(D1, "a", 1.0), (D1, "b", 1.0), (D2, "a", 9.0)]


def test_upsert_updates_adds_and_keeps(spark, path):
    S.publish_upsert(frame(spark, D1, "ab"), path, D1)
    S.publish_upsert(frame(spark, D2, "ab"), path, D2)
    for _ in range(2):
        S.publish_upsert(frame(spark, D2, "bc", 5.0), path, D2)
        assert content(spark, path) == [
            (D1, "a", 1.0), (D1, "b", 1.0), (D2, "a", 1.0), (D2, "b", 5.0), (D2, "c", 5.0),
        ]


def test_a_run_that_dies_before_the_switch_changes_nothing(spark, path, monkeypatch):
    """Two dates are written whole, then the run stops: readers still see both old ones whole."""
    both = [D1, D2]
    S.publish_replace(frame(spark, D1, "ab").unionByName(frame(spark, D2, "abc")), path, both)
    before = content(spark, path)

    def die(staged):
        raise KeyboardInterrupt

    new = frame(spark, D1, "x", 9.0).unionByName(frame(spark, D2, "y", 9.0))
    with monkeypatch.context() as m:
        m.setattr(S, "switch", die)
        with pytest.raises(KeyboardInterrupt):
            S.publish_replace(new, path, both)
    assert content(spark, path) == before
    S.publish_replace(new, path, both)
    assert content(spark, path) == [(D1, "x", 9.0), (D2, "y", 9.0)]


def test_readers_keep_what_they_opened(spark, path):
    S.publish_replace(frame(spark, D1, "ab"), path, [D1])
    opened = S.read_snapshots(spark, path)
    S.publish_replace(frame(spark, D1, "z"), path, [D1])
    assert opened.count() == 2 and S.read_snapshots(spark, path).count() == 1


def test_two_publishes_at_once(spark, path):
    """Different dates both get in; of two for one date the later one is refused."""
    S.publish_replace(frame(spark, D1, "a"), path, [D1])
    one, two = S.stage(frame(spark, D1, "b"), path), S.stage(frame(spark, D2, "c"), path)
    late = S.stage(frame(spark, D1, "d"), path)
    S.switch(one)
    S.switch(two)
    with pytest.raises(S.ConcurrentPublish, match=D1):
        S.switch(late)
    assert content(spark, path) == [(D1, "b", 1.0), (D2, "c", 1.0)]


def test_a_pointer_number_is_taken_once(spark, path):
    S.publish_replace(frame(spark, D1, "a"), path, [D1])
    taken = S.current(spark, path)
    assert taken.number == 1 and not S._create_pointer(spark, path, S.Pointer(1, {}))
    assert S.current(spark, path) == taken


def test_a_pointer_cut_short_counts_as_absent(spark, path):
    from stockpolicy.functions.session import file_system

    S.publish_replace(frame(spark, D1, "ab"), path, [D1])
    fs, file = file_system(spark, f"{path}/_pointers/00000002.json")
    stream = fs.create(file, False)
    stream.write(bytearray(b'{"dates": {"2018'))
    stream.close()
    assert content(spark, path) == [(D1, "a", 1.0), (D1, "b", 1.0)]
    S.publish_replace(frame(spark, D2, "c"), path, [D2])
    assert S.current(spark, path).number == 3 and len(content(spark, path)) == 3


def test_expire_keeps_what_pointers_name(spark, path):
    for seller in "abc":
        S.publish_replace(frame(spark, D1, seller), path, [D1])
    S.publish_replace(frame(spark, D2, "z"), path, [D2])
    assert S.expire(spark, path, keep=2) == 2
    assert content(spark, path) == [(D1, "c", 1.0), (D2, "z", 1.0)]
    assert S.expire(spark, path) == 0 and S.snapshot_rows(spark, path).keys() == {dt.date(2018, 8, 24), dt.date(2018, 8, 31)}


def test_dates_must_have_rows(spark, path):
    S.publish_replace(frame(spark, D1, "ab"), path, [D1])
    with pytest.raises(ValueError, match=f"no rows for {D2}"):
        S.publish_replace(frame(spark, D1, "x"), path, [D1, D2])
    with pytest.raises(ValueError, match="another date"):
        S.publish_replace(frame(spark, D1, "x"), path, [D2])
    assert content(spark, path) == [(D1, "a", 1.0), (D1, "b", 1.0)]


def test_measures_are_observed_by_the_write(spark, path):
    staged = S.stage(frame(spark, D1, "abc"), path, {"n": F.count("*"), "most": F.max("seller_id")})
    assert staged.measures == {"n": 3, "most": "c"} and staged.rows == {D1: 3}
    assert not S.snapshot_exists(spark, path)
    staged.discard()


def test_bad_keys_are_refused(spark, path):
    with pytest.raises(ValueError, match="repeated"):
        S.publish_replace(frame(spark, D1, "aa"), path, [D1])
    with pytest.raises(ValueError, match="NULL"):
        S.publish_replace(frame(spark, D1, "a", category=None), path, [D1])
    with pytest.raises(ValueError, match="another date"):
        S.publish_upsert(frame(spark, D1, "a"), path, D2)
    assert not S.snapshot_exists(spark, path)


def test_contract(spark, path):
    df = frame(spark, D1, "a", demand_sd=float("nan"))
    assert df.dtypes == [(n, t) for n, t in PUBLISHED] and len(PUBLISHED) == 27
    S.publish_replace(df, path, [D1])
    stored = S.read_snapshots(spark, path)
    assert stored.dtypes == df.dtypes
    assert stored.first()["demand_sd"] is None


def test_latest(spark, path):
    S.publish_replace(frame(spark, D1, "ab").unionByName(frame(spark, D2, "a")), path, [D1, D2])
    stored = S.read_snapshots(spark, path)
    assert [str(r["calc_date"]) for r in S.latest_snapshot(stored).collect()] == [D2]
    assert S.latest_snapshot(stored, before=D2).count() == 2
    assert S.latest_snapshot(stored, before=D1).count() == 0


def test_latest_prunes_partitions(spark, path):
    from support import plan_of

    S.publish_replace(frame(spark, D1, "ab").unionByName(frame(spark, D2, "a")), path, [D1, D2])
    plan = plan_of(S.latest_snapshot(S.read_snapshots(spark, path)).select("seller_id"))
    assert "PartitionFilters: [isnotnull(calc_date" in plan and "Subquery" in plan


def test_layers_overwrite(spark, path):
    for _ in range(2):
        layers.write_layer(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5
    layers.write_small(spark.range(3), f"{path}-csv", "csv")
    layers.write_small(spark.range(3), f"{path}-json", "json")
    assert spark.read.option("header", True).csv(f"{path}-csv").count() == 3
    assert spark.read.json(f"{path}-json").count() == 3


def test_fact_window_reads_one_year_and_pushes_down(spark, path, tables):
    from support import plan_of

    from checks.fixture import CALC_DATE
    from stockpolicy.operators.stats import demand_stats, trailing_demand

    layers.write_fact(tables.fct, path)
    stored = layers.read_fact(spark, path)
    assert stored.exceptAll(tables.fct).isEmpty() and tables.fct.exceptAll(stored).isEmpty()
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = plan_of(demand_stats(trailing_demand(stored, CALC_DATE, 26)))
    assert "LessThanOrEqual(purchase_week,2001-07-31)" in plan
    assert "GreaterThan(purchase_week,2001-01-30)" in plan
    assert "revenue" not in plan.split("ReadSchema")[1]
    recent = layers.read_fact(spark, path, CALC_DATE.replace(month=3), CALC_DATE)
    assert recent.filter("purchase_week < date'2001-03-31'").isEmpty() and not recent.isEmpty()
    assert "(week_year#" in plan_of(recent).split("PartitionFilters")[1].split("PushedFilters")[0]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
