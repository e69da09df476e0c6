import pytest

from checks.fixture import CFG
from stockpolicy.config import Mapping
from stockpolicy.plans import readiness as R

ORDERS = "order_id string, status string, ordered_at string, received_at string, promised_at string, dispatched_at string"


def test_source_problems_are_all_listed(spark, tmp_path):
    (tmp_path / "o.csv").write_text("id,state,placed\n1,x,2018-01-01\n")
    mapping = Mapping.from_dict(
        {
            "orders": {"file": "o.csv", "columns": {"order_id": "id", "status": "state", "ordered_at": "placed",
                                                     "received_at": "got"}},
            "order_lines": {"file": "l.csv", "columns": {"order_id": "id"}},
        }
    )
    raw, problems = R.check_sources(spark, str(tmp_path), mapping)
    assert raw == {}
    text = "\n".join(problems)
    assert "orders.received_at <- 'got', which is not in the header of o.csv (id, state, placed)" in text
    assert "orders.promised_at is not mapped" in text
    assert "order_lines is needed: nothing at" in text and "products is needed: no entry" in text


def orders(spark, n, status="F", span=30 * 7):
    return spark.range(n).selectExpr(
        "cast(id as string) order_id", f"'{status}' status",
        f"cast(date_add(date'2018-01-01', int(id * {span} / {max(n - 1, 1)})) as string) ordered_at",
        f"cast(date_add(date'2018-01-03', int(id * {span} / {max(n - 1, 1)})) as string) received_at",
        "if(id = 0, 'soon', null) promised_at", "cast(null as string) dispatched_at",
    )


def raw(spark, n, per_product=1, **kw):
    lines = spark.range(n).selectExpr(
        "cast(id as string) order_id", "'1' line_no", f"cast(id div {per_product} as string) product_id",
        "cast(id % 40 as string) supplier_id", "'1' unit_value", "'1' quantity",
    )
    products = spark.range(n).selectExpr("cast(id as string) product_id", "if(id % 9 = 8, null, 'c') category")
    return {"orders": orders(spark, n, **kw), "order_lines": lines, "products": products}


def report(spark, *a, **kw):
    df = R.input_readiness(raw(spark, *a, **kw), CFG)
    return {r["check"]: r for r in df.collect()}, df


def test_good_extract(spark):
    got, df = report(spark, 800, per_product=10)
    assert {k: r["level"] for k, r in got.items() if r["level"] != "OK"} == {"unparseable promised_at": "WARN"}
    assert got["history weeks"]["detail"] == "2018-01-01 to 2018-07-30" and got["history weeks"]["value"] == 30
    assert got["viable series"]["detail"] == "product"
    assert got["completed status"]["detail"] == "F"
    assert R.overall_verdict(df).first().asDict() == {"verdict": "WARN", "failed": 0, "warned": 1}
    R.require_ready(df)


def test_series_grain_counts_distinct_weeks(spark):
    got, _ = report(spark, 800)
    assert got["median lines per product"]["value"] == 1
    assert got["products sold exactly once"]["value"] == 800
    assert got["viable series"]["value"] == 40 and got["viable series"]["detail"] == "category+supplier"


def test_poor_extract(spark):
    got, df = report(spark, 100, span=70, status="open")
    levels = {k: r["level"] for k, r in got.items()}
    assert levels["completed status"] == levels["usable orders"] == levels["viable series"] == "FAIL"
    assert got["completed status"]["detail"] == "open" and "history weeks" not in levels
    assert R.overall_verdict(df).first()["verdict"] == "FAIL"
    with pytest.raises(R.InputNotReadyError, match="3 readiness"):
        R.require_ready(df)


def test_short_history_warns(spark):
    got, _ = report(spark, 600, span=70)
    assert got["history weeks"]["level"] == "WARN" and got["history weeks"]["value"] == 10
