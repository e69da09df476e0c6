import pytest

from stockpolicy.config import Mapping, PolicyConfig
from stockpolicy.sources import extracts as E

SPEC = {
    "orders": {
        "file": "po.csv",
        "columns": {"order_id": "PO_NUMBER", "status": "PO STATUS", "ordered_at": "RELEASED",
                    "received_at": "RECEIVED", "promised_at": "PROMISED"},
        "completed_status": "CLOSED",
    },
    "order_lines": {
        "file": "items.csv",
        "columns": {"order_id": "PO_NUMBER", "line_no": "ITEM", "product_id": "MATNR",
                    "supplier_id": "LIFNR", "unit_value": "NET.PRICE"},
    },
    "products": {"file": "mat.csv", "columns": {"product_id": "MATNR", "category": "MATKL"}},
    "suppliers": {"file": "absent.csv", "columns": {"supplier_id": "LIFNR"}},
}
PO = (
    "﻿PO_NUMBER,PO STATUS,RELEASED,RECEIVED,PROMISED,NOTE\r\n"
    '1,CLOSED,2018-01-01,2018-01-05,2018-01-09,"a, b"\r\n'
    '2,"CLO\nSED",2018-01-01,,NA,"say ""hi"""\r\n'
    "003,CLOSED,2018-01-01, ,2018-01-09,\r\n"
)


@pytest.fixture
def extract(tmp_path):
    (tmp_path / "po.csv").write_bytes(PO.encode("utf-8"))
    (tmp_path / "items.csv").write_text("PO_NUMBER,ITEM,MATNR,LIFNR,NET.PRICE\n1,1,m,l,1.50\n")
    (tmp_path / "mat.csv").write_text("MATNR,MATKL\nm,tools\n")
    return tmp_path


def load(spark, folder, spec=SPEC, **kw):
    raw = E.load_raw(spark, str(folder), Mapping.from_dict(spec), **kw)
    return {section: E.good_lines(df) for section, df in raw.items()}


def test_values_arrive_as_written(spark, extract):
    raw = load(spark, extract)
    assert set(raw) == {"orders", "order_lines", "products"}
    got = [tuple(r) for r in raw["orders"].orderBy("order_id").collect()]
    assert raw["orders"].columns == [
        "order_id", "status", "ordered_at", "received_at", "promised_at", "dispatched_at",
    ]
    assert got == [
        ("003", "CLOSED", "2018-01-01", " ", "2018-01-09", None),
        ("1", "CLOSED", "2018-01-01", "2018-01-05", "2018-01-09", None),
        ("2", "CLO\nSED", "2018-01-01", None, "NA", None),
    ]
    assert {t for df in raw.values() for _, t in df.dtypes} == {"string"}
    line = raw["order_lines"].first()
    assert line["unit_value"] == "1.50" and line["quantity"] is None


def test_na_words_are_optional(spark, extract):
    orders = load(spark, extract, na_values=("NA",))["orders"]
    assert orders.filter("order_id = '2'").first()["promised_at"] is None


def test_single_line_mode_splits_files(spark, extract):
    (extract / "po.csv").write_text(PO.replace("﻿", "").replace("CLO\nSED", "CLOSED"))
    assert load(spark, extract, multiline=False)["orders"].count() == 3


@pytest.mark.parametrize("multiline", [True, False])
def test_a_folder_of_files_is_one_source(spark, extract, multiline):
    folder = extract / "parts"
    folder.mkdir()
    for i in range(3):
        (folder / f"{i}.csv").write_text(f"MATNR,MATKL\nm{i},tools\n")
    spec = SPEC | {"products": {"file": "parts/*.csv", "columns": SPEC["products"]["columns"]}}
    products = load(spark, extract, spec, multiline=multiline)["products"]
    assert sorted(r["product_id"] for r in products.collect()) == ["m0", "m1", "m2"]
    (folder / "9.csv").write_text("MATKL,MATNR\ntools,m9\n")
    with pytest.raises(Exception, match="(?i)header"):
        load(spark, extract, spec, multiline=multiline)["products"].collect()


def test_contract_errors(spark, extract):
    with pytest.raises(E.ExtractError, match="products is needed: no entry in the mapping"):
        load(spark, extract, {k: v for k, v in SPEC.items() if k != "products"})
    with pytest.raises(E.ExtractError, match="products is needed: nothing at .*gone.csv"):
        load(spark, extract, SPEC | {"products": SPEC["products"] | {"file": "gone.csv"}})
    wrong = {"product_id": "MATNR", "category": "GROUP"}
    with pytest.raises(E.ExtractError, match="products.category <- 'GROUP', which is not in the header"):
        load(spark, extract, SPEC | {"products": {"file": "mat.csv", "columns": wrong}})


def test_all_problems_come_at_once(spark, extract):
    lines = SPEC["order_lines"] | {"columns": {"order_id": "NO_1", "line_no": "NO_2"}}
    with pytest.raises(E.ExtractError) as failed:
        load(spark, extract, {"orders": SPEC["orders"] | {"file": "gone.csv"}, "order_lines": lines})
    assert [p.split()[0] for p in failed.value.problems] == [
        "orders", "order_lines.order_id", "order_lines.line_no", "products",
    ]


@pytest.mark.parametrize("multiline", [True, False])
def test_lines_of_a_wrong_width_are_kept_apart(spark, extract, multiline):
    (extract / "mat.csv").write_text('MATNR,MATKL\nm,tools\nshort\n"a,b",x\nm2,a,b\nm3,\n"q,r"\n')
    raw = E.load_raw(spark, str(extract), Mapping.from_dict(SPEC), multiline=multiline)
    good = sorted((r["product_id"], r["category"]) for r in E.good_lines(raw["products"]).collect())
    assert good == [("a,b", "x"), ("m", "tools"), ("m3", None)]
    broken = E.broken_lines(raw)
    assert broken.filter("table_name = 'raw.orders'").isEmpty() == multiline  # a break inside quotes
    assert sorted(tuple(r) for r in broken.filter("table_name = 'raw.products'").collect()) == [
        ("raw.products", '"q,r"'), ("raw.products", "m2,a,b"), ("raw.products", "short"),
    ]
    # Reading few columns must not hide them.
    assert E.good_lines(raw["products"]).select("product_id").count() == 3


def test_reserved_name_in_the_header(spark, extract):
    (extract / "mat.csv").write_text("MATNR,MATKL,broken_line\nm,tools,x\n")
    with pytest.raises(E.ExtractError, match="reserved name"):
        load(spark, extract)


def test_counts(spark, extract):
    raw = load(spark, extract)
    counts = {r["table_name"].removeprefix("raw."): r["n_rows"] for r in E.raw_row_counts(raw).collect()}
    assert E.assert_counts(counts, {"orders": 3, "products": None})["orders"] == 3
    with pytest.raises(E.ExtractError, match="orders has 3 lines, announced are 4"):
        E.assert_counts(counts, {"orders": 4})
    with pytest.raises(E.ExtractError, match="products is needed and has no rows; orders has 3 lines"):
        E.assert_counts(counts | {"products": 0}, {"orders": 4})
    assert E.assert_counts({"suppliers": 0}, {}) == {"suppliers": 0}


def test_settings(tmp_path):
    m = Mapping.from_dict(SPEC)
    assert m.completed_status == "CLOSED" and m.get("nothing") is None
    with pytest.raises(ValueError, match="unknown settings: windw"):
        PolicyConfig.from_dict({"windw": 3})
    pytest.importorskip("yaml")
    path = tmp_path / "config.yaml"
    path.write_text("demand_window_weeks: 13\nstart_date: 2018-01-01\nservice_levels: {A: 0.99}\n")
    cfg = PolicyConfig.from_yaml(str(path))
    assert (cfg.demand_window_weeks, str(cfg.start_date)) == (13, "2018-01-01")
