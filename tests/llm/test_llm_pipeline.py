import corpus_pipeline
import pytest

from stockpolicy.llm import near_dedup, quality_rules

SMALL = "/root/testdata/sf0.01"


@pytest.mark.parametrize("table", ["odd", "nothing"])
def test_stages_take_odd_rows(request, spark, table):
    docs = request.getfixturevalue(table)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        if name == "packing":
            assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        else:
            assert out.dtypes == docs.dtypes
        out.count()


def test_decisions_take_effect(spark, documents):
    first = corpus_pipeline.keep_quality(spark, documents, SMALL)
    kept = {r["doc_id"] for r in quality_rules.judge(documents).filter("kept").collect()}
    assert {r["doc_id"] for r in first.collect()} == kept and 0.5 < len(kept) / documents.count() < 1
    second = corpus_pipeline.drop_near_duplicates(spark, first, SMALL)
    groups = near_dedup.near_duplicates(first, 3, 2)
    heads = {r["component_id"] for r in groups.collect()}
    assert {r["doc_id"] for r in second.collect()} == heads and len(heads) < len(kept)


def test_clean_documents_are_kept(spark, documents):
    """Labelled good documents pass the quality rules."""
    good = spark.read.parquet(f"{SMALL}/labels.parquet").filter("quality = 1 AND toxic = 0")
    judged = quality_rules.judge(documents).join(good, "doc_id")
    assert judged.filter("NOT kept AND NOT base_failed").count() <= 0.01 * judged.count()


def test_a_large_batch_is_handed_on_in_slices(spark, monkeypatch):
    """Whatever Spark's batches, `run` sees a bounded number of bytes, and every row once."""
    import pyarrow as pa

    from stockpolicy.llm import common

    sizes = [5, 9_000_000, 3, 2_000_000, 7, 0]
    batch = pa.RecordBatch.from_pydict({"text": ["x" * n for n in sizes]})
    parts = list(common.slices(batch))
    assert [len(t) for p in parts for t in p.column("text").to_pylist()] == sizes and len(parts) == 3
    even = pa.RecordBatch.from_pydict({"text": ["x" * 10_000] * 1000})
    assert max(p.nbytes for p in common.slices(even)) <= common.BATCH_BYTES
    monkeypatch.setattr(common, "BATCH_BYTES", 100)
    docs = spark.range(500).selectExpr("id", "repeat('ab', 20) text")
    out = common.map_batches(docs, "id long, n int", lambda b: {"id": b.column("id"), "n": [b.num_rows] * b.num_rows})
    assert sorted(r["id"] for r in out.collect()) == list(range(500))
