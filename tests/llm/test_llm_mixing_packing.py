import itertools
import re

import duckdb
import numpy as np
import pandas as pd
import pytest
from tokenizers import Tokenizer

from stockpolicy.llm import mixing, packing

SMALL = "/root/testdata/sf0.01"


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, stop=2):
    """sizes by source, in order; the excess goes round until none is above."""
    w = {s: weights[i % len(weights)] for i, s in enumerate(sizes)}
    target, open_ = {}, set(sizes)
    left = sum(sizes.values()) * share
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total >= stop * sizes[s]}
        if not over:
            return target | {s: left * w[s] / total for s in open_}
        for s in over:
            target[s] = stop * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 5, "c": 50, None: 1}, {"x": 7}, {"a": 0, "b": 9}, {c: i * i for i, c in enumerate("abcdefgh")}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_permutation_is_one():
    for n in (1, 2, 3, 17, 64, 1000):
        for seed in (0, 5, 2**63):
            out = mixing.permuted(np.arange(n), np.full(n, n), np.full(n, seed, np.uint64))
            assert sorted(out.tolist()) == list(range(n))


def test_mix_meets_its_targets(spark, documents):
    got = mixing.taken(documents).toPandas()
    docs = documents.toPandas()
    sizes = docs.text.map(lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")))
    assert got.sort_values("doc_id")["size"].tolist() == sizes[docs.doc_id.argsort()].tolist()
    assert (got.taken <= 2 * got["size"]).all()
    merged = got.merge(docs[["doc_id", "source"]], on="doc_id")
    for _, rows in merged.groupby("source"):
        assert abs(rows.taken.sum() - rows.target.iloc[0]) < 1
        assert rows["size"].sum() == rows.source_size.iloc[0]
    again = mixing.taken(documents.repartition(7)).toPandas()
    pd.testing.assert_frame_equal(*(x.sort_values("doc_id", ignore_index=True) for x in (got, again)))


def test_sizes_and_targets_equal_sql(documents):
    rows = duckdb.sql(mixing.oracle().replace("FROM documents", f"FROM '{SMALL}/documents.parquet'")).fetchall()
    got = mixing.taken(documents).select("doc_id", "size", "source_size", "target").collect()
    assert sorted(rows) == sorted(tuple(r) for r in got)


def test_shards_and_slots(spark, documents):
    _, plan, mixed = mixing.mix(documents, shard_blocks=64)
    slots, plan = mixed.toPandas(), plan.toPandas().set_index("source")
    for source, rows in slots.groupby("source"):
        assert sorted(rows.slot) == list(range(plan.slots[source]))
        whole = rows[rows["pass"] < plan.passes[source]]
        assert not whole.duplicated(["pass", "block"]).any() and not rows.duplicated(["pass", "block"]).any()
    drawn = slots[slots.shard >= 0].groupby("shard").size()
    assert (drawn <= 64).all() and len(drawn) > 5


def test_few_blocks_are_drawn_as_well(spark):
    """A mix far smaller than a shard: its one shard holds the draws, corrected by a few slots only."""
    plan = spark.createDataFrame([("a", 300), ("b", 100), (None, 200), ("empty", 0)], "source string, slots long")
    drawn = {r["source"]: r["n"] for r in mixing.shard_counts(plan, 17).collect()}
    assert sum(drawn.values()) == 600 and "empty" not in drawn and drawn["a"] > drawn[None] > drawn["b"]
    slots = mixing.slots_of(plan, 17).toPandas()
    assert slots.groupby("source", dropna=False).size().to_dict() == {"a": 300, "b": 100, np.nan: 200} or len(slots) == 600
    assert (slots.shard == 0).mean() > 0.8
    many = mixing.shard_counts(plan, 17, shard_blocks=64).toPandas()
    assert (many.n > 0).all() and many.groupby("shard").n.sum().tolist() == [64] * 9 + [24]


def test_documents_of_the_mix(spark, odd, nothing):
    out = mixing.mixed_documents(odd)
    assert out.dtypes == odd.dtypes
    got = out.collect()
    taken = mixing.taken(odd).toPandas()
    words = sum(len((r["text"]).split()) for r in got)
    assert words == taken.taken.sum() and all(r["n_chars"] == len(r["text"]) for r in got)
    assert len(got) == (taken.taken > 0).sum()
    assert mixing.mixed_documents(nothing).count() == 0 and mixing.taken(nothing).count() == 0


def test_cut_words():
    text = " a b\tc\n\nd  é f "
    assert mixing.cut_words(text, [(0, 0, 6)]) == text
    assert mixing.cut_words(text, [(1, 3, 4), (0, 0, 2), (0, 4, 6), (1, 2, 3)]) == "a b\né f\nc\n\nd"


def test_odd_rows_of_the_mix(odd):
    rows = mixing.taken(odd).toPandas()
    assert len(rows) == odd.count()
    assert rows[rows["size"] == 0].taken.sum() == 0


def test_fullest_is_the_best_sum():
    rng = np.random.default_rng(2)
    for _ in range(60):
        items = rng.integers(1, 30, 7).tolist()
        room = int(rng.integers(5, 70))
        counts = sorted({n: items.count(n) for n in items}.items(), reverse=True)
        used = dict(packing.fullest(counts, room))
        best = max(sum(c) for k in range(8) for c in itertools.combinations(items, k) if sum(c) <= room)
        assert sum(n * k for n, k in used.items()) == best
        assert all(k <= items.count(n) for n, k in used.items())


def test_lengths_fill_sequences():
    rng = np.random.default_rng(3)
    lengths = np.concatenate([rng.integers(1, 2049, 3000), np.full(2000, 512), np.full(50, 2048)])
    sequence, offset = packing.pack_lengths(lengths)
    assert sequence.max() + 1 <= int(lengths.sum() / 2048 * 1.01) + 1
    frame = pd.DataFrame({"s": sequence, "o": offset, "n": lengths}).sort_values(["s", "o"])
    assert (frame.groupby("s").n.sum() <= 2048).all()
    assert (frame.o == frame.groupby("s").n.cumsum() - frame.n).all()
    assert [len(x) for x in packing.pack_lengths(np.zeros(0, np.int64))] == [0, 0]


def library(texts):
    own = Tokenizer.from_file(packing.default_tokenizer())
    own.encode_special_tokens = True
    return [e.ids for e in own.encode_batch(texts, add_special_tokens=False)]


TEXTS = [
    "", " ", "a", " a", "a ", "  a  b", "it's we'll don't 'S", "x\n y\n\nz \t w", "<|endoftext|> no", "日本 語　テ\xa0x é ñ",
    "a  b ​ c", "1234 567 abc123 !!! ... --", "tab\tonly", "\r\n win \r\n dos", "a" * 300 + " " + "b" * 300, "🙂 🙂🙂",
]


def test_ids_equal_the_library(documents):
    encode = packing.Encoder(packing.default_tokenizer())
    assert encode.by_word and encode.fast
    texts = TEXTS + [r["text"] for r in documents.filter("doc_id % 4 = 0").select("text").collect()]
    assert [np.frombuffer(encode(t), "<u4").tolist() for t in texts] == library(texts)
    encode.fast = None
    assert [np.frombuffer(encode.whole(t), "<u4").tolist() for t in TEXTS] == library(TEXTS)


def test_sequences_hold_all_ids(spark, documents):
    some = documents.filter("doc_id < 150")
    rows = packing.packed(some).toPandas()
    assert (rows[rows.length < 2048].piece == 0).all()
    joined = rows.sort_values(["sequence_id", "offset"])
    assert (joined.offset == joined.groupby("sequence_id").length.cumsum() - joined.length).all()
    assert (joined.groupby("sequence_id").length.sum() <= 2048).all()
    texts = {r["doc_id"]: r["text"] for r in some.collect()}
    whole = dict(zip(texts, library(list(texts.values()))))
    from zlib import crc32

    for r in rows.itertuples():
        own = (whole[r.doc_id] + [0])[r.start : r.start + r.length]
        assert crc32(np.array(own, "<u4").tobytes()) == r.ids_crc32
    total = {r.sequence_id: len(r.ids) for r in packing.sequences(some).toPandas().itertuples()}
    assert sum(total.values()) == sum(len(i) + 1 for i in whole.values()) and max(total.values()) <= 2048


def test_odd_rows_packed(odd, nothing):
    rows = packing.packed(odd).toPandas()
    assert set(rows.doc_id.dropna()) == {1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11} and rows.doc_id.isna().sum() == 2
    assert rows[rows.doc_id == 3].length.tolist() == [1]
    assert packing.packed(nothing).count() == 0
