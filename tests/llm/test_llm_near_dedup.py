import itertools
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stockpolicy.llm import near_dedup
from stockpolicy.llm.components import components


def plain_simhash(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, radius):
    """Smallest position reachable, by comparing all pairs."""
    top = list(range(len(fps)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if bin(fps[i] ^ fps[j]).count("1") <= radius:
            a, b = find(i), find(j)
            top[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("radius,crowded", [(2, 256), (2, 3), (3, 256), (4, 256)])
def test_components_equal_brute_force(spark, radius, crowded):
    rng = np.random.default_rng(radius)
    fps = []
    for _ in range(12):  # groups of near fingerprints, chains among them
        f = int(rng.integers(0, 1 << 63))
        for _ in range(14):
            fps.append(f)
            for b in rng.choice(64, int(rng.integers(0, radius + 2)), replace=False):
                f ^= 1 << int(b)
    fps += [0, 1, 3, 7, 15, (1 << 64) - 1, (1 << 64) - 2]
    fps = sorted(set(fps), key=signed)
    nodes = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    found = components(near_dedup.links(nodes, radius, crowded))
    got = {r["node"]: r["component"] for r in found.collect()}
    want = plain_components(fps, radius)
    assert [got.get(signed(f), signed(f)) for f in fps] == [signed(fps[w]) for w in want]


def test_links_come_once_where_nothing_is_crowded(spark):
    fps = spark.createDataFrame([(5,), (7,), (4,), (7 << 40,)], "fp long")
    rows = [tuple(r) for r in near_dedup.links(fps, 2).collect()]
    assert sorted(rows) == [(4, 5), (4, 7), (5, 7)]


def test_whole_table_equals_brute_force(spark, documents):
    some = documents.filter("n_chars < 1500")
    rows = near_dedup.near_duplicates(some, 3, 2).collect()
    texts = {r["doc_id"]: r["text"] for r in some.collect()}
    ids = sorted(texts)
    fps = [plain_simhash(texts[i], 3) for i in ids]
    want = plain_components(fps, 2)
    got = {r["doc_id"]: (r["fp"], r["component_id"]) for r in rows}
    assert got == {i: (signed(f), ids[w]) for i, f, w in zip(ids, fps, want)}


def test_odd_rows(odd):
    rows = near_dedup.near_duplicates(odd, 3, 2).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] not in (8, None)}
    assert by[1] == by[2] == 1 and by[3] == by[4] == by[5] == 3 and by[10] == 10


def test_one_of_each_group_stays(odd):
    kept = near_dedup.drop_near_duplicates(odd, 3, 2)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert sorted((i for i in ids if i is not None)) == [1, 3, 6, 7, 8, 8, 9, 10, 11]
    assert ids.count(None) == 2


def test_empty(nothing):
    assert near_dedup.near_duplicates(nothing, 3, 2).count() == 0
    assert near_dedup.drop_near_duplicates(nothing, 3, 2).count() == 0


def test_a_chain_settles(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = components(edges.filter("a != 150"))
    assert {(r["component"], r["n"]) for r in found.groupBy("component").agg(F.count("*").alias("n")).collect()} == {(0, 151), (151, 150)}
