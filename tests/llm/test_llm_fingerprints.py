import hashlib
import itertools
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from stockpolicy.llm import fingerprints


def plain(text):
    """Weighted votes of neighbouring words, straight from the definition."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    votes, total = [0] * 64, 0
    for i, w in enumerate(words):
        after = words[i + 1] if i + 1 < len(words) else None
        h = xxhash.xxh64_intdigest(w.encode(), 42)
        h = h if after is None else xxhash.xxh64_intdigest(after.encode(), h)
        weight = min(len(w) + len(after or ""), 32)
        total += weight
        for b in range(64):
            votes[b] += weight * (h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * votes[b] > total)


def test_documents_equal_brute_force(spark, documents):
    some = documents.filter("doc_id % 3 = 0 OR doc_id < 40").repartition(5)
    rows = sorted(fingerprints.compare_neighbours(some).collect(), key=lambda r: r["doc_id"])
    texts = {r["doc_id"]: r["text"] for r in some.collect()}
    ids = sorted(texts)
    own = {i: plain(texts[i]) for i in ids}
    for at, r in enumerate(rows):
        i, follows = ids[at], ids[at - 1]
        m = len(texts[i]) // 3
        changed = texts[i][: len(texts[i]) - m] + texts[follows][:m]
        assert r["doc_id"] == i and r["n_chars"] == len(texts[i])
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert r["fingerprint"] == f"{own[i]:016x}" and r["edited_fingerprint"] == f"{plain(changed):016x}"
        assert r["near_edited"] == 1 - bin(own[i] ^ plain(changed)).count("1") / 64
        assert r["near_next"] == 1 - bin(own[i] ^ own[follows]).count("1") / 64
        near = sum(bin(own[i] ^ own[j]).count("1") <= 3 for j in ids if j != i)
        assert r["n_near"] == (near if i % 50 == 0 else None)


def test_tables_find_all_pairs(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(-(1 << 63), 1 << 63, 20)
    all_ = sorted({int(b) ^ (sum(1 << int(k) for k in rng.choice(63, int(n), replace=False))) for b in base for n in rng.integers(0, 5, 12)})
    index = spark.createDataFrame([(f,) for f in all_], "f long")
    for radius in (1, 3, 5):
        got = sorted(tuple(r) for r in fingerprints.within(index.select(F.col("f").alias("q")), index, radius).collect())
        mask = (1 << 64) - 1
        far = lambda a, b: bin((a ^ b) & mask).count("1")
        assert got == sorted((a, b, far(a, b)) for a, b in itertools.product(all_, all_) if far(a, b) <= radius)


def test_native(documents):
    near = fingerprints.compare_neighbours(documents.limit(5))
    assert not re.search("Python|Arrow|Pandas", near._jdf.queryExecution().executedPlan().toString())


def test_odd_rows(odd, nothing):
    rows = fingerprints.compare_neighbours(odd).collect()
    assert len(rows) == odd.count()
    for r in rows:
        if r["doc_id"] in (3, 4, 5):
            assert r["fingerprint"] == "0" * 16
    a, b = (next(r for r in rows if r["doc_id"] == i) for i in (1, 2))
    assert a["fingerprint"] == b["fingerprint"]
    assert fingerprints.compare_neighbours(nothing).count() == 0
    one = fingerprints.fingerprints(odd.filter("doc_id in (1, 3, 6, 7)"))
    assert one.count() == 4
