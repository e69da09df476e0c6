"""The Merkle manifest against a tree built in plain Python."""

import hashlib
import zlib
from functools import reduce

import duckdb
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpolicy.llm import merkle


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    parts = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in parts))


def tree(nodes):
    """Levels of digests from the nodes up to a single one."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def proof_and_fold(levels, i, node):
    proof = ""
    for level in levels[:-1]:
        start = i - i % 8
        before, after = "".join(level[start:i]), "".join(level[i + 1 : start + 8])
        proof, node, i = proof + before + after, h(before + node + after), i // 8
    return proof, node


def brute_force(rows):
    lower = str.maketrans(merkle.UPPER, merkle.LOWER)
    groups = {}
    for r in rows:
        own, changed = leaf(r, r["text"]), None
        if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
            changed = leaf(r, r["text"] and r["text"].translate(lower))
        groups.setdefault(r["lang"], []).append((r["doc_id"], own, changed))
    langs = sorted(groups, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in langs:
        groups[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[lang] = tree([r[1] for r in groups[lang]])
    upper = tree([trees[lang][-1][0] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        for i, (key, own, changed) in enumerate(groups[lang]):
            proof, node = proof_and_fold(trees[lang], i, changed or own)
            rest, folded = proof_and_fold(upper, k, node)
            root = upper[-1][0]
            out.append((key, own, trees[lang][-1][0], root, h(proof + rest), folded, folded == root))
    return out


def same(got, want):
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_documents_equal_brute_force(documents):
    rows = documents.collect()
    same(merkle.tampering_check(documents).collect(), brute_force(rows))


def test_sizes_around_a_run_and_a_block(spark):
    """One language per size, and more languages than a run holds; some trees have two tiers."""
    sizes = [1, 2, 7, 8, 9, 63, 64, 65, 512, 513, 4095, 4096, 4097, 33_000]
    text = F.concat(F.lit("Text "), F.col("id").cast("string"))
    parts = [
        spark.range(n).select(
            F.col("id").alias("doc_id"), text.alias("text"), F.lit(f"l{n}").alias("lang"), F.lit(None).cast("string").alias("source"), F.lit(1).alias("n_chars")
        )
        for n in sizes
    ]
    docs = reduce(DataFrame.unionByName, parts)
    same(merkle.tampering_check(docs).collect(), brute_force(docs.collect()))


def test_versions_share_what_they_do_not_change(documents):
    made = merkle.build(documents, merkle.tampered_leaf())
    copies = merkle.versions(made).collect()
    rows = {r["doc_id"]: r for r in merkle.verify(made).collect()}
    by_version = {}
    for c in copies:
        by_version.setdefault(c["doc_id"], {})[c["level"]] = c["node"]
    failed = {k for k, r in rows.items() if not r["verified"]}
    assert set(by_version) == failed  # a change that changes nothing owns no node
    for key, nodes in by_version.items():
        assert sorted(nodes) == list(range(len(nodes)))
        assert nodes[max(nodes)] == rows[key]["folded_root"]
    assert max(len(v) for v in by_version.values()) <= 8  # a path, never the tree


def test_odd_rows(odd):
    same(merkle.tampering_check(odd).collect(), brute_force(odd.collect()))


def test_empty_table(nothing):
    assert merkle.tampering_check(nothing).collect() == []


def test_sql_equals(spark, documents, tmp_path):
    from support import SMOKE

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMOKE}/documents.parquet'")
    small = spark.read.parquet(f"{SMOKE}/documents.parquet")
    result = con.execute(merkle.oracle())
    names = [d[0] for d in result.description]
    same(merkle.tampering_check(small).select(*names).collect(), result.fetchall())
