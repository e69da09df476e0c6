"""Whitening against a dense eigendecomposition."""

import math

import numpy as np
import pytest

from stockpolicy.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def dense(x):
    """Eigenvalues and eigenvectors of the covariance of whole vectors, falling."""
    c = x - x.mean(0)
    values, vectors = np.linalg.eigh(c.T @ c / len(x))
    return c, values[::-1], vectors[:, ::-1]


def by_row(rows, column):
    out = {}
    for r in rows:
        out.setdefault(r["vec_id"], {})[r["component"]] = r[column]
    return out


def test_documents_table_equals_dense(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    kept = table.collect()
    x = np.floor(1024 * np.array([r["embedding"] for r in kept], float)) + 100_000
    c, values, vectors = dense(x)
    rows = whitening.whitened(table).collect()
    assert len(rows) == 8 * len(kept)
    got = by_row(rows, "whitened")
    got = np.array([[got[r["vec_id"]][k] for k in range(1, 9)] for r in kept])
    want = c @ vectors[:, :8] / np.sqrt(values[:8])
    signs = np.sign((got * want).sum(0))
    assert np.abs(got * signs - want).max() < 1e-9
    explained = [by_row(rows[:8], "explained")[rows[0]["vec_id"]][k] for k in range(1, 9)]
    assert np.allclose(explained, values[:8] / values.sum(), rtol=1e-10)
    assert {r["identity_error"] for r in rows} == {rows[0]["identity_error"]} and rows[0]["identity_error"] < 1e-9
    whole, n = x.astype(int).astype(object), len(x)
    exact = ((n * whole - whole.sum(0)) ** 2).sum(1)
    deviation = by_row(rows, "deviation")
    assert [int(deviation[r["vec_id"]][1]) for r in kept] == exact.tolist()


def test_odd_rows(spark):
    """Nulls, NaN and infinity, ragged and empty vectors fall out; repeats, a null key and clashing columns stay."""
    rng = np.random.default_rng(1)
    good = [(i, rng.normal(size=5).tolist()) for i in range(40)] + [(7, [1.0] * 5), (7, [1.0] * 5), (None, [2.0] * 5)]
    bad = [(90, None), (91, [1.0, None, 0.0, 0.0, 0.0]), (92, [math.nan] * 5), (93, [math.inf, 0.0, 0.0, 0.0, 0.0]), (94, []), (95, [1.0])]
    wide = SCHEMA + ", key string, x string, n string, component string, whitened string"
    df = spark.createDataFrame([(*r, *"abcde") for r in good + bad], wide).repartition(4)
    rows = whitening.whitened(df).collect()
    assert len(rows) == 5 * len(good) and {r["n"] for r in rows} == {len(good)}
    assert {r["vec_id"] for r in rows} == {k for k, _ in good}
    assert rows[0]["identity_error"] < 1e-9
    total = sum(by_row(rows, "explained")[0].values())
    assert abs(total - 1) < 1e-9


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [None, None]])
def test_nothing_to_whiten(spark, vectors):
    df = spark.createDataFrame(list(enumerate(vectors)), SCHEMA)
    assert whitening.whitened(df).collect() == []


def test_low_rank_gives_fewer_components(spark):
    df = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0, 1.0]) for i in range(10)], SCHEMA)
    assert {r["component"] for r in whitening.whitened(df).collect()} == {1}


def test_large_entries_are_refused(spark):
    df = spark.createDataFrame([(1, [1e30, 0.0]), (2, [0.0, 0.0])], SCHEMA)
    with pytest.raises(Exception, match="exceeds 2\\^40"):
        whitening.whitened(df).collect()


@pytest.mark.parametrize(
    "values",
    [
        np.r_[1e6, np.linspace(10, 9, 99)],  # one direction far above a flat rest
        np.linspace(2, 1, 200),  # no gap anywhere
        np.r_[np.full(8, 5.0), np.full(50, 5.0 - 1e-3)],  # ties, and a narrow gap below them
        np.r_[1.0, 1e-3, 1e-6, np.zeros(60)],  # low rank
    ],
)
def test_filter_certifies_hard_spectra(values):
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.normal(size=(len(values), len(values))))[0]
    v = (q * values) @ q.T
    found = whitening.leading(lambda b: v @ b, len(values), 8)
    want = values[values > 1e-12 * values[0]][:8]
    assert np.allclose(found.values, want, rtol=1e-9)
    assert np.abs(found.vectors.T @ found.vectors - np.eye(len(want))).max() < 1e-12
    assert np.linalg.norm(v @ found.vectors - found.vectors * found.values, axis=0).max() <= 3e-13 * values[0]


def test_sums_beyond_a_long_stay_exact():
    x = np.array([[2**50 + 1, 3], [5, -(2**50)]], np.int64)
    m = whitening.Moments(2**20, [2**60, -(2**61)], [0, 0])
    assert m.moved(x).tolist() == [[2**20 * int(v) - s for v, s in zip(r, m.sums)] for r in x]
