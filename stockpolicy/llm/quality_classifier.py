"""Quality by ordinal regression: cumulative logits with shared hashed-text weights.

P(grade > k) = logistic(w.x - t_k): one weight per hashed feature for all grades, and
ordered limits t_0 < t_1 < ... between them. A text's features are its words, their shapes
and a few proportions, hashed into a fixed number of places.
"""

from __future__ import annotations

import zlib
from collections import Counter
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpolicy.llm.common import bounded_sample, crc32_mod, map_batches, texts_of

PLACES = 1 << 15
SAMPLE = 12_000  # rated rows to train on; the bound of the fit
SHAPES = 200_000  # words a worker remembers, about 40 MB

_known: dict[str, tuple[int, int]] = {}


def _place(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % PLACES


def _word(word: str) -> tuple[int, int]:
    """Places of a word's shape and of the word."""
    got = _known.get(word)
    if got is None:
        shape, last = [], ""
        for c in word:
            kind = ("A" if c.isupper() else "a") if c.isalpha() else "9" if c.isdigit() else c
            if kind != last or not c.isalpha():
                shape.append(kind)
            last = kind
        if len(_known) >= SHAPES:
            _known.clear()
        got = _known[word] = _place("s " + "".join(shape)[:24]), _place("w " + word.lower())
    return got


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places and values. Shapes weigh by their share of the words, words by presence.

    An empty text has the bias and its size class only.
    """
    words = text.split()
    n = len(words)
    counts = Counter(words)
    shapes: Counter[int] = Counter()
    own: set[int] = set()
    for w, c in counts.items():
        shape, place = _word(w)
        shapes[shape] += c
        own.add(place)
    places = [_place("bias"), _place(f"size {min(n.bit_length(), 12)}")]
    values = [1.0, 1.0]
    if n:
        again = sum(map(eq, words, words[1:])) / n
        for name, share in (("again", again), ("distinct", len(counts) / n), ("length", len(text) / n / 20)):
            places += [_place(name), _place(f"{name} {int(10 * min(share, 1))}")]
            values += [share, 1.0]
        places += shapes
        values += [2 * (c / n) ** 0.5 for c in shapes.values()]
        places += own
        values += [1 / len(own) ** 0.5] * len(own)
    return np.array(places, np.int64), np.array(values)


class Model(NamedTuple):
    weights: np.ndarray
    limits: np.ndarray  # ordered, one less than there are grades


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def flat(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, value, row) of all features of some texts."""
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
    sizes = [len(p) for p, _ in rows]
    return np.concatenate([p for p, _ in rows]), np.concatenate([v for _, v in rows]), np.repeat(np.arange(len(rows)), sizes)


def fit(place: np.ndarray, value: np.ndarray, of: np.ndarray, grades: np.ndarray, n_grades: int, epochs: int = 200, rate: float = 0.3, decay: float = 1e-3) -> Model:
    """Full-batch adaptive gradient on the ordinal log-likelihood; arguments as from `flat`.

    The gaps between limits are exponentials, so the limits stay in order. Without rows
    all weights are zero.
    """
    weights, n = np.zeros(PLACES), len(grades)
    first, gaps = np.array([-0.5 * (n_grades - 1)]), np.zeros(max(0, n_grades - 2))
    squares = [np.full_like(a, 1e-6) for a in (weights, first, gaps)]
    share = np.bincount(grades, minlength=n_grades) / max(1, n)
    balance = (1 / np.sqrt(np.maximum(share, 1e-3)))[grades]
    balance /= max(balance.sum(), 1e-9)
    for _ in range(epochs if n else 0):
        score = np.bincount(of, value * weights[place], n)
        limits = _limits(first, gaps)
        edge = np.concatenate([[-np.inf], limits, [np.inf]])
        # P(grade) = P(above its lower limit) - P(above its upper limit)
        low, high = _logistic(score - edge[grades]), _logistic(score - edge[grades + 1])
        low[grades == 0], high[grades == n_grades - 1] = 1.0, 0.0
        p = np.maximum(low - high, 1e-9)
        d_low, d_high = balance * low * (1 - low) / p, balance * high * (1 - high) / p
        slope = d_high - d_low
        g_weights = np.bincount(place, value * slope[of], PLACES) + decay * weights
        g_limits = np.array([d_low[grades == k + 1].sum() - d_high[grades == k].sum() for k in range(n_grades - 1)])
        g_gaps = np.array([g_limits[k + 1 :].sum() for k in range(n_grades - 2)]) * np.exp(gaps)
        steps = (g_weights, np.array([g_limits.sum()]), g_gaps)
        for param, g, s in zip((weights, first, gaps), steps, squares):
            s += g * g
            param -= rate * g / np.sqrt(s)
    return Model(weights, _limits(first, gaps))


def _limits(first: np.ndarray, gaps: np.ndarray) -> np.ndarray:
    return np.concatenate([first, first + np.cumsum(np.exp(gaps))])


def above(model: Model, texts: list[str]) -> np.ndarray:
    """P(grade > k) for every text and limit k."""
    scores = np.array([v @ model.weights[p] for p, v in map(features, texts)])
    return _logistic(scores[:, None] - model.limits[None, :])


def train(docs: DataFrame, ratings: DataFrame, sample: int = SAMPLE, n_grades: int = 3) -> Model:
    """Fit on at most `sample` rated rows, always the same ones.

    ratings: doc_id, grade from 0. Null grades and ids do not count. Features are made
    where the texts are; the sampled ids go there, as a table of that bounded size. Of rows that repeat a sampled id one is read. Runs jobs.
    """
    rated = ratings.filter("grade IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "grade")
    chosen = F.broadcast(bounded_sample(rated, "doc_id", sample))
    rows = docs.select("doc_id", "text").join(chosen, "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("grade").cast("int").alias("grade"))

    def run(batch: pa.RecordBatch) -> dict:
        found = [features(t) for t in texts_of(batch)]
        return {
            "doc_id": batch.column("doc_id"), "grade": batch.column("grade"),
            "places": [p.astype(np.int32) for p, _ in found], "values": [v.astype(np.float32) for _, v in found],
        }

    out = map_batches(rows, "doc_id long, grade int, places array<int>, values array<float>", run)
    got = out.toArrow().sort_by("doc_id").combine_chunks()
    sizes = got["places"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
    place, value = (got[c].combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("places", "values"))
    of, grades = np.repeat(np.arange(len(sizes)), sizes), got["grade"].to_numpy()
    return fit(place.astype(np.int64), value.astype(float), of, grades.astype(np.int64), n_grades)


def score(docs: DataFrame, model: Model, grade: int = 1, least: float = 0.5) -> DataFrame:
    """One row per row of `docs`: doc_id, expected_grade, tail_probability, kept.

    tail_probability is that of `grade` or better, and a row is kept if it is `least` at
    least. Reads doc_id and text. A null text counts as empty, and an empty one is scored by
    its size class alone. Repeated rows and null ids stay. An empty table gives none.
    """
    schema = docs.select("doc_id").schema.add("expected_grade", "double")
    schema = schema.add("tail_probability", "double").add("kept", "boolean")

    def run(batch: pa.RecordBatch) -> dict:
        p = above(model, texts_of(batch))
        tail = p[:, grade - 1]
        return {"doc_id": batch.column("doc_id"), "expected_grade": p.sum(1), "tail_probability": tail, "kept": tail >= least}

    return map_batches(docs.select("doc_id", "text"), schema, run)


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) of the labels that may be learned from: 0 poor, 1 toxic, 2 good.

    Rows whose crc32 of the id is 2 modulo 4 are held out. A row without the label that its
    grade depends on has a null grade, from which nothing is learned.
    """
    open_ = labels.filter(crc32_mod("doc_id", 4) != 2)
    return open_.select("doc_id", F.expr("CASE WHEN quality = 0 THEN 0 WHEN quality = 1 THEN 2 - toxic END").alias("grade"))
