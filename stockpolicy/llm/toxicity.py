"""Toxicity by weak supervision.

Many voters look at a text: words of a lexicon, word beginnings that stand out among
the labelled toxic texts, patterns, and the labels that may be learned from, as one more voter that
is silent on other texts. A generative model estimates how often each voter is right
and which of them go together; its posterior labels train a linear classifier, and that
scores all texts.
"""

from __future__ import annotations

import re
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpolicy.llm.common import bounded_sample, crc32_mod, map_batches, texts_of

# Common insults.
LEXICON = (
    "idiot moron stupid loser clown scum trash pathetic worthless disgusting imbecile dumb "
    "idiota imbécil estúpido estúpida basura payaso asqueroso "
    "imbécile crétin stupide ordure minable débile "
    "idiotisch dummkopf abschaum trottel widerlich erbärmlich"
).split()
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_OTHER = 2500, 4000, 1000  # texts to train on; the bound of the fit
STEMS = (4, 5, 6, 7, 8, 9)  # lengths of word beginnings
VOTERS, TERMS = 400, 3000
LETTERS = re.compile(r"[^\W\d_]+")


def term_names(word: str) -> list[str]:
    """A word and its beginnings, these marked by a hyphen."""
    return [word, *(word[:k] + "-" for k in STEMS if len(word) > k)]


def patterns(text: str) -> list[int]:
    """Votes of the pattern voters: 1 toxic, -1 not, 0 none."""
    letters = sum(map(str.isalpha, text)) or 1
    upper = sum(map(str.isupper, text)) / letters
    return [
        1 if re.search(r"\b(?:you|your|du|dein|tu|ton|eres)\b", text, re.I) else 0,
        1 if text.count("!") * 200 > len(text) else 0,
        1 if upper > 0.5 else 0,
        -1 if len(text) < 40 else 0,
        1 if re.search(r"[@#$%*]{4,}", text) else 0,
    ]


class Model(NamedTuple):
    weights: dict[str, float]
    bias: float
    voters: list[tuple[str, float]]  # term voters and their accuracies


class Sample(NamedTuple):
    """Words of the texts to learn from: of text i, words[at[i]:at[i + 1]] and their counts."""

    names: list[str]
    words: np.ndarray
    counts: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Sample:
        names: dict[str, int] = {}
        found = [Counter(LETTERS.findall(t.lower())) for t in texts]
        words = [names.setdefault(w, len(names)) for f in found for w in f]
        counts = [n for f in found for n in f.values()]
        at = np.cumsum([0] + [len(f) for f in found])
        return cls(list(names), np.array(words, np.int64), np.array(counts, np.int64), at)


class Terms:
    """Terms of a sample's texts by number. A word has several, a text those of its words."""

    def __init__(self, sample: Sample):
        self.sample = sample
        number: dict[str, int] = {}
        self.by_word = np.full((len(sample.names), len(STEMS) + 1), -1, np.int64)
        for i, w in enumerate(sample.names):
            own = [number.setdefault(t, len(number)) for t in term_names(w)]
            self.by_word[i, : len(own)] = own
        self.names, self.number = list(number), number

    def __len__(self) -> int:
        return len(self.sample.at) - 1

    def texts_with(self, rows: np.ndarray) -> np.ndarray:
        """How many of the given texts have each term."""
        total = np.zeros(len(self.names), np.int64)
        for i in rows:
            own = self.by_word[self.sample.words[self.sample.at[i] : self.sample.at[i + 1]]]
            total[np.unique(own[own >= 0])] += 1
        return total

    def hits(self, chosen: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, index in chosen, count) wherever a text has a chosen term."""
        index = np.full(len(self.names) + 1, -1)
        for j, t in enumerate(chosen):
            index[self.number.get(t, -1)] = j
        index[-1] = -1
        columns = index[self.by_word][self.sample.words]
        row = np.repeat(np.arange(len(self)), np.diff(self.sample.at))
        i, k = np.nonzero(columns >= 0)
        key, inverse = np.unique(row[i] * max(1, len(chosen)) + columns[i, k], return_inverse=True)
        counts = np.bincount(inverse, self.sample.counts[i], len(key))
        return key // max(1, len(chosen)), key % max(1, len(chosen)), counts


def mine(terms: Terms, toxic: np.ndarray, clean: np.ndarray, most: int) -> list[str]:
    """Terms whose presence speaks for toxic text, by likelihood ratio: found in a few toxic texts
    and many times rarer elsewhere."""
    a, b = max(1, len(toxic)), max(1, len(clean))
    yes, no = terms.texts_with(toxic), terms.texts_with(clean)
    p, q = (yes + 0.5) / (a + 1), (no + 0.5) / (b + 1)
    gain = yes * np.log(p / q) + (a - yes) * np.log((1 - p) / (1 - q))
    usable = np.flatnonzero((yes >= 4) & (p > 12 * q))
    return [terms.names[i] for i in usable[np.lexsort((usable, -gain[usable]))][:most]]


def label_model(votes: np.ndarray, sure: np.ndarray, prior: float, rounds: int = 25) -> tuple[np.ndarray, np.ndarray]:
    """Posterior P(toxic) of each row, and each voter's accuracy.

    votes: rows x voters of -1, 0, 1; sure: votes of the voter to start from, counted in votes as
    well. Each voter has a table P(vote | label), fitted by expectation maximisation. Then the
    votes' correlations given the label are estimated; a voter that goes with others
    counts for its share only, and the fit is repeated. Near copies of one voter, which
    no label explains (a correlation of 0.8 and more), share from the start.
    """
    n, m = votes.shape
    balance = votes.sum(1)
    posterior = np.where(balance > 0, 0.9, np.where(balance < 0, 0.02, prior))
    posterior = np.where(sure > 0, 0.97, np.where(sure < 0, 0.03, posterior))
    share = 1 / (1 + _together(votes.astype(np.float32) - votes.mean(0), 0.8).sum(1))
    shown = [(votes == v).astype(np.float32) for v in (-1, 0, 1)]
    for stage in range(2):
        for _ in range(rounds):
            tables = []
            for p in (posterior, 1 - posterior):
                counts = np.stack([s.T @ p for s in shown]) + 0.1
                tables.append(np.log(counts / counts.sum(0)))
            ratio = tables[0] - tables[1]
            odds = np.log(prior / (1 - prior)) + sum(s @ (ratio[v] * share) for v, s in enumerate(shown))
            posterior = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if stage == 0:
            # Residuals given the soft label; positive correlation means double counting.
            fired = votes.astype(np.float32)
            mean1 = posterior @ fired / max(posterior.sum(), 1e-6)
            mean0 = (1 - posterior) @ fired / max((1 - posterior).sum(), 1e-6)
            rest = fired - posterior[:, None] * mean1 - (1 - posterior)[:, None] * mean0
            share = 1 / (1 + _together(rest, 0.1).sum(1))
    positive = shown[2].T @ posterior + 0.5
    accuracy = positive / (shown[2].sum(0) + 1)
    return posterior, accuracy


def _together(rest: np.ndarray, least: float) -> np.ndarray:
    """Correlations between columns that are at least that high, others and a column's own zero."""
    rest = rest / (np.sqrt((rest**2).sum(0)) + 1e-9)
    found = np.clip(rest.T @ rest, 0, 1)
    found[found < least] = 0
    np.fill_diagonal(found, 0)
    return found


def linear(terms: Terms, target: np.ndarray, chosen: list[str], epochs: int = 150) -> tuple[dict[str, float], float]:
    """Logistic regression on posterior labels: adaptive gradient, shrunk weights."""
    row, col, counts = terms.hits(chosen)
    val, n = np.log1p(counts), len(target)
    weights, bias = np.zeros(len(chosen)), -2.0
    square, bias_square = np.full(len(chosen), 1e-6), 1e-6
    for _ in range(epochs):
        score = bias + np.bincount(row, val * weights[col], n)
        error = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - target) / n
        g = np.bincount(col, val * error[row], len(chosen)) + 1e-5 * weights
        square += g * g
        weights -= 0.3 * g / np.sqrt(square)
        bias_square += error.sum() ** 2
        bias -= 0.3 * error.sum() / np.sqrt(bias_square)
    return {t: float(w) for t, w in zip(chosen, weights) if abs(w) > 1e-6}, float(bias)


def fit(sample: Sample, pattern_votes: np.ndarray, labels: np.ndarray) -> Model:
    """Voters from the labelled texts, posteriors from all votes, weights from the posteriors.

    labels: 1, 0, or -1 where there is none.
    """
    if not len(labels):
        return Model({}, -4.0, [])
    terms = Terms(sample)
    toxic, clean = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    voters = [*dict.fromkeys([*LEXICON, *mine(terms, toxic, clean, VOTERS)])]
    row, col, counts = terms.hits(voters)
    votes = np.zeros((len(labels), len(voters) + 2), np.int8)
    votes[row, col] = 1
    whole = np.array([not t.endswith("-") for t in voters])
    words, hits = np.bincount(row, counts * whole[col], len(labels)), np.bincount(row, minlength=len(labels))
    votes[:, -2] = np.where(hits == 0, -1, 0)
    votes[:, -1] = (words > 1) | (hits > 2)
    given = np.where(labels < 0, 0, 2 * labels - 1).astype(np.int8)
    votes = np.concatenate([votes, pattern_votes, given[:, None]], axis=1)
    # The sample holds more toxic texts than the corpus; the prior is that of the sample.
    prior = min(0.9, max(0.02, (len(toxic) + 1) / (len(toxic) + len(clean) + 2)))
    posterior, accuracy = label_model(votes, given, prior)
    chosen = mine(terms, np.flatnonzero(posterior > 0.8), np.flatnonzero(posterior < 0.2), TERMS)
    weights, bias = linear(terms, posterior, [*dict.fromkeys([*voters, *chosen])])
    return Model(weights, bias, [(t, float(a)) for t, a in zip(voters, accuracy)])


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on bounded samples: labelled toxic and clean texts, and others. Runs jobs.

    Only labels whose id's crc32 is not 2 modulo 4 are read. The sampled ids, of that bounded
    number, go to where the texts are; terms are counted there. Of rows that repeat a
    sampled id one is read.
    """
    open_ = labels.filter((crc32_mod("doc_id", 4) != 2) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    ids = bounded_sample(open_.filter("toxic = 1").select("doc_id", F.lit(1).alias("y")), "doc_id", SAMPLE_TOXIC)
    ids = ids.unionByName(bounded_sample(open_.filter("toxic = 0").select("doc_id", F.lit(0).alias("y")), "doc_id", SAMPLE_CLEAN))
    others = bounded_sample(docs.filter("doc_id IS NOT NULL").select("doc_id"), "doc_id", SAMPLE_OTHER)
    ids = ids.unionByName(others.join(ids, "doc_id", "left_anti").withColumn("y", F.lit(None).cast("int")))
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min("y").alias("y"), F.min("text").alias("text"))

    def run(batch: pa.RecordBatch) -> dict:
        texts = texts_of(batch)
        found = [list(Counter(LETTERS.findall(t.lower())).items()) for t in texts]
        return {
            "doc_id": batch.column("doc_id"), "y": batch.column("y"),
            "words": [[w for w, _ in f] for f in found], "counts": [[n for _, n in f] for f in found],
            "patterns": [patterns(t) for t in texts],
        }

    out = map_batches(rows, "doc_id long, y int, words array<string>, counts array<int>, patterns array<int>", run)
    got = out.toArrow().sort_by("doc_id").combine_chunks()
    words = got["words"].combine_chunks()
    coded = words.flatten().dictionary_encode()
    at = np.concatenate([[0], np.cumsum(words.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    counts = got["counts"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    sample = Sample(coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), counts, at)
    votes = got["patterns"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    labels = got["y"].fill_null(-1).to_numpy()
    return fit(sample, votes.reshape(len(labels), len(patterns(""))).astype(np.int8), labels)


def probability(model: Model, text: str, known: dict[str, tuple] | None = None) -> float:
    """Score of one whole text; known remembers which weighted terms a word has."""
    known = {} if known is None else known
    found: dict[str, int] = {}
    for w in LETTERS.findall(text.lower()):
        own = known.get(w)
        if own is None:
            if len(known) > 300_000:
                known.clear()
            own = known[w] = tuple(t for t in term_names(w) if t in model.weights)
        for t in own:
            found[t] = found.get(t, 0) + 1
    score = model.bias + sum(model.weights[t] * np.log1p(n) for t, n in found.items())
    return float(1 / (1 + np.exp(-np.clip(score, -30, 30))))


def score(docs: DataFrame, model: Model, least: float = 0.3) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score, predicted.

    Reads doc_id and text; the score depends on the text alone. A null or empty text gets the
    score of a text without any term. Repeated rows and null ids stay. An empty table
    gives none.
    """
    schema = docs.select("doc_id").schema.add("score", "double")

    def run(batch: pa.RecordBatch) -> dict:
        known: dict[str, tuple] = {}
        return {"doc_id": batch.column("doc_id"), "score": [probability(model, t, known) for t in texts_of(batch)]}

    scored = map_batches(docs.select("doc_id", "text"), schema, run)
    return scored.select(
        "doc_id",
        (crc32_mod("doc_id", 4) == 2).alias("held_out"),
        "score",
        F.when(F.col("score") >= least, 1).otherwise(0).alias("predicted"),
    )
