"""Secret scan: fixed patterns, and a character network over every further candidate.

A candidate is a long run of token characters. A small convolutional network in
numpy reads it with its surroundings and gives a calibrated probability that it is a
secret. It is trained on labelled findings: all those of the fixed patterns in the corpus
against all other candidates there, and drawn ones of common shapes. The
limit is the highest that still finds the wanted share of all held-out secrets.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockpolicy.functions.session import release, stored
from stockpolicy.llm.common import by_size, map_batches, send_package, texts_of

# The base patterns. Keywords in either case of ASCII letters only.
KINDS = ("assign", "access", "hex", "model")
ASSIGN = re.compile(
    "("
    + "|".join(
        "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
        for word in ("password", "passwd", "secret", "token", "api_?key")
    )
    + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
WORDS = (b"password", b"passwd", b"secret", b"token", b"api")

# Candidates: runs of token characters, this long with a digit, or longer without.
WITH_DIGIT, WITHOUT_DIGIT = 16, 24
SCANNED = 1 << 18  # characters at a time; some 50 bytes each
BEFORE, PIECE, AFTER, TAP = 16, 48, 8, 5
JOINTS = "+/_.=-"
DIGITS = "0123456789"
DRAWN = 1500  # drawn findings of each label
STEPS, RATE = 16, 0.005  # passes over all findings of the corpus, and their rate
FINE, WIDEST = 256, 64  # a score is rounded to 1/FINE and clipped, so that counts of scores are few
PARTS = 48  # files of the findings to train on


def _table(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_LOWER, _DIGITS = bytes(range(97, 123)), bytes(range(48, 58))
_HEX = _table(_DIGITS + b"abcdef")
_TOKEN = _table(_DIGITS + _LOWER + _LOWER.upper() + b"+/_=.-")
_DIGIT = _table(_DIGITS)


def _runs(flags: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    a, b = edge[::2], edge[1::2]
    long = b - a >= least
    return a[long], b[long]


class Found(NamedTuple):
    base: list[tuple[str, int, int]]  # kind, start, end in code points
    others: list[tuple[int, int]]  # further candidates: runs, or what base spans leave of them


def is_candidate(value: str) -> bool:
    return len(value) >= WITHOUT_DIGIT or (len(value) >= WITH_DIGIT and any(c in DIGITS for c in value))


def left_over(text: str, runs: list[tuple[int, int]], base: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """The candidates among the parts of ascending, disjoint `runs` that no base span covers.

    A part that a base span has cut off loses the joining signs at its ends. One sweep over both.
    """
    covered: list[list[int]] = []
    for s, e in sorted((s, e) for _, s, e in base):
        if covered and s <= covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], e)
        else:
            covered.append([s, e])
    out, first = [], 0
    for s, e in runs:
        while first < len(covered) and covered[first][1] <= s:
            first += 1
        at, cuts = s, first
        parts = []
        while cuts < len(covered) and covered[cuts][0] < e:
            parts.append((at, covered[cuts][0]))
            at = covered[cuts][1]
            cuts += 1
        if cuts == first:  # untouched, and a candidate already
            out.append((s, e))
            continue
        for x, y in [*parts, (at, e)]:
            value = text[x:y] if x < y else ""
            kept = value.strip(JOINTS)
            x += len(value) - len(value.lstrip(JOINTS))
            if is_candidate(kept):
                out.append((x, x + len(kept)))
    return out


def scan(texts: list[str]) -> list[Found]:
    """Base spans and further candidates of every whole text, in code points.

    Time and memory grow with the length of the texts, however many runs these hold.
    """
    out: list[Found] = []
    for part in by_size(texts, SCANNED):
        some = texts[part]
        raws = [t.encode("utf-8", "surrogatepass") for t in some]
        joined = np.frombuffer(b"\n".join(raws) + b"\n", np.uint8)
        starts = np.cumsum([0] + [len(r) + 1 for r in raws])
        points = np.concatenate([[0], np.cumsum((joined & 0xC0) != 0x80)])  # code points before a byte

        def placed(a: np.ndarray, b: np.ndarray) -> list[list[tuple[int, int]]]:
            """The spans of each text, in its code points."""
            of = np.searchsorted(starts, a, "right") - 1
            zero = points[starts[of]]
            spans = [[] for _ in some]
            for i, s, e in zip(of.tolist(), (points[a] - zero).tolist(), (points[b] - zero).tolist()):
                spans[i].append((s, e))
            return spans

        hexes = placed(*_runs(_HEX[joined], HEX_LEAST))
        a, b = _runs(_TOKEN[joined], WITH_DIGIT)
        digits = np.concatenate([[0], np.cumsum(_DIGIT[joined])])
        use = (digits[b] > digits[a]) | (b - a >= WITHOUT_DIGIT)
        runs = placed(a[use], b[use])
        for i, (text, raw) in enumerate(zip(some, raws)):
            base = [("hex", s, e) for s, e in hexes[i]]
            low = raw.lower()
            if any(w in low for w in WORDS):
                base += [
                    ("assign", *m.span())
                    for m in ASSIGN.finditer(text)
                    if m.end(2) - m.start(2) >= ASSIGN_LEAST
                ]
            if b"AKIA" in raw:
                base += [
                    ("access", *m.span())
                    for m in ACCESS.finditer(text)
                    if m.end() - m.start() >= ACCESS_LEAST
                ]
            base.sort(key=lambda s: (s[1], KINDS.index(s[0])))
            out.append(Found(base, left_over(text, runs[i], base)))
    return out


def window(text: str, start: int, end: int) -> tuple[str, str, str]:
    return text[max(0, start - BEFORE) : start], text[start:end], text[end : end + AFTER]


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


# The network -----------------------------------------------------------------

SIGNS, FILTERS = 98, 16


def _coded(text: str, width: int, right: bool = False) -> list[int]:
    codes = [ord(c) - 31 if 32 <= ord(c) < 127 else 96 for c in text[:width]]
    pad = [0] * (width - len(codes))
    return pad + codes if right else codes + pad


def encode(windows: list[tuple[str, str, str]]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of sign numbers, a row per piece of a candidate, and each row's candidate."""
    rows, of = [], []
    for i, (before, value, after) in enumerate(windows):
        for at in range(0, max(1, len(value)), PIECE):
            rows.append(
                _coded(before, BEFORE, right=True)
                + _coded(value[at : at + PIECE], PIECE)
                + _coded(after, AFTER)
            )
            of.append(i)
    return np.array(rows, np.int64).reshape(-1, BEFORE + PIECE + AFTER), np.array(of, np.int64)


class Model(NamedTuple):
    taps: np.ndarray  # TAP x SIGNS x FILTERS
    shift: np.ndarray
    dense: np.ndarray  # features: maximum before and inside, mean inside
    bias: float
    scale: float  # calibration: probability = logistic(scale * score + offset)
    offset: float
    limit: float


def _score(taps, shift, dense, bias, x) -> np.ndarray:
    score = (_features(taps, shift, x)[1] @ dense + bias).astype(np.float64)
    return np.clip(np.round(score * FINE) / FINE, -WIDEST, WIDEST)


def _probability(score: np.ndarray, scale: float, offset: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(scale * score + offset, -30, 30)))


def _features(taps, shift, x):
    places = x.shape[1] - TAP + 1
    maps = np.zeros((len(x), places, taps.shape[2]), np.float32) + shift
    for k in range(TAP):
        maps += taps[k][x[:, k : k + places]]
    maps = np.maximum(maps, 0)
    head, body = maps[:, : BEFORE - 2], maps[:, BEFORE - 2 :]
    return maps, np.concatenate([head.max(1), body.max(1), body.mean(1)], axis=1)


def scores(model: Model, windows: list[tuple[str, str, str]]) -> np.ndarray:
    """Calibrated probability of each candidate, the highest of its pieces."""
    out = np.zeros(len(windows))
    x, of = encode(windows)
    for at in range(0, len(x), 1024):
        score = _score(model.taps, model.shift, model.dense, model.bias, x[at : at + 1024])
        np.maximum.at(out, of[at : at + 1024], _probability(score, model.scale, model.offset))
    return out


def drawn_findings(seed: int, n: int) -> tuple[list[tuple[str, str, str]], list[int]]:
    """n findings of each label, of common shapes: keys, digests, encoded bytes; and
    long words, host names, paths, dates, identifiers."""
    rng = np.random.default_rng(seed)
    lower, digit = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    full = lower + lower.upper() + digit

    def some(alphabet: str, least: int, most: int) -> str:
        return "".join(rng.choice(list(alphabet), int(rng.integers(least, most))))

    def word() -> str:
        return "".join(rng.choice(["th", "er", "on", "an", "re", "ing", "tion", "ver", "ch", "que", "os"], 3))

    def secret() -> str:
        return [
            lambda: some(digit + "abcdef", 24, 65),
            lambda: some(full, 20, 50),
            lambda: some(full + "+/", 24, 64) + "=",
            lambda: some(lower, 2, 4) + "_" + some(full, 24, 40),
            lambda: some(full, 12, 24) + "-" + some(full, 12, 24),
        ][rng.integers(5)]()

    def harmless() -> str:
        return [
            lambda: "".join(word() for _ in range(rng.integers(3, 30))),
            lambda: some(lower, 1, 5) * int(rng.integers(12, 60)),
            lambda: f"{word()}.{word()}{rng.integers(99)}.example.com",
            lambda: f"/{word()}/{word()}/{word()}-{rng.integers(2100)}",
            lambda: "-".join(word() for _ in range(3)) + str(rng.integers(99)),
            lambda: f"{rng.integers(1990, 2030)}-0{rng.integers(1, 10)}-{rng.integers(10, 28)}-{rng.integers(10**6)}",
            lambda: "_".join([word().upper(), word().upper(), str(rng.integers(99)), word()]),
            lambda: some(digit, 16, 30),
            lambda: word() + "=" * int(rng.integers(14, 40)),
        ][rng.integers(9)]()

    def around() -> tuple[str, str]:
        return f"{word()} {word()} {word()} "[-BEFORE:], f" {word()} {word()}"[:AFTER]

    rows, labels = [], []
    for label, make in ((1, secret), (0, harmless)):
        for _ in range(n):
            before, after = around()
            rows.append((before, make(), after))
            labels.append(label)
    return rows, labels


def _side(value: str) -> bool:
    """Held out: all findings of one value are on the same side."""
    return zlib.crc32(value.encode("utf-8", "surrogatepass")) % 5 == 0


def fit(windows: list[tuple[str, str, str]], labels: list[int], recall: float = 0.98, epochs: int = 8, seed: int = 5) -> Model:
    """Train on four fifths of the values, calibrate and set the limit on the rest. Same model every time.

    All findings of one value, with or without surroundings, are on the same side.
    """
    drawn, marks = drawn_findings(seed, DRAWN)
    # Each finding of the corpus also without its surroundings, so that a keyword before it isn't all.
    bare = [("", v, "") for _, v, _ in windows]
    x, of = encode([*windows, *bare, *drawn])
    y = np.array([*labels, *labels, *marks], np.float32)[of]
    rng = np.random.default_rng(seed)
    values = [v for _, v, _ in (*windows, *bare, *drawn)]
    held = np.array([_side(v) for v in values])[of]
    taps = rng.normal(0, 0.15, (TAP, SIGNS, FILTERS)).astype(np.float32)
    shift = np.zeros(FILTERS, np.float32)
    dense = rng.normal(0, 0.1, 3 * FILTERS).astype(np.float32)
    bias = np.zeros(1, np.float32)
    params = [taps, shift, dense, bias]
    adam = Adam(params)
    train = np.flatnonzero(~held)
    for _ in range(epochs):
        rng.shuffle(train)
        for at in range(0, len(train), 256):
            rows = train[at : at + 256]
            adam.step(_gradients(params, x[rows], y[rows]))
    score = _score(taps, shift, dense, bias[0], x[held])
    return calibrated(params, score, y[held], np.ones(len(score)), recall)


class Adam:
    """Steps of the parameters, in place."""

    def __init__(self, params: list[np.ndarray], rate: float = 0.01):
        self.params, self.rate, self.steps = params, rate, 0
        self.means, self.squares = ([np.zeros_like(p) for p in params] for _ in range(2))

    def step(self, grads) -> None:
        self.steps += 1
        for p, g, m, s in zip(self.params, grads, self.means, self.squares):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            p -= self.rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(s / (1 - 0.999**self.steps)) + 1e-8)


def calibrated(params: list[np.ndarray], score: np.ndarray, y: np.ndarray, weight: np.ndarray, recall: float) -> Model:
    """The model of the parameters, calibrated on held-out scores; its limit is the highest
    that leaves the share `recall` of their secrets, by weight."""
    scale, offset = _platt(score, y, weight)
    p = _probability(score, scale, offset)
    order = np.argsort(p, kind="stable")
    order = order[y[order] > 0]
    so_far = np.cumsum(weight[order])
    limit = 1.0
    if len(order):
        limit = float(p[order[np.searchsorted(so_far, (1 - recall) * so_far[-1], "right")]])
    taps, shift, dense, bias = params
    return Model(taps, shift, dense, float(bias[0]), scale, offset, limit)


def _gradients(params, x, y, weight=None):
    """Of the mean loss, or of the loss summed by weight."""
    taps, shift, dense, bias = params
    maps, feats = _features(taps, shift, x)
    score = feats @ dense + bias[0]
    error = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - y
    error = (error / len(y) if weight is None else error * weight).astype(np.float32)
    back = error[:, None] * dense[None, :]
    n, places, f = maps.shape
    cut = BEFORE - 2
    grad = np.zeros_like(maps)
    rows, cols = np.arange(n)[:, None], np.arange(f)[None, :]
    grad[rows, maps[:, :cut].argmax(1), cols] += back[:, :f]
    grad[rows, cut + maps[:, cut:].argmax(1), cols] += back[:, f : 2 * f]
    grad[:, cut:] += back[:, None, 2 * f :] / (places - cut)
    grad *= maps > 0
    flat = grad.reshape(-1, f)
    tap_grad = np.zeros_like(taps)
    for k in range(TAP):
        signs = x[:, k : k + places].reshape(-1)
        for j in range(f):
            tap_grad[k, :, j] = np.bincount(signs, flat[:, j], SIGNS)
    return tap_grad, flat.sum(0), feats.T @ error, np.array([error.sum()], np.float32)


def _platt(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic calibration by Newton steps on softened labels."""
    pos, neg = max(1.0, (weight * y).sum()), max(1.0, (weight * (1 - y)).sum())
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    w = np.array([1.0, 0.0])
    design = np.stack([score, np.ones_like(score)], 1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hess = (design * (weight * (p * (1 - p) + 1e-6))[:, None]).T @ design + 1e-6 * np.eye(2)
        w = w - np.linalg.solve(hess, design.T @ (weight * (p - target)))
    return float(w[0]), float(w[1])


# On tables -------------------------------------------------------------------

FINDING = "struct<start:int,end:int,before:string,value:string,after:string>"
CANDIDATES = f"base array<struct<kind:string,start:int,end:int>>, labelled array<{FINDING}>, others array<{FINDING}>"


def candidates(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, base, labelled, others) of every row: base spans, their windows, further candidates."""
    schema = docs.select(key).schema
    for field in T._parse_datatype_string(CANDIDATES):
        schema = schema.add(field)

    def run(batch: pa.RecordBatch) -> dict:
        texts = texts_of(batch)
        found = scan(texts)

        def windows(text, spans):
            return [(s, e, *window(text, s, e)) for s, e in spans]

        def rows(lists, names):
            return [[dict(zip(names, x)) for x in xs] for xs in lists]

        names = ("start", "end", "before", "value", "after")
        return {
            key: batch.column(key),
            "base": rows([f.base for f in found], ("kind", "start", "end")),
            "labelled": rows([windows(t, _values(t, f.base)) for t, f in zip(texts, found)], names),
            "others": rows([windows(t, f.others) for t, f in zip(texts, found)], names),
        }

    return map_batches(docs.select(key, "text"), schema, run)


def _values(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """The secret part of each base span: for an assignment, what is assigned."""
    out = []
    for kind, s, e in base:
        m = ASSIGN.match(text, s, e) if kind == "assign" else None
        out.append((m.start(2), e) if m else (s, e))
    return out


PIECES = "label int, drawn boolean, held boolean, before string, value string, after string, share double"
CHUNKS = "held boolean, signs binary, label binary, drawn binary, share binary, n0 long, n1 long"
CHUNK = 256  # pieces
WHOLE = 2**32  # sums are whole numbers of 1/WHOLE, so that they don't depend on any order


def _pieces(window: tuple[str, str, str], label: int, drawn: bool = False) -> list[tuple]:
    """Rows of PIECES of one finding; their shares add up to 1."""
    before, value, after = window
    n, held = max(1, -(-len(value) // PIECE)), _side(value)
    return [(label, drawn, held, before, value[at * PIECE : (at + 1) * PIECE], after, 1 / n) for at in range(n)]


def pieces(found: DataFrame) -> DataFrame:
    """What to train on: the pieces of all findings from `candidates`, each with and without its
    surroundings, and of drawn ones. Distinct rows of PIECES, in an order that does not vary."""
    names = [f.name for f in T._parse_datatype_string(PIECES)]

    def run(batch: pa.RecordBatch) -> dict:
        rows: dict[tuple, None] = {}  # a set in order
        for column, label in (("labelled", 1), ("others", 0)):
            for of_text in batch.column(column).to_pylist():
                for f in of_text:
                    rows.update(dict.fromkeys(_pieces((f["before"], f["value"], f["after"]), label)))
                    rows.update(dict.fromkeys(_pieces(("", f["value"], ""), label)))
        return dict(zip(names, zip(*rows))) if rows else {n: [] for n in names}

    own = map_batches(found.select("labelled", "others"), PIECES, run)
    drawn = [row for w, y in zip(*drawn_findings(5, DRAWN)) for row in _pieces(w, y, drawn=True)]
    both = own.unionByName(found.sparkSession.createDataFrame(drawn, PIECES))
    return both.repartition(PARTS, *names).distinct().sortWithinPartitions(*names)


def chunks(rows: DataFrame) -> DataFrame:
    """Rows of CHUNKS from rows of PIECES: sign numbers and the rest, CHUNK pieces at a time.

    n0, n1: 1/WHOLE of findings of the corpus with label 0 and 1.
    """
    names = [f.name for f in T._parse_datatype_string(CHUNKS)]

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {n: [] for n in names}
        held, drawn = (np.array(batch.column(c).to_pylist(), bool) for c in ("held", "drawn"))
        label, share = (np.array(batch.column(c).to_pylist(), np.float32) for c in ("label", "share"))
        windows = list(zip(*(batch.column(c).to_pylist() for c in ("before", "value", "after"))))
        for side in (False, True):
            of = np.flatnonzero(held == side)
            for at in range(0, len(of), CHUNK):
                some = of[at : at + CHUNK]
                whole = np.round(share[some].astype(np.float64) * WHOLE).astype(np.int64)
                own = [int(whole[~drawn[some] & (label[some] == y)].sum()) for y in (0, 1)]
                signs = encode([windows[i] for i in some])[0].astype(np.uint8)
                row = side, signs.tobytes(), label[some].tobytes(), drawn[some].tobytes(), share[some].tobytes(), *own
                for name, value in zip(names, row):
                    out[name].append(value)
        return out

    return map_batches(rows, CHUNKS, run)


def _read(batch: pa.RecordBatch, weights: dict[int, float]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sign numbers, labels and weights of each row of CHUNKS."""
    for signs, label, drawn, share in zip(*(batch.column(c) for c in ("signs", "label", "drawn", "share"))):
        y, n = (np.frombuffer(c.as_py(), np.float32) for c in (label, share))
        x = np.frombuffer(signs.as_py(), np.uint8).reshape(len(y), -1).astype(np.int64)
        own = np.where(y > 0, weights.get(1, 0.0), weights.get(0, 0.0))
        yield x, y, n * np.where(np.frombuffer(drawn.as_py(), bool), 1.0, own)


def summed_gradients(rows: DataFrame, params: list[np.ndarray], weights: dict[int, float]) -> list[np.ndarray]:
    """Gradients of the weighted loss over all rows of CHUNKS; a sum per task comes to the driver. Runs a job."""
    send_package(rows.sparkSession)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(sum(p.size for p in params), np.int64)
        for batch in it:
            for part in _read(batch, weights):
                grads = np.concatenate([g.ravel() for g in _gradients(params, *part)])
                total += np.round(grads.astype(np.float64) * WHOLE).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})

    total = np.zeros(sum(p.size for p in params), np.int64)
    for r in rows.select("signs", "label", "drawn", "share").mapInArrow(run, "sums binary").collect():
        total += np.frombuffer(r["sums"], np.int64)
    cuts = np.cumsum([p.size for p in params])[:-1]
    return [(g / WHOLE).reshape(p.shape).astype(np.float32) for g, p in zip(np.split(total, cuts), params)]


def train(found: DataFrame, recall: float = 0.98) -> Model:
    """Fit on all findings from `candidates` and on drawn ones; only sums come to the driver.

    Starts from a fit on the drawn ones and takes STEPS steps by the gradient over all pieces that
    are not held out. The held-out ones, counted by score, calibrate the model and set the limit. A finding
    weighs 1, however long; those of a label together, with and without surroundings, no more than twice
    the drawn ones. The same model every time. Runs jobs.
    """
    start = fit([], [], recall)
    rows = stored(chunks(pieces(found)), "pieces")
    sums = rows.agg(F.sum("n0"), F.sum("n1")).first()
    counts = {label: n / WHOLE for label, n in enumerate(sums) if n}
    if not counts:
        release(rows)
        return start
    weights = {label: min(1.0, 2 * DRAWN / n) for label, n in counts.items()}
    total = 2 * DRAWN + sum(weights[label] * n for label, n in counts.items())
    params = [start.taps, start.shift, start.dense, np.array([start.bias], np.float32)]
    adam, used = Adam(params, RATE), rows.filter("not held")
    for _ in range(STEPS):
        adam.step([g / total for g in summed_gradients(used, params, weights)])

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"label": [], "score": [], "weight": []}
        for x, y, weight in _read(batch, weights):
            out["label"] += y.astype(int).tolist()
            out["score"] += np.round(_score(*params[:3], params[3][0], x) * FINE).astype(int).tolist()
            out["weight"] += np.round(weight * WHOLE).astype(int).tolist()
        return out

    scored = map_batches(rows.filter("held"), "label int, score int, weight long", run)
    held = scored.groupBy("label", "score").agg(F.sum("weight").alias("weight")).orderBy("label", "score").collect()
    score, y, weight = (np.array([r[c] for r in held], np.float64) for c in ("score", "label", "weight"))
    release(rows)
    return calibrated(params, score / FINE, y, weight / WHOLE, recall)


def _spans(base, others, probable, limit) -> list[tuple[str, int, int]]:
    added = [("model", s, e) for (s, e), p in zip(others, probable) if p >= limit]
    return sorted([*base, *added], key=lambda x: (x[1], KINDS.index(x[0])))


def findings(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per row of `docs`: key, n_assign, n_access, n_hex, base_sha256, spans.

    Positions are code points, the end exclusive. A null or empty text has no spans
    and the digest of an empty list. Repeated rows and null keys stay. An empty table
    gives none. Texts are read once; candidates are stored, and the network
    scores all of them. Columns beside key and text are not read. Runs jobs.
    """
    found = stored(candidates(docs, key), "candidates")
    model = train(found)
    schema = docs.select(key).schema
    for name in ("n_assign", "n_access", "n_hex"):
        schema = schema.add(name, "long")
    schema = schema.add("base_sha256", "string").add("spans", "string").add("n_model", "long")

    def run(batch: pa.RecordBatch) -> dict:
        out = {c: [] for c in schema.names[1:]}
        bases, others = batch.column("base").to_pylist(), batch.column("others").to_pylist()
        windows = [(o["before"], o["value"], o["after"]) for row in others for o in row]
        probable, at = scores(model, windows), 0
        for base, row in zip(bases, others):
            own = [(b["kind"], b["start"], b["end"]) for b in base]
            spans = _spans(own, [(o["start"], o["end"]) for o in row], probable[at : at + len(row)], model.limit)
            at += len(row)
            for kind in KINDS[:3]:
                out[f"n_{kind}"].append(sum(k == kind for k, _, _ in own))
            out["base_sha256"].append(hashlib.sha256(written(own).encode()).hexdigest())
            out["spans"].append(written(spans))
            out["n_model"].append(len(spans) - len(own))
        return {key: batch.column(key)} | out

    return map_batches(found.drop("labelled"), schema, run)


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns of `docs`, with every found secret replaced by `mark`.

    Of an assignment the name stays and the value goes. Where a column n_chars exists
    it is the new length. Null texts stay null; a text without findings stays as it is.
    Texts are read twice, once to train. Runs jobs.
    """
    found = stored(candidates(docs, docs.columns[0]).drop("base"), "candidates")
    model = train(found)
    release(found)
    count = next((c for c in docs.columns if c.lower() == "n_chars"), None)

    def run(batch: pa.RecordBatch) -> dict:
        out = {c: batch.column(c) for c in batch.schema.names}
        texts = texts_of(batch)
        found = scan(texts)
        windows = [window(t, *o) for t, f in zip(texts, found) for o in f.others]
        probable, at, changed = scores(model, windows), 0, {}
        for i, (t, f) in enumerate(zip(texts, found)):
            mine = probable[at : at + len(f.others)]
            at += len(f.others)
            cut = _values(t, f.base) + [o for o, p in zip(f.others, mine) if p >= model.limit]
            if cut:
                changed[i] = _without(t, cut, mark)
        if changed:
            old = batch.column("text").to_pylist()
            out["text"] = pa.array([changed.get(i, t) for i, t in enumerate(old)], pa.string())
            if count:
                sizes = batch.column(count).to_pylist()
                kind = batch.schema.field(count).type
                out[count] = pa.array([len(changed[i]) if i in changed else n for i, n in enumerate(sizes)]).cast(kind)
        return out

    return map_batches(docs, docs.schema, run)


def _without(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    parts, at = [], 0
    for s, e in sorted(spans):
        if s >= at:
            parts += [text[at:s], mark]
        at = max(at, e)
    return "".join([*parts, text[at:]])
