"""Quality rules with adaptive limits per language and source.

Every text gets a few counts. Their ratios go into mergeable quantile sketches, one
per language, source and measure; a limit lies a few spreads outside the middle half of
its own group, so that a source of tables or of capital letters is held against itself.
"""

from __future__ import annotations

import math
import re
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockpolicy.functions.session import stored
from stockpolicy.llm.common import by_size, bytes_of, fresh, map_batches

# The base rule.
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
SYMBOLS = "#*$%&|<>"

COUNTS = "n_words word_chars n_symbols n_lines n_dup_lines n_repeat_words n_upper n_again".split()

# Ratio by measure: numerator, denominator; and the least distance that its limit keeps
# from the middle of the group, so that a uniform group does not reject harmless rows.
MEASURES = {
    "symbols": ("n_symbols", "n_words", 0.3),
    "upper": ("n_upper", "word_chars", 0.4),
    "again": ("n_again", "n_words", 0.2),
    "dup_lines": ("n_dup_lines", "n_lines", 0.5),
    "word_length": ("word_chars", "n_words", 4.0),
}
TWO_SIDED = ("word_length",)  # too low a value counts as well, by half the distance

# Sketch buckets grow by GAMMA, so a quantile is off by 1% at most.
ACCURACY = 0.01
GAMMA = (1 + ACCURACY) / (1 - ACCURACY)
ZERO = -100_000  # the bucket of zero
SPREADS = 4.0
# A group's quartiles count as many rows as it has, its language's as PRIOR rows more; those of
# the language are drawn to all rows' in the same way. So limits change smoothly with a group's size.
PRIOR = 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS.encode())] = True
_UPPER = np.zeros(256, bool)
_UPPER[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True


def _per_text(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return np.diff(total[np.concatenate([[0], ends])])


def repeated_words(words: list[bytes], counts: np.ndarray) -> np.ndarray:
    """Per text, its words that lie in a window of eight found twice or more in it.

    words: of all texts in a row; counts: words per text. Windows get exact ids by
    doubling: pairs of words, pairs of pairs, pairs of those.
    """
    n, ends = len(words), np.cumsum(counts)
    if n < WINDOW:
        return np.zeros(len(counts), np.int64)
    column = np.empty(n, object)
    column[:] = words
    ids = pd.factorize(column)[0].astype(np.int64)
    step = 1
    while step < WINDOW:
        ids = pd.factorize(ids[:-step] * (ids.max() + 1) + ids[step:])[0].astype(np.int64)
        step *= 2
    text = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(text[: n - WINDOW + 1] == text[WINDOW - 1 :])
    if not len(at):
        return np.zeros(len(counts), np.int64)
    key, uniques = pd.factorize(text[at] * (ids.max() + 1) + ids[at])
    twice = at[np.bincount(key, minlength=len(uniques))[key] > 1]
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + WINDOW, -1)
    return _per_text(np.cumsum(edge[:-1]) > 0, ends)


def text_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The counts of each UTF-8 text. An empty one has zeros."""
    parts: dict[str, list] = {c: [] for c in COUNTS}
    for part in by_size(texts):
        some = texts[part]
        ends = np.cumsum([len(t) for t in some])
        raw = np.frombuffer(b"".join(some), np.uint8)
        space = _SPACE[raw]
        parts["word_chars"].append(_per_text(((raw & 0xC0) != 0x80) & ~space, ends))
        parts["n_symbols"].append(_per_text(_SYMBOL[raw], ends))
        parts["n_upper"].append(_per_text(_UPPER[raw], ends))
        words, counts, again, lines, dups = [], [], [], [], []
        for t in some:
            own = t.split()
            words += own
            counts.append(len(own))
            again.append(sum(map(eq, own, own[1:])))  # words equal to the one before
            with_word = [x for x in t.split(b"\n") if x.strip()]
            lines.append(len(with_word))
            dups.append(len(with_word) - len(set(with_word)))
        parts["n_words"].append(counts)
        parts["n_again"].append(again)
        parts["n_lines"].append(lines)
        parts["n_dup_lines"].append(dups)
        parts["n_repeat_words"].append(repeated_words(words, np.array(counts, np.int64)))
    return {c: np.concatenate(x).astype(np.int64) for c, x in parts.items()}


def with_counts(docs: DataFrame, columns: list[str], names: dict[str, str]) -> DataFrame:
    """`columns` of docs and the counts, under `names`."""
    read = docs.select(*dict.fromkeys([*columns, "text"]))
    schema = T.StructType([docs.schema[c] for c in columns] + [T.StructField(names[c], T.LongType()) for c in COUNTS])

    def run(batch: pa.RecordBatch) -> dict:
        counts = text_counts(bytes_of(batch))
        return {c: batch.column(c) for c in columns} | {names[c]: counts[c] for c in COUNTS}

    return map_batches(read, schema, run)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def _ratio(measure: str, names: dict[str, str]) -> Column:
    over, under, _ = MEASURES[measure]
    return F.when(F.col(names[under]) > 0, F.col(names[over]) / F.col(names[under])).otherwise(0.0)


def sketches(counts: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): logarithmic buckets, merged by adding n.

    counts: lang, source and the count columns. Rows that the base rule rejects do
    not enter. Aggregated before the shuffle, so a hot source costs a few rows a task.
    """
    names = {c: c for c in COUNTS}
    each = ", ".join(f"'{m}', m_{m}" for m in MEASURES)
    rows = counts.filter(~base_failed(F.col("n_words"), F.col("n_repeat_words"))).select(
        "lang", "source", *(_ratio(m, names).alias(f"m_{m}") for m in MEASURES)
    )
    long = rows.selectExpr("lang", "source", f"stack({len(MEASURES)}, {each}) AS (measure, x)")
    bucket = F.when(F.col("x") > 0, F.ceil(F.log("x") / math.log(GAMMA))).otherwise(ZERO)
    return long.groupBy("lang", "source", "measure", bucket.cast("int").alias("bucket")).agg(
        F.count("*").alias("n")
    )


def _quartiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """q1, q2, q3 and rows per group; a group's window holds its buckets, a few thousand at most."""
    merged = sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*by, "measure")
    seen = F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    ranked = merged.select("*", seen.alias("seen"), F.sum("n").over(group).alias("total"))
    value = F.when(F.col("bucket") == ZERO, 0.0).otherwise(
        2 * F.pow(F.lit(GAMMA), F.col("bucket")) / (GAMMA + 1)
    )

    def quantile(q: float) -> Column:
        return F.min(F.when(F.col("seen") >= F.col("total") * q, value))

    return ranked.groupBy(*by, "measure").agg(
        *(quantile(q / 4).alias(f"q{q}") for q in (1, 2, 3)), F.max("total").alias("total")
    )


def limits(sketch: DataFrame) -> DataFrame:
    """(lang, source, low_<measure>, high_<measure>) of every group in the sketch.

    Quartiles of a group are drawn towards its language's, and these towards all rows', as far as
    PRIOR rows weigh against its own.
    """
    own = _quartiles(sketch, ["lang", "source"]).alias("s")
    lang = _quartiles(sketch, ["lang"]).alias("l")
    all_ = _quartiles(sketch, []).alias("a")
    joined = own.join(
        lang, F.col("s.lang").eqNullSafe(F.col("l.lang")) & (F.col("s.measure") == F.col("l.measure"))
    ).join(all_, F.col("s.measure") == F.col("a.measure"))

    def drawn(own: str, q: str, towards: Column) -> Column:
        n = F.col(f"{own}.total")
        return (n * F.col(f"{own}.{q}") + PRIOR * towards) / (n + PRIOR)

    def pick(q: str) -> Column:
        return drawn("s", q, drawn("l", q, F.col(f"a.{q}")))

    table = joined.select(
        F.col("s.lang").alias("lang"), F.col("s.source").alias("source"),
        F.col("s.measure").alias("measure"), *(pick(f"q{q}").alias(f"q{q}") for q in (1, 2, 3)),
    )
    sides = []
    for m, (_, _, least) in MEASURES.items():
        far = F.greatest(SPREADS * (F.col("q3") - F.col("q1")), F.lit(least))
        high = F.greatest(F.col("q3") + SPREADS * (F.col("q3") - F.col("q1")), F.col("q2") + least)
        sides.append(F.max(F.when(F.col("measure") == m, high)).alias(f"high_{m}"))
        if m in TWO_SIDED:
            sides.append(F.max(F.when(F.col("measure") == m, F.col("q2") - far / 2)).alias(f"low_{m}"))
    return table.groupBy("lang", "source").agg(*sides)


def _verdict(names: dict[str, str], edge) -> Column:
    """Kept or not. A group all of whose rows fail the base rule has no limits, and needs none."""
    failed = base_failed(F.col(names["n_words"]), F.col(names["n_repeat_words"]))
    outside = F.lit(False)
    for m in MEASURES:
        outside = outside | F.coalesce(_ratio(m, names) > edge(f"high_{m}"), F.lit(False))
        if m in TWO_SIDED:
            outside = outside | F.coalesce(_ratio(m, names) < edge(f"low_{m}"), F.lit(False))
    return ~(failed | outside)


def _same_group(a: DataFrame, b: DataFrame) -> Column:
    return a["lang"].eqNullSafe(b["lang"]) & a["source"].eqNullSafe(b["source"])


def judge(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, the counts, base_failed, kept.

    Reads doc_id, text, lang, source. A null or empty text has zero counts and fails
    the base rule; a null language or source is a group of its own. Repeated rows stay.
    An empty table gives none. Texts are read once; the counts are stored. Runs jobs.
    """
    names = {c: c for c in COUNTS}
    counts = stored(with_counts(docs, ["doc_id", "lang", "source"], names), "counts")
    table = stored(limits(sketches(counts)), "limits")
    judged = counts.join(table, _same_group(counts, table), "left")
    return judged.select(
        "doc_id",
        *COUNTS,
        base_failed(F.col("n_words"), F.col("n_repeat_words")).alias("base_failed"),
        _verdict(names, F.col).alias("kept"),
    )


def apply_rules(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that the rules keep, with all their columns.

    As `judge`. Texts are read twice, which costs less than moving them to the verdicts:
    no text is shuffled. Runs jobs.
    """
    names = {c: c for c in COUNTS}
    counts = with_counts(docs, ["lang", "source"], names)
    small = limits(sketches(counts))
    edges = [c for c in small.columns if c not in ("lang", "source")]
    taken = list(docs.columns)
    renamed = {}
    for c in [*COUNTS, "lang", "source", *edges]:
        renamed[c] = fresh(f"rule_{c}", taken)
        taken.append(renamed[c])
    table = stored(small, "limits").withColumnsRenamed({c: renamed[c] for c in small.columns})
    own = {c: renamed[c] for c in COUNTS}
    counted = with_counts(docs, docs.columns, own)
    same = counted["lang"].eqNullSafe(F.col(renamed["lang"])) & counted["source"].eqNullSafe(
        F.col(renamed["source"])
    )
    judged = counted.join(table, same, "left")
    kept = judged.filter(_verdict(own, lambda edge: F.col(renamed[edge])))
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns))


def oracle() -> str:
    """The same verdicts in DuckDB SQL."""
    symbols = "[" + re.escape(SYMBOLS).replace("\\#", "#").replace("\\&", "&").replace("\\<", "<").replace("\\>", ">") + "]"
    ratio = {m: f"CASE WHEN {u} > 0 THEN {o}::DOUBLE / {u} ELSE 0 END" for m, (o, u, _) in MEASURES.items()}
    longs = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS measure, {r} AS x FROM good" for m, r in ratio.items())

    def quartiles(name: str, by: str) -> str:
        comma = by and by + ", "
        qs = ", ".join(
            f"min(CASE WHEN seen >= total * {q / 4} THEN CASE WHEN bucket = {ZERO} THEN 0.0 "
            f"ELSE 2 * pow({GAMMA!r}::DOUBLE, bucket) / {GAMMA + 1!r}::DOUBLE END END) AS q{q}"
            for q in (1, 2, 3)
        )
        return f"""{name} AS (SELECT {comma}measure, {qs}, max(total) AS total FROM (
          SELECT *, sum(n) OVER (PARTITION BY {comma}measure ORDER BY bucket
                                 ROWS UNBOUNDED PRECEDING) AS seen,
                 sum(n) OVER (PARTITION BY {comma}measure) AS total
          FROM (SELECT {comma}measure, bucket, sum(n) AS n FROM sketch GROUP BY {comma}measure, bucket))
          GROUP BY {comma}measure)"""

    pick = ", ".join(
        f"(s.total * s.q{q} + {PRIOR} * ((l.total * l.q{q} + {PRIOR} * a.q{q}) / (l.total + {PRIOR})))"
        f" / (s.total + {PRIOR}) AS q{q}"
        for q in (1, 2, 3)
    )
    sides, outside = [], []
    for m, (_, _, least) in MEASURES.items():
        sides.append(f"max(CASE WHEN measure = '{m}' THEN greatest(q3 + {SPREADS} * (q3 - q1), q2 + {least}) END) AS high_{m}")
        outside.append(f"coalesce({ratio[m]} > high_{m}, false)")
        if m in TWO_SIDED:
            sides.append(f"max(CASE WHEN measure = '{m}' THEN q2 - greatest({SPREADS} * (q3 - q1), {least}) / 2 END) AS low_{m}")
            outside.append(f"coalesce({ratio[m]} < low_{m}, false)")
    failed = f"(n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)"
    return rf"""
    WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text,
                      regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    grams AS (SELECT doc_id, i, list_aggregate(w[i:i + {WINDOW - 1}], 'string_agg', ' ') AS g
              FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d WHERE len(w) >= {WINDOW})),
    twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
    rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
            FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS p FROM twice) GROUP BY doc_id),
    lines AS (SELECT doc_id, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines FROM (
              SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d)),
    again AS (SELECT doc_id, count(*) AS n_again FROM (SELECT doc_id, unnest(w[2:]) AS a, unnest(w[:-2]) AS b FROM d) WHERE a = b GROUP BY doc_id),
    counts AS (SELECT d.doc_id, lang, source, len(w)::BIGINT AS n_words,
                 length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
                 (length(text) - length(regexp_replace(text, '{symbols}', '', 'g')))::BIGINT AS n_symbols,
                 n_lines::BIGINT AS n_lines, n_dup_lines::BIGINT AS n_dup_lines,
                 coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
                 (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')))::BIGINT AS n_upper,
                 coalesce(n_again, 0)::BIGINT AS n_again
               FROM d JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN again USING (doc_id)),
    good AS (SELECT * FROM counts WHERE NOT {failed}),
    sketch AS (SELECT lang, source, measure,
                 CASE WHEN x > 0 THEN ceil(ln(x) / {math.log(GAMMA)!r}::DOUBLE)::INT ELSE {ZERO} END AS bucket, count(*) AS n
               FROM ({longs}) GROUP BY ALL),
    {quartiles("s", "lang, source")}, {quartiles("l", "lang")}, {quartiles("a", "")},
    edges AS (SELECT lang, source, {", ".join(sides)} FROM (
                SELECT s.lang, s.source, s.measure, {pick}
                FROM s JOIN l ON s.lang IS NOT DISTINCT FROM l.lang AND s.measure = l.measure
                       JOIN a ON s.measure = a.measure) GROUP BY lang, source)
    SELECT doc_id, {", ".join(COUNTS)}, {failed} AS base_failed,
           NOT ({failed} OR {" OR ".join(outside)}) AS kept
    FROM counts c LEFT JOIN edges e
      ON c.lang IS NOT DISTINCT FROM e.lang AND c.source IS NOT DISTINCT FROM e.source
    """
