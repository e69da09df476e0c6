"""Mixing sources to target weights, in blocks.

The words of each source lie in one row, cut into blocks of a fixed length. Output
shards draw how many blocks of each source they hold; a source's slots, counted
through all shards, map to its blocks by a pseudorandom permutation per pass, so any
slot finds its block without a global shuffle.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockpolicy.functions.session import stored
from stockpolicy.llm.common import WORD, fresh, map_batches

WEIGHTS = (3, 1, 2)
SHARE, STOP = 1.5, 2  # of all sizes, and of a source's own
BLOCK = 128  # words
SHARD_BLOCKS = 4096
ROWS_PER_BUCKET = 4_000
ROUNDS = 6


def sizes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, source, row_hash, size) of every row: size is its number of words, 0 for a null text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        key,
        "source",
        F.xxhash64(F.col(key), whole).alias("row_hash"),
        F.regexp_count(whole, F.lit(WORD)).cast("long").alias("size"),
    )


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, stop: float = STOP) -> DataFrame:
    """(source, source_size, target) of each source; null is a source, the last one.

    Weights go round by code point order. A source's target stops at `stop` times its
    size; what is over goes to the others by weight, until none is above. In order
    of stop over weight a source is stopped exactly if it is so when all before
    it are, which one ordered pass finds. One row per source, no other rows.
    """
    each = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    given = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), F.pmod(turn, F.lit(len(weights))) + 1)
    most = F.col("source_size") * float(stop)
    rows = each.withColumn("weight", given).withColumn("most", most)
    order = Window.orderBy(F.col("most") / F.col("weight"), F.asc_nulls_last("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    all_ = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(all_) * float(share) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    ) / F.sum("weight").over(after)
    rows = rows.withColumn("level", level)
    stopped = F.col("most") <= F.col("weight") * F.col("level")
    last = F.max(F.when(~stopped, F.col("level"))).over(all_)
    target = F.when(stopped, F.col("most")).otherwise(F.col("weight") * last)
    return rows.select("source", "source_size", target.alias("target"))


def placed(sized: DataFrame) -> DataFrame:
    """Every row of `sized` with `start`, its first word's place among its source's words.

    Sums go by bucket of the row hash, so a hot source is spread over many tasks; a
    bucket holds about ROWS_PER_BUCKET rows whatever the source. Runs a count.
    """
    buckets = max(1, math.ceil(sized.count() / ROWS_PER_BUCKET))
    rows = sized.withColumn("bucket", F.pmod("row_hash", F.lit(buckets)))
    own = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = own.select(
        F.col("source").alias("s"), F.col("bucket").alias("b"),
        F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"),
    )
    inside = (
        Window.partitionBy("source", "bucket")
        .orderBy("row_hash", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    running = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    same = running["source"].eqNullSafe(F.col("s")) & (running["bucket"] == F.col("b"))
    return running.join(offsets, same).select(
        *sized.columns, (F.col("offset") + F.col("inside")).alias("start")
    )


def permuted(index: np.ndarray, n: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """Place of each index under a pseudorandom permutation of 0..n-1, one for each (n, seed).

    A Feistel network over the next even power of two; values of n and more go round again.
    """
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    limit, seed = n.astype(np.uint64), seed.astype(np.uint64)
    with np.errstate(over="ignore"):
        while len(todo):
            x, m, h, s = out[todo], mask[todo], half[todo], seed[todo]
            left, right = x >> h, x & m
            for r in range(ROUNDS):
                v = (right + s * np.uint64(2 * r + 1)) * np.uint64(0x9E3779B97F4A7C15)
                v ^= v >> np.uint64(29)
                v *= np.uint64(0xBF58476D1CE4E5B9)
                v ^= v >> np.uint64(32)
                left, right = right, left ^ (v & m)
            out[todo] = (left << h) | right
            todo = todo[out[todo] >= limit[todo]]
    return out.astype(np.int64)


def shard_counts(plan: DataFrame, seed: int, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """(source, shard, n): how many slots of each source each output shard draws, if any.

    plan: source, slots. A shard's counts are one multinomial draw by the sources'
    shares of all slots, seeded by the shard's number, so shards are independent and
    reruns agree. The last shard is as large as what is left, so all slots are drawn however few
    they are. Draws miss a source's total by chance; `slots_of` settles that.
    The list of sources, one row each, comes to the driver and goes to every task: about
    50 bytes a source, so a million sources are 50 MB.
    """
    rows = plan.select("source", "slots").collect()
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    total = sum(r["slots"] for r in rows)
    spark = plan.sparkSession
    names, shares = [r["source"] for r in rows], np.array([r["slots"] / max(1, total) for r in rows])
    shards = -(-total // shard_blocks)
    schema = T.StructType(
        [plan.schema["source"], T.StructField("shard", T.LongType()), T.StructField("n", T.LongType())]
    )

    def run(batch: pa.RecordBatch) -> dict:
        ids = batch.column("id").to_numpy()
        source, shard, n = [], [], []
        for i in ids.tolist():
            drawn = np.random.default_rng([seed, i]).multinomial(min(shard_blocks, total - i * shard_blocks), shares)
            some = np.flatnonzero(drawn)
            source += [names[s] for s in some]
            shard += [i] * len(some)
            n += drawn[some].tolist()
        return {"source": source, "shard": shard, "n": n}

    return map_batches(spark.range(shards), schema, run)


def slots_of(plan: DataFrame, seed: int, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """(source, shard, slot): slots 0..slots-1 of every source, each in a shard.

    Drawn beyond a source's total: left out. Not drawn: put into closing shards.
    """
    drawn = shard_counts(plan, seed, shard_blocks)
    upto = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    counted = drawn.select("source", "shard", F.sum("n").over(upto).alias("stop"), "n")
    ends = plan.select(F.col("source").alias("s"), "slots")
    same = F.col("source").eqNullSafe(F.col("s"))
    inside = counted.join(ends, same).select(
        "source", "shard", (F.col("stop") - F.col("n")).alias("first"), F.least("stop", "slots").alias("stop")
    )
    seen = drawn.groupBy(F.col("source").alias("s")).agg(F.sum("n").alias("seen"))
    rest = plan.join(seen, plan["source"].eqNullSafe(F.col("s")), "left").select(
        "source", F.lit(-1).cast("long").alias("shard"), F.coalesce("seen", F.lit(0)).alias("first"), F.col("slots").alias("stop")
    )
    # A row of a thousand slots at most, so that no task expands a whole source.
    ranges = inside.unionByName(rest).filter("first < stop")
    parts = ranges.select(
        "source", "shard", "stop", F.explode(F.expr("sequence(first, stop - 1, 1000L)")).alias("first")
    ).repartition("source", "first")
    return parts.select(
        "source", "shard", F.explode(F.expr("sequence(first, least(first + 1000, stop) - 1)")).alias("slot")
    ).withColumn("shard", F.when(F.col("shard") < 0, -1 - F.floor(F.col("slot") / shard_blocks)).otherwise(F.col("shard")))


def planned(target: DataFrame, block: int = BLOCK) -> DataFrame:
    """targets with whole blocks, tail, full passes, words of the last pass, and slots."""
    size, want = F.col("source_size"), F.floor("target")
    rows = target.select(
        "*", F.floor(size / block).alias("blocks"), (size % block).alias("tail"),
        F.when(size > 0, F.floor(want / size)).otherwise(F.lit(0)).alias("passes"),
        F.when(size > 0, want % size).otherwise(F.lit(0)).alias("rest"),
    )
    per_pass = F.col("blocks") + F.when(F.col("tail") > 0, 1).otherwise(0)
    return rows.withColumn("slots", F.col("passes") * per_pass + F.ceil(F.col("rest") / block))


def mixture(located: DataFrame, plan: DataFrame, block: int = BLOCK, seed: int = 17, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """(source, shard, slot, pass, block, words): which block fills each slot, and its words taken.

    The tail block, shorter than the rest, comes last in each pass; so full passes take
    every word once, and the last slot of the last pass takes what is still missing.
    """
    slots = slots_of(plan, seed, shard_blocks)
    own = plan.select(F.col("source").alias("s"), "blocks", "tail", "passes", "rest", "source_size")
    rows = slots.join(own, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    per_pass = F.col("blocks") + F.when(F.col("tail") > 0, 1).otherwise(0)
    rows = rows.withColumn("pass", F.floor(F.col("slot") / per_pass)).withColumn("at", F.col("slot") % per_pass)
    rows = rows.withColumn("salt", F.xxhash64(F.coalesce("source", F.lit("")), "pass", F.lit(seed)))
    schema = T.StructType([*rows.schema.fields, T.StructField("block", T.LongType())])

    def run(batch: pa.RecordBatch) -> dict:
        own = {c: batch.column(c) for c in batch.schema.names}
        at, n = own["at"].to_numpy(), own["blocks"].to_numpy()
        index = at.copy()
        whole = at < n
        index[whole] = permuted(at[whole], n[whole], own["salt"].to_numpy()[whole].view(np.uint64))
        return own | {"block": index}

    full = F.when(F.col("block") < F.col("blocks"), F.lit(block)).otherwise(F.col("tail"))
    left = F.col("rest") - F.col("at") * block
    words = F.when(F.col("pass") < F.col("passes"), full).otherwise(F.least(full, left))
    return map_batches(rows, schema, run).select("source", "shard", "slot", "pass", "block", words.cast("long").alias("words"))


def _pieces(rows: DataFrame, block: int) -> DataFrame:
    """Each row once per block it touches: block, and its words there as [low, high) of the source."""
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    cut = rows.filter("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
    return cut.withColumn("low", F.greatest("start", F.col("block") * block)).withColumn(
        "high", F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block)
    )


def taken_pieces(rows: DataFrame, mixed: DataFrame, block: int = BLOCK) -> DataFrame:
    """Pieces of rows that the mixture takes, with pass, shard, slot; [low, high) counts words in the row."""
    pieces = _pieces(rows, block)
    chosen = mixed.select(F.col("source").alias("s"), F.col("block").alias("b"), "pass", "shard", "slot", "words")
    joined = pieces.join(chosen, pieces["source"].eqNullSafe(F.col("s")) & (pieces["block"] == F.col("b")))
    high = F.least(F.col("high"), F.col("block") * block + F.col("words"))
    out = joined.withColumn("high", high).filter("high > low")
    return out.withColumn("low", F.col("low") - F.col("start")).withColumn("high", F.col("high") - F.col("start")).drop("s", "b")


def mix(docs: DataFrame, key: str = "doc_id", block: int = BLOCK, seed: int = 17, shard_blocks: int = SHARD_BLOCKS):
    """(rows, plan, mixture) of `docs`: stored rows with sizes and places, the plan per source, the slots.

    Reads key, source and text. A null text has no words; a null source is a source,
    the last one. Repeated rows count each. An empty table has no sources and no slots.
    Runs jobs.
    """
    sized = stored(sizes(docs, key), "sizes")
    rows = stored(placed(sized), "places")
    plan = stored(planned(targets(sized), block), "plan")
    return rows, plan, mixture(rows, plan, block, seed, shard_blocks)


def taken(docs: DataFrame, key: str = "doc_id", block: int = BLOCK, seed: int = 17, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """One row per row of `docs`: key, size, source_size, target, taken (words in the mix). See `mix`."""
    rows, plan, mixed = mix(docs, key, block, seed, shard_blocks)
    # Rows are told apart by source and place; rows without words share places and take nothing.
    got = taken_pieces(rows, mixed, block).groupBy("source", "start").agg(F.sum(F.col("high") - F.col("low")).alias("got"))
    got = got.select(F.col("source").alias("gs"), F.col("start").alias("gp"), "got")
    own = plan.select(F.col("source").alias("ps"), "source_size", "target")
    out = rows.join(own, F.col("source").eqNullSafe(F.col("ps"))).join(
        got, F.col("source").eqNullSafe(F.col("gs")) & (F.col("start") == F.col("gp")) & (F.col("size") > 0), "left"
    )
    return out.select(key, "size", "source_size", "target", F.coalesce("got", F.lit(0)).cast("long").alias("taken"))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def cut_words(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The words of `spans` (pass, low, high), each pass in text order, runs joined by a line break.

    A run keeps the white space between its words; a pass that takes every word is the whole text.
    """
    raw = text.encode("utf-8", "surrogatepass")
    word = ~_SPACE[np.frombuffer(raw, np.uint8)]
    edge = np.diff(np.concatenate([[0], word.astype(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    runs: list[list[int]] = []
    for p, low, high in sorted(spans):
        if runs and runs[-1][0] == p and runs[-1][2] == low:
            runs[-1][2] = high
        else:
            runs.append([p, low, high])
    out = [
        raw if low == 0 and high == len(starts) else raw[starts[low] : ends[high - 1]]
        for _, low, high in runs
    ]
    return b"\n".join(out).decode("utf-8", "surrogatepass")


def mixed_documents(docs: DataFrame, key: str = "doc_id", block: int = BLOCK, seed: int = 17) -> DataFrame:
    """The mixture as documents: each row of `docs` with the words that the mix takes of it.

    All columns are kept; text holds the taken words, twice where they are taken twice,
    and n_chars, if there, the new length. Rows of which nothing is taken, and so
    rows without words, are not in the mix. Rows that repeat key and text are cut
    separately but share their other columns. Runs jobs.
    """
    rows, _, mixed = mix(docs, key, block, seed)
    cut = taken_pieces(rows, mixed, block)
    spans = cut.groupBy("row_hash", "source", "start").agg(
        F.collect_list(F.struct("pass", "low", "high")).alias("spans")
    )
    h, s, o, p = (fresh(n, docs.columns) for n in ("h", "spans", "src", "at"))
    spans = spans.select(F.col("row_hash").alias(h), F.col("source").alias(o), F.col("start").alias(p), F.col("spans").alias(s))
    own: Column = F.xxhash64(F.col(key), F.coalesce(F.col("text"), F.lit("")))
    hashed = docs.withColumn(f"{h}_", own)
    if rows.filter("size > 0").groupBy("row_hash", "source").count().filter("count > 1").limit(1).count():
        hashed = hashed.dropDuplicates([f"{h}_", "source"])
    joined = hashed.join(spans, (F.col(f"{h}_") == F.col(h)) & hashed["source"].eqNullSafe(F.col(o)))
    joined = joined.select(*(hashed[c] for c in docs.columns), s)
    count = next((c for c in docs.columns if c.lower() == "n_chars"), None)

    def run(batch: pa.RecordBatch) -> dict:
        out = {c: batch.column(c) for c in docs_columns}
        lists = batch.column(s).to_pylist()
        texts = [
            cut_words(t, [(x["pass"], x["low"], x["high"]) for x in xs])
            for t, xs in zip(out["text"].to_pylist(), lists)
        ]
        out["text"] = pa.array(texts, pa.string())
        if count:
            out[count] = pa.array(list(map(len, texts))).cast(batch.schema.field(count).type)
        return out

    docs_columns = docs.columns
    return map_batches(joined, docs.schema, run)


def oracle() -> str:
    """Sizes and targets in DuckDB SQL; `taken` follows a pseudorandom permutation and is left out."""
    weights = ", ".join(map(str, WEIGHTS))
    return rf"""
    WITH d AS (SELECT doc_id, source,
                      len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
    w AS (SELECT *, {float(STOP)} * source_size AS most,
            [{weights}][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} + 1)::INT]::DOUBLE AS weight FROM s),
    l AS (SELECT *, ((SELECT sum(source_size) FROM s) * {SHARE} - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
          FROM w WINDOW o AS (ORDER BY most / weight, source NULLS LAST)),
    t AS (SELECT source, source_size, CASE WHEN most <= weight * level THEN most
            ELSE weight * max(CASE WHEN most > weight * level THEN level END) OVER () END AS target FROM l)
    SELECT doc_id, size, source_size, target FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
    """
