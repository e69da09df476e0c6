"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint has one bit per bit position of the shingle hashes, set where more
than half of them have it. Two fingerprints within `radius` bits, cut into
radius // 2 + 1 segments, have a segment in which they differ by at most one bit.
So each segment is indexed under every one-bit wildcard, and fingerprints with an
equal variant are compared. Everything runs on distinct fingerprints: copies fall
together before any join.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpolicy.functions.session import stored
from stockpolicy.llm.common import bytes_of, fresh, map_batches
from stockpolicy.llm.components import components

BITS = 64
SEED = 42
FPS_PER_TASK = 10_000  # distinct fingerprints whose variants one task makes
CHUNK = 1 << 16  # shingles voted on at a time, which bounds memory for long texts


def simhash(text: bytes, shingle: int) -> int:
    """Fingerprint of one UTF-8 text, A-Z in lower case, words cut at ASCII white space.

    Fewer words than a shingle make one shingle; no words give zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths)
    starts = (ends - lengths)[:n]
    stops = ends[min(shingle, len(words)) - 1 :] - 1
    digest, votes = xxhash.xxh64_digest, np.zeros(BITS, np.int64)
    for at in range(0, n, CHUNK):
        spans = zip(starts[at : at + CHUNK].tolist(), stops[at : at + CHUNK].tolist())
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in spans])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(0, dtype=np.uint32)
    return int.from_bytes(np.packbits(votes * 2 > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = 5, key: str = "doc_id") -> DataFrame:
    """(key, text_hash, fp) of every row. A null text counts as empty: fingerprint zero."""
    read = docs.select(key, "text", _text_hash().alias("text_hash"))
    schema = read.drop("text").schema.add("fp", "long")

    def run(batch: pa.RecordBatch) -> dict:
        values = [simhash(t, shingle) for t in bytes_of(batch)]
        kept = {c: batch.column(c) for c in (key, "text_hash")}
        return kept | {"fp": pa.array(values, pa.int64())}

    return map_batches(read, schema, run)


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def _cuts(radius: int) -> list[tuple[int, int]]:
    """(first bit, width) of the segments; two at least, which only tightens the index."""
    n = max(2, radius // 2 + 1)
    edges = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def _masks(radius: int):
    """SQL array by bit: the segment of the bit without the bit itself."""
    masks = []
    for first, width in _cuts(radius):
        segment = ((1 << width) - 1) << first
        masks += [_signed(segment & ~(1 << i)) for i in range(first, first + width)]
    return F.array(*(F.lit(m).cast("long") for m in masks))


def _distance(a, b):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _one_of(diff, radius: int):
    """The variant under which a pair counts: the first segment that differs by one bit at most.

    A pair meets under many variants; taking it under one keeps each link once.
    """
    chosen = None
    for first, width in reversed(_cuts(radius)):
        part = F.shiftrightunsigned(diff, first).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        bit = F.when(part == 0, F.lit(first)).when(
            F.bit_count(part) == 1,
            F.lit(first) + F.bit_count(part - F.lit(1).cast("long")),
        )
        chosen = bit if chosen is None else F.coalesce(bit, chosen)
    return chosen


def variants(fps: DataFrame, radius: int) -> DataFrame:
    """(wild, value, fp): each distinct fingerprint under each one-bit wildcard of each segment."""
    bits = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("wild"))
    mask = F.element_at(_masks(radius), F.col("wild") + 1)
    return bits.select("wild", F.col("fp").bitwiseAND(mask).alias("value"), "fp")


def links(fps: DataFrame, radius: int, crowded: int = 256) -> DataFrame:
    """(a, b) with a < b: links that join all fingerprints within `radius` bits.

    fps: distinct fingerprints, column fp. Variants held by up to `crowded`
    fingerprints are compared pair by pair, and every pair within the radius comes
    out once. For more, with a radius of 2, pairs would grow with the square: there the
    fingerprints are indexed once more under two-bit wildcards. Those that share
    such a key lie within 2 bits of one another, so a star to the smallest one
    joins them all, exactly and in proportion to the fingerprints. With another
    radius crowded variants are compared pair by pair as well. Runs a job.
    """
    # Dealt by their number: each becomes 64 rows, so few and small partitions would make large ones.
    tasks = max(1, math.ceil(fps.count() / FPS_PER_TASK))
    every = variants(fps.repartition(tasks), radius)
    counts = every.groupBy("wild", "value").agg(F.count("*").alias("n")).filter("n > 1")
    shared = stored(every.join(counts, ["wild", "value"]), "variants")
    two = radius == 2
    few = shared.filter(F.col("n") <= crowded) if two else shared
    left = few.select("wild", "value", F.col("fp").alias("a"))
    right = few.select("wild", "value", F.col("fp").alias("b"))
    near = (F.col("a") < F.col("b")) & (_distance("a", "b") <= radius)
    # A pair whose chosen variant is crowded is missing here; the stars join it.
    once = F.col("wild") == _one_of(F.col("a").bitwiseXOR(F.col("b")), radius)
    pairs = left.join(right, ["wild", "value"]).filter(near & once).select("a", "b")
    return pairs.unionByName(_stars(shared.filter(F.col("n") > crowded), radius)) if two else pairs


def _stars(crowd: DataFrame, radius: int) -> DataFrame:
    """Links among fingerprints of crowded variants, through two-bit wildcards.

    Members of a variant (wild bit w of segment S) that lie within two bits differ
    in w and one bit outside S, or in two bits outside S, or in fewer.
    """
    spans = [range(first, first + width) for first, width in _cuts(radius)]
    held = crowd.select("fp", "wild", *(F.col("wild").between(x[0], x[-1]).alias(f"in{s}") for s, x in enumerate(spans)))

    def long_array(values) -> Column:
        return F.array(*(F.lit(_signed(v)).cast("long") for v in values))

    keyed = None
    for s, span in enumerate(spans):
        free = [b for b in range(BITS) if b not in span]
        own = held.filter(f"in{s}")
        single = own.select("fp", "wild", F.explode(long_array(1 << b for b in free)).alias("bit"))
        with_wild = single.select("fp", F.expr("bit | shiftleft(1L, wild)").alias("mask"))
        pairs = [1 << b | 1 << c for b in free for c in free if b < c]
        without = own.select("fp").distinct().select("fp", F.explode(long_array(pairs)).alias("mask"))
        both = with_wild.unionByName(without)
        keyed = both if keyed is None else keyed.unionByName(both)
    keyed = keyed.distinct().select("mask", F.expr("fp & ~mask").alias("value"), "fp")
    heads = keyed.groupBy("mask", "value").agg(F.min("fp").alias("a"), F.count("*").alias("n"))
    stars = keyed.join(heads.filter("n > 1"), ["mask", "value"]).filter("a < fp")
    return stars.select("a", F.col("fp").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = 5, radius: int = 3, key: str = "doc_id", crowded: int = 256
) -> DataFrame:
    """One row per row of `docs`: (key, text_hash, fp, component, component_id).

    Rows whose fingerprints differ by at most `radius` bits are linked, and linked
    rows share the smallest key reachable. Copies have one fingerprint. Empty and
    null texts have fingerprint zero and are linked like any other. Repeated keys
    stay repeated rows; a null key gets a component like any row, and a component
    of null keys alone has a null id. An empty table gives none. Only the key and
    the column text are read, so other columns cannot clash. Runs jobs.
    """
    marked = stored(fingerprints(docs, shingle, key), "fingerprints")
    nodes = stored(marked.groupBy("fp").agg(F.min(key).alias("first")), "nodes")
    found = stored(links(nodes.select("fp"), radius, crowded), "links")
    member = components(found)  # (node, component): fingerprints that have a link
    nodes = nodes.join(member.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("component"), "first"
    )
    least = nodes.groupBy("component").agg(F.min("first").alias("component_id"))
    by_fp = nodes.join(least, "component").select("fp", "component", "component_id")
    return marked.join(by_fp, "fp").select(key, "text_hash", "fp", "component", "component_id")


def hexadecimal(fp):
    """The fingerprint as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def drop_near_duplicates(
    docs: DataFrame, shingle: int = 5, radius: int = 3, key: str = "doc_id"
) -> DataFrame:
    """The rows of `docs` that are first in their component, with all their columns.

    First is the smallest key, then the smallest text hash; null keys come last. Of
    rows that repeat both key and text, one stays. Runs jobs.
    """
    groups = stored(near_duplicates(docs, shingle, radius, key), "groups")
    order = F.struct(F.col(key).isNull(), F.col(key), "text_hash")
    first = groups.groupBy("component").agg(F.min(order).alias("o"))
    k, h = fresh("key", docs.columns), fresh("hash", docs.columns)
    heads = first.select(F.col(f"o.{key}").alias(k), F.col("o.text_hash").alias(h))
    same = docs[key].eqNullSafe(F.col(k)) & (_text_hash() == F.col(h))
    kept = docs.join(heads, same)
    repeats = groups.join(heads, groups[key].eqNullSafe(F.col(k)) & (groups["text_hash"] == F.col(h)))
    if repeats.groupBy(k, h).count().filter("count > 1").limit(1).count():
        n = fresh("n", docs.columns)
        rank = Window.partitionBy(k, h).orderBy(h)
        kept = kept.withColumn(n, F.row_number().over(rank)).filter(F.col(n) == 1).drop(n)
    return kept.drop(k, h)
