"""Document fingerprints: weighted SimHash, and search by permuted block tables.

Built-in functions only. A term is a pair of neighbouring words, weighted by its length.
Each term's 64-bit hash votes with its weight for or against every bit; the votes of two
bits share one 64-bit sum, so a term costs 32 additions in generated code.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpolicy.functions.session import stored

BITS = 64
SPACE = " \t\n\x0b\f\r"
CUT = r"[\x20\x09-\x0D]+"
LANES = 0x0000000100000001  # the lowest bit of both halves
HEAVIEST = 32  # a term's weight is its length up to this; 2^26 terms fit a half


def _terms(text: Column) -> Column:
    """Array of (word, next word); the last word has no next one. No words: empty."""
    bare = F.btrim(text, F.lit(SPACE))
    words = F.split(bare, CUT)
    pairs = F.arrays_zip(words.alias("a"), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(1))).alias("b"))
    return F.when(bare != "", pairs)


def votes(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, fingerprint long) of every row whose text has words.

    Rows laid out by `keys` already are not moved again. A bit is 1 if more than half of
    the weight has it.
    """
    terms = rows.select(*keys, F.explode(_terms(F.col(text))).alias("t"))
    a, b = F.col("t").getField("a"), F.col("t").getField("b")
    weight = F.least(F.char_length(a) + F.coalesce(F.char_length(b), F.lit(0)), F.lit(HEAVIEST)).cast("long")
    hashed = terms.select(*keys, F.xxhash64(a, b).alias("h"), weight.alias("w"))
    lanes = [
        F.sum(F.col("w") * F.shiftrightunsigned("h", k).bitwiseAND(F.lit(LANES))).alias(f"v{k}")
        for k in range(BITS // 2)
    ]
    summed = hashed.groupBy(*keys).agg(F.sum("w").alias("all"), *lanes)
    low = [F.col(f"v{k}").bitwiseAND(F.lit(0xFFFFFFFF)) for k in range(BITS // 2)]
    high = [F.shiftrightunsigned(f"v{k}", 32) for k in range(BITS // 2)]
    bits = [
        F.when(votes * 2 > F.col("all"), F.lit(1 << k if k < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long"))
        for k, votes in enumerate(low + high)
    ]
    return summed.select(*keys, reduce(Column.bitwiseOR, bits).alias("fingerprint"))


def fingerprints(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, fingerprint) of every row; null and empty texts, and those without words, have 0.

    Repeated keys are an error: give a column that tells rows apart.
    """
    got = votes(docs.select(key, "text"), [key], "text")
    named = got.select(F.col(key).alias("_k"), "fingerprint")
    joined = docs.select(key).join(named, F.col(key).eqNullSafe(F.col("_k")), "left")
    return joined.select(key, F.coalesce("fingerprint", F.lit(0).cast("long")).alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits, 0 to 1."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


# Search ----------------------------------------------------------------------


def tables(radius: int, blocks: int | None = None) -> list[int]:
    """Masks of the permuted tables: every choice of `blocks - radius` blocks that agree.

    Two fingerprints within the radius spoil that many blocks at most, so they agree on
    the rest, which is one of the choices.
    """
    n = blocks or 2 * radius
    edges = [BITS * i // n for i in range(n + 1)]
    spans = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [sum(c) for c in combinations(spans, n - radius)]
    return [m - (1 << BITS) if m >= 1 << 63 else m for m in masks]


def _tabled(rows: DataFrame, masks: list[int], fingerprint: str) -> DataFrame:
    mask = F.element_at(F.array(*(F.lit(m).cast("long") for m in masks)), F.col("table") + 1)
    numbered = rows.withColumn("table", F.explode(F.sequence(F.lit(0), F.lit(len(masks) - 1))))
    return numbered.withColumn("masked", F.col(fingerprint).bitwiseAND(mask))


def within(queries: DataFrame, index: DataFrame, radius: int = 3) -> DataFrame:
    """(q, f, distance): all pairs of distinct fingerprints within `radius` bits, each once.

    queries: column q; index: column f; both without repeats. Keys are
    about half of the bits, so a key is shared by chance only at billions of rows. A pair
    that agrees in several tables counts in the first.
    """
    masks = tables(radius)
    left = _tabled(queries.select("q"), masks, "q")
    right = _tabled(index.select("f"), masks, "f")
    diff = F.col("q").bitwiseXOR(F.col("f"))
    first = F.coalesce(
        *(F.when(diff.bitwiseAND(F.lit(m).cast("long")) == 0, F.lit(t)) for t, m in enumerate(masks))
    )
    # A row becomes one per table here, which Spark's size estimates leave out: no broadcast.
    met = left.hint("merge").join(right, ["table", "masked"])
    near = met.filter((F.bit_count(diff) <= radius) & (F.col("table") == first))
    return near.select("q", "f", F.bit_count(diff).alias("distance"))


# Neighbours in the order of keys ---------------------------------------------


def _content(key: str) -> Column:
    return F.xxhash64(F.col(key), F.coalesce(F.col("text"), F.lit("")))


def neighbours(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, row, n_chars, next) of every row: row and next are content hashes.

    The next row has the next smaller key (null keys come last, equal keys go by hash), and
    the first follows the last. Rows are ranged by key, so no task orders all of
    them; only the first row of each range meets the others. Runs jobs.
    """
    whole = F.coalesce(F.col("text"), F.lit(""))
    ids = stored(docs.select(key, _content(key).alias("row"), F.char_length(whole).cast("long").alias("n_chars")), "ids")
    order = [F.desc_nulls_last(key), F.asc("row")]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = ids.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, "ranged")
    inside = Window.partitionBy("part").orderBy(*order)
    rows = ranged.select("*", F.lead("row").over(inside).alias("after"), F.row_number().over(inside).alias("n"))
    heads = rows.filter("n = 1").select("part", F.col("row").alias("head"))
    all_heads = Window.orderBy("part")
    wrap = F.first("head").over(all_heads.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    follows = heads.select(
        F.col("part").alias("p"), F.coalesce(F.lead("head").over(all_heads), wrap).alias("then")
    )
    # One row per range, so as many as there are shuffle partitions.
    joined = rows.join(F.broadcast(follows), F.col("part") == F.col("p"))
    return joined.select(key, "row", "n_chars", F.coalesce("after", "then").alias("next"))


def edited(docs: DataFrame, near: DataFrame, key: str = "doc_id") -> DataFrame:
    """(row, text, edited) per distinct row: the last third of the text replaced by the
    beginning of the next row's text.

    Whole texts move once, by row hash, and the replacing beginnings once more.
    """
    texts = docs.select(_content(key).alias("row"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    # Rows that repeat key and text are one: their next row is that of the last of them.
    single = near.groupBy("row").agg(F.max(F.struct(F.col("next") != F.col("row"), "next", "n_chars")).alias("x"))
    links = single.select("row", F.col("x.next").alias("next"), F.col("x.n_chars").alias("n_chars"))
    if near.groupBy("row").count().filter("count > 1").limit(1).count():
        texts = texts.dropDuplicates(["row"])
    wanted = links.select(F.col("next").alias("row"), F.col("row").alias("of"), "n_chars", third.alias("m"))
    begins = texts.join(wanted, "row").select(
        F.col("of").alias("row"), "n_chars", "m", F.expr("substring(text, 1, m)").alias("begin")
    )
    joined = texts.join(begins, "row")
    return joined.select("row", "text", F.expr("concat(substring(text, 1, cast(n_chars - m AS INT)), begin)").alias("edited"))


def compare_neighbours(docs: DataFrame, key: str = "doc_id", radius: int = 3, every: int = 50) -> DataFrame:
    """One row per row of `docs`: key, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, n_near.

    Reads key and text. n_near, for rows whose key is divisible by `every`: how many other rows have a
    fingerprint within `radius` bits, searched among all rows; null for others. A null
    text counts as empty: fingerprint 0. Rows that repeat key and text get equal results. An
    empty table gives none. Runs jobs.
    """
    near = stored(neighbours(docs, key), "neighbours")
    both = edited(docs, near, key)
    each = both.select("row", F.posexplode(F.array("text", "edited")).alias("variant", "t"))
    marks = votes(each, ["row", "variant"], "t")
    sides = marks.groupBy("row").agg(
        *(F.max(F.when(F.col("variant") == v, F.col("fingerprint"))).alias(n) for v, n in enumerate(("own", "changed")))
    )
    digests = both.select("row", F.sha2(F.col("edited"), 256).alias("edited_sha256"))
    zero = F.lit(0).cast("long")
    found = digests.join(sides, "row", "left").select(
        "row", "edited_sha256", F.coalesce("own", zero).alias("own"), F.coalesce("changed", zero).alias("changed")
    )
    found = stored(found, "fingerprints")
    nexts = found.select(F.col("row").alias("next"), F.col("own").alias("next_own"))
    rows = near.join(found, "row").join(nexts, "next")
    copies = rows.groupBy(F.col("own").alias("f")).agg(F.count("*").alias("copies"))
    asked = rows.filter(F.col(key) % every == 0)
    pairs = within(asked.select(F.col("own").alias("q")).distinct(), copies, radius)
    n_near = pairs.join(copies, "f").groupBy("q").agg((F.sum("copies") - 1).alias("n_near"))
    out = rows.join(n_near, F.col("own") == F.col("q"), "left")
    return out.select(
        key, "n_chars", "edited_sha256",
        hexadecimal(F.col("own")).alias("fingerprint"), hexadecimal(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
        F.when(F.col(key) % every == 0, F.col("n_near")).alias("n_near"),
    )


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
