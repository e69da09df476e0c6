"""Merkle manifest of a dataset as a persistent tree whose versions copy paths only.

Leaves of a group (a language) ascend by key; every eight consecutive nodes become their
digest until one is left, and the groups' last nodes become the root in the same way.
The tree is cut into aligned blocks of four levels, so a block is 4096 nodes at most and is
hashed in one task; the blocks' own roots are the nodes of the next tier. A changed leaf
makes a version: it owns new copies of the leaf's ancestors and shares every other node
with the base. Inside a block the ancestors are copied in its task, and above it the
version goes on along the block root's path, which the upper tiers hand down.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockpolicy.functions.session import stored
from stockpolicy.llm.common import send_package

FANOUT = 8
LEVELS = 4  # of a block
BLOCK = FANOUT**LEVELS
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

PATH = "path array<struct<before: string, after: string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column, as_text: Column | None = None) -> Column:
    """`-` for null, else UTF-8 byte count, `:` and the value; integers in decimal."""
    text = value.cast("string") if as_text is None else as_text
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(text: Column) -> Column:
    """Digest of a documents row with `text` in place of its own."""
    parts = [field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    return F.sha2(F.encode(F.concat(*parts, field(text)), "UTF-8"), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def group_of(name: str) -> Column:
    """The group as text that is never null and sorts like it: null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("="), F.col(name)), F.lit(""))


def placed(rows: DataFrame, by: str, order: list[str], name: str) -> DataFrame:
    """`rows` with `at`, the place within `by` from 0, and `size`, the rows of `by`.

    Rows are ranged on (by, order), so a hot group spreads over many tasks; its ranges'
    counts, a row per range and group, give each range's first place. Runs jobs.
    """
    ranged = stored(
        rows.repartitionByRange(by, *order)
        .sortWithinPartitions(by, *order)
        .withColumn("_seen", F.monotonically_increasing_id()),
        name,
    )
    part = F.shiftright("_seen", 33).alias("_part")
    counts = ranged.groupBy(by, part).agg(F.min("_seen").alias("_first"), F.count("*").alias("_n"))
    whole = Window.partitionBy(by)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        by,
        "_part",
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(whole).alias("size"),
    )
    located = ranged.withColumn("_part", part).join(starts, [by, "_part"])
    return located.withColumn("at", F.col("_seen") + F.col("_shift")).drop("_part", "_seen", "_shift")


def levels_of(nodes: list[str], size: int) -> list[list[str]]:
    """Digests by level of one block, from its nodes up to its root.

    A group of one block stops at a single node; a larger one goes up all of a block's levels.
    """
    out = [nodes]
    while len(out) <= LEVELS if size > BLOCK else len(out[-1]) > 1:
        last = out[-1]
        out.append([digest("".join(last[i : i + FANOUT])) for i in range(0, len(last), FANOUT)])
    return out


def siblings(level: list[str], i: int) -> tuple[str, str]:
    """The other nodes of the node's run: those before it and those after it, joined."""
    start = i - i % FANOUT
    return "".join(level[start:i]), "".join(level[i + 1 : start + FANOUT])


@dataclass
class Manifest:
    """A base tree. `leaves` and every tier are stored tables.

    leaves: (doc_id, part, at, size, leaf, changed); tiers: (part, at, size, node), the
    first holding the roots of leaf blocks; tops: (part, at, size, node) of the groups'
    last nodes as the nodes of the tree above them, tier by tier; root: its digest.
    """

    leaves: DataFrame
    tiers: list[DataFrame]
    tops: list[DataFrame]
    root: str | None


def _block_roots(nodes: DataFrame, column: str, name: str) -> DataFrame:
    """(part, at, size, node): the root of each block of (part, at, size, column)."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        part, block = (k.as_py() for k in key)
        table = table.sort_by("at")
        size = table["size"][0].as_py()
        top = levels_of(table[column].to_pylist(), size)[-1]
        made = {"part": [part], "at": [block], "size": [-(-size // BLOCK)], "node": top}
        return pa.table(made, schema=pa.schema([("part", pa.string()), ("at", pa.int64()), ("size", pa.int64()), ("node", pa.string())]))

    block = F.expr(f"at div {BLOCK}").alias("block")
    read = nodes.select("part", block, "at", "size", column)
    grouped = read.groupBy("part", "block").applyInArrow(run, "part string, at long, size long, node string")
    return stored(grouped, name)


def _tiers(nodes: DataFrame, column: str, name: str) -> list[DataFrame]:
    """Block roots, their blocks' roots and so on, until every part has one node."""
    tiers = [_block_roots(nodes, column, name)]
    while not tiers[-1].filter("size > 1").isEmpty():
        tiers.append(_block_roots(tiers[-1], "node", name))
    return tiers


def build(docs: DataFrame, changed: Column | None = None) -> Manifest:
    """The base tree of `docs` (columns doc_id, source, lang, n_chars, text). Runs jobs.

    `changed` is the digest of a row's altered leaf, null where it has none. Any column may
    be null; null keys come first, and rows of one key are ordered by digest, so rows that
    repeat whole are interchangeable. An empty table has no root. Other columns are not read.
    """
    send_package(docs.sparkSession)
    altered = F.lit(None).cast("string") if changed is None else changed
    own = docs.select(
        "doc_id", group_of("lang").alias("part"), leaf_of(F.col("text")).alias("leaf"), altered.alias("changed")
    )
    leaves = stored(placed(stored(own, "leaves"), "part", ["doc_id", "leaf"], "ranged"), "placed")
    tiers = _tiers(leaves, "leaf", "blocks")
    last = tiers[-1].select(F.lit("").alias("all"), F.col("part").alias("lang"), F.col("node").alias("subroot"))
    ordered = placed(last, "all", ["lang"], "subroots").select(
        F.col("all").alias("part"), "at", "size", "lang", "subroot"
    )
    subroots = stored(ordered, "subroots")
    tops = [subroots, *_tiers(subroots, "subroot", "tops")]
    head = tops[-1].select("node").first()
    return Manifest(leaves, tiers, tops, head["node"] if head else None)


def _handed_down(nodes: DataFrame, column: str, above: DataFrame, keep: list[str], name: str) -> DataFrame:
    """(*keep, path): each node's siblings up to the root, level by level.

    above: (part, at, path) of the nodes' block roots. A block meets its one path in a
    cogroup, so a path is sent once for 4096 nodes.
    """
    schema = ", ".join(f"{c} {'long' if c in ('at', 'size') else 'string'}" for c in keep)
    arrow = pa.schema(
        [(c, pa.int64() if c in ("at", "size") else pa.string()) for c in keep]
        + [("path", pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())])))]
    )

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        table = left.sort_by("at")
        rest = right["path"][0].as_py()
        levels = levels_of(table[column].to_pylist(), table["size"][0].as_py())
        paths = []
        for i in range(len(levels[0])):
            path = []
            for depth, level in enumerate(levels[:-1]):
                before, after = siblings(level, i // FANOUT**depth)
                path.append({"before": before, "after": after})
            paths.append(path + rest)
        return pa.table({c: table[c] for c in keep} | {"path": paths}, schema=arrow)

    read = nodes.withColumn("block", F.expr(f"at div {BLOCK}")).select(
        "part", "block", *dict.fromkeys(["at", "size", column, *(k for k in keep if k != "part")])
    )
    up = above.select("part", F.col("at").alias("block"), "path")
    joined = read.groupBy("part", "block").cogroup(up.groupBy("part", "block"))
    return stored(joined.applyInArrow(run, f"{schema}, {PATH}"), name)


def _paths(tree: Manifest) -> DataFrame:
    """(part, at, path, subroot): for each block of leaves, its root's siblings up to the root."""
    at_root = F.expr("cast(array() as array<struct<before: string, after: string>>)")
    above = tree.tops[-1].select("part", "at", at_root.alias("path"))
    for tier in reversed(tree.tops[1:-1]):
        above = _handed_down(tier, "node", above, ["part", "at"], "paths")
    top = _handed_down(tree.tops[0], "subroot", above, ["lang", "subroot"], "paths")
    paths = tree.tiers[-1].join(top, F.col("part") == F.col("lang")).select("part", "at", "path", "subroot")
    subroots = paths.select("part", "subroot")
    for tier in reversed(tree.tiers[:-1]):
        paths = _handed_down(tier, "node", paths, ["part", "at"], "paths")
    return paths if "subroot" in paths.columns else paths.join(subroots, "part")


class Block:
    """One block of the base tree, and versions of it."""

    def __init__(self, leaves: list[str], size: int, path: list[dict]):
        self.levels = levels_of(leaves, size)
        self.path = [(p["before"], p["after"]) for p in path]
        upper = "".join(b + a for b, a in self.path)
        # A node's proof ends with its parent's, so proofs are built from the top down.
        proofs = [upper] * len(self.levels[-1])
        for level in reversed(self.levels[:-1]):
            proofs = ["".join((*siblings(level, i), proofs[i // FANOUT])) for i in range(len(level))]
        self.proofs = proofs
        self._base: str | None = None

    def _above(self, node: str) -> Iterator[str]:
        for before, after in self.path:
            node = digest(before + node + after)
            yield node

    def base(self) -> str:
        """The root recomputed from the block's own root."""
        if self._base is None:
            self._base = [self.levels[-1][0], *self._above(self.levels[-1][0])][-1]
        return self._base

    def version(self, i: int, leaf: str) -> list[str]:
        """Copies of the ancestors that the version with `leaf` at place i owns, upwards.

        As soon as a copy would equal the base's node, the version shares the rest.
        """
        copies, node = [], leaf
        for depth, level in enumerate(self.levels):
            at = i // FANOUT**depth
            if node == level[at]:
                return copies
            copies.append(node)
            if depth + 1 < len(self.levels):
                before, after = siblings(level, at)
                node = digest(before + node + after)
        return copies + list(self._above(node))

    def folded(self, i: int, leaf: str) -> str:
        """The root over `leaf` and the base's siblings."""
        copies = self.version(i, leaf)
        return copies[-1] if len(copies) == len(self.levels) + len(self.path) else self.base()


def _by_block(tree: Manifest, run, schema: str) -> DataFrame:
    """`run(part, table, block)` for each block of leaves, with its `Block`."""

    def whole(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        table = left.sort_by("at")
        size, path = table["size"][0].as_py(), right["path"][0].as_py()
        return run(table, Block(table["leaf"].to_pylist(), size, path), right["subroot"][0].as_py())

    leaves = tree.leaves.withColumn("block", F.expr(f"at div {BLOCK}"))
    paths = _paths(tree).withColumnRenamed("at", "block")
    return leaves.groupBy("part", "block").cogroup(paths.groupBy("part", "block")).applyInArrow(whole, schema)


def versions(tree: Manifest) -> DataFrame:
    """(doc_id, lang, at, level, node): the nodes that each changed leaf's version owns.

    Level 0 is the leaf; the last one is the version's root. Nodes not listed are the
    base's. A change that leaves a leaf as it was owns nothing.
    """
    arrow = pa.schema(
        [("doc_id", pa.int64()), ("lang", pa.string()), ("at", pa.int64()), ("level", pa.int32()), ("node", pa.string())]
    )

    def run(table: pa.Table, block: Block, subroot: str) -> pa.Table:
        rows = []
        part = table["part"][0].as_py()
        lang = part[1:] if part else None
        columns = (table[c].to_pylist() for c in ("doc_id", "at", "changed"))
        for i, (key, at, changed) in enumerate(zip(*columns)):
            for level, node in enumerate(block.version(i, changed) if changed else ()):
                rows.append((key, lang, at, level, node))
        return pa.table([list(c) for c in zip(*rows)] or [[]] * 5, schema=arrow)

    return _by_block(tree, run, "doc_id long, lang string, at long, level int, node string")


RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def verify(tree: Manifest) -> DataFrame:
    """One row per leaf: its digests, its proof, and the root folded from its changed digest.

    proof_sha256 is the digest of all siblings, level by level; folded_root takes the
    changed leaf, or the leaf itself where it has none, and `verified` compares it to the root.
    """
    root = tree.root
    types = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    arrow = pa.schema([(n, types[t]) for n, t in (c.split() for c in RESULT.split(", "))])

    def run(table: pa.Table, block: Block, subroot: str) -> pa.Table:
        leaves, changed = table["leaf"].to_pylist(), table["changed"].to_pylist()
        folded = [block.folded(i, c or own) for i, (own, c) in enumerate(zip(leaves, changed))]
        n = len(leaves)
        return pa.table(
            {
                "doc_id": table["doc_id"],
                "leaf": leaves,
                "subroot": [subroot] * n,
                "root": [root] * n,
                "proof_sha256": [digest(p) for p in block.proofs],
                "folded_root": folded,
                "verified": [f == root for f in folded],
            },
            schema=arrow,
        )

    return _by_block(tree, run, RESULT)


def tampered_leaf() -> Column:
    """Digest of the row with its text in lower case where 3 divides the key's crc32, else null."""
    key = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    return F.when(key % 3 == 0, leaf_of(lower_ascii(F.col("text"))))


def tampering_check(docs: DataFrame) -> DataFrame:
    """`verify` of the documents, a third of the keys with their text's A-Z in lower case. Runs jobs.

    A null key has no crc32, so it is never tampered with. An empty table gives no rows.
    """
    return verify(build(docs, tampered_leaf()))


def oracle(depth: int = 8, top: int = 3) -> str:
    """DuckDB text for `tampering_check`, for up to 8 ** depth rows a language and 8 ** top languages."""

    def part(value: str) -> str:
        return f"coalesce(octet_length(encode(({value})::VARCHAR))::VARCHAR || ':' || ({value})::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    # crc32 bit by bit: each byte of the digits is xored in, then eight -1 marks shift it out.
    marks = "flatten([[ascii(c), -1, -1, -1, -1, -1, -1, -1, -1] for c in string_split(doc_id::VARCHAR, '')])"
    step = (
        "lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) "
        "ELSE xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END) END"
    )
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, [m::BIGINT for m in {marks}]), {step}), 4294967295)"
    lower = f"translate(text, '{UPPER}', '{LOWER}')"
    ctes = [
        f"""rows_ AS (SELECT doc_id, lang, {leaf("text")} AS leaf,
            CASE WHEN {crc} % 3 = 0 THEN {leaf(lower)} END AS changed FROM documents)""",
        """l0 AS (SELECT *, coalesce('=' || lang, '') AS part, leaf AS node, coalesce(changed, leaf) AS fold, '' AS proof,
            row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM rows_)""",
        "n0 AS (SELECT part, place AS pos, leaf AS node FROM l0)",
    ]

    def climb(i: int, leaves: str, nodes: str) -> list[str]:
        """One level: runs become nodes, and each row's fold and proof take in its siblings."""
        return [
            f"s{i} AS (SELECT part, max(pos) + 1 AS n FROM {nodes} GROUP BY part)",
            f"""n{i + 1} AS (SELECT part, run AS pos,
                CASE WHEN max(n) = 1 THEN max(node) ELSE sha256(string_agg(node, '' ORDER BY pos)) END AS node
                FROM (SELECT part, pos, pos // 8 AS run, node, n FROM {nodes} JOIN s{i} USING (part)) GROUP BY part, run)""",
            f"""r{i} AS (SELECT part, pos // 8 AS run, list(node ORDER BY pos) AS run_nodes FROM {nodes} GROUP BY ALL)""",
            f"""l{i + 1} AS (SELECT l.* EXCLUDE (fold, proof, place),
                CASE WHEN n = 1 THEN fold ELSE sha256(array_to_string(run_nodes[:place % 8], '') || fold
                    || array_to_string(run_nodes[place % 8 + 2:], '')) END AS fold,
                CASE WHEN n = 1 THEN proof ELSE proof || array_to_string(run_nodes[:place % 8], '')
                    || array_to_string(run_nodes[place % 8 + 2:], '') END AS proof,
                CASE WHEN n = 1 THEN place ELSE place // 8 END AS place
                FROM {leaves} l JOIN s{i} USING (part) JOIN r{i} r ON r.part = l.part AND r.run = l.place // 8)""",
        ]

    for i in range(depth):
        ctes += climb(i, f"l{i}", f"n{i}")
    a, b = depth, depth + 1
    ctes += [
        f"top AS (SELECT part AS lang_, node AS subroot, row_number() OVER (ORDER BY part) - 1 AS pos FROM n{a})",
        f"n{b} AS (SELECT 'all' AS part, pos, subroot AS node FROM top)",
        f"""l{b} AS (SELECT l.* EXCLUDE (part, place), 'all' AS part, t.pos AS place, subroot
            FROM l{a} l JOIN top t ON t.lang_ = l.part)""",
    ]
    for i in range(b, b + top):
        ctes += climb(i, f"l{i}", f"n{i}")
    last = b + top
    stored_once = ", ".join(c.replace(" AS (", " AS MATERIALIZED (", 1) for c in ctes)
    return f"""WITH {stored_once}
        SELECT doc_id, leaf, subroot, n.node AS root, sha256(proof) AS proof_sha256,
            fold AS folded_root, fold = n.node AS verified FROM l{last} l JOIN n{last} n ON n.part = l.part"""
