"""N-gram Jaccard join through a token-group matrix.

Sets are partitioned into small groups of similar ones, and a group is kept as the union of
its tokens with, per token, the bits of the members that hold it. A query's overlap with
the union bounds its overlap with every member, so only groups that reach the bound are
opened; opening reads all members' overlaps off the bits at once.

Which groups a query meets is decided by an exact prefix filter: of two similar sets, the
first tokens of each, in one order of all tokens with frequent ones last, have one in common.
Sets already known to be connected are not compared again, so a large group of near
copies costs links in proportion to its members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpolicy.functions.session import stored
from stockpolicy.llm.common import by_size, bytes_of, send_package
from stockpolicy.llm.components import components

SHARE = (80, 100)  # the Jaccard similarity, as a fraction
MEMBERS = 32  # of a group: a bit of the matrix each
GROUP_TOKENS = 1 << 18  # of a group, unless one set alone has more
CHUNK_TOKENS = 1 << 20  # of the sets that a task holds at a time
RANGE_TOKENS = 1 << 21  # about as many are counted in one group
FREQUENT, FREQUENT_SETS = 1 << 20, 8  # tokens ordered last: at most so many, in so many sets each
SLICE = 256  # queries opened against a group in one go
STARS = 1  # rounds in which a set meets one other per token, before all that is left is met
SLICE_BYTES = 1 << 18  # of texts hashed at a time

# Odd multipliers, one per place in a shingle, and those of the finishing mix.
PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

# A word's hash is a polynomial of its bytes modulo 2^64, taken off running sums over a whole slice
# of texts. Bytes stand for random numbers, A-Z for those of a-z. Such polynomials are weak for
# long words only, which are hashed one by one.
BASE = np.uint64(0x9E3779B97F4A7C55)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
LONG_WORD = 64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
BYTES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTES[ord("A") : ord("Z") + 1] = BYTES[ord("a") : ord("z") + 1]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * MIX[0]
    x ^= x >> np.uint64(27)
    x *= MIX[1]
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse for i below n; those of a usual slice are kept."""
    if n > len(_kept[0]):
        made = tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, b)])) for b in (BASE, INVERSE))
        if n > 4 * SLICE_BYTES:
            return made
        _kept[:] = made
    return _kept[0][:n], _kept[1][:n]


_kept: list[np.ndarray] = [np.zeros(0, np.uint64)] * 2


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word of UTF-8 bytes."""
    own = np.frombuffer(raw, np.uint8)
    edge = np.diff(np.concatenate([[True], SPACE[own], [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge < 0), np.flatnonzero(edge > 0)
    power, inverse = _powers(len(own))
    sums = np.concatenate([[np.uint64(0)], np.cumsum(BYTES[own] * power)])
    hashes = _mixed((sums[ends] - sums[starts]) * inverse[starts])
    for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        hashes[i] = xxhash.xxh64_intdigest(raw[starts[i] : ends[i]].lower())
    return hashes, starts


def shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Of each UTF-8 text its distinct shingles of five words as sorted 64-bit hashes.

    A-Z count as a-z, and words are cut at ASCII white space. Fewer than five words make one
    shingle, none make an empty set.
    """
    width = len(PLACES)
    for part in by_size(texts, SLICE_BYTES):
        some = texts[part]
        hashes, at = word_hashes(b" ".join(some))
        total = len(hashes)
        mixed = np.zeros(total, np.uint64)
        for k in range(min(width, total)):
            mixed[: total - k] += hashes[k:] * PLACES[k]
        mixed = _mixed(mixed)
        ends = np.cumsum([len(t) + 1 for t in some])
        stops = np.searchsorted(at, ends).tolist()
        for first, stop in zip([0, *stops], stops):
            n = stop - first
            if 0 < n < width:
                own = _mixed((hashes[first:stop] * PLACES[:n]).sum(keepdims=True, dtype=np.uint64))
            else:
                own = np.sort(mixed[first : max(stop - width + 1, first)])
            yield own[np.concatenate([[True], own[1:] != own[:-1]])] if len(own) else own


def identity(tokens: np.ndarray, clashes: frozenset = frozenset()) -> tuple[int, int]:
    """Two 64-bit names of a set, signed. The first is the one used, or the second if others share it."""
    raw = tokens.tobytes()
    first, second = (int(np.uint64(xxhash.xxh64_intdigest(raw, seed)).astype(np.int64)) for seed in (1, 2))
    return (second, first) if first in clashes else (first, second)


def at_least(n: int, share: tuple[int, int]) -> int:
    """The smallest whole number that is `share` of n or more."""
    return -(-n * share[0] // share[1])


def similar(common, a, b, share: tuple[int, int] = SHARE):
    """Whether sets of sizes a and b with so many common tokens reach the share. Arrays as well."""
    return (share[1] * common >= share[0] * (a + b - common)) & (common > 0)


def marked(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, id, other, n, low): names, size and smallest token of each row's set; null where empty."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            rows = [
                (*identity(s), len(s), int(s[0].astype(np.int64))) if len(s) else (None, None, 0, None)
                for s in shingle_sets(bytes_of(batch))
            ]
            columns = [pa.array(list(c), pa.int64()) for c in zip(*rows)]
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[key, "id", "other", "n", "low"])

    read = docs.select(key, "text")
    return read.mapInArrow(run, read.drop("text").schema.add("id", "long").add("other", "long").add("n", "long").add("low", "long"))


def _chunks(it: Iterator[pa.RecordBatch], clashes: frozenset) -> Iterator[dict[int, np.ndarray]]:
    """The distinct sets of a task by name, CHUNK_TOKENS or so at a time."""
    held, size = {}, 0
    for batch in it:
        for tokens in shingle_sets(bytes_of(batch)):
            if len(tokens):
                name = identity(tokens, clashes)[0]
                if name not in held:
                    held[name] = tokens
                    size += len(tokens)
            if size >= CHUNK_TOKENS:
                yield held
                held, size = {}, 0
    if held:
        yield held


def _ranges(tokens: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Token range and the next 32 bits. Both together tell tokens apart well enough to find candidates."""
    return (tokens >> np.uint64(64 - bits)).astype(np.int64), (tokens >> np.uint64(32 - bits)).astype(np.uint32)


def _runs(ranges: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The token ranges that occur, ascending, each with its slice."""
    starts = np.flatnonzero(np.concatenate([[True], ranges[1:] != ranges[:-1]])).tolist()
    for a, b in zip(starts, [*starts[1:], len(ranges)]):
        yield int(ranges[a]), slice(a, b)


def frequent_tokens(docs: DataFrame, bits: int, clashes: frozenset) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent tokens (range and 32 bits in one number, ascending) and their rank by frequency.

    Counted over all documents: a task sends, per token range, its tokens with their counts,
    and one group adds up a range. At most FREQUENT tokens come to the driver, whatever the
    corpus; others are ordered like rare ones, which costs time and loses nothing.
    """

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _chunks(it, clashes):
            tokens, counts = np.unique(np.concatenate(list(held.values())), return_counts=True)
            ranges, low = _ranges(tokens, bits)
            rows = []
            for r, at in _runs(ranges):
                part, own = low[at], counts[at]
                more = own > 1
                rows.append((r, part[~more].tobytes(), part[more].tobytes(), own[more].astype(np.uint32).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["range", "once", "more", "counts"])

    def add_up(key: tuple, table: pa.Table) -> pa.Table:
        def column(name: str) -> np.ndarray:
            return np.frombuffer(b"".join(table[name].to_pylist()), np.uint32)

        once, more, counts = column("once"), column("more"), column("counts")
        every = np.concatenate([once, more])
        order = np.argsort(every, kind="stable")
        every, weight = every[order], np.concatenate([np.ones(len(once), np.int64), counts.astype(np.int64)])[order]
        starts = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        total = np.add.reduceat(weight, starts)
        kept = total >= FREQUENT_SETS
        code = every[starts][kept].astype(np.int64) + (key[0].as_py() << 32)
        return pa.table({"code": code, "sets": total[kept]})

    sent = docs.select("text").mapInArrow(count, "range long, once binary, more binary, counts binary")
    counted = stored(sent.groupBy("range").applyInArrow(add_up, "code long, sets long"), "frequent")
    found = counted.orderBy(F.desc("sets"), "code").limit(FREQUENT).toArrow().sort_by("code")
    codes, sets = found["code"].to_numpy(), found["sets"].to_numpy()
    rank = np.empty(len(codes), np.uint64)
    rank[np.lexsort((codes, sets))] = np.arange(len(codes), dtype=np.uint64)
    return codes, rank


def in_order(tokens: np.ndarray, codes: np.ndarray, rank: np.ndarray, bits: int) -> np.ndarray:
    """The tokens of a set in the order of all tokens: by hash, but frequent ones last, by frequency."""
    key = tokens >> np.uint64(1)
    if len(codes):
        ranges, low = _ranges(tokens, bits)
        code = (ranges << 32) + low
        at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
        hit = codes[at] == code
        key[hit] = rank[at[hit]] + np.uint64(1 << 63)
    return tokens[np.argsort(key, kind="stable")]


def in_reach(token: np.ndarray, size: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """Whether a posting has a partner under its token: sorted by token and size, indexed ones positive.

    A set asks for indexed ones of its own size or less, down to `share` of it. The last
    indexed one before it is the largest of these, and the one after an indexed one is the
    least that may ask for it, so looking at neighbours tells.
    """
    at, n = np.arange(len(token)), np.abs(size).astype(np.int64)
    new = np.concatenate([[True], token[1:] != token[:-1]])
    first = np.maximum.accumulate(np.where(new, at, 0))
    last = np.concatenate([[-1], np.maximum.accumulate(np.where(size > 0, at, -1))[:-1]])
    asks = (last >= first) & (n[last] * share[1] >= n * share[0])
    found = np.zeros(len(token), bool)
    found[:-1] = (size[:-1] > 0) & ~new[1:] & (n[:-1] * share[1] >= n[1:] * share[0])
    return asks | found


def shared_prefixes(
    docs: DataFrame, bits: int, clashes: frozenset, codes: np.ndarray, rank: np.ndarray, share: tuple[int, int]
) -> DataFrame:
    """(token, id, n, indexed): prefix tokens of sets that have a possible partner under them.

    A set of n tokens asks with its first n - ceil(t n) + 1 tokens. Of a pair the smaller set
    need only be found by its first n - ceil(2t / (1 + t) n) + 1, which are `indexed`.
    """
    spark = docs.sparkSession
    sent_order = spark.sparkContext.broadcast((codes, rank))  # FREQUENT numbers at most
    both = (2 * share[0], share[0] + share[1])

    def send(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_codes, own_rank = sent_order.value
        for held in _chunks(it, clashes):
            tokens, names, sizes = [], [], []
            for name, s in held.items():
                n = len(s)
                first = in_order(s, own_codes, own_rank, bits)[: n - at_least(n, share) + 1]
                found = n - at_least(n, both) + 1
                size = np.full(len(first), n, np.int32)
                size[found:] *= -1
                tokens.append(first)
                names.append(np.full(len(first), name, np.int64))
                sizes.append(size)
            every, name, size = (np.concatenate(c) for c in (tokens, names, sizes))
            order = np.argsort(every)
            ranges, low = _ranges(every[order], bits)
            name, size = name[order], size[order]
            rows = [(r, low[at].tobytes(), name[at].tobytes(), size[at].tobytes()) for r, at in _runs(ranges)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["range", "tokens", "names", "sizes"])

    def meet(key: tuple, table: pa.Table) -> pa.Table:
        def column(name: str, kind: type) -> np.ndarray:
            return np.frombuffer(b"".join(table[name].to_pylist()), kind)

        token, name, size = column("tokens", np.uint32), column("names", np.int64), column("sizes", np.int32)
        order = np.lexsort((name, np.abs(size), token))
        token, name, size = token[order], name[order], size[order]
        new = np.concatenate([[True], (token[1:] != token[:-1]) | (name[1:] != name[:-1])])  # copies fall together
        token, name, size = token[new], name[new], size[new]
        met = in_reach(token, size, share)
        code = token[met].astype(np.int64) + (key[0].as_py() << 32)
        return pa.table({"token": code, "id": name[met], "n": np.abs(size[met]).astype(np.int64), "indexed": size[met] > 0})

    sent = docs.select("text").mapInArrow(send, "range long, tokens binary, names binary, sizes binary")
    met = sent.groupBy("range").applyInArrow(meet, "token long, id long, n long, indexed boolean")
    return stored(met, "prefixes")


def partitioned(sets: DataFrame) -> DataFrame:
    """(id, n, gid) of `sets` (id, n, low): groups of sets that have the smallest token in common.

    Sets are ranged on (smallest token, size, id), so those that share it lie side by side in
    any number of tasks, and cut into groups of at most MEMBERS sets and GROUP_TOKENS tokens.
    """

    def cut(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gid, low, members, tokens = TaskContext.get().partitionId() << 40, None, 0, 0
        for batch in it:
            gids = []
            for own, n in zip(batch.column("low").to_pylist(), batch.column("n").to_pylist()):
                if own != low or members == MEMBERS or tokens + n > GROUP_TOKENS:
                    gid, low, members, tokens = gid + 1, own, 0, 0
                members, tokens = members + 1, tokens + n
                gids.append(gid)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n"), pa.array(gids, pa.int64())], names=["id", "n", "gid"])

    order = ["low", "n", "id"]
    ranged = sets.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    return stored(ranged.mapInArrow(cut, "id long, n long, gid long"), "groups")


GROUP = "gid long, ids array<long>, sizes array<long>, roots array<long>, tokens binary, bits binary"


class Group:
    """A row of the matrix: the union of the members' tokens, and the bits of who holds each."""

    def __init__(self, ids: list[int], sets: list[np.ndarray]):
        self.ids, self.sizes = ids, np.array([len(s) for s in sets])
        self.tokens, at = np.unique(np.concatenate(sets), return_inverse=True)
        self.bits = np.zeros(len(self.tokens), np.uint32)
        bit = np.repeat(np.uint32(1) << np.arange(len(sets), dtype=np.uint32), self.sizes)
        np.bitwise_or.at(self.bits, at, bit)

    @classmethod
    def of(cls, row: dict) -> Group:
        made = cls.__new__(cls)
        made.ids, made.sizes = row["ids"], np.array(row["sizes"])
        made.tokens, made.bits = np.frombuffer(row["tokens"], np.uint64), np.frombuffer(row["bits"], np.uint32)
        return made

    def held(self, bits: np.ndarray) -> np.ndarray:
        """How many of these tokens each member holds."""
        flags = np.unpackbits(np.ascontiguousarray(bits).view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
        return flags.sum(0, dtype=np.int64)[: len(self.ids)]

    def member(self, name: int) -> np.ndarray:
        return self.tokens[self.bits & np.uint32(1 << self.ids.index(name)) > 0]

    def overlaps(self, query: np.ndarray, share: tuple[int, int]) -> np.ndarray | None:
        """Common tokens with each member, or None where the union itself falls short: not opened."""
        at = np.minimum(np.searchsorted(self.tokens, query), len(self.tokens) - 1)
        common = at[self.tokens[at] == query]
        if len(common) < at_least(len(query), share):
            return None
        return self.held(self.bits[common])

    def roots(self, share: tuple[int, int]) -> list[int]:
        """Per member the smallest member that links lead to inside the group."""
        root = list(range(len(self.ids)))
        for i in range(len(self.ids)):
            common = self.held(self.bits[self.bits & np.uint32(1 << i) > 0])
            for j in np.flatnonzero(similar(common, self.sizes[i], self.sizes, share)).tolist():
                a, b = root[i], root[j]
                if a != b:
                    root = [min(a, b) if r in (a, b) else r for r in root]
        least: dict[int, int] = {}
        for r, name in zip(root, self.ids):
            least[r] = min(name, least.get(r, name))
        return [least[r] for r in root]


def matrix(docs: DataFrame, wanted: DataFrame, clashes: frozenset, share: tuple[int, int], key: str) -> DataFrame:
    """GROUP rows. wanted: (key, id, gid), one row of `docs` per set; its tokens are read off its text."""
    names = wanted.select(F.col(key).alias("_key"), F.col("id").alias("_id"), "gid")
    rows = docs.select(key, "text").join(names, F.col(key).eqNullSafe(F.col("_key"))).select("gid", "_id", "text")

    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            out = []
            for gid, name, tokens in zip(batch.column("gid").to_pylist(), batch.column("_id").to_pylist(), shingle_sets(bytes_of(batch))):
                if len(tokens) and identity(tokens, clashes)[0] == name:  # another row of the key is another set
                    out.append((gid, name, tokens.tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["gid", "id", "tokens"])

    def build(key_: tuple, table: pa.Table) -> pa.Table:
        sets = dict(zip(table["id"].to_pylist(), table["tokens"].to_pylist()))
        ids = sorted(sets)
        group = Group(ids, [np.frombuffer(sets[i], np.uint64) for i in ids])
        columns = [[key_[0].as_py()], [ids], [group.sizes.tolist()], [group.roots(share)], [group.tokens.tobytes()], [group.bits.tobytes()]]
        return pa.table(dict(zip((c.split()[0] for c in GROUP.split(", ")), columns)))

    sets = rows.mapInArrow(read, "gid long, id long, tokens binary")
    return stored(sets.groupBy("gid").applyInArrow(build, GROUP), "matrix")


def opened(pairs: DataFrame, groups: DataFrame, place: DataFrame, share: tuple[int, int]) -> DataFrame:
    """(a, b) with a < b: links between queries and members of the groups they meet. Runs jobs.

    pairs: distinct (query, gid), stored. Tokens of a query are read off its own group's row and go from
    there to the groups it meets. A group that many queries meet is opened in slices of SLICE of them.
    """

    asked_schema = "gid long, slice long, query long, tokens binary"

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        names = left["query"].to_pylist()
        group = Group.of(right.to_pylist()[0]) if names else None
        tokens = {q: group.member(q).tobytes() for q in set(names)}
        columns = [left["target"], left["slice"], left["query"], pa.array([tokens[q] for q in names], pa.binary())]
        return pa.table(columns, names=[c.split()[0] for c in asked_schema.split(", ")])

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = [], []
        if left.num_rows and right.num_rows:
            row = right.slice(0, 1).to_pylist()[0]
            group, roots = Group.of(row), row["roots"]
            for name, raw in zip(left["query"].to_pylist(), left["tokens"].to_pylist()):
                query = np.frombuffer(raw, np.uint64)
                common = group.overlaps(query, share)
                if common is not None:
                    linked = np.flatnonzero(similar(common, len(query), group.sizes, share)).tolist()
                    for root in {roots[j] for j in linked} - {name}:
                        a.append(min(name, root))
                        b.append(max(name, root))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    met = pairs.groupBy("gid").agg(F.ceil(F.count("*") / SLICE).cast("long").alias("slices"))
    own = place.select(F.col("id").alias("query"), F.col("gid").alias("own"))
    routed = pairs.join(met, "gid").join(own, "query").select(
        "own", "query", F.col("gid").alias("target"), F.pmod(F.xxhash64("query"), F.col("slices")).alias("slice")
    )
    routed = stored(routed, "routed")
    holders = groups.join(routed.select(F.col("own").alias("gid")).distinct(), "gid", "left_semi")
    asked = routed.groupBy("own").cogroup(holders.groupBy("gid")).applyInArrow(send, asked_schema)
    held = groups.join(met, "gid").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices")
    links = asked.groupBy("gid", "slice").cogroup(held.groupBy("gid", "slice")).applyInArrow(compare, "a long, b long")
    return stored(links.distinct(), "links")


def _in_reach(share: tuple[int, int]):
    """Of a pair the set found is the smaller one, but large enough to reach the share."""
    return (F.col("s_n") <= F.col("n")) & (F.col("s_n") * share[1] >= F.col("n") * share[0])


def star_pairs(postings: DataFrame, share: tuple[int, int]) -> DataFrame:
    """(query, gid): each query meets, per token, the group of one set of another component."""
    found = F.struct("comp", "gid", F.col("n").alias("s_n"))
    ends = postings.filter("indexed").groupBy("token").agg(F.min(found).alias("low"), F.max(found).alias("high"))
    asked = postings.join(ends, "token").filter("low.comp != comp OR high.comp != comp")
    other = F.when(F.col("low.comp") != F.col("comp"), F.col("low")).otherwise(F.col("high"))
    met = asked.select(F.col("id").alias("query"), "n", other.alias("o")).select("query", "n", F.col("o.gid").alias("gid"), F.col("o.s_n").alias("s_n"))
    return met.filter(_in_reach(share)).select("query", "gid").distinct()


def largest_components(postings: DataFrame) -> DataFrame:
    """(token, main): the largest component of each token that more than one has."""
    counts = postings.groupBy("token", "comp").agg(F.count("*").alias("sets"))
    held = counts.groupBy("token").agg(F.max_by("comp", F.struct("sets", "comp")).alias("main"), F.count("*").alias("comps"))
    return held.filter("comps > 1").select("token", "main")


def all_pairs_left(postings: DataFrame, share: tuple[int, int]) -> DataFrame:
    """(query, gid): every query with every group that has a set of another component under a common token.

    A token's largest component is not met with itself, so what a token costs is its sets
    times its groups outside the largest component, and the other way round.
    """
    live = stored(postings.join(largest_components(postings), "token"), "live")
    inside = F.col("comp") == F.col("main")
    asked = live.select("token", F.col("id").alias("query"), "n", "comp", inside.alias("inside"))
    # The matrix proper: a group stands under a token once per component, however many members have it.
    cells = live.filter("indexed").groupBy("token", "gid", "comp", "main").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    found = cells.select("token", "gid", "least", "most", F.col("comp").alias("s_comp"), inside.alias("s_inside"))
    few = asked.filter("NOT inside").join(found, "token")
    rest = asked.filter("inside").join(found.filter("NOT s_inside"), "token")
    reach = (F.col("least") <= F.col("n")) & (F.col("most") * share[1] >= F.col("n") * share[0])
    met = few.unionByName(rest).filter(reach & (F.col("comp") != F.col("s_comp")))
    return met.select("query", "gid").distinct()


def jaccard_components(docs: DataFrame, share: tuple[int, int] = SHARE, key: str = "doc_id") -> DataFrame:
    """One row per row of `docs`: (key, n_shingles, component_id). Runs jobs.

    Rows link when their sets of five-word shingles have a Jaccard similarity of `share` or more, and
    component_id is the smallest key reachable. Rows of one set are one node. A text without
    words, null or empty, has an empty set and is linked with nothing. Repeated keys stay
    repeated rows; a null key is a row like others, and the id of null keys alone is null. An
    empty table gives no rows. Only the key and the column text are read. Shingles are told
    apart by 64-bit hashes.
    """
    send_package(docs.sparkSession)
    rows = stored(marked(docs, key), "marked")
    twins = rows.groupBy("id").agg(F.min("other").alias("a"), F.max("other").alias("b")).filter("a != b")
    clashes = frozenset(r["id"] for r in twins.select("id").collect())  # sets squared over 2^64: hardly ever one
    if clashes:
        rows = rows.withColumn("id", F.when(F.col("id").isin(*clashes), F.col("other")).otherwise(F.col("id")))
    nodes = rows.filter("n > 0").groupBy("id").agg(F.min(key).alias("first"), F.first("n").alias("n"), F.first("low").alias("low"))
    member = _members(docs, nodes, rows, clashes, share, key)
    of_node = nodes.join(member.withColumnRenamed("node", "id"), "id", "left").select(
        "id", F.coalesce("component", "id").alias("component"), "first"
    )
    least = of_node.groupBy("component").agg(F.min("first").alias("least"))
    named = of_node.join(least, "component").select("id", F.col("least").alias("component_id"))
    return rows.join(named, "id", "left").select(
        key, F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col(key)).alias("component_id")
    )


def _members(docs: DataFrame, nodes: DataFrame, rows: DataFrame, clashes: frozenset, share: tuple[int, int], key: str) -> DataFrame:
    """(node, component) of the sets that have a link."""
    total = rows.agg(F.sum("n")).first()[0] or 0
    bits = int(total // RANGE_TOKENS).bit_length()
    order = frequent_tokens(docs, bits, clashes)
    prefixes = shared_prefixes(docs, bits, clashes, *order, share)
    met = stored(prefixes.select("id").distinct().join(nodes, "id"), "met")  # others link with nothing
    place = partitioned(met)
    groups = matrix(docs, place.join(met, "id").select(F.col("first").alias(key), "id", "gid"), clashes, share, key)
    inside = groups.select(F.explode(F.arrays_zip("ids", "roots")).alias("m")).select(F.col("m.roots").alias("a"), F.col("m.ids").alias("b"))
    links = stored(inside.filter("a < b"), "links")
    placed = stored(prefixes.join(place.select("id", "gid"), "id"), "placed")
    tested = None
    # Each set meets one other per token, which joins most near copies; then all pairs that are left.
    for pairs_of in [star_pairs] * STARS + [all_pairs_left]:
        member = components(links)
        comp = F.coalesce("component", "id").alias("comp")
        postings = placed.join(member.withColumnRenamed("node", "id"), "id", "left").select("token", "id", "n", "indexed", "gid", comp)
        pairs = pairs_of(postings, share)
        if tested is not None:
            pairs = pairs.join(tested, ["query", "gid"], "left_anti")
        pairs = stored(pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = links.unionByName(opened(pairs, groups, place, share))
    return components(links)


def oracle() -> str:
    """DuckDB text for `jaccard_components` with the default share."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
        WITH RECURSIVE words AS (
            SELECT doc_id, row_number() OVER () AS row_,
                list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
            FROM documents),
        sets AS MATERIALIZED (
            SELECT doc_id, row_, CASE WHEN len(w) = 0 THEN [] ELSE
                list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, greatest(len(w) - 4, 1) + 1)]) END AS s
            FROM words),
        tokens AS (SELECT row_, unnest(s) AS token FROM sets),
        common AS (
            SELECT a.row_ AS a, b.row_ AS b, count(*) AS c FROM tokens a JOIN tokens b ON a.token = b.token AND a.row_ < b.row_
            GROUP BY ALL),
        links AS MATERIALIZED (
            SELECT a, b FROM common JOIN sets x ON x.row_ = a JOIN sets y ON y.row_ = b
            WHERE 100 * c >= 80 * (len(x.s) + len(y.s) - c)),
        both_ AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach AS (
            SELECT row_, row_ AS other FROM sets
            UNION
            SELECT reach.row_, both_.b FROM reach JOIN both_ ON both_.a = reach.other)
        SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
        FROM reach JOIN sets s ON s.row_ = reach.row_ JOIN sets o ON o.row_ = reach.other
        GROUP BY s.row_, s.doc_id, n_shingles"""
