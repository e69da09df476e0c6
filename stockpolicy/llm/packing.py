"""Best-fit packing by minimum bin slack.

Texts become token ids in the tasks that read them. Pieces are dealt to shards of a
bounded number of rows; in a shard every sequence takes the longest piece left and then
the combination of available lengths that fills it best, found by subset-sum over
a bitset. Equal combinations are taken as often as their lengths last.
"""

from __future__ import annotations

import json
import math
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockpolicy.functions.session import stored
from stockpolicy.llm.common import map_batches, send_package, texts_of

CAPACITY = 2048
END = b"\0\0\0\0"  # id 0 after every document
SHARD_ROWS = 50_000
CACHED, CACHED_CHARS = 400_000, 48  # entries of a worker's cache (some 60 MB), longest entry

_loaded: dict[str, Encoder] = {}


class Encoder:
    """Token ids as little-endian 32-bit bytes, by the tokenizer file at `path`.

    A byte-level tokenizer never joins characters across a single space between
    others, so a text is cut there and equal words are looked up. A text with white
    space beside a space is encoded whole, and so is any text under another kind of
    tokenizer. Where the ids of a byte-level file rise with its merges, its table drives
    the faster of two libraries; the ids are the same.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.by_word = (
            spec.get("normalizer") is None
            and pre.get("type") == "ByteLevel"
            and pre.get("add_prefix_space") is False
        )
        self.fast = _byte_level(spec) if self.by_word else None
        self.known: dict[str, bytes | bool] = {}

    def whole(self, text: str) -> bytes:
        if self.fast:
            return array("I", self.fast(text)).tobytes()
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __call__(self, text: str) -> bytes:
        if not self.by_word:
            return self.whole(text)
        first, *words = text.split(" ")
        known = self.known
        ids = list(map(known.get, words))
        if None in ids:
            if len(known) > CACHED:
                known.clear()
            for i, w in enumerate(words):
                if ids[i] is None:
                    # White space beside a space: not to be cut there.
                    own = self.whole(" " + w) if w and w == w.strip() else False
                    ids[i] = own
                    if len(w) <= CACHED_CHARS:
                        known[w] = own
        if False in ids or first != first.strip() or (words and not first):
            return self.whole(text)
        return self.whole(first) + b"".join(ids)


def _byte_level(spec: dict):
    """An encoding function from the file's own table, or None if its ids don't rise with its merges."""
    import tiktoken

    model = spec["model"]
    letters = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    others = [b for b in range(256) if b not in letters]
    byte = {chr(b): b for b in letters} | {chr(256 + i): b for i, b in enumerate(others)}
    special = {t["content"] for t in spec.get("added_tokens", ())}
    ranks = {bytes(map(byte.__getitem__, t)): i for t, i in model["vocab"].items() if t not in special}
    pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    merged = [model["vocab"].get("".join(m), -1) for m in pairs]
    if merged != sorted(set(merged)) or len(ranks) != 256 + len(merged) or model.get("unk_token"):
        return None
    pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    own = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return own.encode_ordinary


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str | None) -> Encoder:
    """The worker's encoder for a tokenizer file, loaded once."""
    path = path or default_tokenizer()
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    return _loaded[path]


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: only the first may be shorter than capacity."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def pieces(docs: DataFrame, key: str = "doc_id", capacity: int = CAPACITY, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]) of every row's pieces.

    A null or empty text is the closing id alone. No ids are dropped.
    """
    schema = docs.select(key).schema
    schema = schema.add("piece", "integer").add("start", "long").add("length", "long").add("ids_crc32", "long")
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))

    def run(batch: pa.RecordBatch) -> dict:
        of, piece, start, length, crc, ids = [], [], [], [], [], []
        for i, raw in enumerate(map(encoder(tokenizer), texts_of(batch))):
            raw += END
            for k, (s, n) in enumerate(cuts(len(raw) // 4, capacity)):
                own = raw[4 * s : 4 * (s + n)]
                of.append(i)
                piece.append(k)
                start.append(s)
                length.append(n)
                crc.append(zlib.crc32(own))
                if with_ids:
                    ids.append(np.frombuffer(own, "<u4").astype(np.int32))
        out = {key: batch.column(key).take(pa.array(of, pa.int64())), "piece": piece, "start": start, "length": length, "ids_crc32": crc}
        return out | {"ids": ids} if with_ids else out

    return map_batches(docs.select(key, "text"), schema, run)


def fullest(available: list[tuple[int, int]], room: int) -> list[tuple[int, int]]:
    """The lengths, (length, times), whose sum comes closest to `room` from below.

    available: (length, count), longest first. Bit s of `reach` says that s can be
    summed; each length is added in powers of two, so its count bounds it.
    """
    reach, mask = 1, (1 << room + 1) - 1
    steps: list[tuple[int, int, int]] = []
    for length, count in available:
        if length > room:
            continue
        left, k = min(count, room // length), 1
        while left > 0:
            k = min(k, left)
            steps.append((length, k, reach))
            reach |= (reach << k * length) & mask
            left -= k
            k *= 2
        if reach >> room:
            break
    at, used = reach.bit_length() - 1, {}
    for length, k, before in reversed(steps):
        if not before >> at & 1:
            at -= k * length
            used[length] = used.get(length, 0) + k
    return list(used.items())


def combinations(counts: dict[int, int], capacity: int) -> Iterator[tuple[list[tuple[int, int]], int]]:
    """(combination, times) of sequences that use up all pieces; counts: pieces by length."""
    left = {n: c for n, c in counts.items() if c}
    order = sorted(left, reverse=True)
    while left:
        while order and order[0] not in left:
            order.pop(0)
        longest = order[0]
        rest = dict(left)
        rest[longest] -= 1
        available = [(n, rest[n]) for n in order if n in left and rest[n]]
        used = dict(fullest(available, capacity - longest)) if longest < capacity else {}
        used[longest] = used.get(longest, 0) + 1
        times = min(left[n] // k for n, k in used.items())
        yield sorted(used.items(), reverse=True), times
        for n, k in used.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece."""
    order = np.argsort(-lengths, kind="stable")
    values, firsts, counts = np.unique(-lengths[order], return_index=True, return_counts=True)
    at = {int(-v): int(f) for v, f in zip(values, firsts)}  # next unused piece of each length
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    number = 0
    for combination, times in combinations({int(-v): int(c) for v, c in zip(values, counts)}, capacity):
        place = 0
        for n, k in combination:
            for _ in range(k):
                rows = order[at[n] : at[n] + times]
                at[n] += times
                sequence[rows] = np.arange(number, number + times)
                offset[rows] = place
                place += n
        number += times
    return sequence, offset


def pack(cut: DataFrame, capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS, key: str = "doc_id") -> DataFrame:
    """The rows of `pieces` with sequence_id and offset.

    Pieces are dealt to shards by hash, and a shard packs alone: it has a bounded number of
    rows, and loses part of one sequence against packing everything at once. Runs a count.
    """
    send_package(cut.sparkSession)
    shards = max(1, math.ceil(cut.count() / shard_rows))
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64(key, "piece", "ids_crc32"), F.lit(shards)))
    schema = T.StructType([*cut.schema.fields, *(T.StructField(c, T.LongType()) for c in ("sequence_id", "offset"))])
    names = schema.names

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "ids_crc32", key, "piece"], ignore_index=True)
        sequence, offset = pack_lengths(rows["length"].to_numpy(np.int64), capacity)
        return rows.assign(sequence_id=(int(rows["shard"].iloc[0]) << 32) + sequence, offset=offset)[names]

    return dealt.groupBy("shard").applyInPandas(run, schema)


def packed(docs: DataFrame, key: str = "doc_id", capacity: int = CAPACITY, tokenizer: str | None = None, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, sequence_id, offset.

    Reads key and text. A null or empty text is one piece, the closing id. Repeated rows
    are packed each. An empty table gives none. Texts are read once. Runs jobs.
    """
    cut = stored(pieces(docs, key, capacity, tokenizer), "pieces")
    return pack(cut, capacity, shard_rows, key)


def sequences(docs: DataFrame, key: str = "doc_id", capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, capacity ids at most in each."""
    cut = stored(pieces(docs, key, capacity, tokenizer, with_ids=True), "pieces")
    put = pack(cut, capacity, SHARD_ROWS, key)
    parts = put.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return parts.select("sequence_id", F.flatten(F.col("p.ids")).alias("ids"))
