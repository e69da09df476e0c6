"""The Jaccard join through token groups against all pairs."""

import random

import duckdb
import numpy as np
import pytest

from stockpolicy.llm import token_groups as tg

SCHEMA = "doc_id long, text string"


def shingles(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).replace("\x0b", " ").replace("\x0c", " ")
    words = [w for w in words.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def brute_force(rows, share=(80, 100)):
    """Sorted (key, n, component id) of (key, text) rows."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    held = {}
    for i, s in enumerate(sets):
        for token in s:
            held.setdefault(token, []).append(i)
    for i, s in enumerate(sets):
        common = {}
        for token in s:
            for j in held[token]:
                if j < i:
                    common[j] = common.get(j, 0) + 1
        for j, c in common.items():
            if share[1] * c >= share[0] * (len(s) + len(sets[j]) - c):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return sorted(
        ((k, len(s), least.get(find(i)) if s else k) for i, ((k, _), s) in enumerate(zip(rows, sets))), key=str
    )


def result(df, **kw):
    return sorted(map(tuple, tg.jaccard_components(df, **kw).collect()), key=str)


def test_documents_equal_brute_force(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    got = result(documents)
    assert got == brute_force(rows)
    assert len({c for _, _, c in got}) < len(rows) - 50  # copies and near copies were found


def planted(seed, n=160):
    """Near copies around the limit, a passage shared by most texts, and a family of chained edits."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    passage = " ".join(rnd.choices(words, k=40))
    rows, key = [], 1000
    for i in range(n):
        base = rnd.choices(words, k=rnd.choice([5, 12, 30, 80, 300]))
        for _ in range(rnd.choice([1, 1, 2, 4])):
            own = list(base)
            for at in rnd.sample(range(len(own)), k=rnd.choice([0, 0, 1, 2, max(1, len(own) // 40)]) % (len(own) + 1)):
                own[at] = rnd.choice(words)
            text = " ".join(own)
            rows.append((key, text if rnd.random() < 0.3 else f"{text} {passage}"))
            key -= 1
    chain = rnd.choices(words, k=200)
    for i in range(40):  # each differs from the one before in a word, the ends share little
        chain = [*chain[: i * 5], rnd.choice(words), *chain[i * 5 + 1 :]]
        rows.append((key, " ".join(chain)))
        key -= 1
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("stars", [0, 2])
def test_planted_near_copies_equal_brute_force(spark, stars, monkeypatch):
    """Compared at once, and after rounds of stars."""
    monkeypatch.setattr(tg, "STARS", stars)
    rows = planted(stars)
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert result(df) == brute_force(rows)


def test_another_share(spark):
    rows = planted(3, 60)
    assert result(spark.createDataFrame(rows, SCHEMA), share=(1, 2)) == brute_force(rows, (1, 2))


def test_many_near_copies_of_one_text(spark):
    """One family of 700, far more than a group holds, and a common passage beside it."""
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(900)]
    base = rnd.choices(words, k=150)
    rows = []
    for i in range(700):
        own = list(base)
        for at in rnd.sample(range(150), k=rnd.choice([1, 2, 3])):
            own[at] = f"x{i}y{at}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, " ".join([*rnd.choices(words, k=60), *base[:20]])) for i in range(200)]
    assert result(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute_force(rows)


def test_exactly_at_the_limit(spark):
    """8 of 10 shingles in common link, 7 of 9 do not."""
    a = "a b c d e f g h i j k l".split()  # 8 shingles
    rows = [(1, " ".join(a)), (2, " ".join([*a, "m", "n"])), (3, " ".join(["q", "r", *a[:11]]))]
    sets = [shingles(t) for _, t in rows]
    assert (len(sets[0] & sets[1]), len(sets[0] | sets[1])) == (8, 10)
    assert (len(sets[0] & sets[2]), len(sets[0] | sets[2])) == (7, 10)
    assert result(spark.createDataFrame(rows, SCHEMA)) == [(1, 8, 1), (2, 10, 1), (3, 9, 3)]


def test_odd_rows(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert result(odd) == brute_force(rows)


def test_nothing_and_empty_texts(spark, nothing):
    assert result(nothing) == []
    rows = [(2, None), (1, ""), (3, " \n\t"), (None, None)]
    assert result(spark.createDataFrame(rows, SCHEMA)) == sorted([(2, 0, 2), (1, 0, 1), (3, 0, 3), (None, 0, None)], key=str)


def test_a_union_bounds_its_members():
    """The bound is never below a member's overlap, and members' overlaps are exact."""
    rnd = np.random.default_rng(6)
    pool = np.unique(rnd.integers(0, 2**63, 300).astype(np.uint64))
    sets = [np.sort(rnd.choice(pool, size=k, replace=False)) for k in (5, 60, 120, 200)] + [pool]
    group = tg.Group(list(range(5)), sets)
    for own in sets:
        assert group.member([s is own for s in sets].index(True)).tolist() == own.tolist()
        want = [len(np.intersect1d(own, s)) for s in sets]
        assert group.overlaps(own, (80, 100)).tolist() == want
    stranger = np.arange(50, dtype=np.uint64)
    assert group.overlaps(stranger, (80, 100)) is None  # not opened


def test_only_postings_without_a_partner_are_dropped():
    rnd = np.random.default_rng(10)
    for _ in range(200):
        m = int(rnd.integers(1, 12))
        token, n = rnd.integers(0, 3, m).astype(np.uint32), rnd.integers(1, 15, m).astype(np.int32)
        order = np.lexsort((n, token))
        token, n = token[order], n[order]
        indexed = rnd.random(m) < 0.5
        got = tg.in_reach(token, np.where(indexed, n, -n), (80, 100))
        for i in range(m):
            partner = any(
                token[i] == token[j] and i != j and (
                    (j < i and indexed[j] and 100 * n[j] >= 80 * n[i]) or (i < j and indexed[i] and 100 * n[i] >= 80 * n[j])
                ) for j in range(m)
            )
            assert got[i] == partner


def test_frequent_tokens_come_last():
    tokens = np.sort(np.random.default_rng(7).integers(0, 2**64, 40, dtype=np.uint64))
    ranges, low = tg._ranges(tokens, 3)
    codes = ((ranges << 32) + low)[[4, 9]]
    order = tg.in_order(tokens, codes, np.array([1, 0], np.uint64), 3).tolist()
    assert order[-2:] == [tokens[9], tokens[4]] and sorted(order) == tokens.tolist()
    assert order[:-2] == [t for i, t in enumerate(tokens.tolist()) if i not in (4, 9)]


def test_word_hashes_tell_words_apart():
    rnd = random.Random(9)
    words = {"".join(rnd.choices("abcdefgh", k=rnd.randrange(1, 9))) for _ in range(20_000)}
    words |= {"x" * k for k in range(1, 300)} | {"ab" * k for k in range(1, 90)} | {"é", "e\u0301", "ſ", "s", "\xa0", "\x00", "0"}
    words = sorted(words)
    raw = "\x0b".join(words).encode()
    hashes, starts = tg.word_hashes(raw)
    assert len(starts) == len(words) == len(np.unique(hashes))
    upper = raw.replace(b"abc", b"ABC").replace(b"x", b"X")
    again, _ = tg.word_hashes(b"\t\n " + upper + b"  ")
    assert (again == hashes).all()  # wherever a word stands, in either case
    assert [len(x) for x in tg.word_hashes(b"")] == [0, 0]


def test_sets_do_not_depend_on_slices(monkeypatch):
    texts = [t.encode() for _, t in planted(5, 30)] + [b"", b" ", b"one two"]
    want = [s.tolist() for s in tg.shingle_sets(texts)]
    monkeypatch.setattr(tg, "SLICE_BYTES", 100)
    assert [s.tolist() for s in tg.shingle_sets(texts)] == want
    assert [len(s) for s in want] == [len(shingles(t.decode())) for t in texts]


def test_a_shared_name_is_resolved():
    a = np.arange(5, dtype=np.uint64)
    first, second = tg.identity(a)
    assert tg.identity(a, frozenset([first])) == (second, first)


def test_sql_equals(spark):
    from support import SMOKE

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMOKE}/documents.parquet'")
    found = con.execute(tg.oracle())
    names = [d[0] for d in found.description]
    got = tg.jaccard_components(spark.read.parquet(f"{SMOKE}/documents.parquet")).select(*names)
    assert sorted(map(tuple, got.collect())) == sorted(found.fetchall())
