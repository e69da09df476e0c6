import zlib

import numpy as np
import pytest

from stockpolicy.llm import quality_classifier, quality_rules

SMALL = "/root/testdata/sf0.01"


def plain_repeats(words):
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    return len({p for at in windows.values() if len(at) > 1 for i in at for p in range(i, i + 8)})


def test_repeated_words_equal_brute_force():
    rng = np.random.default_rng(1)
    texts = [[f"w{x}".encode() for x in rng.integers(0, k, n)] for k, n in ((2, 40), (3, 300), (50, 200), (1, 7), (1, 30), (9, 0))]
    got = quality_rules.repeated_words([w for t in texts for w in t], np.array([len(t) for t in texts]))
    assert got.tolist() == [plain_repeats(t) for t in texts]


def test_counts():
    text = "Ab é|d\n\nAb é|d\n#x\x0b"
    got = quality_rules.text_counts([text.encode(), b""])
    assert {c: v.tolist() for c, v in got.items()} == {
        "n_words": [5, 0], "word_chars": [12, 0], "n_symbols": [3, 0], "n_lines": [3, 0],
        "n_dup_lines": [1, 0], "n_repeat_words": [0, 0], "n_upper": [2, 0], "n_again": [0, 0],
    }


def test_sketch_quantiles_are_close(spark):
    rng = np.random.default_rng(3)
    x = rng.lognormal(1, 0.7, 4000)
    rows = [("en", "s", 1000, int(v * 1000), 0, 1, 0, 0, 0, 0) for v in x]
    counts = spark.createDataFrame(rows, "lang string, source string, " + ", ".join(f"{c} long" for c in quality_rules.COUNTS))
    q = quality_rules._quartiles(quality_rules.sketches(counts), ["lang", "source"]).filter("measure = 'word_length'").first()
    for got, want in zip((q["q1"], q["q2"], q["q3"]), np.quantile(x, [0.25, 0.5, 0.75])):
        assert abs(got / want - 1) < 0.03


def test_odd_rows(odd):
    rows = {(r["doc_id"], r["n_words"]): r for r in quality_rules.judge(odd).collect()}
    assert quality_rules.judge(odd).count() == odd.count()
    assert rows[3, 0]["base_failed"] and not rows[3, 0]["kept"]
    assert rows[1, 60]["kept"]
    kept = quality_rules.apply_rules(odd)
    assert kept.columns == odd.columns and kept.dtypes == odd.dtypes
    want = sorted(str(r["doc_id"]) for r in quality_rules.judge(odd).filter("kept").collect())
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == want


def test_empty(nothing):
    assert quality_rules.judge(nothing).count() == 0
    assert quality_rules.apply_rules(nothing).count() == 0


def test_a_source_is_held_against_itself(spark):
    plain = "some words of quiet prose that go on for a while and never repeat at all in this row number {} okay then good"
    loud = plain.upper()
    rows = [(i, plain.format(i), "en", "plain", 1) for i in range(300)] + [(1000 + i, loud.format(i), "en", "loud", 1) for i in range(300)]
    rows += [(5000, loud.format(5000), "en", "plain", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    dropped = [r["doc_id"] for r in quality_rules.judge(docs).filter("NOT kept").collect()]
    assert dropped == [5000]


def test_limits_change_smoothly_with_a_group(spark):
    """A loud source of growing size: its own limit takes over without a step."""
    plain = "some words of quiet prose that go on for a while and never repeat at all in this row number {} okay then good"
    base = [(i, plain.format(i), "en", "plain", 1) for i in range(400)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    highs = []
    for n in (1, 30, 99, 100, 101, 199, 200, 201, 2000, 8000):
        rows = base + [(1000 + i, plain.upper().format(i), "en", "loud", 1) for i in range(n)]
        counts = quality_rules.with_counts(spark.createDataFrame(rows, schema), ["lang", "source"], {c: c for c in quality_rules.COUNTS})
        limit = quality_rules.limits(quality_rules.sketches(counts)).filter("source = 'loud'").first()
        highs.append(limit["high_upper"])
    assert highs[0] < 1 < highs[-1]
    # No step anywhere: a row more or less moves a limit by little, and it settles at the group's own.
    assert max(abs(highs[i] - highs[i + 1]) for i in (2, 3, 5, 6)) < 0.03 and abs(highs[-1] - highs[-2]) < 0.1


def test_mid_level_junk_is_dropped_where_groups_are_large(spark):
    rng = np.random.default_rng(8)
    words = [f"word{i}" for i in range(500)]
    rows = [(i, " ".join(rng.choice(words, 60)) + ".", "en", f"s{i % 2}", 1) for i in range(800)]
    junk = {9001: " ".join(w + "##" for w in rng.choice(words, 60)), 9002: " ".join(np.repeat(rng.choice(words, 30), 2)), 9003: " ".join(w * 9 for w in rng.choice(words, 40))}
    rows += [(k, t, "en", "s0", 1) for k, t in junk.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    dropped = {r["doc_id"] for r in quality_rules.judge(docs).filter("NOT kept").collect()}
    assert dropped == set(junk)


def test_limits_stay_in_order_and_grades_are_told_apart():
    rng = np.random.default_rng(0)
    texts, grades = [], []
    for g, words in enumerate((["bad!!", "%%%x"], ["plain", "words"], ["fine", "prose", "here"])):
        for _ in range(60):
            texts.append(" ".join(rng.choice(words + ["the", "of"], 30)))
            grades.append(g)
    rows = quality_classifier.flat([quality_classifier.features(t) for t in texts])
    model = quality_classifier.fit(*rows, np.array(grades), 3)
    assert (np.diff(model.limits) > 0).all()
    p = quality_classifier.above(model, texts)
    assert (p[:, 0] >= p[:, 1]).all()
    assert (np.abs(p.sum(1) - np.array(grades)) < 0.5).mean() > 0.95


def test_gradient_is_that_of_the_likelihood():
    """One small step along the fitted direction raises the likelihood from every start."""
    texts, grades = ["a b c", "a x", "y z z", "y"], np.array([0, 1, 2, 2])
    rows = quality_classifier.flat([quality_classifier.features(t) for t in texts])

    def likelihood(m):
        p = np.concatenate([np.ones((4, 1)), quality_classifier.above(m, texts), np.zeros((4, 1))], 1)
        return np.log(p[np.arange(4), grades] - p[np.arange(4), grades + 1]).sum()

    fits = [likelihood(quality_classifier.fit(*rows, grades, 3, epochs=n, rate=0.05)) for n in (1, 5, 20, 80)]
    assert fits == sorted(fits)


def test_held_out_accuracy_and_odd_rows(spark, documents, odd, nothing):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = quality_classifier.train(documents, quality_classifier.graded(labels))
    scored = quality_classifier.score(documents, model).toPandas()
    both = scored.merge(labels.toPandas(), on="doc_id")
    held = both[[zlib.crc32(str(i).encode()) % 4 == 2 for i in both.doc_id]]
    assert (held.kept == (held.quality == 1)).mean() > 0.95
    assert quality_classifier.score(odd, model).count() == odd.count()
    assert quality_classifier.score(nothing, model).count() == 0
    bare = quality_classifier.train(nothing, labels.limit(0).selectExpr("doc_id", "quality AS grade"))
    assert not bare.weights.any()


def test_missing_labels_give_no_grade(spark, documents):
    rows = [(1, 0, None), (2, 1, 0), (3, 1, 1), (4, None, 1), (5, None, None), (6, 1, None), (7, 0, 1), (None, 1, 0)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["grade"] for r in quality_classifier.graded(labels).collect()}
    want = {1: 0, 2: 2, 3: 1, 4: None, 5: None, 6: None, 7: 0, None: 2}
    assert got == {k: v for k, v in want.items() if k is None or zlib.crc32(str(k).encode()) % 4 != 2}
    only_null = spark.createDataFrame([(i, None, None) for i in range(50)], labels.schema)
    assert not quality_classifier.train(documents, quality_classifier.graded(only_null)).weights.any()


def test_scores_equal_brute_force(spark, documents):
    """Expected grade and tail probability against the formula, text by text."""
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = quality_classifier.train(documents, quality_classifier.graded(labels))
    texts = {r["doc_id"]: r["text"] or "" for r in documents.select("doc_id", "text").collect()}
    for r in quality_classifier.score(documents, model).filter("doc_id % 10 = 0").collect():
        places, values = quality_classifier.features(texts[r["doc_id"]])
        score = sum(float(v) * float(model.weights[p]) for p, v in zip(places, values))
        tails = [1 / (1 + np.exp(limit - score)) for limit in model.limits]
        assert r["expected_grade"] == pytest.approx(sum(tails)) and r["tail_probability"] == pytest.approx(tails[0])
        assert r["kept"] == (tails[0] >= 0.5)


@pytest.mark.parametrize("name", ["op2_quality_rules"])
def test_sql(spark, name):
    import __spark_entry__ as entry
    from checks.compare import compare, connect

    folder = "/root/testdata/sf0.001"
    assert compare(spark, connect(folder), folder, entry.queries()[name], entry.oracle_sql()[name]) is None


