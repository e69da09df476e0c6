"""HTML extraction, toxicity, shared passages."""

import html
import re
import zlib

import numpy as np
import pytest

from stockpolicy.llm import boosting, html_extract, substring_dedup, toxicity

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{SMALL}/pages.parquet")


@pytest.fixture(scope="module")
def forest(pages):
    return html_extract.train(pages)


def article(source):
    inner = re.search("<article>(.*)</article>", source, re.S)[1]
    return " ".join(html.unescape(re.sub("<[^>]*>", " ", re.sub("</?b>", "", inner))).split())


def test_pages_equal_their_articles(pages, forest):
    got = {r["page_id"]: r for r in html_extract.extract(pages, forest).collect()}
    for r in pages.collect():
        assert got[r["page_id"]]["text"] == article(r["html"])
        assert got[r["page_id"]]["n_chars"] == len(article(r["html"]))


def test_other_layouts_held_out(forest):
    rng = np.random.default_rng(123)
    paragraphs = [" ".join(rng.choice("some words that make a plain sentence of text today".split(), 30)) + "." for _ in range(40)]
    short = ["Home page", "About us", "Read more", "Contact", "A longer title of things", "News"]
    right = wrong = 0
    for _ in range(80):
        page = html_extract.Page(html_extract.composed(rng, paragraphs, short))
        chosen = page.decode(boosting.log_probabilities(forest, page.features()))
        for n, t in page.pieces:
            if n >= 0 and ("\x01" in t or "\x02" in t):
                ok = ("\x01" in t) == (chosen[n] == html_extract.MAIN)
                right, wrong = right + ok * len(t), wrong + (not ok) * len(t)
    assert right / (right + wrong) > 0.97


def paragraphs_of(source):
    return re.findall("<p>.*?</p>", re.search("<article>(.*)</article>", source, re.S)[1], re.S)


INSERTED = {
    "links in the last paragraph": ('<p>See <a href="/x">this page</a> and <a href="/y">that one</a>.</p>', " See this page and that one."),
    "a list of sources": ('<ul><li><a href="/a">First source</a></li><li><a href="/b">Second source</a></li></ul>', " First source Second source"),
    "a linked name": ('<p>Text by <a href="/who">A. Writer</a></p>', " Text by A. Writer"),
    "a form": ('<form action="/s"><label>Email</label><input name=q><button>Subscribe</button></form>', ""),
    "a form with paragraphs": ("<form><p>Your name</p><input><p>Send it</p></form>", ""),
}


@pytest.fixture(scope="module")
def held_out(pages):
    """A forest that has seen a third of the pages, and the others."""
    sources = [r["html"] for r in pages.orderBy("page_id").collect()]
    return boosting.fit(*html_extract.examples(sources[::3]), classes=3), [s for i, s in enumerate(sources) if i % 3]


def test_unseen_pages_equal_their_articles(held_out):
    model, sources = held_out
    assert [t == article(s) for t, s in zip(html_extract.main_texts(sources, model), sources)].count(False) == 0


@pytest.mark.parametrize("kind", INSERTED)
def test_links_and_forms_in_the_article(held_out, kind):
    model, sources = held_out
    added, text = INSERTED[kind]
    changed = [s.replace("</article>", added + "</article>") for s in sources]
    got = html_extract.main_texts(changed, model)
    assert np.mean([g == article(s) + text for g, s in zip(got, sources)]) > 0.95


def test_a_form_between_two_paragraphs(held_out):
    model, sources = held_out
    some = [(s, paragraphs_of(s)) for s in sources]
    some = [(s, p[0]) for s, p in some if len(p) > 1]
    for kind in ("a form", "a form with paragraphs"):
        got = html_extract.main_texts([s.replace(p, p + INSERTED[kind][0], 1) for s, p in some], model)
        assert np.mean([g == article(s) for g, (s, _) in zip(got, some)]) > 0.95


def test_an_article_without_its_element(held_out):
    """The heading and the text of a plain div, all else as it was."""
    model, sources = held_out
    got = html_extract.main_texts([s.replace("<article>", "<div>").replace("</article>", "</div>") for s in sources], model)
    assert np.mean([g == article(s) for g, s in zip(got, sources)]) > 0.95


KINDS = [  # layouts that the generator does not draw; {0} is the article, {1} to {4} are short texts
    "<body><table><tr><td><a href=/>{1}</a> <a href=/>{2}</a> <a href=/>{3}</a></td></tr><tr><td>{0}</td></tr><tr><td>&copy; {4}</td></tr></table>",
    "<body><center><a href=/>{1}</a> | <a href=/>{2}</a> | <a href=/>{3}</a></center><hr>{0}<hr><address>{4}</address>",
    "<body><div><div><span><a href=/>{1}</a></span><span><a href=/>{2}</a></span></div></div><main><div><div>{0}</div></div></main><div><small>{4}</small></div>",
    "<body><header><nav><a href=/>{1}</a><a href=/>{2}</a></nav></header><div role=main>{0}</div><footer><p>{3}</p><p>{4}</p></footer>",
]


@pytest.mark.parametrize("layout", KINDS)
def test_layout_kinds_held_out(held_out, layout):
    model, sources = held_out
    right = total = 0
    for s in sources[:60]:
        inner = re.search("<article>(.*)</article>", s, re.S)[1]
        page = "<html><head><title>x</title></head>" + layout.format(inner, "Home", "News", "About us", "Some Company 2020") + "</body></html>"
        want, got = article(s).split(), html_extract.main_texts([page], model)[0].split()
        extra = len(got) - len(want)
        right += len(want) if " ".join(want) in " ".join(got) and extra <= 4 else 0
        total += len(want)
    assert right / total > 0.9


def test_a_pure_node_settles_what_is_below(forest):
    page = html_extract.Page("<body><div><p>a</p><p>b<i>c</i></p></div><div>d<p>e</p>f</div></body>")
    rng = np.random.default_rng(1)
    for _ in range(50):
        logs = np.log(rng.dirichlet([1, 1, 1], len(page.tag)))
        chosen = page.decode(logs)
        for i, p in enumerate(page.parent):
            if p >= 0 and chosen[p] != html_extract.MIXED:
                assert chosen[i] == chosen[p]


def test_decoding_is_the_best_labelling():
    page = html_extract.Page("<body><div><p>a</p><p>b</p></div><p>c</p></body>")
    n = len(page.tag)
    leaf = [i not in page.parent for i in range(n)]
    rng = np.random.default_rng(2)
    for _ in range(30):
        logs = np.log(rng.dirichlet([1, 1, 1], n))
        best = max(
            (sum(logs[i, s] for i, s in enumerate(states)), states)
            for states in np.ndindex(*[3] * n)
            if all(not (leaf[i] and s == 2) and (page.parent[i] < 0 or states[page.parent[i]] in (2, s)) for i, s in enumerate(states))
        )
        assert tuple(page.decode(logs)) == best[1]


@pytest.mark.parametrize("source", ["", "   ", "<", "<p", "<script>x", "<!-- a", "</p></div>", "<p>a<p>b</b></i>", "<div>" * 300 + "x", "<a href='x>y", "&amp &nosuch; &#x41;"])
def test_broken_pages_are_read(source, forest):
    assert isinstance(html_extract.main_texts([source], forest)[0], str)


def whole(source):
    page = html_extract.Page(source)
    return page.text(np.zeros(len(page.tag), int))


@pytest.mark.parametrize("source", [
    "<html><head><meta charset=utf-8><title>x</title><body><article><p>a b</p><p>c</p></article></body></html>",
    "<head><title>x</title><link href=y><style>p {}</style><article><p>a b<p>c</article>",
    "<head><noscript><link href=y></noscript><script>z</script><body class=post>a b <p>c",
    "<head><title>x</title>a b<p>c",
    "<head></body><p>a b</p>c",
    "<html><head><title>x</title></head><body><p>a b</p>c</body></html>",
])
def test_head_without_an_end_tag(source):
    assert whole(source) == "a b c"


@pytest.mark.parametrize("source", [
    "<p><svg class=icon viewBox='0 0 9 9'/>a b</p>c",
    "<p><math/>a <svg><path d=m /><style/><title/><g>b</g></svg></p>c",
    "<svg><path d=m><p>a b<div>c</div>",
    "<p>a <math><mi>b</mi></math></p><noscript>c</noscript>",
    "<p>a <object data=x>b</object> <video><source src=x>c</video></p>",
    "<button>a<p>b</p><div><select><option>c</div>",
    "<script>x<p></script><p>a<style>y</style> b<textarea>z</textarea><template><p>w</p></template></p><iframe>v</iframe>c",
])
def test_only_raw_elements_lose_their_text(source):
    assert whole(source) == "a b c"


def test_an_icon_before_the_article(pages, forest):
    for icon in ("<svg class='icon'/>", "<math/>", "<button>", "<svg><path d='m'>"):
        for r in pages.orderBy("page_id").limit(10).collect():
            assert html_extract.main_texts([r["html"].replace("<article>", icon + "<article>")], forest)[0] == article(r["html"])


def test_article_of_a_page_without_head_end(pages, forest):
    for r in pages.orderBy("page_id").limit(20).collect():
        cut = re.sub("</head>|</?body[^>]*>", "", r["html"])
        assert html_extract.main_texts([cut], forest)[0] == article(r["html"])


def test_references_space_and_breaks():
    page = html_extract.Page("<article><p>a&nbsp;&lt;b&gt;<b>c</b>d\n  e<br>f</p><p>g</p></article>")
    assert page.text(np.zeros(len(page.tag), int)) == "a <b>cd e f g"


def test_odd_pages(spark, forest):
    rows = [(1, None, None), (None, "u", "<p>x</p>"), (2, "u", ""), (2, "u", ""), (3, "u", "<article><p>" + "long text " * 40_000 + "</p></article>")]
    table = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, text string")
    got = html_extract.extract(table, forest)
    assert got.columns == ["page_id", "url", "text", "n_chars"] and got.count() == 5
    assert got.filter("page_id = 1").first()["text"] == "" and got.filter("page_id = 3").first()["n_chars"] == 399_999
    assert html_extract.extract(table.limit(0)).count() == 0


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    got = toxicity.score(docs.join(labels.select("doc_id"), "doc_id"), model).toPandas().merge(labels.toPandas(), on="doc_id")
    held = got[got.held_out]
    assert held.held_out.tolist() == [zlib.crc32(str(i).encode()) % 4 == 2 for i in held.doc_id]
    toxic = held[held.toxic == 1]
    assert (toxic.predicted == 1).mean() > 0.85 and (held[held.toxic == 0].predicted == 1).mean() < 0.03


def test_toxicity_odd_rows(odd, nothing, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.train(nothing, none)
    got = toxicity.score(odd, model)
    assert got.count() == odd.count() and got.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0
    assert toxicity.score(nothing, model).count() == 0
    assert toxicity.train(odd, none).bias < 0


def test_label_model_learns_accuracies():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.3
    right = [0.95, 0.85, 0.7, 0.55]
    votes = np.stack([np.where(rng.random(4000) < a, 2 * y - 1, 1 - 2 * y) for a in right], 1).astype(np.int8)
    votes = np.concatenate([votes, votes[:, 1:2], votes[:, 1:2]], 1)  # copies of a voter
    posterior, _ = toxicity.label_model(votes, np.zeros(4000, np.int8), 0.3)
    assert ((posterior > 0.5) == y).mean() > 0.93


def test_chain_is_the_best_chain():
    """Against all predecessors, without the tree."""
    rng = np.random.default_rng(5)
    for _ in range(40):
        n = int(rng.integers(1, 14))
        a, b = rng.integers(0, 30, n), rng.integers(0, 30, n)
        found = substring_dedup.chain(a, b)
        assert sorted(i for c in found for i in c) == list(range(n))
        order = sorted(range(n), key=lambda i: (a[i], b[i]))
        best = {}
        for i in order:
            best[i] = 5 + max([0] + [best[p] - 0.05 * (a[i] + b[i] - a[p] - b[p]) for p in order if a[p] < a[i] and b[p] < b[i]])
        path = found[0]
        cost = 5 * len(path) - 0.05 * (a[path[-1]] + b[path[-1]] - a[path[0]] - b[path[0]])
        assert abs(cost - max(best.values())) < 1e-9


def words(rng, n):
    return [f"w{x}" for x in rng.integers(0, 5000, n)]


def test_planted_passages(spark):
    rng = np.random.default_rng(7)
    passage, fuzzy = words(rng, 60), words(rng, 120)
    rows = []
    for i in range(40):
        own = words(rng, 200)
        if i % 4 == 0:
            own[50:50] = passage
        if i % 4 == 1:
            edited = fuzzy.copy()
            for k in rng.choice(120, 6, replace=False):
                edited[k] = f"e{i}x{k}"
            own[20:20] = edited
        rows.append((i, " ".join(own)))
    rows += [(100, rows[2][1]), (101, rows[2][1]), (102, None), (103, ""), (104, "only a few words"), (None, rows[2][1]), (104, "again")]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, at string").repartition(4)
    got = substring_dedup.passages(docs).toPandas()
    assert set(got.doc_id) == {i for i in range(40) if i % 4 < 2} | {2, 100, 101}
    exact = got[got.doc_id.isin(range(0, 40, 4))]
    assert (exact.identity == 1).all() and (exact.end_word - exact.start_word >= 60).all() and (exact.start_word == 50).all()
    assert (got[got.doc_id.isin(range(1, 40, 4))].identity >= 0.8).all()
    # A hot passage costs a few rows a text, not all pairs.
    assert len(got) <= 5 * got.doc_id.nunique()


def test_a_passage_whose_heads_differ(spark):
    """Heads that hold either half only, alone and in crowds."""
    for seed, heads in ((19, [(3, 100), (4, 101)]), (23, [(1, 2, 3, 4, 100, 101), (5, 6, 7, 102, 103, 104)])):
        rng = np.random.default_rng(seed)
        passage = words(rng, 80)
        rows = [(i, " ".join(words(rng, 90) + passage[40 * h : 40 * h + 40] + words(rng, 90))) for h in (0, 1) for i in heads[h]]
        rows += [(i, " ".join(words(rng, 50) + passage + words(rng, 50))) for i in (50, 60)]
        got = substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
        assert set(zip(got.doc_id, got.other_doc_id)) == {(50, 60), (60, 50)}
        assert (got.start_word <= 50).all() and (got.end_word >= 130).all()


def test_a_passage_beyond_another(spark):
    """Two texts share 80 words, of which the heads hold the first 60."""
    rng = np.random.default_rng(29)
    passage = words(rng, 80)
    rows = [(i, " ".join(words(rng, 50) + passage[: 80 if i in (50, 60) else 60] + words(rng, 50))) for i in (1, 2, 50, 60, 90)]
    got = substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    assert set(got.doc_id) == {1, 2, 50, 60, 90}
    assert (got[got.doc_id.isin([50, 60])].groupby("doc_id").end_word.max() >= 130).all()


def test_a_passage_held_twice(spark):
    rng = np.random.default_rng(17)
    passage = words(rng, 80)
    rows = [(i, " ".join(words(rng, 60) + passage + words(rng, 60) + (passage if i % 2 else []) + words(rng, 20))) for i in range(1, 8)]
    got = substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    for i in range(1, 8):
        assert set(got[(got.doc_id == i) & (got.end_word - got.start_word >= 80)].start_word) >= {60, *([200] if i % 2 else [])}


def test_a_word_over_and_over(spark):
    """Runs of one word or of a short line, of any lengths, are shared passages from LEAST words on."""
    rng = np.random.default_rng(31)
    line = words(rng, 3)
    rows = [(1, ["the"] * 300), (2, words(rng, 80) + ["the"] * 70 + words(rng, 80)), (3, words(rng, 30) + ["the"] * 20 + words(rng, 30))]
    rows += [(4, line * 60), (5, words(rng, 40) + line * 20), (6, words(rng, 20) + line * 8 + words(rng, 20)), (7, words(rng, 100))]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    got = substring_dedup.passages(docs).toPandas()
    held = {i: {w for s, e in zip(g.start_word, g.end_word) for w in range(s, e)} for i, g in got.groupby("doc_id")}
    assert set(held) == {1, 2, 4, 5}
    assert held[1] >= set(range(300)) and held[2] >= set(range(80, 150)) and held[4] >= set(range(180)) and held[5] >= set(range(40, 100))
    text = dict(rows)
    for r in got[got.identity == 1].itertuples():
        assert text[r.doc_id][r.start_word : r.end_word] == text[r.other_doc_id][r.other_start_word : r.other_end_word]


def test_a_common_line_costs_its_texts(spark, monkeypatch):
    """A line that is no passage is not compared in all pairs of its texts; a passage in two of them is found."""
    rng = np.random.default_rng(37)
    line, rest, n = words(rng, 25), words(rng, 25), 150
    rows = [(i, " ".join(words(rng, 60) + line + (rest if i in (70, 80) else words(rng, 25)) + words(rng, 60))) for i in range(n)]
    counts, compared = [], substring_dedup._compared

    def counted(texts, found):
        counts.append(found.count())
        return compared(texts, found)

    monkeypatch.setattr(substring_dedup, "_compared", counted)
    got = substring_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    assert {(70, 80), (80, 70)} <= set(zip(got.doc_id, got.other_doc_id)) and set(got.doc_id) == {70, 80}
    assert sum(counts) < 100 * n


def test_equal_runs_are_those_of_brute_force():
    """Every run of LEAST words that both texts have is offered by both, whatever seeds are known."""
    rng = np.random.default_rng(41)
    for k in range(20):
        run = words(rng, 70) if k % 2 else [f"w{x}" for x in rng.integers(0, 2, 90)]
        sides = [" ".join(words(rng, int(rng.integers(0, 60))) + run + words(rng, int(rng.integers(0, 60)))).encode() for _ in (0, 1)]
        hashes = [substring_dedup.word_hashes([t])[0] for t in sides]
        text, place, seed = substring_dedup.seeds(*substring_dedup.word_hashes(sides))
        both = set(seed[text == 0]) & set(seed[text == 1])
        held = [np.array([p for p, s in zip(place[text == i], seed[text == i]) if s in both], int) for i in (0, 1)]
        found = [dict(zip(*(v.tolist() for v in substring_dedup.equal_runs(hashes[i], held[i], held[i])))) for i in (0, 1)]
        runs = [{i: tuple(t.split()[i : i + 50]) for i in range(len(t.split()) - 49)} for t in sides]
        shared = set(runs[0].values()) & set(runs[1].values())
        for i in (0, 1):
            first = {r for p, r in runs[i].items() if p in found[i]}
            assert shared <= first
        assert len({found[0][p] for p in found[0] if runs[0][p] in shared} & set(found[1].values())) == len(shared)


def test_every_run_shares_a_seed():
    rng = np.random.default_rng(9)
    run = [w.encode() for w in words(rng, substring_dedup.SHINGLE + substring_dedup.WINDOW - 1)]
    for _ in range(30):
        sides = [b" ".join([w.encode() for w in words(rng, int(rng.integers(0, 40)))] + run + [b"z%d" % s] * 3) for s in (0, 1)]
        text, _, seed = substring_dedup.seeds(*substring_dedup.word_hashes(sides))
        assert set(seed[text == 0]) & set(seed[text == 1])


def test_passages_of_nothing(nothing):
    assert substring_dedup.passages(nothing).count() == 0


def test_documents_equal_brute_force(documents):
    docs = {r["doc_id"]: r["text"].encode().lower().split() for r in documents.collect()}
    seen: dict = {}
    for d, w in docs.items():
        for i in range(len(w) - 49):
            seen.setdefault(tuple(w[i : i + 50]), set()).add(d)
    want = {d for ds in seen.values() if len(ds) > 1 for d in ds}
    got = {r["doc_id"] for r in substring_dedup.passages(documents).select("doc_id").collect()}
    assert want <= got
