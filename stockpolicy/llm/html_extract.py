"""Main text of HTML pages: boosted trees over DOM nodes, decoded down the tree.

Each block element is main text, not main text, or mixed. The trees look at the subtree (text,
links, tags), attribute words, depth, position, siblings and ancestors. A node that is
all one thing settles everything below it; only a mixed node's children may differ.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockpolicy.llm import boosting
from stockpolicy.llm.common import bounded_sample, map_batches, texts_of

SAMPLE = 240  # pages to train on; the bound of the fit

# HTML's element kinds.
RAW = "script style textarea title template iframe"  # their content is no text
FOREIGN = {"svg", "math"}  # what is inside runs on in its line, and "/>" ends an element
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark nobr q s samp "
    "small span strike strong sub sup time tt u var wbr picture source".split()
)
HEAD = set("base basefont bgsound link meta noframes noscript".split())  # beside raw ones, what a head holds
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY = {  # an open element of this kind ends where one of these begins
    "p": set(
        "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
        "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li dt dd".split()
    ),
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "button": {"button"}, "select": {"select"},
    "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"},
}
BREAKS_OUT = CLOSED_BY["p"] | CLOSED_BY["td"] | set(  # an open svg or math ends where one of these begins
    "b big br button code em embed i img input listing nobr object ruby s select small span strong strike sub sup tt u var".split()
)
SCOPES = {"table", "ul", "ol", "dl", "div", "section", "article", "main", "body", "td", "blockquote", "form"}

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    rf"|<(?P<raw>{'|'.join(RAW.split())})(?=[\s/>]).*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-z][^>]*>|<[!?/][^>]*>",
    re.S | re.I,
)
CLOSED_RAW = re.compile(r"<[a-z]+(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?<=/)>", re.I)
ATTRIBUTE = re.compile(r"(class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
ATTRIBUTE_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")

# Attribute words by what they name.
GROUPS = [
    "content article main post entry story text articlebody body prose",
    "nav navigation menu breadcrumb breadcrumbs navbar toc pagination pager tabs skip",
    "header masthead banner top logo branding topbar",
    "footer copyright bottom colophon legal contentinfo",
    "sidebar aside widget related recommended rail trending popular complementary more tags",
    "ad ads advert advertisement sponsor sponsored promo promotion adsense banner",
    "comment comments reply replies respond discussion disqus thread feedback",
    "cookie consent notice gdpr popup modal alert newsletter subscribe subscription overlay paywall",
    "form search login signup share social sharing buttons toolbar contact",
]
GROUP_OF = {w: i for i, words in enumerate(GROUPS) for w in words.split()}
TAGS = "article main section div p h ul li nav header footer aside table td form figure quote body #text".split()
SAME_TAG = {f"h{i}": "h" for i in range(1, 7)} | {
    "ol": "ul", "dl": "ul", "dt": "li", "dd": "li", "th": "td", "tr": "table", "tbody": "table",
    "blockquote": "quote", "pre": "quote", "figcaption": "figure", "html": "body",
}
ABOVE = [TAGS.index(t) for t in ("article", "main", "nav", "header", "footer", "aside", "form")]
COUNTERS = 7  # characters, in links, tags, paragraphs, list items, links, sentence marks
MAIN, OTHER, MIXED = range(3)


class Page:
    """The block elements of one page in document order, and its text in pieces."""

    def __init__(self, source: str):
        self.tag: list[int] = []
        self.parent: list[int] = []
        self.groups: list[int] = []
        self.opened: list[list[int]] = []
        self.closed: list[list[int] | None] = []
        self.pieces: list[tuple[int, str]] = []  # (node, text); node -1 marks a break
        self._read(source)

    def _open(self, tag: str, parent: int, groups: int, now: list[int]) -> int:
        name = SAME_TAG.get(tag, tag)
        self.tag.append(TAGS.index(name) if name in TAGS else len(TAGS))
        self.parent.append(parent)
        self.groups.append(groups)
        self.opened.append(now.copy())
        self.closed.append(None)
        return len(self.tag) - 1

    def _read(self, source: str) -> None:
        now = [0] * COUNTERS
        root = self._open("body", -1, 0, now)
        stack: list[tuple[str, int]] = [("body", root)]  # element, its block node
        links, foreign, run, skip = 0, 0, -1, False  # skip: in the head, whose end tag may be left out
        at = 0

        def text(s: str) -> None:
            nonlocal run, skip
            if not s:
                return
            s = html.unescape(s)
            if s.isspace():
                self.pieces.append((-1, " "))
                return
            skip = False  # a head has no text of its own
            if run < 0:
                run = self._open("#text", stack[-1][1], 0, now)
            self.pieces.append((run, s))
            size = len(s)
            now[0] += size
            now[1] += size if links else 0
            now[6] += sum(s.count(c) for c in ".,!?;")

        def end_run() -> None:
            nonlocal run
            if run >= 0:
                self.closed[run] = now.copy()
                run = -1
            self.pieces.append((-1, " "))

        def pop_to(depth: int) -> None:
            nonlocal links, foreign
            while len(stack) > depth:
                name, node = stack.pop()
                foreign -= name in FOREIGN
                links -= name == "a"
                if not stack or stack[-1][1] != node:
                    end_run()
                    self.closed[node] = now.copy()

        while m := TOKEN.search(source, at):
            text(source[at : m.start()])
            if m["raw"] and foreign:
                m = CLOSED_RAW.match(source, m.start()) or m
            at = m.end()
            if m.re is CLOSED_RAW:
                continue
            tag = (m["tag"] or "").lower()
            if not tag:
                continue
            if skip:
                skip = tag in HEAD or bool(m["end"]) and tag not in ("head", "body", "html", "br")
                if skip or tag == "head":
                    continue
            if m["end"]:
                for d in range(len(stack) - 1, 0, -1):
                    if stack[d][0] == tag:
                        pop_to(d)
                        break
                    if stack[d][0] in SCOPES and tag in INLINE | {"p", "li"}:
                        break
                if tag == "p":
                    end_run()
                continue
            if tag in ("html", "body"):
                self.groups[root] |= _groups(m["attrs"])
                continue
            if tag == "head":
                skip = True
                continue
            if foreign and tag in BREAKS_OUT:
                pop_to(next(d for d, (name, _) in enumerate(stack) if name in FOREIGN))
            if foreign or tag in FOREIGN:
                if not m["attrs"].endswith("/"):
                    foreign += tag in FOREIGN
                    links += tag == "a"
                    stack.append((tag, stack[-1][1]))
                continue
            now[2] += 1
            if tag == "br":
                self.pieces.append((-1, " "))
            if tag == "hr":
                end_run()
            if tag in VOID:
                continue
            for d in range(len(stack) - 1, 0, -1):
                open_tag = stack[d][0]
                if tag in CLOSED_BY.get(open_tag, ()):
                    pop_to(d)
                    if open_tag == "p" or open_tag == tag:
                        break
                elif open_tag in SCOPES:
                    break
            if tag == "a":
                links += 1
                now[5] += 1
            if tag in INLINE:
                if not m["attrs"].endswith("/"):
                    stack.append((tag, stack[-1][1]))
                elif tag == "a":
                    links -= 1
                continue
            end_run()
            now[3] += tag == "p"
            now[4] += tag == "li"
            stack.append((tag, self._open(tag, stack[-1][1], _groups(m["attrs"]), now)))
        text(source[at:])
        pop_to(0)
        self._merge_runs()

    def _merge_runs(self) -> None:
        """A block whose one child is a run of text is that text."""
        children = np.bincount(np.array(self.parent[1:], int), minlength=len(self.tag)) if len(self.tag) > 1 else [0]
        run = len(TAGS) - 1
        into = list(range(len(self.tag)))
        for i in range(1, len(self.tag)):
            if self.tag[i] == run and children[self.parent[i]] == 1 and self.parent[i]:
                into[i] = self.parent[i]
        keep = [i for i in range(len(into)) if into[i] == i]
        new = {i: k for k, i in enumerate(keep)}
        self.pieces = [(new[into[n]] if n >= 0 else -1, t) for n, t in self.pieces]
        self.parent = [new[into[self.parent[i]]] if self.parent[i] >= 0 else -1 for i in keep]
        for name in ("tag", "groups", "opened", "closed"):
            old = getattr(self, name)
            setattr(self, name, [old[i] for i in keep])

    def features(self) -> np.ndarray:
        n = len(self.tag)
        tag, parent, bits = np.array(self.tag), np.array(self.parent), np.array(self.groups)
        opened, closed = np.array(self.opened, float), np.array(self.closed, float)
        inside = closed - opened
        chars, page = inside[:, 0], max(1.0, inside[0, 0])
        depth, above_tags, above_bits = np.zeros(n), np.zeros(n, int), np.zeros(n, int)
        order, count = np.zeros(n), np.zeros(n)
        last: dict[int, int] = {}
        previous, following = np.full(n, -1), np.full(n, -1)
        for i in range(1, n):
            p = parent[i]
            depth[i] = depth[p] + 1
            above_tags[i] = above_tags[p] | 1 << tag[p]
            above_bits[i] = above_bits[p] | bits[p]
            order[i] = count[p]
            count[p] += 1
            if p in last:
                previous[i], following[last[p]] = last[p], i
            last[p] = i
        siblings = np.where(parent >= 0, count[parent], 1)
        density = inside[:, 1] / np.maximum(chars, 1)

        def beside(values: np.ndarray, at: np.ndarray) -> np.ndarray:
            return np.where(at >= 0, values[at], -1)

        columns = [
            *(tag == k for k in range(len(TAGS))),
            *((bits >> k) & 1 for k in range(len(GROUPS))),
            *((above_bits >> k) & 1 for k in range(len(GROUPS))),
            *((above_tags >> k) & 1 for k in ABOVE),
            depth, siblings, order / np.maximum(siblings, 1), siblings - order, count,
            np.log1p(chars), chars / page, density, opened[:, 0] / page, closed[:, 0] / page,
            inside[:, 6] / np.maximum(chars, 1), inside[:, 2] / np.maximum(chars, 1),
            np.log1p(inside[:, 3]), np.log1p(inside[:, 4]), np.log1p(inside[:, 5]),
            beside(np.log1p(chars), previous), beside(np.log1p(chars), following),
            beside(density, previous), beside(density, following),
            np.where(parent >= 0, np.log1p(chars[parent]), 0), np.where(parent >= 0, density[parent], 0),
        ]
        return np.stack(columns, 1).astype(np.float64)

    def decode(self, logs: np.ndarray) -> np.ndarray:
        """Main or other for every node: the likeliest labelling in which a node that is
        all main, or all other, has only such nodes below. A form is never all main."""
        n = len(self.tag)
        pure = logs[:, :2].copy()
        pure[np.array(self.tag) == TAGS.index("form"), MAIN] = -np.inf
        mixed = logs[:, MIXED].copy()
        leaf = np.ones(n, bool)
        leaf[np.array(self.parent[1:], int)] = False
        mixed[leaf] = -np.inf
        best = np.zeros(n)
        for i in range(n - 1, -1, -1):
            best[i] = max(pure[i, 0], pure[i, 1], mixed[i])
            if self.parent[i] >= 0:
                pure[self.parent[i]] += pure[i]
                mixed[self.parent[i]] += best[i]
        chosen = np.zeros(n, int)
        for i in range(n):
            above = chosen[self.parent[i]] if self.parent[i] >= 0 else MIXED
            chosen[i] = above if above != MIXED else int(np.argmax([*pure[i], mixed[i]]))
        return chosen

    def text(self, chosen: np.ndarray) -> str:
        parts = [t if n < 0 or chosen[n] == MAIN else " " for n, t in self.pieces]
        return " ".join("".join(parts).split())


def _groups(attrs: str) -> int:
    bits = 0
    for m in ATTRIBUTE.finditer(attrs or ""):
        for word in ATTRIBUTE_WORD.findall(m[2] or m[3] or m[4] or ""):
            group = GROUP_OF.get(word.lower())
            if group is not None:
                bits |= 1 << group
    return bits


# Training --------------------------------------------------------------------


def own_labels(page: Page) -> np.ndarray | None:
    """Labels that the page's own markup gives: an article or main element is main text, but for
    what in it is named as something else. None if it has no such element."""
    main = {TAGS.index("article"), TAGS.index("main")}
    if not main.intersection(page.tag):
        return None
    away = {TAGS.index(t) for t in ("nav", "aside", "footer", "form")}
    state = np.full(len(page.tag), OTHER)
    for i in range(1, len(page.tag)):
        p = page.parent[i]
        inside = state[p] == MAIN or page.tag[i] in main
        named = page.tag[i] in away or page.groups[i] >> 1
        state[i] = MAIN if inside and not named else OTHER
    return _with_mixed(page, state)


def _with_mixed(page: Page, state: np.ndarray) -> np.ndarray:
    """Labels of inner nodes from those of the leaves below."""
    n = len(page.tag)
    below = np.zeros((n, 2), bool)
    leaf = np.ones(n, bool)
    leaf[np.array(page.parent[1:], int)] = False
    for i in range(n - 1, -1, -1):
        if leaf[i]:
            below[i, state[i]] = True
        if page.parent[i] >= 0:
            below[page.parent[i]] |= below[i]
    return np.where(below.all(1), MIXED, np.where(below[:, 0], MAIN, OTHER))


def composed(rng: np.random.Generator, paragraphs: list[str], short: list[str]) -> tuple[str, list[tuple[str, bool]]]:
    """A page of a drawn layout from given texts; every text is marked \\x01 (main) or \\x02."""

    def pick(texts):
        return html.escape(texts[rng.integers(len(texts))])

    def chance(p):
        return rng.random() < p

    def one(options):
        return options[rng.integers(len(options))]

    bare = chance(0.25)  # a page without classes and ids

    def attr(words):
        if bare or chance(0.25):
            return ""
        word = one(words.split()) + one(["", "", "-wrap", "_1", "-box", " clearfix", "-area"])
        return f' {one(["class", "class", "id"])}="{word}"'

    def say(text, main):
        return ("\x01" if main else "\x02") + text

    def links(n):
        items = "".join(f'<li><a href="/{i}">{say(pick(short), False)}</a></li>' for i in range(n))
        return f"<ul>{items}</ul>" if chance(0.7) else "".join(f'<a href="/{i}">{say(pick(short), False)}</a> ' for i in range(n))

    def anchor(main):
        return f'<a href="/{rng.integers(99)}">{say(pick(short), main)}</a>'

    def linked(main):
        """A sentence of a few words and one to three links."""
        words = " ".join(pick(paragraphs).split()[: rng.integers(1, 12)])
        return f"{say(words, main)} " + f" {say(one(['and', 'or', 'see']), main)} ".join(anchor(main) for _ in range(rng.integers(1, 4))) + "."

    def prose(n, main):
        out = []
        for _ in range(n):
            t = pick(paragraphs)
            out.append(one([
                f"<p>{say(t, main)}</p>", f"<p>{say(t, main)}</p>", f"<p>{say(t, main)}",
                f"<div>{say(t, main)}</div>", f"{say(t, main)}<br><br>", f"<p><b>{say(t, main)}<br>",
                f"<p>{say(t, main)} {anchor(main)} {say(t[:40], main)}</p>", f"<p>{linked(main)}</p>",
            ]))
        return "".join(out)

    def sources():
        """A list of links that belongs to the article."""
        items = "".join(f"<li>{one([anchor(True), anchor(True), linked(True)])}</li>" for _ in range(rng.integers(1, 6)))
        list_ = one(["ul", "ol"])
        return f"<{list_}>{items}</{list_}>"

    def block(tags, words, inner):
        tag = one(tags.split())
        return f"<{tag}{attr(words)}>{inner}</{tag}>"

    nav = lambda: block("nav div div ul", "nav menu navigation breadcrumb pagination", links(rng.integers(3, 9)))
    header = lambda: block("header div div", "header masthead banner logo topbar", f"{one(['<h1>', '<p>', '<div>'])}{say(pick(short), False)}" + (nav() if chance(0.4) else ""))
    footer = lambda: block("footer footer div", "footer copyright colophon legal", f"&copy; {say(pick(short), False)} &middot; {say(pick(paragraphs)[:120], False)}" + (links(3) if chance(0.4) else ""))
    side = lambda: block("aside aside div", "sidebar related widget recommended trending", f"<h3>{say(pick(short), False)}</h3>" + (links(rng.integers(2, 7)) if chance(0.6) else prose(rng.integers(1, 3), False)))
    ad = lambda: f'<div class="{one("ad ads advert sponsor promo advertisement".split())}">{say(pick(paragraphs)[: rng.integers(20, 300)], False)}</div>'
    notice = lambda: f'<div class="{one("cookie notice consent popup newsletter alert modal".split())}{one(["", "-bar", " show"])}">{prose(1, False)}{one(["", "<button>OK</button>"])}</div>'
    field = lambda: one([f'<label>{say(pick(short), False)}</label><input name="q">', f'<p>{say(pick(short), False)}</p><input type="text">', f'<button>{say(pick(short), False)}</button>', say(pick(paragraphs)[:80], False)])
    form = lambda: f'<form action="/x"{attr("search login form subscribe contact")}>{"".join(field() for _ in range(rng.integers(1, 4)))}</form>'
    comments = lambda: f'<{(t := one(["section", "div", "ol"]))} {one(["class", "id"])}="{one(["comments", "comment-list", "replies", "discussion"])}"><h3>{say(pick(short), False)}</h3>' + "".join(f'<div class="{one(["comment", "reply", "comment-body"])}">{prose(rng.integers(1, 3), False)}</div>' for _ in range(rng.integers(1, 5))) + f"</{t}>"
    share = lambda: block("div ul", "share social buttons toolbar", links(rng.integers(2, 5)))
    inner = f"<{(h := one(['h1', 'h1', 'h2']))}>{say(pick(short), True)}</{h}>"
    for _ in range(rng.integers(1, 5)):
        inner += prose(rng.integers(1, 5), True)
        if chance(0.3):
            inner += f"<h2>{say(pick(short), True)}</h2>"
        if chance(0.15):
            inner += "<ul>" + "".join(f"<li>{say(pick(paragraphs), True)}</li>" for _ in range(3)) + "</ul>"
        if chance(0.12):
            inner += f"<blockquote>{prose(1, True)}</blockquote>"
        if chance(0.12):
            inner += f"<table><tr><td>{say(pick(short), True)}</td><td>{say(pick(short), True)}</td></tr></table>"
        if chance(0.3):
            inner += sources()
        if chance(0.1):
            inner += one([ad, share, notice, side])()
        if chance(0.15):
            inner += form()
    if chance(0.15):
        inner = f"<header>{inner.split('</h', 1)[0]}</{h}></header>" + inner.split(f"</{h}>", 1)[1]
    if chance(0.25):
        inner += f"<p>{linked(True)}</p>"
    if chance(0.2):
        inner += comments()
    if chance(0.3):
        inner = block("div section", "content entry text body", inner)
    main = block(one(["article", "article main", "div", "section div", "main"]), "content article main post entry story", inner)
    parts = [x() for x, p in ((header, 0.5), (nav, 0.7), (ad, 0.4), (notice, 0.3), (form, 0.2), (side, 0.3)) if chance(p)]
    rng.shuffle(parts)
    parts.append(main)
    after = [x() for x, p in ((share, 0.2), (comments, 0.3), (side, 0.4), (ad, 0.3), (form, 0.2), (notice, 0.2)) if chance(p)]
    rng.shuffle(after)
    parts += after
    if chance(0.8):
        parts.append(footer())
    body = "".join(parts)
    if chance(0.3):
        body = block("div", "page wrapper container site", body)
    return f"<html><head><title>x</title></head><body>{body}</body></html>"


def examples(pages: list[str], seed: int = 11, drawn: int = 700) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of nodes: of the pages whose markup names their article, and of pages
    composed from their texts in drawn layouts, where every text's label is known."""
    xs, ys, paragraphs, short = [], [], [], []
    for source in pages:
        page = Page(source)
        labels = own_labels(page)
        if labels is None:
            continue
        xs.append(page.features())
        ys.append(labels)
        for n, t in page.pieces:
            t = " ".join(t.split())
            if n >= 0 and t:
                (short if len(t) < 70 else paragraphs).append(t)
    words = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor".split()
    rng = np.random.default_rng(seed)
    if len(paragraphs) < 20:
        paragraphs += [" ".join(rng.choice(words, int(n))).capitalize() + "." for n in rng.integers(10, 120, 40)]
    if len(short) < 20:
        short += [" ".join(rng.choice(words, int(n))) for n in rng.integers(1, 6, 40)]
    for _ in range(drawn):
        page = Page(composed(rng, paragraphs, short))
        state = np.full(len(page.tag), OTHER)
        for n, t in page.pieces:
            if n >= 0 and "\x01" in t:
                state[n] = MAIN
        # The marks are one character a text and the same for both labels, so they tell the features nothing.
        xs.append(page.features())
        ys.append(_with_mixed(page, state))
    return np.concatenate(xs), np.concatenate(ys)


def train(pages: DataFrame) -> boosting.Forest:
    """Fit on at most SAMPLE pages of the table, always the same ones. Runs jobs.

    The sampled ids, of that bounded number, go to where the pages are. Of rows that repeat a
    sampled id one is read.
    """
    named = pages.filter("page_id IS NOT NULL").select("page_id")
    ids = F.broadcast(bounded_sample(named.distinct(), "page_id", SAMPLE))
    found = pages.select("page_id", "html").join(ids, "page_id")
    rows = found.groupBy("page_id").agg(F.min("html").alias("html")).collect()
    rows.sort(key=lambda r: r["page_id"])
    return boosting.fit(*examples([r["html"] or "" for r in rows]), classes=3)


def main_texts(sources: list[str], model: boosting.Forest) -> list[str]:
    pages = [Page(s) for s in sources]
    logs = boosting.log_probabilities(model, np.concatenate([p.features() for p in pages]))
    out, at = [], 0
    for p in pages:
        out.append(p.text(p.decode(logs[at : at + len(p.tag)])))
        at += len(p.tag)
    return out


def extract(pages: DataFrame, model: boosting.Forest | None = None) -> DataFrame:
    """One row per row of `pages`: page_id, url, text, n_chars.

    Reads page_id, url and html. Null, empty and textless pages have the empty text. Repeated rows
    and null ids stay. An empty table gives none. Pages are read whole, once beside
    the bounded training sample. Runs a job to train if no model is given.
    """
    model = model or train(pages)
    schema = pages.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")

    def run(batch: pa.RecordBatch) -> dict:
        sources, texts = texts_of(batch, "html"), []
        for at in range(0, len(sources), 100):
            texts += main_texts(sources[at : at + 100], model)
        kept = {c: batch.column(c) for c in ("page_id", "url")}
        return kept | {"text": texts, "n_chars": [len(t) for t in texts]}

    return map_batches(pages.select("page_id", "url", "html"), schema, run)
