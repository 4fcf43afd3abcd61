"""Main text of web pages by a tree-structured graphical model.

Every DOM node is content or not.  A node's potential is log-linear in its
name, the words of its class, id and role, and the text and links below it;
parent-child potentials connect the nodes.  Sum-product messages, upward and
downward, give each node's content marginal; text nodes of marginal 0.5 or
more are the page's text.  The weights are fitted by maximum likelihood (the
same messages give the gradient) to labelled pages, a bounded sample.

Blocks: text is cut at block elements; white space within one becomes one
space; blocks are joined by two line feeds in page order.

Defined cases: a null, empty or tagless page is parsed like any other (bare
text is judged as a text node); repeated rows are extracted each on its own;
pages are read whole; the sample is drawn from the pages that mark their
article, and where these are too few, pages built around other pages' texts
make up for them; an empty table gives no rows; other columns are carried by
``extract`` only if asked for.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bundlelake.llm.dom import BLOCK, HIDDEN, Tree, attributes, parse
from bundlelake.llm.labelled import first_by_hash
from bundlelake.session import scratch_path

SAMPLE = 200           # labelled pages: the first by a hash of the id
VARIANTS = 3           # pages built from each of them
STEPS, RATE, RIDGE = 200, 0.1, 1e-3
LABEL = "data-label"   # marks subtrees of labelled pages, 1 content, 0 not

GROUPS = {
    "#text": "#text", "p": "p pre blockquote", "div": "div", "article": "article", "main": "main", "section": "section", "nav": "nav menu",
    "header": "header hgroup", "footer": "footer", "aside": "aside dialog", "form": "form fieldset label legend input select",
    "list": "ul ol dl", "item": "li dt dd", "a": "a", "heading": "h1 h2 h3 h4 h5 h6", "inline": "b i em strong span u small sub sup code q cite mark time abbr font",
    "table": "table tbody thead tfoot tr caption", "cell": "td th", "page": "#document html body", "figure": "figure figcaption img picture details summary", "other": "",
}
GROUP = {t: i for i, (_, tags) in enumerate(GROUPS.items()) for t in tags.split()}
OTHER = len(GROUPS) - 1
HINTS = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs topbar toolbar tabs pager pagination toc sitemap skip links",
    "top": "header masthead logo banner branding hero site head",
    "bottom": "footer foot copyright legal colophon credits imprint bottom",
    "side": "sidebar side aside widget rail related recommended recommendations trending popular complementary more teaser promo promos",
    "notice": "notice cookie cookies consent gdpr modal popup overlay alert warning message paywall subscribe newsletter signup announcement toast disclaimer",
    "advert": "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors dfp outbrain taboola promotion",
    "form": "form search login register contact searchbox poll survey feedback",
    "comment": "comment comments commentlist reply replies discussion disqus respond reader readers responses thread review reviews",
    "share": "share sharing social follow like likes tweet tags tag meta byline author bio",
    "content": "article content main post entry story text body articlebody maincontent page prose copy markdown hentry",
}
HINT = {w: i for i, words in enumerate(HINTS.values()) for w in words.split()}
N_TAG, N_HINT = len(GROUPS), len(HINTS)
NUMBERS = ["log_chars", "links", "share", "short", "stops", "in_link", "copyright", "bias"]
N_FEATURES = N_TAG + N_HINT + len(NUMBERS)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(frozen=True)
class Model:
    weights: np.ndarray     # features -> log odds of content
    pair: np.ndarray        # (element or text child, parent label, child label)


class Forest:
    """Trees of several pages as arrays."""

    def __init__(self, trees: list[Tree]):
        sizes = [len(t.tag) for t in trees]
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        tags = [x for t in trees for x in t.tag]
        self.parent = np.concatenate([np.where(np.array(t.parent) < 0, -1, np.array(t.parent) + f) for t, f in zip(trees, self.first)]).astype(np.int64)
        n = len(tags)
        self.is_text = np.array([x == "#text" for x in tags], bool)
        group = np.array([GROUP.get(x, OTHER) for x in tags])
        hidden, in_link = np.array([x in HIDDEN for x in tags]), np.array([x == "a" for x in tags])
        hints = np.zeros((n, N_HINT))
        chars, stops, rights, full = np.zeros(n), np.zeros(n), np.zeros(n), 0
        self.label = np.full(n, -1)
        for i, (tag, source, text) in enumerate((g, a, x) for t in trees for g, a, x in zip(t.tag, t.attrs, t.text)):
            if tag == "#text":
                body = text.strip()
                chars[i], stops[i] = len(body), sum(map(body.count, ".!?"))
                rights[i] = "©" in body
            elif source:
                attrs = attributes(source)
                words = " ".join(attrs.get(k, "") for k in ("class", "id", "role", "itemprop"))
                for w in _WORDS.findall(words):
                    if (h := HINT.get(w.lower())) is not None:
                        hints[i, h] = 1
                style = attrs.get("style", "").replace(" ", "").lower()
                hidden[i] |= "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or "display:none" in style
                if LABEL in attrs:
                    self.label[i] = attrs[LABEL] == "1"
        self.levels = self._levels(n)
        # top down: what an ancestor passes on
        for level in self.levels[1:]:
            p = self.parent[level]
            hidden[level] |= hidden[p]
            in_link[level] |= in_link[p]
            self.label[level] = np.where(self.label[level] < 0, self.label[p], self.label[level])
        self.hidden, self.label = hidden, np.maximum(self.label, 0)
        chars, stops, rights = (np.where(hidden, 0, x) for x in (chars, stops, rights))
        linked = np.where(in_link, chars, 0)
        for level in self.levels[:0:-1]:  # bottom up: sums over subtrees
            for x in (chars, stops, rights, linked):
                np.add.at(x, self.parent[level], x[level])
        page = np.repeat(np.arange(len(trees)), sizes)
        whole = np.maximum(chars[self.first[:-1]], 1)[page]
        numbers = [np.log1p(chars) / 4, linked / np.maximum(chars, 1), chars / whole, chars < 25, np.minimum(stops, 8) / 8, in_link, rights > 0,
                   np.ones(n)]
        one_hot = np.zeros((n, N_TAG))
        one_hot[np.arange(n), group] = 1
        self.x = np.column_stack([one_hot, hints, *numbers]).astype(float)

    def _levels(self, n: int) -> list[np.ndarray]:
        depth = np.zeros(n, np.int64)
        for i, p in enumerate(self.parent.tolist()):  # parents come first
            if p >= 0:
                depth[i] = depth[p] + 1
        order = np.argsort(depth, kind="stable")
        return np.split(order, np.cumsum(np.bincount(depth))[:-1]) if n else []

    def messages(self, m: Model):
        """Sum-product: log beliefs of nodes (n, 2) and of edges to the
        parent (n, 2, 2), not normalised; roots have no edge."""
        n = self.parent.size
        own = np.column_stack([np.zeros(n), self.x @ m.weights])
        pair = m.pair[self.is_text.astype(int)]
        up, sent = own.copy(), np.zeros((n, 2))
        for level in self.levels[:0:-1]:
            sent[level] = np.logaddexp.reduce(pair[level] + up[level][:, None, :], axis=2)
            for j in (0, 1):
                np.add.at(up[:, j], self.parent[level], sent[level, j])
        belief, edge = up.copy(), np.zeros((n, 2, 2))
        for level in self.levels[1:]:
            rest = belief[self.parent[level]] - sent[level]  # the parent without this child
            edge[level] = rest[:, :, None] + pair[level] + up[level][:, None, :]
            belief[level] = np.logaddexp.reduce(edge[level], axis=1)
        return belief, edge

    def marginals(self, m: Model) -> np.ndarray:
        belief, _ = self.messages(m)
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500)))


def train(trees: list[Tree]) -> Model:
    """Maximum likelihood of the labels by Adam: gradients are the label
    counts less the expected ones, from the marginals."""
    m = Model(np.zeros(N_FEATURES), np.zeros((2, 2, 2)))
    if not trees:
        return m
    f = Forest(trees)
    y, child = f.label.astype(float), f.parent >= 0
    kind, yp, n = f.is_text[child].astype(int), f.label[f.parent[child]], len(trees)
    seen = np.zeros((2, 2, 2))
    np.add.at(seen, (kind, yp, f.label[child]), 1)
    theta = np.zeros(N_FEATURES + 8)
    m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, STEPS + 1):
        m = Model(theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2, 2))
        belief, edge = f.messages(m)
        p = 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500)))
        e = edge[child]
        e = np.exp(e - np.logaddexp.reduce(e.reshape(-1, 4), axis=1)[:, None, None])
        expected = np.stack([e[kind == k].sum(axis=0) for k in (0, 1)])
        g = np.concatenate([f.x.T @ (y - p), (seen - expected).ravel()]) / n - RIDGE * theta
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        theta = theta + RATE * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-8)
    return Model(theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2, 2))


# --- labelled pages -------------------------------------------------------------------------

CHROME_TAGS = {"nav", "menu", "header", "footer", "aside", "dialog", "form", "a", "button"}
_CONTENT = ['<article{}>', '<main{}>', '<div class="content"{}>', '<div id="main-content"{}>', '<section class="post entry"{}>', '<div{}>',
            '<div class="story-body" itemprop="articleBody"{}>', '<td{}>', '<div class="wrap"{}>']
_CHROME = {
    "menu": ['<nav>', '<div class="menu">', '<ul class="navigation">', '<div id="nav">', '<div role="navigation">', '<div class="breadcrumbs">'],
    "top": ['<header>', '<div class="header">', '<div id="masthead">', '<div class="site-header">'],
    "side": ['<aside>', '<div class="sidebar">', '<div id="sidebar" class="widget">', '<section class="related">', '<div class="recommended">'],
    "notice": ['<div class="cookie-notice">', '<div id="consent">', '<section class="notice">', '<div class="newsletter">', '<div role="alert" class="alert">', '<dialog>'],
    "advert": ['<div class="ad">', '<div class="advert">', '<div id="ads">', '<section class="sponsored">', '<p class="advertisement">', '<aside class="ad">'],
    "form": ['<form>', '<form class="search">', '<form id="login" action="/login">'],
    "comment": ['<section class="comments">', '<div id="comments">', '<div class="comment-list">', '<ol class="commentlist">', '<div id="disqus" class="discussion">'],
    "share": ['<div class="share">', '<div class="social-links">'],
    "bottom": ['<footer>', '<div class="footer">', '<div id="footer">', '<div class="copyright">'],
}


def _end(start: str) -> str:
    return f"</{re.match(r'<(\w+)', start).group(1)}>"


def _label(start: str, value: int) -> str:
    return start[:-1] + f' {LABEL}="{value}">'


def article_paragraphs(page: str) -> list[str]:
    """Block texts of a page's own <article> or <main>."""
    tree = parse(page)
    root = next((i for i, t in enumerate(tree.tag) if t in ("article", "main")), None)
    if root is None:
        return []
    inside = np.zeros(len(tree.tag), bool)
    inside[root] = True
    for i in range(root + 1, len(tree.tag)):
        inside[i] = inside[tree.parent[i]] and tree.tag[i] not in HIDDEN | {"nav", "aside", "form", "footer"}
    return blocks(tree, inside)


def other_paragraphs(page: str) -> list[str]:
    """Block texts of a page outside elements named as chrome, without the
    short ones if there are others; of the whole page if there are none."""
    tree = parse(page)
    seen, plain = np.ones(len(tree.tag), bool), np.ones(len(tree.tag), bool)
    for i, tag in enumerate(tree.tag):
        p = tree.parent[i]
        seen[i] = tag not in HIDDEN and (p < 0 or seen[p])
        plain[i] = seen[i] and tag not in CHROME_TAGS and (p < 0 or plain[p])
    texts = blocks(tree, plain) or blocks(tree, seen)
    return [t for t in texts if len(t) >= 25] or texts


def build_page(paragraphs: list[str], rng: np.random.Generator) -> str:
    """A labelled page around real paragraphs, with chrome of other kinds."""
    esc = html.escape
    words = [w for p in paragraphs for w in p.split()] or ["word"]
    some = lambda n: esc(" ".join(words[i] for i in rng.integers(0, len(words), n)))
    pick = lambda xs: xs[rng.integers(0, len(xs))]
    link = lambda n=2: f'<a href="/{rng.integers(0, 999)}">{some(n)}</a>'

    def chrome(kind: str) -> str:
        start = pick(_CHROME[kind])
        if kind == "menu":
            body = "".join(f"<li>{link(rng.integers(1, 4))}</li>" for _ in range(rng.integers(3, 9)))
            body = body if start.startswith("<ul") else f"<ul>{body}</ul>"
        elif kind == "top":
            body = f"<h1>{some(2)}</h1><p>{some(5)}</p>" if rng.random() < 0.5 else f'<a href="/">{some(2)}</a>'
        elif kind in ("side", "notice", "advert"):
            body = pick([some(rng.integers(3, 30)) + ".", f"<p>{some(rng.integers(5, 30))}.</p>", f"<h3>{some(2)}</h3><p>{some(20)}. {link()}</p>",
                         f"<ul><li>{link(5)}</li><li>{link(6)}</li></ul>"])
            body = some(12) + "." if start.startswith("<p") else body
        elif kind == "form":
            body = f'<label>{some(3)}</label><input name="q"><p>{some(4)}</p><button>{some(1)}</button>'
        elif kind == "comment":
            one = lambda: pick(['<div class="comment">{}</div>', "<p>{}</p>", "<li>{}</li>"]).format(f"<p>{some(rng.integers(4, 60))}.</p>")
            body = f"<h3>{some(2)}</h3>" + "".join(one() for _ in range(rng.integers(1, 6)))
        elif kind == "share":
            body = link(1) + link(1)
        else:
            body = f"&copy; {some(2)} &middot; {some(rng.integers(3, 20))}." + (link() if rng.random() < 0.5 else "")
        return _label(start, 0) + body + _end(start)

    def block(text: str) -> str:
        t = esc(text)
        return pick([f"<p>{t}</p>"] * 8 + [f"<p>{t}", f"<p><b>{t}<br>", f"<div>{t}</div>", f"<blockquote><p>{t}</p></blockquote>", f"<ul><li>{t}</li></ul>",
                                             f"<p>{link(3)} {t}</p>", f"<h2>{t}</h2>", f"<p>{some(1)}.</p><p>{t}</p>", f"<section><h3>{some(3)}</h3><p>{t}</p></section>",
                                             f"<table><tr><td>{t}</td></tr></table>", f"{t}<br>"])

    inner = [f"<h1>{some(5)}</h1>"] * (rng.random() < 0.7) + [block(p) for p in paragraphs]
    for kind in ("advert", "share", "notice", "form", "comment", "side"):
        if rng.random() < 0.2:
            inner.insert(rng.integers(0, len(inner) + 1) if kind != "comment" else len(inner), chrome(kind))
    start = pick(_CONTENT)
    main = start.format(f' {LABEL}="1"') + "".join(inner) + ("" if rng.random() < 0.1 else _end(start))
    main = f"<table><tr>{main}</tr></table>" if start.startswith("<td") else main
    main = f'<div id="page">{main}</div>' if rng.random() < 0.3 else main
    before = [chrome(k) for k in ("top", "menu", "notice", "advert", "form", "side") if rng.random() < 0.5]
    after = [chrome(k) for k in ("share", "side", "comment", "form", "advert", "notice", "menu", "bottom") if rng.random() < 0.45]
    return f"<html><head><title>{some(3)}</title></head><body>{''.join(before)}{main}{''.join(after)}</body></html>"


def _kinds(batches):
    """(h, kind): 2 for a page that marks an article with text, 1 for another
    page with text, 0 for the rest."""
    for b in batches:
        pages = b.column(1).to_pylist()
        kinds = [2 if article_paragraphs(p) else int(bool(other_paragraphs(p))) for p in pages]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(kinds, pa.int32())], names=["h", "kind"])


def _labelled(batches):
    for b in batches:
        out = []
        for i, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            paragraphs = article_paragraphs(page)
            if paragraphs:
                out.append((i, re.sub(r"<(article|main)\b", rf'<\1 {LABEL}="1"', page, count=1, flags=re.IGNORECASE)))
            else:
                paragraphs = other_paragraphs(page)
            if paragraphs:
                rng = np.random.default_rng([(i or 0) & 0x7FFFFFFF, 5])
                out += [(i, build_page(paragraphs, rng)) for _ in range(VARIANTS)]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in out], pa.int64()), pa.array([p for _, p in out], pa.string())], names=["id", "html"])


def labelled_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE) -> DataFrame:
    """(id, html) with ``data-label`` marks: ``sample`` of the pages that mark
    their own article, as they are, and pages built from their paragraphs.
    Where fewer mark one, pages built around the texts of others fill up.
    All pages are parsed for that only if the first ``sample`` by hash do not
    all mark an article."""
    all_pages = pages.select(F.col(id_col).cast("long").alias("id"), F.col(html_col).alias("html")).where(F.col("html").isNotNull())
    all_pages = all_pages.withColumn("h", F.xxhash64("id", "html"))
    take = lambda h: (all_pages.join(F.broadcast(h), "h").groupBy("h").agg(F.first("id").alias("id"), F.first("html").alias("html")))
    first = take(first_by_hash(all_pages.select("h").distinct(), F.col("h"), sample))  # ``sample`` numbers
    kinds = [r["kind"] for r in first.select("h", "html").mapInArrow(_kinds, "h long, kind int").select("kind").collect()]
    if any(k != 2 for k in kinds):
        at = scratch_path(pages.sparkSession, "extraction-kinds")
        all_pages.select("h", "html").mapInArrow(_kinds, "h long, kind int").where("kind > 0").write.parquet(at)
        every = pages.sparkSession.read.parquet(at).distinct()
        marked = [r["h"] for r in first_by_hash(every.where("kind = 2").select("h"), F.col("h"), sample).collect()]
        rest = [r["h"] for r in first_by_hash(every.where("kind = 1").select("h"), F.col("h"), sample - len(marked)).collect()] \
            if len(marked) < sample else []
        first = take(pages.sparkSession.createDataFrame([(h,) for h in marked + rest], "h long"))
    return first.select("id", "html").mapInArrow(_labelled, "id long, html string")


def fit(labelled: DataFrame) -> Model:
    """Train on labelled pages (id, html); the caller bounds their number."""
    rows = sorted((r["id"] or 0, r["html"]) for r in labelled.collect())
    return train([parse(page) for _, page in rows])


# --- extraction -----------------------------------------------------------------------------

def blocks(tree: Tree, content: np.ndarray) -> list[str]:
    """Texts of the content nodes, cut where a block element begins or ends.
    (In page order, text belongs to the innermost block around it; a change
    of that block is a cut, and so is any block element in between.)"""
    home, out, now, last = [0] * len(tree.tag), [], [], None
    for i, tag in enumerate(tree.tag):
        p = tree.parent[i]
        if tag in BLOCK or p < 0:
            home[i], last = i, None
        else:
            home[i] = home[p]
            if tag == "br" and now:
                now.append(" ")
            if tag == "#text" and content[i]:
                if home[i] != last:
                    out.append("".join(now))
                    now = []
                now.append(tree.text[i])
                last = home[i]
    out.append("".join(now))
    return [x for x in (" ".join(t.split()) for t in out) if x]


def extract_texts(model: Model, pages: list[str | None]) -> list[str]:
    trees = [parse(p) for p in pages]
    f = Forest(trees)
    content = (f.marginals(model) >= 0.5) & f.is_text & ~f.hidden
    return ["\n\n".join(blocks(t, content[a:b])) for t, a, b in zip(trees, f.first[:-1], f.first[1:])]


def extract(pages: DataFrame, model: Model, html_col: str = "html", carry: tuple = ("page_id", "url"), at_once: int = 64) -> DataFrame:
    """The carried columns and ``text`` of every page; no shuffle."""
    def run(batches):
        for b in batches:
            for s in range(0, b.num_rows, at_once):
                part = b.slice(s, at_once)
                texts = extract_texts(model, part.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(texts, pa.string())], names=[*carry, "text"])

    src = pages.select(F.col(html_col).alias("html"), *carry)
    kinds = ", ".join(f"`{c}` {src.schema[c].dataType.simpleString()}" for c in carry)
    return src.mapInArrow(run, f"{kinds}, text string")
