"""Main-text extraction from HTML by gradient-boosted trees over DOM nodes (operator 1).

Each page becomes a tree of element nodes; loose text directly in the page, html,
body or head, with the inline elements in it, is a leaf of its own between block
elements. A node's features: depth, place among
its siblings, own and subtree text, link and tag density, punctuation, share of
the page, tag kind, and tokens of its class, id and role attributes, for itself
and its ancestors. Boosted trees give each node a log-odds of main content. A
tree decoder then picks the best labelling in which a dropped node drops its
whole subtree, so no kept node has a dropped ancestor.

There are no labelled pages; the model is fitted on pages laid out from the text
blocks of a bounded sample of the input (`max_pages` pages chosen by a hash of
their id, of a long page its first 200,000 characters) with known regions: article bodies, and menus, headers, footers,
sidebars, notices, adverts, forms and reader comments, under the usual tags and
attribute tokens, each left out at random. In further layouts the article lies
directly in body, partly as loose text, among loose text that isn't part of it.

The text of kept nodes, with character references decoded, is split into blocks
at block elements; white space inside a block (line breaks included) becomes one
space, blocks are trimmed and joined by one space. Script, style, templates,
comments, titles, frames, drawings and the contents of form fields are never
text. A formula (math) is text of the node around it. A page without any element
keeps all its text, and loose text stays where nothing else is left.

A page is read in time linear in its length, whatever its tags: the tag pattern never goes back, and
what a tag closes is looked up by name. A quote inside a tag that is never closed counts as a plain
character, so the tag ends at the next > and no text after it is lost (browsers lose it all).

Defined cases: null or empty html gives an empty text; rows with null or
repeated page_id are taken by themselves, one result row per input row; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstats.llm import arrowtext as at

MAX_PAGES = 250
MAX_SAMPLE_CHARS = 200_000

#: Tag kinds of HTML and usual names of page regions.
SKIPPED = {"script", "style", "template", "title", "textarea", "iframe", "svg", "select"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "object", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "img", "wbr", "input"}
KINDS = [
    {"p"}, {"h1", "h2", "h3", "h4", "h5", "h6"}, {"ul", "ol", "li", "dl", "dt", "dd"}, {"a"}, {"table", "tbody", "thead", "tr", "td", "th"},
    {"blockquote", "pre", "xmp", "figure", "figcaption"}, {"article"}, {"main"}, {"section"}, {"div"}, {"nav", "menu"}, {"header"}, {"footer"}, {"aside"},
    {"form", "button", "fieldset", "label", "option"}, {"html", "body"}, {"head"}, INLINE, {"#text"},
]
FRAME = {"#page", "html", "body", "head"}
REGIONS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toc pagination pager tabs",
    "head": "header head masthead topbar logo toolbar banner",
    "foot": "footer foot bottom copyright legal colophon",
    "side": "sidebar side aside related recommended widget rail more",
    "ad": "ad ads advert advertisement sponsor sponsored promo promotion adsense",
    "notice": "cookie cookies consent notice alert popup modal overlay gdpr subscribe newsletter banner",
    "comment": "comment comments reply replies discussion disqus respond",
    "form": "form search login signup contact share social buttons toolbar",
    "body": "article content main post entry story body text prose markdown",
}
_TOKENS = {t: i for i, (_, words) in enumerate(REGIONS.items()) for t in words.split()}
_N_REGIONS = len(REGIONS)
_BODY = _N_REGIONS - 1
_TAG_REGION = {"nav": 0, "menu": 0, "header": 1, "footer": 2, "aside": 3, "form": 7, "article": _BODY, "main": _BODY}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # possessive, so that no character is tried twice; a quote that never closes is a character like any other
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(>|\Z)",
    re.S,
)
_ENDS = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for t in ("math", "xmp", *SKIPPED)}
_ATTR = re.compile(r"(?:^|[\s/])(class|id|role|data-y)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I | re.S)
_SPLIT = re.compile(r"[^a-z]+")
_SPACE = re.compile(r"\s+")
_CLOSES = {  # a start tag that ends an open one of these
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
_SCOPE = {"ul", "ol", "dl", "table", "td", "th", "html", "body", "article", "main", "section", "div", "nav", "aside", "header", "footer", "form", "object"}


class Page:
    """Nodes in page order (node 0 is the page itself) and text runs (node, block number, text)."""

    def __init__(self, source: str):
        self.tag, self.parent, self.depth = ["#page"], [-1], [0]
        self.regions: list[tuple[int, ...]] = [()]
        self.label: list[str | None] = [None]
        self.runs: list[tuple[int, int, str]] = []
        stack, block, pos, n = [0], 0, 0, len(source)
        # places on the stack by tag, and of tags that bound what an end tag closes
        where: dict[str, list[int]] = {}
        scopes: list[int] = []

        def push(node: int) -> None:
            name = self.tag[node]
            where.setdefault(name, []).append(len(stack))
            if name in _SCOPE:
                scopes.append(len(stack))
            stack.append(node)

        def cut(at: int) -> None:
            while len(stack) > at:
                name = self.tag[stack.pop()]
                where[name].pop()
                if name in _SCOPE:
                    scopes.pop()

        def past(tag: str) -> tuple[int, int]:
            """Where an element's raw contents end, and where the page goes on."""
            end = _ENDS[tag].search(source, pos)
            return (end.start(), end.end()) if end else (n, n)

        def add(tag: str, own: tuple[int, ...] = (), label: str | None = None) -> None:
            self.tag.append(tag)
            self.parent.append(stack[-1])
            self.depth.append(len(stack))
            self.regions.append(own)
            self.label.append(label)

        def loose() -> None:
            if self.tag[stack[-1]] in FRAME:
                add("#text")
                push(len(self.tag) - 1)

        def text(raw: str) -> None:
            if raw:
                if raw.strip():
                    loose()
                self.runs.append((stack[-1], block, html_lib.unescape(raw)))

        while pos < n:
            m = _TOKEN.search(source, pos)
            if not m:
                text(source[pos:])
                break
            text(source[pos : m.start()])
            pos = m.end()
            if not m[2]:
                if m[0].startswith("<![CDATA["):
                    text(html_lib.escape(m[0][9:].removesuffix("]]>")))
                continue
            if not m[4] and pos >= n:
                break  # cut off inside a tag
            tag = m[2].lower()
            if m[1]:
                if tag in INLINE or tag in VOID:
                    block += tag == "br"
                elif tag not in SKIPPED:
                    block += 1
                open_ = where.get(tag)
                if open_ and not (tag in INLINE and scopes and scopes[-1] > open_[-1]):
                    cut(open_[-1])
                continue
            closed = m[3].endswith("/") or m[3].rstrip().endswith("/")
            if tag == "math":
                if not closed:
                    end, to = past(tag)
                    text(_TOKEN.sub(lambda t: html_lib.escape(t[0][9:].removesuffix("]]>")) if t[0].startswith("<![CDATA[") else "", source[pos:end]))
                    pos = to
                continue
            if tag in SKIPPED:
                if not closed:
                    pos = past(tag)[1]
                continue
            if tag == "br":
                self.runs.append((stack[-1], block, " "))
                continue
            if tag not in INLINE:
                block += 1
                if self.tag[stack[-1]] == "#text":
                    cut(len(stack) - 1)
                nearest = max((where[t][-1] for t in (*_CLOSES.get(tag, ()), "p") if where.get(t)), default=0)
                if nearest and (not scopes or nearest >= scopes[-1]):
                    cut(nearest)
            if tag in VOID:
                continue
            if tag in INLINE:
                loose()
            own: set[int] = set()
            label = None
            for a in _ATTR.finditer(m[3]):
                value = a[2] or a[3] or a[4] or ""
                if a[1].lower() == "data-y":
                    label = value
                else:
                    own.update(_TOKENS[t] for t in _SPLIT.split(value.lower()) if t in _TOKENS)
            if tag in _TAG_REGION:
                own.add(_TAG_REGION[tag])
            add(tag, tuple(own), label)
            push(len(self.tag) - 1)
            if tag == "xmp":
                raw = source[pos : past(tag)[0]]
                text(html_lib.escape(raw))
                pos += len(raw)


_KIND = {t: i for i, kind in reversed(list(enumerate(KINDS))) for t in kind}
N_FEATURES = 12 + len(KINDS) + 2 * _N_REGIONS


def features(page: Page) -> np.ndarray:
    """One row per node."""
    n = len(page.tag)
    parent = np.array(page.parent)
    own, links, marks = np.zeros(n), np.zeros(n), np.zeros(n)
    before = np.zeros(n)
    seen, at_node = 0, 0
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = page.tag[i] == "a" or in_link[page.parent[i]]
    for node, _, raw in page.runs:
        size = len(raw.strip())
        before[at_node + 1 : node + 1] = seen
        at_node = max(at_node, node)
        seen += size
        own[node] += size
        if in_link[node]:
            links[node] += size
        marks[node] += raw.count(",") + raw.count(".")
    before[at_node + 1 :] = seen
    total, link, mark = own.copy(), links.copy(), marks.copy()
    nodes, paras = np.ones(n), np.array([t == "p" for t in page.tag], float)
    children = np.zeros(n)
    for i in range(n - 1, 0, -1):  # children come after their parents
        k = page.parent[i]
        total[k] += total[i]
        link[k] += link[i]
        mark[k] += mark[i]
        nodes[k] += nodes[i]
        paras[k] += paras[i]
        children[k] += 1
    place = np.zeros(n)
    count = [0] * n
    out = np.zeros((n, N_FEATURES))
    first = 12 + len(KINDS)
    for i in range(1, n):
        k = page.parent[i]
        place[i] = count[k]
        count[k] += 1
        out[i, 12 + _KIND.get(page.tag[i], 9)] = 1
        for r in page.regions[i]:
            out[i, first + r] = 1
        out[i, first + _N_REGIONS : first + 2 * _N_REGIONS] = np.maximum(out[k, first + _N_REGIONS : first + 2 * _N_REGIONS], out[k, first : first + _N_REGIONS])
    siblings = np.maximum(children[parent], 1)
    whole = max(total[0], 1)
    out[:, 0] = page.depth
    out[:, 1] = np.log1p(siblings)
    out[:, 2] = place / siblings
    out[:, 3] = np.log1p(own)
    out[:, 4] = np.log1p(total)
    out[:, 5] = link / np.maximum(total, 1)
    out[:, 6] = np.log1p(total / nodes)
    out[:, 7] = total / whole
    out[:, 8] = np.log1p(paras)
    out[:, 9] = mark / np.maximum(total, 1)
    out[:, 10] = before / whole
    out[:, 11] = np.log1p(total[parent])
    return out


class BoostedTrees:
    """Logistic gradient boosting with depth-3 trees over 32 quantile bins a feature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 50, depth: int = 3, rate: float = 0.25):
        self.depth = depth
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, 33)[1:-1])) for c in x.T]
        bins = np.column_stack([np.searchsorted(c, v, side="left") for c, v in zip(self.cuts, x.T)])
        n, f = bins.shape
        cell = bins + np.arange(f) * 33
        share = min(max(y.mean(), 1e-3), 1 - 1e-3) if len(y) else 0.5
        self.base = float(np.log(share / (1 - share)))
        score = np.full(n, self.base)
        self.trees = []
        for _ in range(rounds if len(y) else 0):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, np.maximum(p * (1 - p), 1e-6)
            node = np.zeros(n, int)
            feature, cut = np.zeros(2**depth - 1, int), np.full(2**depth - 1, 99)
            for level in range(depth):
                base = 2**level - 1
                width = 2**level
                key = ((node - base)[:, None] * (f * 33) + cell).ravel()
                sums = [np.bincount(key, weights=np.repeat(v, f), minlength=width * f * 33).reshape(width, f, 33) for v in (g, h)]
                left_g, left_h = (np.cumsum(s, axis=2) for s in sums)
                all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
                gain = left_g**2 / (left_h + 1) + (all_g - left_g) ** 2 / (all_h - left_h + 1) - all_g**2 / (all_h + 1)
                best = gain.reshape(width, -1).argmax(1)
                feature[base : base + width], cut[base : base + width] = best // 33, best % 33
                node = 2 * node + 1 + (bins[np.arange(n), feature[node]] > cut[node])
            leaf = node - (2**depth - 1)
            value = rate * np.bincount(leaf, weights=g, minlength=2**depth) / (np.bincount(leaf, weights=h, minlength=2**depth) + 1)
            score += value[leaf]
            # thresholds on the values themselves: above cut b means above its upper edge
            edge = np.array([self.cuts[k][b] if b < len(self.cuts[k]) else np.inf for k, b in zip(feature, cut)])
            self.trees.append((feature, edge, value))

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, edge, value in self.trees:
            node = np.zeros(len(x), int)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > edge[node])
            out += value[node - (2**self.depth - 1)]
        return out


def decode(page: Page, score: np.ndarray) -> np.ndarray:
    """Kept nodes: the labelling with the highest sum of scores in which children of dropped nodes are dropped."""
    n = len(page.tag)
    drop, best = -score.copy(), score.copy()
    best[0] = drop[0] = 0
    for i in range(n - 1, 0, -1):
        k = page.parent[i]
        drop[k] += drop[i]
        best[k] += max(best[i], drop[i])
    kept = np.zeros(n, bool)
    kept[0] = True
    for i in range(1, n):
        kept[i] = kept[page.parent[i]] and best[i] >= drop[i]
    return kept


def main_text(page: Page, kept: np.ndarray) -> str:
    if not any(kept[k] and t.strip() for k, _, t in page.runs):
        # loose text, with what it holds, stays if nothing else is left
        in_loose = [False] * len(kept)
        for i in range(1, len(kept)):
            in_loose[i] = page.tag[i] == "#text" or in_loose[page.parent[i]]
        kept = kept | np.array(in_loose)
    if all(t in ("#page", "#text") for t in page.tag):
        kept = np.ones(len(page.tag), bool)
    blocks: dict[int, list[str]] = {}
    for node, block, raw in page.runs:
        if kept[node]:
            blocks.setdefault(block, []).append(raw)
    parts = (_SPACE.sub(" ", "".join(b)).strip() for b in blocks.values())
    return " ".join(p for p in parts if p)


def _layout(blocks: list[str], rng: np.random.RandomState, bare: bool = False) -> str:
    """A page with known regions (data-y), laid out from text blocks; bare: the article lies in body itself.

    An element x-loose stands for a run of loose text.
    """
    pick = lambda: blocks[rng.randint(len(blocks))]
    short = lambda: " ".join(pick().split()[: rng.randint(1, 9)])
    chance = lambda p: rng.random_sample() < p
    esc = html_lib.escape

    def name(region: str) -> str:
        words = REGIONS[region].split()
        word = words[rng.randint(len(words))]
        return f' {"id" if chance(0.3) else "class"}="{word}{"-" + str(rng.randint(9)) if chance(0.2) else ""}"'

    def links(k: int) -> str:
        items = "".join(f'<li><a href="/{i}">{esc(short())}</a></li>' for i in range(k))
        return f"<ul>{items}</ul>" if chance(0.7) else "".join(f'<a href="/{i}">{esc(short())}</a> ' for i in range(k))

    def paragraph() -> str:
        t = esc(pick())
        return f"<p><b>{t}<br>" if chance(0.1) else f"<p>{t}</p>"

    def region(kind: str) -> str:
        tag = {"menu": "nav", "head": "header", "foot": "footer", "side": "aside", "form": "form"}.get(kind, "div")
        tag = tag if chance(0.6) else ("section" if chance(0.2) else "div")
        tag = "noscript" if bare and kind == "notice" and chance(0.4) else tag
        attr = name(kind) if tag in ("div", "section") or chance(0.4) else ""
        inner = {
            "menu": lambda: links(rng.randint(2, 9)), "head": lambda: f"<h1>{esc(short())}</h1>" * chance(0.3) + links(rng.randint(0, 5)) + f"<span>{esc(short())}</span>",
            "foot": lambda: f"&copy; {esc(pick()[:200])}" + links(rng.randint(0, 4)), "side": lambda: f"<h3>{esc(short())}</h3>" + (paragraph() if chance(0.5) else links(4)),
            "ad": lambda: esc(pick()) if chance(0.6) else paragraph(), "notice": lambda: f"<p>{esc(pick())}</p><button>{esc(short())}</button>",
            "comment": lambda: "".join(f'<div class="{"comment" if chance(0.6) else "reply"}"><span>{esc(short())}</span>{paragraph()}</div>' for _ in range(rng.randint(1, 5))),
            "form": lambda: f"<label>{esc(short())}</label><input name=q><button>{esc(short())}</button>",
        }[kind]()
        return f'<{tag}{attr} data-y="0">{inner}</{tag}>'

    def loose_article() -> str:
        lines = [f'{esc(pick())} <a href="x">{esc(short())}</a> {esc(short())}' if chance(0.2) else esc(pick()) for _ in range(rng.randint(1, 6))]
        return f'<x-loose data-y="1">{"<br><br>".join(lines)}</x-loose>'

    def loose_rest() -> str:
        inner = (
            f"&copy; {esc(short())}" if chance(0.3) else f'<a href="/">{esc(short())}</a>' if chance(0.3)
            else " | ".join(f'<a href="/{i}">{esc(short())}</a>' for i in range(rng.randint(2, 8))) if chance(0.6) else esc(short())
        )
        return f'<x-loose data-y="0">{inner}</x-loose>'

    body = [f"<h1>{esc(short())}</h1>"] if chance(0.8) else []
    if bare:
        body.append(loose_article())
    for _ in range(rng.randint(1, 12)):
        kind = rng.random_sample()
        if bare and chance(0.4):
            body.append(loose_article())
            continue
        body.append(
            f"<h2>{esc(short())}</h2>" if kind < 0.1 else f"<ul><li>{esc(pick())}</li><li>{esc(short())}</li></ul>" if kind < 0.17
            else f"<blockquote>{paragraph()}</blockquote>" if kind < 0.22 else f"<pre>{esc(pick())}</pre>" if kind < 0.25
            else f"<div>{esc(pick())}</div>" if kind < 0.32 else f'<p>{esc(pick())} <a href="x">{esc(short())}</a> {esc(short())}</p>' if kind < 0.42 else paragraph()
        )
    if chance(0.25):
        body.insert(rng.randint(len(body) + 1), region("ad"))
    if chance(0.15):
        body.append(region("side"))
    if chance(0.25):
        body.append(region("comment"))
    tag = ["article", "main", "div", "section"][rng.choice(4, p=[0.5, 0.2, 0.2, 0.1])]
    attr = name("body") if tag in ("div", "section") or chance(0.3) else ""
    inner = "".join(body)
    article = f'<{tag}{attr} data-y="1">{f"<div>{inner}</div>" if chance(0.15) else inner}</{tag}>'
    if chance(0.3):
        article = f'<div{name("body") if chance(0.5) else ""} data-y="1">{article}</div>'
    above = [region(k) for k in ("menu", "head", "notice", "ad", "form") if chance(0.45)]
    below = [region(k) for k in ("side", "ad", "comment", "form", "notice", "foot", "menu") if chance(0.4)]
    rng.shuffle(above)
    if bare:
        article = inner if chance(0.8) else article
        above, below = ([], []) if chance(0.2) else (above, below)
        above.insert(rng.randint(len(above) + 1), loose_rest()) if chance(0.5) else None
        below.append(loose_rest()) if chance(0.5) else None
    page = "".join(above) + article + "".join(below)
    return f'<html data-y="1"><body data-y="1">{page if chance(0.85) else page[: max(40, int(len(page) * rng.random_sample()))]}'


def fit(pages: DataFrame, max_pages: int = MAX_PAGES, layouts: int = 600) -> BoostedTrees:
    """Boosted trees from layouts of the text blocks of at most max_pages pages, of each its first MAX_SAMPLE_CHARS characters at most."""
    start = F.substring("html", 1, MAX_SAMPLE_CHARS).alias("html")
    sample = pages.where(F.length("html") > 0).select("page_id", start).orderBy(F.xxhash64("page_id"), "page_id", F.xxhash64("html")).limit(max_pages)
    blocks = []
    for row in sample.toLocalIterator():
        found: dict[int, str] = {}
        for _, b, raw in Page(row["html"]).runs:
            found[b] = found.get(b, "") + raw
        blocks += [t for x in found.values() if (t := _SPACE.sub(" ", x).strip())]
    rng = np.random.RandomState(11)
    blocks = blocks or ["text"]
    x, y = [], []
    for i in range(layouts + layouts // 2):
        page = Page(_layout(blocks, rng, bare=i >= layouts))
        page.tag = ["#text" if t == "x-loose" else t for t in page.tag]
        label = [1.0] * len(page.tag)
        for i in range(1, len(page.tag)):
            label[i] = float(page.label[i]) if page.label[i] is not None else label[page.parent[i]]
        x.append(features(page)[1:])
        y.append(np.array(label[1:]))
    return BoostedTrees(np.concatenate(x), np.concatenate(y))


def extract(pages: DataFrame, model: BoostedTrees | None = None, html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(model or fit(pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in at.chunks(batch, html, 1 << 20):
                trees = [Page(h.as_py() or "") for h in part.column(html)]
                x = [features(t) for t in trees]
                score = shared.value.log_odds(np.concatenate(x))
                cut = np.cumsum([0, *map(len, x)])
                texts = [main_text(t, decode(t, score[a:b])) for t, a, b in zip(trees, cut[:-1], cut[1:])]
                yield pa.record_batch(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html).mapInArrow(run, "page_id long, url string, text string, n_chars long")
