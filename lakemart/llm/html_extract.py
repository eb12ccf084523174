"""Main text of web pages by a tree-structured graphical model of their DOM.

Block elements are binary nodes: content or not.  A node has a potential from
its features (tag, words in class and id, share of link text, length) and each
parent-child edge one from both labels and the child's kind.  Sum-product
message passing upward and downward gives every node's marginal; blocks whose
marginal is above one half are kept.  The weights are the maximum likelihood
on labelled pages, by gradient ascent with the same message passing.
"""

from __future__ import annotations

import html as _html
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages whose trees pass messages together.
PAGES = 256

# Fixed values of HTML: elements without end tags, elements whose content is not
# markup, elements whose text is never shown as text, and block elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style template noscript svg math canvas object audio video iframe title textarea select "
                   "option button datalist xmp noembed noframes".split())
BLOCK = frozenset("html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd nav header footer aside form "
                  "fieldset table caption thead tbody tfoot tr td th blockquote pre figure figcaption address details summary "
                  "hgroup search dialog center menu".split())
CLOSES_P = BLOCK - {"html", "body", "caption", "thead", "tbody", "tfoot", "tr", "td", "th", "li", "dt", "dd"} | {"hr"}
#: Elements that end when one of their kind begins, and what bounds the search for the open one.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
            "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"})}
#: A tag whose attributes hold neither < nor >, which is nearly every tag.
_PLAIN = re.compile(r"<(/?)([a-zA-Z][^\s/<>\"']*+)(?=[\s/>])((?:[^<>\"']++|\"[^\"<>]*+\"|'[^'<>]*+')*+)>")
_NAME_END = re.compile(r"[\s/>]")
_MARK = re.compile(r"[>\"']")
_ATTR = re.compile(r"\b(?:class|id|role|aria-label|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDES = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?until)|display\s*:\s*none", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

TAGS = ("article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd nav header footer aside form table tr td th "
        "blockquote pre figure figcaption address body html").split()
#: Words in class, id and role that speak against and for content.
AGAINST = ("nav menu header footer sidebar side ad ads advert advertisement adsense banner promo promotion sponsor sponsored cookie cookies notice "
           "consent gdpr popup modal overlay alert comment comments reply replies respond discussion form login signup search newsletter "
           "subscribe share sharing social related recommended breadcrumb breadcrumbs pagination pager widget copyright legal toolbar "
           "topbar masthead navigation contentinfo complementary dialog disclaimer tags meta byline author").split()
FOR = "article content post entry story text body main page prose copy lead section".split()
FEATURES = {name: i for i, name in enumerate(
    ["bias", *("tag:" + t for t in TAGS), "tag:other", *("word:" + w for w in AGAINST), "for", "no words",
     "links:some", "links:most", "text:none", "text:short", "text:middle", "text:long"])}
#: Kinds of child nodes, each with its own parent-child potential.
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th tr tbody thead tfoot ul ol dl table figure figcaption caption".split())


class _Next:
    """Places of a pattern, asked for from left to right: the text is searched once."""

    def __init__(self, pattern: re.Pattern, text: str):
        self.search, self.text, self.at = pattern.search, text, -1

    def __call__(self, start: int) -> int:
        """The first place from ``start`` on (the text's end if there is none)."""
        if self.at < start:
            m = self.search(self.text, start)
            self.at = m.start() if m else len(self.text)
        return self.at


class Tags:
    """Markup of a page from left to right, in time proportional to its length:
    what an unclosed tag, quote or comment looked for in vain is not looked for again."""

    def __init__(self, text: str):
        self.text = text
        self.name_end, self.mark = _Next(_NAME_END, text), _Next(_MARK, text)
        self.last = {c: text.rfind(c) for c in (">", '"', "'", "]]>")}
        self.open_ended: set[int] = set()  # marks from which on no tag ends

    def next(self, at: int) -> tuple[int, int, str | None, bool, str | None, str] | None:
        """The first markup from ``at`` on: start, end, marked text of a CDATA
        section, whether it is an end tag, name (None if it is no tag), attributes."""
        text = self.text
        start = text.find("<", at)
        while start >= 0:
            m = _PLAIN.match(text, start)
            if m:
                return start, m.end(), None, m[1] == "/", m[2], m[3]
            if text.startswith("<!--", start):
                end = text.find("-->", start + 4)
                return start, end + 3 if end >= 0 else len(text), None, False, None, ""
            if start > self.last[">"]:
                start = text.find("<!--", start)  # nothing but an unclosed comment
                continue
            if text.startswith("<![CDATA[", start) and start + 9 <= self.last["]]>"]:
                end = text.find("]]>", start + 9)
                return start, end + 3, text[start + 9: end], False, None, ""
            if text.startswith(("<!", "<?"), start):
                end = text.find(">", start + 2)
                if end >= 0:
                    return start, end + 1, None, False, None, ""
            else:
                closing = text.startswith("/", start + 1)
                name = start + 1 + closing
                first = text[name: name + 1]
                if first.isascii() and first.isalpha():
                    attrs = self.name_end(name)
                    end = self._tag_end(attrs)
                    if end >= 0:
                        return start, end + 1, None, closing, text[name:attrs], text[attrs:end]
            start = text.find("<", start + 1)
        return None

    def _tag_end(self, at: int) -> int:
        """Place of the > outside of quotes that ends a tag, or -1."""
        text, seen = self.text, []
        at = self.mark(at)
        while at < len(text) and at not in self.open_ended:
            if text[at] == ">":
                return at
            seen.append(at)
            if self.last[text[at]] == at:
                break
            m = _MARK.search(text, text.find(text[at], at + 1) + 1)
            at = m.start() if m else len(text)
        self.open_ended.update(seen)
        return -1


class Dom:
    """Block nodes of a page: parents, tags, features and pieces of text in page order."""

    __slots__ = ("parent", "tag", "feature", "pieces", "links", "size", "stack", "open")

    def __init__(self, text: str):
        self.parent, self.tag, self.feature, self.pieces, self.links, self.size = [-1], ["html"], [""], [], [0], [0]
        stack = self.stack = [("html", 0, False, False)]  # tag, block node, hidden, link
        self.open: dict[str, list[int]] = {}  # places in the stack of each tag, the root aside
        tags, at = Tags(text), 0
        while (found := tags.next(at)) is not None:
            start, end, marked, closing, tag, attrs = found
            if start > at:
                self._put(stack[-1], text[at:start])
            at = end
            if tag is None:
                if marked:
                    self._put(stack[-1], marked)
                continue
            tag = tag.lower()
            if closing:
                self._close(tag)
                continue
            self._open(tag, attrs)
            if tag in RAW and stack[-1][0] == tag:
                m = re.compile(rf"</{tag}\b", re.I).search(text, at)
                over = text.find(">", m.end()) if m else -1
                at = over + 1 if over >= 0 else len(text)
                self._cut(len(stack) - 1)
        if at < len(text):
            self._put(stack[-1], text[at:])

    def _put(self, top, raw: str) -> None:
        if not top[2]:
            self.pieces.append((top[1], raw))
            n = len(raw.strip())
            self.size[top[1]] += n
            if top[3]:
                self.links[top[1]] += n

    def _open(self, tag: str, attrs: str) -> None:
        stack = self.stack
        if tag == "br" or tag == "hr":
            self._put(stack[-1], " ")
        if tag in CLOSES_P:
            self._end({"p"}, {"td", "th", "table", "button", "object"})
        if tag in SIBLINGS:
            self._end(*SIBLINGS[tag])
        if tag in VOID:
            return
        if tag == "html" or (tag == "body" and self.open.get("body")):
            return
        top = stack[-1]
        if tag != "body" and top[0] == "head" and tag in BLOCK:
            self._cut(len(stack) - 1)
            top = stack[-1]
        if tag == "body" and top[0] == "head":
            self._cut(len(stack) - 1)
            top = stack[-1]
        hidden = top[2] or tag in HIDDEN or bool(attrs and _HIDES.search(attrs))
        node = top[1]
        if tag in BLOCK:
            node = len(self.parent)
            self.parent.append(top[1])
            self.tag.append(tag)
            self.feature.append(" ".join(a or b or c for a, b, c in _ATTR.findall(attrs)) if attrs else "")
            self.links.append(0)
            self.size.append(0)
        self.open.setdefault(tag, []).append(len(stack))
        stack.append((tag, node, hidden, top[3] or tag == "a"))

    def _cut(self, at: int) -> None:
        """Close the elements from place ``at`` of the stack on."""
        for tag, *_ in reversed(self.stack[at:]):
            self.open[tag].pop()
        del self.stack[at:]

    def _innermost(self, tags) -> int:
        """Place of the innermost open element of ``tags``, or 0."""
        return max((self.open[t][-1] for t in tags if self.open.get(t)), default=0)

    def _end(self, kinds, bounds) -> None:
        """Close the innermost open element of ``kinds`` down to one of ``bounds``;
        of three kinds or more, all of them."""
        while (at := self._innermost(kinds)) and at > self._innermost(bounds):
            self._cut(at)
            if len(kinds) < 3:
                break

    def _close(self, tag: str) -> None:
        at = self._innermost((tag,))
        if at and (tag in BLOCK or at > self._innermost(("td", "th"))):
            self._cut(at)


@lru_cache(maxsize=20_000)
def _hints(words: str) -> tuple[int, ...]:
    found = {w.lower() for w in _WORD.findall(words)}
    against = [FEATURES["word:" + w] for w in AGAINST if w in found]
    return tuple(against) if against else (FEATURES["for"],) if found & set(FOR) else (FEATURES["no words"],)


def node_features(dom: Dom) -> list[list[int]]:
    out = []
    for tag, words, size, links in zip(dom.tag, dom.feature, dom.size, dom.links, strict=True):
        f = [0, FEATURES["tag:" + tag] if tag in TAGS else FEATURES["tag:other"], *_hints(words)]
        if links and links > 0.6 * size:
            f.append(FEATURES["links:most"])
        elif links > 0.2 * size:
            f.append(FEATURES["links:some"])
        f.append(FEATURES["text:none"] if not size else FEATURES["text:short"] if size < 40
                 else FEATURES["text:middle"] if size < 160 else FEATURES["text:long"])
        out.append(f)
    return out


class Forest:
    """The trees of several pages as arrays, parents before children."""

    def __init__(self, doms: list[Dom]):
        parent, depth, kind, owner, feature, page, base = [], [], [], [], [], [], 0
        for k, dom in enumerate(doms):
            level = []
            for p, tag in zip(dom.parent, dom.tag, strict=True):
                level.append(0 if p < 0 else level[p] + 1)
                parent.append(p + base if p >= 0 else -1)
                kind.append(0 if tag in FLOW else 1)
            depth += level
            for i, f in enumerate(node_features(dom)):
                owner += [base + i] * len(f)
                feature += f
            page += [k] * len(level)
            base += len(level)
        self.n = base
        self.parent, self.kind = np.array(parent, np.int64), np.array(kind, np.int64)
        self.owner, self.feature, self.page = (np.array(x, np.int64) for x in (owner, feature, page))
        depth = np.array(depth)
        order = np.argsort(depth, kind="stable")
        ends = np.searchsorted(depth[order], np.arange(depth.max() + 2)) if base else np.zeros(1, int)
        self.levels = [order[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def marginals(self, unary: np.ndarray, edge: np.ndarray):
        """Sum-product over all trees.  unary: weights of features for label 1;
        edge: [kind, parent label, child label].  Returns the node marginals
        (n, 2) and the edge marginals (n, 2, 2) of each node with its parent."""
        own = np.zeros((self.n, 2))
        own[:, 1] = np.bincount(self.owner, unary[self.feature], self.n)
        up, sent = own.copy(), np.zeros((self.n, 2))
        for nodes in reversed(self.levels[1:]):
            both = up[nodes][:, None, :] + edge[self.kind[nodes]]
            sent[nodes] = np.logaddexp(both[:, :, 0], both[:, :, 1])
            np.add.at(up, self.parent[nodes], sent[nodes])
        total, pair = up.copy(), np.zeros((self.n, 2, 2))
        for nodes in self.levels[1:]:
            above = total[self.parent[nodes]] - sent[nodes]
            both = above[:, :, None] + edge[self.kind[nodes]] + up[nodes][:, None, :]
            pair[nodes] = both
            total[nodes] = np.logaddexp(both[:, 0], both[:, 1])
        total -= np.logaddexp(total[:, :1], total[:, 1:])
        inner = np.concatenate(self.levels[1:]) if len(self.levels) > 1 else np.zeros(0, np.int64)
        flat = pair[inner].reshape(-1, 4)
        flat = np.exp(flat - flat.max(1, keepdims=True)) if len(flat) else flat
        edges = np.zeros((self.n, 2, 2))
        edges[inner] = (flat / flat.sum(1, keepdims=True)).reshape(-1, 2, 2) if len(flat) else 0
        return np.exp(total), edges


def labelled_pages() -> list[tuple[str, list[int]]]:
    """Training pages with a label for each block node, the root first, in page
    order.  They combine the usual parts of pages; ``data-y`` carries the label
    and is taken out again."""
    long = "A plain sentence of running text that tells a part of the story, and one more, so that it is long enough to read. " * 2
    short = "A short remark here."
    links = '<a href="/a">First</a> <a href="/b">Second</a>'

    def e(tag, y, inner, words=""):
        return f'<{tag}{f" class={chr(34)}{words}{chr(34)}" if words else ""} data-y="{y}">{inner}</{tag}>'

    def junk(tag, words, inner=None):
        body = inner or e("p", 0, short) + e("p", 0, long) + e("ul", 0, e("li", 0, links) + e("li", 0, short))
        return e(tag, 0, body, words)

    menus = [junk("nav", "", e("ul", 0, e("li", 0, links) * 3)), junk("header", "site-header", e("h1", 0, "A site") + e("p", 0, short)),
             junk("div", "menu", e("ul", 0, e("li", 0, links) * 2)), junk("header", "", e("div", 0, e("a", 0, "A site").replace(' data-y="0"', "", 1)) + e("nav", 0, links))]
    extras = [junk("aside", ""), junk("aside", "sidebar"), junk("div", "sidebar"), junk("div", "ad", short), junk("div", "ad", long),
              junk("div", "advert", e("p", 0, long)), junk("section", "comments", e("h2", 0, "Replies") + e("article", 0, e("p", 0, long), "comment") + e("div", 0, e("p", 0, short), "reply")),
              junk("div", "cookie-notice", e("p", 0, long)), junk("form", "", e("p", 0, "Your name") + e("div", 0, short)),
              junk("form", "", short), junk("form", "", f"Name {e('div', 0, short)}"),
              junk("div", "newsletter", e("form", 0, e("p", 0, short)) + e("p", 0, long)), junk("div", "related", e("h3", 0, "More") + e("ul", 0, e("li", 0, links) * 2)),
              junk("div", "share", links), junk("div", "banner", e("div", 0, short)), junk("ol", "comments", e("li", 0, e("p", 0, long)) * 2),
              junk("div", "comment-list", e("div", 0, e("p", 0, long)) + e("div", 0, short)), junk("section", "promo", e("h2", 0, "Buy") + e("p", 0, long))]
    extras += [junk("div", w, e("p", 0, long) + e("p", 0, short)) for w in AGAINST[:-4]]
    footers = [junk("footer", "", short), junk("footer", "", e("p", 0, long) + e("ul", 0, e("li", 0, links))), junk("div", "footer", e("p", 0, short))]
    flow = [e("p", 1, long), e("p", 1, short), e("h2", 1, "A heading"), e("ul", 1, e("li", 1, long) + e("li", 1, short)), e("blockquote", 1, e("p", 1, long)),
            e("p", 1, f"{long} {links}"), e("pre", 1, short), e("table", 1, e("tbody", 1, e("tr", 1, e("td", 1, short) + e("td", 1, long)))),
            e("ol", 1, e("li", 1, short) * 3), e("figure", 1, e("figcaption", 1, short)), e("p", 1, "Yes."), e("h3", 1, "Next"),
            e("dl", 1, e("dt", 1, "Term") + e("dd", 1, long)), e("section", 1, e("h2", 1, "A part") + e("p", 1, long)), e("div", 1, e("p", 1, long) + e("p", 1, short)),
            e("div", 1, long), e("p", 1, links)]
    frames = [lambda x: e("article", 1, x), lambda x: e("main", 1, e("article", 1, x)), lambda x: e("div", 1, x, "content"),
              lambda x: e("main", 1, x), lambda x: e("div", 0, e("article", 1, x), "wrapper"), lambda x: e("div", 1, e("div", 1, x, "entry-content"), "post"),
              lambda x: e("section", 1, x), lambda x: e("div", 0, e("div", 1, x, "article-body"), "container")]
    out = []

    def put(page, root=0):
        out.append((re.sub(r' data-y="\d"', "", page), [root, *map(int, re.findall(r'data-y="(\d)"', page))]))

    rng = np.random.default_rng(7)

    def some(of, least, most):
        return [of[i] for i in rng.integers(len(of), size=rng.integers(least, most + 1))]

    for k in range(4 * len(extras)):
        parts = [*some([e("h1", 1, "A title of the page"), e("h1", 1, "A title") + e("p", 1, short)], 0, 1), *some(flow, 1, 6)]
        for x in [extras[k // 4]] * (k % 2) + some(extras, 0, 1):
            parts.insert(int(rng.integers(1, len(parts) + 1)), x)
        body = frames[k % len(frames)]("".join(parts))
        body = "".join(some(extras, 0, 2)) + body + "".join(some(extras, 0, 2))
        for words in some(["", "wrap", "container", "row", "layout"], 0, 2):
            body = e("div", 0, body, words)
        page = "".join(some(menus, 0, 2)) + body + "".join(some(footers, 0, 1))
        put(f'<html><head><title>t</title></head><body data-y="0">{page}</body></html>')
    for k in range(12):
        parts = "".join(flow[(k + j) % len(flow)] for j in range(1 + k % 4))
        put(f'<html><head><title>t</title></head><body data-y="1">{parts}</body></html>', 1)
        put(f'<html><body data-y="1">{e("h1", 1, "A title")}{parts}{footers[k % len(footers)]}</body></html>', 1)
        put(parts, 1)
        put((long, short, long + "<br>" + short)[k % 3], 1)
    return out


@lru_cache(maxsize=1)
def trained(steps: int = 250, rate: float = 0.2, decay: float = 2e-4) -> tuple[np.ndarray, np.ndarray]:
    """Unary and edge weights of greatest likelihood on the labelled pages."""
    pages = labelled_pages()
    forest = Forest([Dom(p) for p, _ in pages])
    label = np.concatenate([np.array(y) for _, y in pages])
    if len(label) != forest.n:
        raise ValueError("labels do not match the pages' nodes")
    inner = np.flatnonzero(forest.parent >= 0)
    unary, edge = np.zeros(len(FEATURES)), np.zeros((2, 2, 2))
    seen = np.bincount(forest.feature, label[forest.owner], len(FEATURES))
    seen_edge = np.zeros((2, 2, 2))
    np.add.at(seen_edge, (forest.kind[inner], label[forest.parent[inner]], label[inner]), 1)
    m = [np.zeros_like(unary), np.zeros_like(edge)]
    v = [np.zeros_like(unary), np.zeros_like(edge)]
    n = len(pages)
    for t in range(1, steps + 1):
        node, pair = forest.marginals(unary, edge)
        expected = np.bincount(forest.feature, node[forest.owner, 1], len(FEATURES))
        expected_edge = np.zeros((2, 2, 2))
        np.add.at(expected_edge, forest.kind[inner], pair[inner])
        for i, (w, g) in enumerate(((unary, (seen - expected) / n - decay * unary), (edge, (seen_edge - expected_edge) / n - decay * edge))):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            w += rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.99**t)) + 1e-8)
    return unary, edge


def extract(pages: list[str], weights: tuple[np.ndarray, np.ndarray] | None = None) -> list[str]:
    """Main text of each page."""
    unary, edge = weights or trained()
    out = []
    for k in range(0, len(pages), PAGES):
        doms = [Dom(p) for p in pages[k: k + PAGES]]
        forest = Forest(doms)
        keep = forest.marginals(unary, edge)[0][:, 1] > 0.5
        base = 0
        for dom in doms:
            blocks: list[list] = []
            for node, raw in dom.pieces:
                if not blocks or blocks[-1][0] != node:
                    blocks.append([node, []])
                blocks[-1][1].append(raw)
            lines = [" ".join(_html.unescape("".join(raw)).split()) for node, raw in blocks if keep[base + node]]
            out.append("\n".join([x for x in lines if x]))
            base += len(dom.parent)
    return out


def extract_text(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns ``keep`` and the main text (empty if there is none) of every row.

    Null and empty pages give an empty text; broken markup is read as far as
    it goes (a tag that never ends is text, a comment or script that never ends
    reaches to the end), in time proportional to the page; null ids and repeated rows stay as they are; other columns are
    not read.  A column of ``keep`` must not be named text.
    """
    weights = trained()

    def run(batches):
        for b in batches:
            texts = extract([x or "" for x in b.column(b.num_columns - 1).to_pylist()], weights)
            yield pa.record_batch([*b.columns[:-1], pa.array(texts, pa.string())], names=[*keep, "text"])

    src = pages.select(*keep, F.col(html_col).alias("html"))
    schema = ", ".join(f"`{c}` {t}" for c, t in src.dtypes[:-1])
    return src.mapInArrow(run, f"{schema}, text string")
