"""Op 4, main text of web pages by gradient-boosted trees over DOM nodes.

A page becomes a tree of its block elements; inline markup only contributes its text.
Every node gets features of its subtree (text and link density, words, punctuation, tags),
its attributes' tokens, depth, siblings, ancestors and place. Boosted trees give the
evidence that it is article text. Decoding chooses for every node "all of it", "none of it"
or "by its children", the last at a price where it has several, so that the total evidence is largest; a
node under a kept or a dropped one has no say, hence no contradictions.

The trees are learnt here from pages composed by a generator out of marked parts (article
forms, menus, headers, sidebars, notices, adverts, forms, comments, footers), filled with
sentences from a bounded sample of the given pages (``SAMPLE_PAGES``).

Scale: a map over the pages without shuffle; the trees are some kilobytes. A task holds an
Arrow batch and the nodes of ``NODES`` elements.

Defined cases: NULL html is empty, and an empty page has the empty text; character
references are decoded; white space (and <br>) inside a block becomes one space; a page
of any length is read whole; repeated rows are read one by one; an empty table gives an
empty result; further columns are not read.
"""

from __future__ import annotations

import math
import random
import re
from dataclasses import dataclass
from html import escape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import register, table

SAMPLE_PAGES = 200
TRAIN_PAGES = 500
TREES, DEPTH, STEP, BINS = 60, 4, 0.2, 24
SPLIT_PRICE = 1.0
NODES = 20_000

INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIP = frozenset("script style template noscript svg math iframe object select textarea button title datalist canvas audio video".split())
PHRASE = INLINE | SKIP  # these leave the block they stand in open
HEAD = frozenset("title meta link style script base noscript template head".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"}, "tfoot": {"tr", "td", "th", "tbody"}}
SCOPES = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"},
          "thead": {"table"}, "tbody": {"table"}, "tfoot": {"table"}}
TAGS = ["p", "h1", "h2 h3 h4 h5 h6", "li dt dd", "ul ol dl", "table tbody thead tfoot tr", "td th caption", "div section center",
        "article main", "nav menu", "header hgroup", "footer address", "aside", "form fieldset input", "blockquote pre", "figure figcaption"]
TAG_OF = {t: i for i, names in enumerate(TAGS) for t in names.split()}
GOOD = re.compile(r"article|content|post|entry|main|story|body|text|blog|prose|paragraph")
BAD = {"menu": r"nav|menu|breadcrumb|crumb|topbar|toolbar|tabs|pager|paginat|skip|navigation|directory",
       "frame": r"footer|header|masthead|banner|copyright|colophon|brand|logo|contentinfo|legal",
       "side": r"sidebar|aside|widget|related|recommend|popular|trending|teaser|complementary|rail|promo|sponsor|tag-?s|category|archive|rss",
       "advert": r"\bads?\b|advert|adsense|sponsor|banner|promo|doubleclick|taboola|outbrain",
       "notice": r"cookie|consent|gdpr|notice|alert|popup|modal|overlay|disclaimer|newsletter|subscribe|signup|login|paywall|toast",
       "talk": r"comment|disqus|reply|respond|discussion|review|feedback|share|social|follow|like|vote|form|search"}
BAD_RE = [re.compile(p) for p in BAD.values()]
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
WHITE = re.compile(r"\s+")


class Page(HTMLParser):
    """Block elements of a page in order, with their text blocks."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.attrs, self.mark = ["#"], [-1], [""], [None]
        self.blocks: list[tuple[int, str, int]] = []  # owner, text, characters in links
        self.open: list[tuple[str, int]] = [("#", 0)]  # every open element with its block
        self.piece: list[str] = []
        self.linked = self.skip = self.links = 0
        self.feed(html)
        self.close()
        self._flush()

    def _flush(self):
        if self.piece:
            text = WHITE.sub(" ", "".join(self.piece)).strip()
            if text:
                self.blocks.append((self.open[-1][1], text, min(self.linked, len(text))))
            self.piece, self.linked = [], 0

    def _pop(self):
        tag, _ = self.open[-1]
        if tag not in PHRASE:
            self._flush()
        self.open.pop()
        if tag in SKIP:
            self.skip -= 1
        if tag == "a":
            self.links -= 1

    def _close_to(self, names, scope=()):
        """Close up to the innermost open element of ``names``, not beyond ``scope``."""
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] in names:
                while len(self.open) > i:
                    self._pop()
                return
            if self.open[i][0] in scope:
                return

    def handle_starttag(self, tag, attrs):
        if tag in ("html", "body"):
            self._close_to({"head"})
            return
        if tag not in HEAD and any(t == "head" for t, _ in self.open[1:3]):
            self._close_to({"head"})
        if tag == "br":
            self.piece.append(" ")
            return
        if tag == "a":
            self._close_to({"a"}, {t for t, _ in self.open if t not in INLINE})
        if tag not in PHRASE:
            if tag in CLOSES:
                self._close_to(CLOSES[tag], SCOPES.get(tag, ()))
            self._close_to({"p"}, {"td", "th", "li", "div", "article", "section", "main", "table", "button", "form"})
            self._flush()
        if tag in VOID:
            return
        at = self.open[-1][1]
        if tag not in PHRASE:
            a = dict(attrs)
            words = " ".join(str(a.get(k) or "") for k in ("class", "id", "role", "aria-label", "itemprop", "data-type")).lower()
            if "hidden" in a or a.get("aria-hidden") == "true" or HIDDEN.search(a.get("style") or ""):
                words += " \x00"
            self.tag.append(tag)
            self.parent.append(at)
            self.attrs.append(words)
            self.mark.append(a.get("data-k"))
            at = len(self.tag) - 1
        self.open.append((tag, at))
        if tag in SKIP:
            self.skip += 1
        if tag == "a":
            self.links += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag == "br":
            self.piece.append(" ")
        elif tag == "p" and not any(t == "p" for t, _ in self.open):
            self._flush()
        elif tag not in VOID and tag not in ("html", "body"):
            self._close_to({tag}, set() if tag not in INLINE else {t for t, _ in self.open[1:] if t not in INLINE})

    def handle_data(self, data):
        if not self.skip and not any(t == "head" for t, _ in self.open[1:3]):
            self.piece.append(data)
            if self.links:
                self.linked += len(data)



def node_features(page: Page) -> np.ndarray:
    """A row of features for each node."""
    n, parent = len(page.tag), np.array(page.parent)
    sums = np.zeros((n, 7))  # characters, in links, words, marks, blocks, own characters, elements
    start = np.zeros(n)
    at, seen = 0, np.zeros(n, bool)
    for owner, text, linked in page.blocks:
        words = text.count(" ") + 1
        ends = text.count(".") + text.count(",") + text.count("!") + text.count("?") + text.count("。") + text.count("،")
        sums[owner] += (len(text), linked, words, ends, 1, len(text), 0)
        if not seen[owner]:
            start[owner], seen[owner] = at, True
        at += len(text)
    sums[:, 6] = 1
    kids = np.zeros(n)
    for v in range(n - 1, 0, -1):
        p = page.parent[v]
        sums[p, [0, 1, 2, 3, 4, 6]] += sums[v, [0, 1, 2, 3, 4, 6]]
        kids[p] += 1
        if seen[v] and (not seen[p] or start[v] < start[p]):
            start[p], seen[p] = start[v], True
    kind = np.array([TAG_OF.get(t, len(TAGS)) for t in page.tag])
    good = np.array([1.0 if GOOD.search(a) else 0.0 for a in page.attrs])
    bad = np.array([[1.0 if a and r.search(a) else 0.0 for r in BAD_RE] for a in page.attrs])
    hidden = np.array([a.endswith("\x00") for a in page.attrs], float)
    # what stands above: good and bad tokens, and the telling elements
    telling = np.column_stack([good, bad, *[(kind == TAG_OF[t]) for t in ("article", "nav", "header", "footer", "aside", "form")], hidden]).astype(float)
    above, depth = np.zeros_like(telling), np.zeros(n)
    place, group, alike = np.zeros(n), np.ones(n), np.ones(n)
    before, after, last_kid, same = np.zeros(n), np.zeros(n), {}, {}
    for v in range(1, n):
        p = page.parent[v]
        above[v] = np.maximum(above[p], telling[p])
        depth[v] = depth[p] + 1
        place[v] = last_kid[p][1] + 1 if p in last_kid else 0
        if p in last_kid:
            u = last_kid[p][0]
            before[v], after[u] = sums[u, 0], sums[v, 0]
        last_kid[p] = (v, place[v])
        same[p, page.tag[v]] = same.get((p, page.tag[v]), 0) + 1
    group[1:] = kids[parent[1:]]
    alike[1:] = [same[page.parent[v], page.tag[v]] for v in range(1, n)]
    chars, total = np.maximum(sums[:, 0], 1), max(1.0, sums[0, 0])
    log = np.log1p
    link = sums[:, 1] / chars
    cols = [log(sums[:, 0]), link, log(sums[:, 2]), sums[:, 0] / np.maximum(sums[:, 2], 1), sums[:, 3] / np.maximum(sums[:, 2], 1),
            sums[:, 6] / chars * 100, log(sums[:, 4]), log(sums[:, 5]), sums[:, 0] / np.maximum(sums[:, 4], 1), depth, place, place / np.maximum(group, 1),
            group, alike / np.maximum(group, 1), log(before), log(after), start / total, (start + sums[:, 0]) / total, sums[:, 0] / total,
            link[np.maximum(parent, 0)], log(kids), np.full(n, log(total))]
    one = np.zeros((n, len(TAGS) + 1))
    one[np.arange(n), kind] = 1
    return np.column_stack([one, bad, good, above[:, :1], above[:, 1:1 + len(BAD)], above[:, 1 + len(BAD):], *cols])


@dataclass
class Forest:
    """Boosted trees of equal depth; node k of a level has children 2k and 2k + 1."""
    base: float
    feature: np.ndarray  # trees x (2^depth - 1)
    cut: np.ndarray
    leaf: np.ndarray  # trees x 2^depth

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of article text."""
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        depth = int(math.log2(self.leaf.shape[1]))
        for f, c, leaf in zip(self.feature, self.cut, self.leaf):
            k = np.zeros(len(x), int)
            for level in range(depth):
                at = (1 << level) - 1 + k
                k = 2 * k + (x[rows, f[at]] > c[at])
            total += leaf[k]
        return total


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Forest:
    """Gradient boosting of histogram trees on log loss."""
    edges = [np.unique(np.quantile(x[:, j], np.arange(1, BINS) / BINS)) for j in range(x.shape[1])]
    edges = [np.array([0.5]) if set(np.unique(x[:, j])) <= {0.0, 1.0} else e for j, e in enumerate(edges)]
    binned = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])
    p = np.average(y, weights=w) if w.sum() else 0.5
    p = min(max(p, 1e-3), 1 - 1e-3)
    forest = Forest(math.log(p / (1 - p)), np.zeros((trees, (1 << depth) - 1), int), np.full((trees, (1 << depth) - 1), np.inf),
                    np.zeros((trees, 1 << depth)))
    total = np.full(len(y), forest.base)
    for t in range(trees):
        q = 1 / (1 + np.exp(-total))
        g, h, k = w * (y - q), w * q * (1 - q), np.zeros(len(y), int)
        for level in range(depth):
            n = 1 << level
            best, pick = np.full(n, 1e-6), [(0, len(edges[0]))] * n
            gs, hs = np.bincount(k, g, n), np.bincount(k, h, n)
            for j, e in enumerate(edges):
                m = len(e) + 1
                gl = np.cumsum(np.bincount(k * m + binned[:, j], g, n * m).reshape(n, m), axis=1)[:, :-1]
                hl = np.cumsum(np.bincount(k * m + binned[:, j], h, n * m).reshape(n, m), axis=1)[:, :-1]
                gr, hr = gs[:, None] - gl, hs[:, None] - hl
                gain = np.where((hl > 1) & (hr > 1), gl ** 2 / (hl + 1) + gr ** 2 / (hr + 1) - (gs ** 2 / (hs + 1))[:, None], -1.0)
                at = gain.argmax(axis=1)
                for a in np.flatnonzero(gain[np.arange(n), at] > best):
                    best[a], pick[a] = gain[a, at[a]], (j, int(at[a]))
            for a, (j, c) in enumerate(pick):
                forest.feature[t, n - 1 + a] = j
                forest.cut[t, n - 1 + a] = edges[j][c] if c < len(edges[j]) else np.inf
            f, c = np.array([j for j, _ in pick]), np.array([c for _, c in pick])
            k = 2 * k + (binned[np.arange(len(y)), f[k]] > c[k])
        leaf = STEP * np.bincount(k, g, 1 << depth) / (np.bincount(k, h, 1 << depth) + 1)
        forest.leaf[t] = leaf
        total += leaf[k]
    return forest


def decode(page: Page, evidence: np.ndarray, price: float = SPLIT_PRICE) -> list[str]:
    """The texts of the blocks that the best consistent choice keeps."""
    n = len(page.tag)
    own, whole, kids, textful = np.zeros(n, bool), np.clip(evidence, -6, 6), np.zeros(n), np.zeros(n, bool)
    for owner, _, _ in page.blocks:
        own[owner] = textful[owner] = True
    alone, parts = whole.copy(), own.astype(int)
    for v in range(n - 1, 0, -1):
        if textful[v]:
            textful[page.parent[v]] = True
            parts[page.parent[v]] += 1
    whole[~textful] = 0
    best = np.zeros(n)
    for v in range(n - 1, -1, -1):  # children come after their parents
        if textful[v]:
            split = kids[v] + (max(alone[v], 0.0) if own[v] else 0.0) - (price if parts[v] > 1 else 0.0)
            best[v] = max(whole[v], 0.0, split)
            if v:
                kids[page.parent[v]] += best[v]
                whole[page.parent[v]] += whole[v]
    state = np.zeros(n, int)  # 0 none, 1 all, 2 by its children
    for v in range(n):
        if v and state[page.parent[v]] != 2:
            state[v] = state[page.parent[v]]
        elif textful[v] and best[v] > 0:
            state[v] = 1 if best[v] == whole[v] else 2
    return [text for owner, text, _ in page.blocks if state[owner] == 1 or (state[owner] == 2 and alone[owner] > 0)]


class Maker:
    """Composes pages of marked parts (data-k is 1 for article text, else 0)."""

    def __init__(self, sentences: list[str], seed: int = 11):
        self.r = random.Random(seed)
        self.pool = sentences or [" ".join("".join(self.r.choice("aeioulmnrst") for _ in range(self.r.randint(2, 9)))
                                           for _ in range(self.r.randint(4, 18))).capitalize() + "." for _ in range(400)]

    def words(self, lo, hi):
        w = " ".join(self.r.choice(self.pool) for _ in range(hi // 4 + 1)).split()
        return escape(" ".join(w[:self.r.randint(lo, hi)]), quote=False)

    def prose(self, lo=1, hi=7):
        s = escape(" ".join(self.r.choice(self.pool) for _ in range(self.r.randint(lo, hi))), quote=False)
        if self.r.random() < 0.15:
            s += f' <a href="/x">{self.words(1, 4)}</a> {self.words(2, 8)}'
        if self.r.random() < 0.1:
            s = f"<em>{s}</em>"
        return s

    def some(self, *options):
        return self.r.choice(options)

    def attr(self, *names):
        return f' {self.some("class", "class", "id")}="{self.some(*names)}"' if names else ""

    def links(self, lo=3, hi=9, long=False):
        a = [f'<a href="/{i}">{self.words(1, 9 if long else 3)}</a>' for i in range(self.r.randint(lo, hi))]
        return self.some("<ul>" + "".join(f"<li>{x}</li>" for x in a) + "</ul>", " | ".join(a), "".join(f"<div>{x}</div>" for x in a))

    def menu(self):
        e = self.some("nav", "nav", "div", "ul")
        body = self.links()
        return f'<{e} data-k="0"{self.attr("menu", "navbar", "main-nav", "topnav", "breadcrumbs") if e == "div" else ""}>{body}</{e}>'

    def header(self):
        e, a = self.some(("header", ""), ("div", self.attr("header", "masthead", "site-header", "top-banner")))
        return f'<{e} data-k="0"{a}><{self.some("h1", "h2", "div", "p")}>{self.words(1, 4)}</{self.some("h1", "h2", "div", "p")}>{self.some("", "<p>" + self.words(3, 10) + "</p>", self.links(2, 5))}</{e}>'

    def footer(self):
        e, a = self.some(("footer", ""), ("footer", ""), ("div", self.attr("footer", "site-footer", "copyright")))
        return f'<{e} data-k="0"{a}>{self.some("&copy; example.org &middot; ", "", "<p>")}{self.prose(1, 2)}{self.some("", self.links(2, 6))}</{e}>'

    def side(self):
        e, a = self.some(("aside", ""), ("div", self.attr("sidebar", "widget", "related-posts", "right-rail", "popular")), ("section", self.attr("recommended", "trending", "widget-area")))
        return f'<{e} data-k="0"{a}><h3>{self.words(1, 4)}</h3>{self.some(self.links(3, 8, True), "<p>" + self.prose(1, 3) + "</p>", self.links() + "<p>" + self.prose(1, 2) + "</p>")}</{e}>'

    def advert(self):
        return f'<{self.some("div", "div", "section", "aside")} data-k="0"{self.attr("ad", "ads", "advert", "ad-box", "sponsored", "promo", "advertisement")}>{self.some(self.prose(1, 3), "<p>" + self.prose(1, 3) + "</p>", "<a href=/>" + self.words(3, 12) + "</a>")}</div>'

    def notice(self):
        return f'<div data-k="0"{self.attr("cookie-notice", "notice", "alert", "consent-banner", "newsletter", "popup", "gdpr")}>{self.some(self.prose(1, 3), "<p>" + self.prose(1, 3) + "</p><button>OK</button>")}</div>'

    def form(self):
        return f'<form data-k="0">{self.some("", "<p>" + self.words(2, 8) + "</p>")}<label>{self.words(1, 3)}</label><input name="q"><button>{self.words(1, 2)}</button></form>'

    def talk(self):
        one = lambda: f'<{self.some("div", "li", "article")}{self.attr("comment", "comment-body", "reply", "review")}><b>{self.words(1, 2)}</b><p>{self.prose(1, 5)}</p></div>'
        return f'<{self.some("section", "div")} data-k="0"{self.attr("comments", "comment-list", "discussion", "disqus", "responses")}>{self.some("<h3>" + self.words(1, 3) + "</h3>", "")}{"".join(one() for _ in range(self.r.randint(1, 6)))}</section></div>'

    def content(self):
        """Parts of an article, some of them cut off by an unwelcome one."""
        out = []
        for _ in range(self.some(0, 1, 1, 2, 3, 5, 8, 12)):
            k = self.r.random()
            if k < 0.66:
                out.append(f"<p>{self.prose()}</p>" if self.r.random() < 0.85 else f"<p><b>{self.prose(1, 2)}<br>")
            elif k < 0.76:
                out.append(f"<{(h := self.some('h2', 'h3', 'h4'))}>{self.words(1, 8)}</{h}>")
            elif k < 0.84:
                out.append("<ul>" + "".join(f"<li>{self.prose(1, 2)}</li>" for _ in range(self.r.randint(2, 5))) + "</ul>")
            elif k < 0.89:
                out.append(f"<blockquote><p>{self.prose(1, 3)}</p></blockquote>" if self.r.random() < 0.6 else f"<pre>{self.prose(1, 3)}</pre>")
            elif k < 0.92:
                out.append("<table>" + "".join("<tr>" + "".join(f"<td>{self.words(1, 4)}</td>" for _ in range(3)) + "</tr>" for _ in range(3)) + "</table>")
            elif k < 0.94:
                out.append(f'<figure><img src="x"><figcaption>{self.words(3, 12)}</figcaption></figure>')
            else:
                out.append(self.some(self.advert, self.side, self.notice, self.form)())
        return "".join(out)

    def page(self):
        title = f"<h1>{self.words(3, 12)}</h1>"
        title = self.some(title, title, f"<header>{title}</header>")
        e, a = self.some(("article", ""), ("article", ""), ("main", ""), ("div", self.attr("content", "post", "entry-content", "article-body", "story", "main")),
                         ("div", ""), ("section", ""), ("td", ""))
        body = (f"<p>{self.prose(1, 2)}</p>" if self.r.random() < 0.7 else "") + self.content()
        article = f'<{e} data-k="1"{a}>{title}{body}</{e}>'
        if self.r.random() < 0.15:
            article = f'<h1 data-k="1">{self.words(3, 12)}</h1><{e} data-k="1"{a}>{body}</{e}>'
        if e == "td":
            article = f"<table><tr>{article}</tr></table>"
        if self.r.random() < 0.3:
            article = f'<{(w := self.some("main", "div"))}{self.attr("container", "wrapper", "page", "main-content")}>{article}{self.some("", self.talk(), self.side())}</{w}>'
        pick = lambda *parts: "".join(p() for p in parts if self.r.random() < 0.5)
        top = [self.menu, self.header, self.advert, self.notice, self.side, self.form]
        self.r.shuffle(top)
        end = [self.talk, self.side, self.advert, self.notice, self.form, self.menu]
        self.r.shuffle(end)
        return (f"<html><head><title>{self.words(2, 8)}</title><style>p{{}}</style></head><body>{pick(*top)}{article}"
                f"{pick(*end)}{self.footer() if self.r.random() < 0.85 else ''}" + self.some("</body></html>", ""))


def examples(sentences: list[str], pages: int = TRAIN_PAGES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, share of article text and weights of composed pages' nodes."""
    maker, xs, ys, ws = Maker(sentences), [], [], []
    for _ in range(pages):
        page = Page(maker.page())
        n = len(page.tag)
        marked, size, kept = [None] * n, np.zeros(n), np.zeros(n)
        for v in range(1, n):
            marked[v] = page.mark[v] if page.mark[v] is not None else marked[page.parent[v]]
        for owner, text, _ in page.blocks:
            size[owner] += len(text)
            kept[owner] += len(text) * (marked[owner] == "1")
        for v in range(n - 1, 0, -1):
            size[page.parent[v]] += size[v]
            kept[page.parent[v]] += kept[v]
        some = size > 0
        xs.append(node_features(page)[some])
        share = (kept / np.maximum(size, 1))[some]
        ys.append(share >= 0.5)
        ws.append(np.abs(2 * share - 1))  # a node of both kinds says little
    return np.concatenate(xs), np.concatenate(ys).astype(float), np.concatenate(ws)


def sentences_of(htmls: list[str]) -> list[str]:
    out: list[str] = []
    for h in htmls:
        for _, text, linked in Page(h).blocks:
            if not linked:
                out += [s + "." for s in text.split(". ")[:20] if 3 <= s.count(" ") < 40]
    return sorted(set(out))[:5000]


def train(pages: DataFrame, html_col: str = "html") -> Forest:
    """Trees learnt from composed pages, with sentences of at most SAMPLE_PAGES pages."""
    rows = pages.where(F.length(html_col) > 0).select(F.substring(html_col, 1, 20_000)).limit(SAMPLE_PAGES).collect()
    return grow(*examples(sentences_of([r[0] for r in rows])))


def extract(pages: DataFrame, forest: Forest, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text) of every page."""
    def texts(batch, at):
        held, nodes = [], 0
        htmls = batch.column("html")
        while at < batch.num_rows and nodes < NODES:
            page = Page(htmls[at].as_py() or "")
            held.append((page, node_features(page)))
            nodes += len(page.tag)
            at += 1
        e = forest.evidence(np.concatenate([x for _, x in held]))
        ends = np.cumsum([len(x) for _, x in held])
        return at, ["\n".join(decode(page, e[b - len(x):b])) for (page, x), b in zip(held, ends)]

    def run(batches):
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                upto, out = texts(batch, at)
                part = batch.slice(at, upto - at)
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("url"), pa.array(out, pa.string())], ["id", "url", "text"])
                at = upto

    d = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kinds = [d.schema[c].dataType.simpleString() for c in ("id", "url")]
    return d.mapInArrow(run, f"id {kinds[0]}, url {kinds[1]}, text string")


@register("op4_html_extraction")
def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return extract(pages, train(pages)).select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))
