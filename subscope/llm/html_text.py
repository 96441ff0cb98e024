"""Main-text extraction by a tree-structured graphical model over the DOM.

Every element of a page is a node with two states, content and boilerplate. A node's potential
comes from what can be seen of it (tag, words of its class and id, length and link share of its
text); a parent-child potential says how likely a child has its parent's state. Messages go up from
the leaves and down from the root, so the marginal of each node is exact. A block of text is kept
when its element is more likely content.

The potentials are counted on labelled pages: a bounded sample of ``SAMPLE`` pages (least hash of
the page) that mark their article themselves, whose labels are that mark, with everything below
``LABEL_NOISE`` elements labelled boilerplate. On other pages the same potentials work without the
mark. Fixed prior counts for the tags and class words of ``PRIOR_WORDS`` stand in for what the
sample does not show. Names are read as wholes: ``no-ads`` says nothing, ``site-footer`` is noise, and one that only
holds a noise word, like ``tags-travel``, is noise unless its element holds most of the page's words (``Page.noise``).

Defined cases: a null or empty page and one without content have an empty text; scripts, styles,
templates, comments and markup are never text; unclosed and misnested tags are closed by the usual
rules; a tag with a quote that never ends stops at its first ``>``; any page is read in linear time;
entities are decoded; equal rows give equal results; other columns are ignored; without labelled pages
the prior alone decides.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 2000
SAMPLE_CHARS = 200_000
#: Weight of the prior in pages' worth of observations.
PRIOR = 200.0

#: Elements by their role in HTML.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
SILENT = {"script", "style", "template", "noscript", "title", "textarea", "svg", "math", "iframe", "object", "select", "datalist"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "dir",
    "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head",
    "header", "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary",
    "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
CLOSES = {  # an opening tag on the left ends an open element on the right
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}, "option": {"option"},
}
SCOPE = {"table", "ul", "ol", "dl", "article", "section", "div", "body", "td", "th", "aside", "nav", "main", "blockquote"}
ARTICLE = {"article", "main"}
#: Elements and words of class or id that mark what is no article text.
LABEL_NOISE = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "fieldset", "search"}
PRIOR_WORDS = {
    False: ("nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "header", "masthead", "footer", "sidebar",
            "aside", "widget", "ad", "ads", "advert", "advertisement", "banner", "promo", "sponsor", "sponsored", "cookie",
            "consent", "notice", "alert", "popup", "modal", "newsletter", "subscribe", "signup", "login", "form", "search",
            "share", "social", "related", "recommended", "comment", "comments", "reply", "replies", "respond", "disqus",
            "pagination", "pager", "tags", "copyright", "legal", "toolbar", "skip"),
    True: ("article", "content", "entry", "post", "story", "text", "main", "body", "maincontent"),
}

#: Elements that divide a page; all others are part of some text. They may be content within boilerplate.
STRUCTURE = BLOCK - {
    "address", "blockquote", "caption", "dd", "dir", "dl", "dt", "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6",
    "hr", "li", "ol", "p", "pre", "summary", "ul",
}
#: Most that the parts of a potential can say (log-odds): a fixed noise word outweighs what many paragraphs below it say.
NAMED, MARKED, STRUCTURAL, TEXTUAL = 30.0, 6.0, 1.0, 0.5

_OTHER = r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)"
#: A quote opens a value only behind "="; a tag whose quotes leave no end for it ends at its first ">" (fourth group).
_TAG = re.compile(_OTHER + r"(?:((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+)>|([^>]*+)>)", re.S)
_PLAIN_TAG = re.compile(_OTHER + r"([^>]*+)>", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")
_NOISE = frozenset(PRIOR_WORDS[False])
_MARKS = frozenset(PRIOR_WORDS[True])
#: A name that starts with one of these says what a page has or lacks, not what the element is.
MODIFIERS = {"no", "non", "not", "without", "has", "have", "with", "hide", "show", "is"}
#: What the names of an element say of it: nothing, a compound that may be noise, noise.
SAYS_NOTHING, MAY_BE_NOISE, IS_NOISE = 0, 1, 2


def names_of(attributes: str) -> tuple[int, tuple[str, ...], tuple[str, ...], bool]:
    """What an element's names say: of noise, the words to go by, those to go by if it is no noise, and whether
    one names an article.

    A name of one word, or one that ends in a noise word (``site-footer``), is taken at its word. One that only
    holds such a word (``tags-travel``) may be noise, and one with a modifier (``no-ads``) says nothing.
    """
    says, marked = SAYS_NOTHING, False
    words: dict[str, None] = {}
    sure: dict[str, None] = {}
    for name in " ".join("".join(x) for x in _NAMES.findall(attributes)).lower().split():
        parts = _WORD.findall(name)
        if len(parts) > 1 and parts[0] in MODIFIERS:
            continue
        words.update(dict.fromkeys(parts))
        if not _NOISE.intersection(parts):
            sure.update(dict.fromkeys(parts))
            marked = marked or (len(parts) == 1 and parts[0] in _MARKS)
        elif parts[-1] in _NOISE:
            says = IS_NOISE
        else:
            says = max(says, MAY_BE_NOISE)
    return says, tuple(words), tuple(sure), marked


class Page:
    """Elements of a page (parent, tag, words, what their names say) and its text runs (text, element, block number).

    Reading takes time in proportion to the page: the depths of open elements are kept by tag.
    """

    def __init__(self, source: str):
        self.parent, self.tag, self.words = [-1], ["#root"], [()]
        self.sure: list[tuple[str, ...]] = [()]
        self.says, self.marked = [SAYS_NOTHING], [False]
        self.runs: list[tuple[str, int, int]] = []
        self._open = [0]
        self._depths: dict[str, list[int]] = {}
        self._blocks = [0]  # depths of open blocks
        self._silent = 0
        self._block = 0
        self._parse(source)

    def _parse(self, source: str) -> None:
        at, find = 0, _TAG.search
        stop = source.rfind(">") + 1  # no tag ends behind it
        while True:
            m = find(source, at, stop)
            if not m and (comment := source.find("<!--", max(at, stop))) >= 0:
                end = comment
            else:
                end = m.start() if m else len(source)
            if end > at and not self._silent:
                self.runs.append((source[at:end], self._open[-1], self._block))
            if not m:
                return
            at = m.end()
            if m[2] is None:
                if m[0].startswith("<!--") and not m[0].endswith("-->"):
                    return  # a comment without an end takes the rest
                continue
            attributes = m[3]
            if attributes is None:
                attributes, find = m[4], _PLAIN_TAG.search
            name = m[2].lower()
            if m[1]:
                if name in BLOCK or name == "br":
                    self._block += 1
                self._close(name)
                continue
            if name in BLOCK:
                self._block += 1
                self._implied(name)
            elif name == "br" and not self._silent:
                self.runs.append((" ", self._open[-1], self._block))
            if name in RAW and not attributes.endswith("/"):
                closing = re.compile(rf"</{re.escape(name)}\s*+>", re.I).search(source, at)
                at = closing.end() if closing else len(source)
                continue
            if name in VOID:
                continue
            said = names_of(attributes) if "=" in attributes else (SAYS_NOTHING, (), (), False)
            for column, value in zip((self.says, self.words, self.sure, self.marked), said, strict=True):
                column.append(value)
            self.parent.append(self._open[-1])
            self.tag.append(name)
            if not attributes.endswith("/") or name in BLOCK:
                depth = len(self._open)
                self._open.append(len(self.tag) - 1)
                self._depths.setdefault(name, []).append(depth)
                if name in BLOCK:
                    self._blocks.append(depth)
                self._silent += name in SILENT

    def _cut(self, depth: int) -> None:
        """Close all elements from this depth on."""
        for i in self._open[depth:]:
            self._depths[self.tag[i]].pop()
            self._silent -= self.tag[i] in SILENT
        while self._blocks[-1] >= depth:
            self._blocks.pop()
        del self._open[depth:]

    def _deepest(self, tags: set[str]) -> int:
        return max((self._depths[t][-1] for t in tags if self._depths.get(t)), default=0)

    def _implied(self, name: str) -> None:
        """Close what an opening block tag ends: an open paragraph, and items of the same kind in the same list or table."""
        for ends, scope in (({"p"}, SCOPE | {"button"}), (CLOSES.get(name, set()), SCOPE)):
            depth = self._deepest(ends)
            if depth and depth >= self._deepest(scope):
                self._cut(depth)

    def _close(self, name: str) -> None:
        depth = self._deepest({name})
        if depth and (name in BLOCK or depth > self._blocks[-1]):  # an inline end tag does not reach out of its block
            self._cut(depth)

    def noise(self) -> list[bool]:
        """Elements whose names say that they are noise.

        Of those that may be, one that holds half of the page's words outside links and noise is none, unless
        something beside it names itself the article; within a named article it must hold nine tenths.
        """
        n = len(self.tag)
        hard, in_link, above = [False] * n, [False] * n, [0] * n
        own, marks = [0] * n, [0] * n
        for i in range(1, n):
            up = self.parent[i]
            hard[i] = hard[up] or self.tag[i] in LABEL_NOISE or self.says[i] == IS_NOISE
            in_link[i] = in_link[up] or self.tag[i] == "a"
            marks[i] = int(not hard[i] and (self.tag[i] in ARTICLE or self.marked[i]) and self.tag[i] not in ("html", "body"))
            above[i] = above[up] + marks[up]
        for text, node, _ in self.runs:
            if not hard[node] and not in_link[node]:
                own[node] += len(text.split())
        for i in range(n - 1, 0, -1):
            own[self.parent[i]] += own[i]
            marks[self.parent[i]] += marks[i]
        out = []
        for i in range(n):
            most = own[i] and (10 * own[i] >= 9 * own[0] if above[i] else 2 * own[i] >= own[0])
            excused = most and marks[0] == marks[i] + above[i]
            out.append(self.says[i] == IS_NOISE or (self.says[i] == MAY_BE_NOISE and not excused))
        return out

    def features(self) -> list[list[str]]:
        """Per element, what its potential looks at."""
        n = len(self.tag)
        size, links = [0] * n, [0] * n
        inside_link = [False] * n
        for i in range(1, n):
            inside_link[i] = inside_link[self.parent[i]] or self.tag[i] == "a"
        for text, node, _ in self.runs:
            count = len(text.split())
            size[node] += count
            if inside_link[node]:
                links[node] += count
        for i in range(n - 1, 0, -1):
            size[self.parent[i]] += size[i]
            links[self.parent[i]] += links[i]
        out = []
        for i, noise in enumerate(self.noise()):
            share = 0 if not links[i] else min(3, 1 + 3 * links[i] // max(size[i], 1))
            words = [f"w:{w}" for w in (self.words if noise else self.sure)[i]]
            out.append([f"t:{self.tag[i]}", f"n:{min(size[i], 1000).bit_length()}:{share}", *words, *(["noise"] * noise)])
        return out

    def labels(self) -> list[bool] | None:
        """Content or not by the page's own mark of its article; None where there is none."""
        if not any(t in ARTICLE for t in self.tag):
            return None
        out = [False] * len(self.tag)
        spoilt, noise = [False] * len(self.tag), self.noise()
        for i in range(1, len(self.tag)):
            up = self.parent[i]
            spoilt[i] = spoilt[up] or self.tag[i] in LABEL_NOISE or noise[i]
            out[i] = (out[up] or self.tag[i] in ARTICLE) and not spoilt[i]
        return out


class Model:
    """Log-odds of features and log-potentials of (parent state, child state)."""

    def __init__(self, seen: Counter | None = None):
        seen = seen or Counter()
        counts = {key: float(n) for key, n in seen.items()}
        for content, names in PRIOR_WORDS.items():
            for w in names:
                counts["w:" + w, content] = counts.get(("w:" + w, content), 0) + PRIOR
        for tag in LABEL_NOISE:
            counts["t:" + tag, False] = counts.get(("t:" + tag, False), 0) + PRIOR
        for tag in ARTICLE:
            counts["t:" + tag, True] = counts.get(("t:" + tag, True), 0) + PRIOR
        for share, content in ((0, True), (2, False), (3, False)):
            for bits in range(3, 11):
                key = f"n:{bits}:{share}"
                counts[key, content] = counts.get((key, content), 0) + PRIOR / 10
        names = {f for f, c in counts if c in (True, False) and isinstance(f, str)}
        self.odds = {f: math.log((counts.get((f, True), 0) + 1) / (counts.get((f, False), 0) + 1)) for f in names}
        self.edges = []
        for kind, switch in ((0, PRIOR / 2000), (1, PRIOR / 20)):  # rows: parent boilerplate, content
            edge = np.array([[PRIOR, switch], [PRIOR / 20, PRIOR]])
            for parent in (0, 1):
                for child in (0, 1):
                    edge[parent, child] += counts.get(((kind, parent, child), None), 0)
            edge = np.log(edge / edge.sum(1, keepdims=True))
            self.edges.append(tuple(np.maximum(edge, -8.0 if kind == 0 else -1.0).reshape(-1).tolist()))

    def unary(self, tag: str, features: list[str]) -> float:
        """Log-odds of content: what the tag says, the size and link share, and the strongest name."""
        said = self.odds.get(features[0], 0.0)
        if tag in LABEL_NOISE:
            said = -NAMED
        elif tag in ARTICLE:
            said = MARKED
        elif tag in STRUCTURE:
            said = max(-STRUCTURAL, min(STRUCTURAL, said))
        else:
            said = max(0.0, min(TEXTUAL, said))
        shape = max(-TEXTUAL, min(TEXTUAL, self.odds.get(features[1], 0.0)))
        if features[-1] == "noise":
            return said + shape - NAMED
        words = [self.odds[f] for f in features[2:] if f in self.odds]
        named = max(words, key=abs) if words else 0.0
        return said + shape + max(-MARKED, min(MARKED, named))

    def marginals(self, page: Page) -> list[float]:
        """Log-odds of content of every element: sum-product upward, then downward."""
        n = len(page.tag)
        own = [self.unary(t, f) for t, f in zip(page.tag, page.features(), strict=True)]
        own[0] = 0.0
        edges = [self.edges[t in STRUCTURE] for t in page.tag]
        up0, up1 = [0.0] * n, [0.0] * n  # product of potential and children's messages, by state
        message0, message1 = [0.0] * n, [0.0] * n
        for i in range(n - 1, 0, -1):
            e00, e01, e10, e11 = edges[i]
            a, b = up0[i], up1[i] + own[i]
            message0[i], message1[i] = _add(e00 + a, e01 + b), _add(e10 + a, e11 + b)
            up0[page.parent[i]] += message0[i]
            up1[page.parent[i]] += message1[i]
        down0, down1 = [0.0] * n, [0.0] * n
        down1[0] = -1.0
        out = [0.0] * n
        for i in range(n):
            if i:
                p = page.parent[i]
                e00, e01, e10, e11 = edges[i]
                a = down0[p] + up0[p] - message0[i]
                b = down1[p] + up1[p] + own[p] - message1[i]
                top = max(a, b)
                a, b = a - top, b - top
                down0[i], down1[i] = _add(e00 + a, e10 + b), _add(e01 + a, e11 + b)
            out[i] = down1[i] + up1[i] + own[i] - down0[i] - up0[i]
        return out


def _add(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def main_text(model: Model, source: str | None) -> str:
    if not source:
        return ""
    page = Page(source)
    odds = model.marginals(page)
    blocks: list[str] = []
    number, parts = -1, []
    for text, node, block in page.runs:
        if block != number:
            if parts:
                blocks.append("".join(parts))
            number, parts = block, []
        if odds[node] > 0:
            parts.append(text)
    if parts:
        blocks.append("".join(parts))
    clean = (" ".join(html.unescape(b).split()) for b in blocks)
    return "\n".join(b for b in clean if b)


def fit(pages: DataFrame, source: str = "html") -> Model:
    """Potentials counted on the bounded sample of pages that mark their article."""
    marked = (
        pages.select(F.col(source).cast("string").alias("html"))
        .where(F.col("html").rlike("(?i)<(article|main)[\\s>]") & (F.length("html") <= SAMPLE_CHARS))
        .withColumn("h", F.xxhash64("html"))
    )
    # only hashes are compared over all pages; pages are moved only if they are in the sample
    least = [r.h for r in marked.select("h").distinct().orderBy("h").limit(SAMPLE).collect()]
    sample = marked.where(F.col("h").isin(least)).dropDuplicates(["h"]).select("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                page = Page(text)
                labels = page.labels()
                if labels is None:
                    continue
                for i, features in enumerate(page.features()):
                    if not i:
                        continue
                    for f in features:
                        counts[f, int(labels[i])] += 1
                    kind = int(page.tag[i] in STRUCTURE)
                    counts[f"e:{kind}{int(labels[page.parent[i]])}", int(labels[i])] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([f for f, _ in counts], pa.string()), pa.array([s for _, s in counts], pa.int32()),
             pa.array(list(counts.values()), pa.int64())], names=["feature", "state", "n"])

    rows = (
        sample.mapInArrow(run, "feature string, state int, n long")
        .groupBy("feature", "state").agg(F.sum("n").alias("n")).where("n >= 2 or feature like 'e:%'").collect()
    )  # features of at most SAMPLE pages
    seen: Counter = Counter()
    for feature, state, n in rows:
        if feature.startswith("e:"):
            seen[(int(feature[2]), int(feature[3]), state), None] = n
        else:
            seen[feature, bool(state)] = n
    return Model(seen)


def extract(pages: DataFrame, id_col: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """Per page: id, url, main text and its number of code points."""
    shared = pages.sparkSession.sparkContext.broadcast(fit(pages, source))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(shared.value, x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                names=[id_col, url, "text", "n_chars"])

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(id_col, F.col(url).cast("string"), F.col(source).cast("string")).mapInArrow(
        run, f"`{id_col}` {kind}, `{url}` string, text string, n_chars long")
