"""Main text of web pages by a tree-structured graphical model.

The block elements of a page form a tree; each is content or not. Unary potentials are linear in
features of the element, parent-child potentials are tables by kind of child. Sum-product messages
upward and downward give each element's exact marginal; the text of elements with a marginal of one
half or more is the main text. The weights are trained by gradient steps on the likelihood of a
bounded sample of pages that carry labels of their own: pages with exactly one <article> or <main>, whose
blocks inside it are content unless they are marked as navigation, notices and the like. For
training, tags and class names are hidden at random, so that text features bear weight too. The
weights start from, and are drawn to, a prior that is used where no such page exists.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?"
    r"|</(?P<end>[A-Za-z][^\s/>]*+)[^>]*+>?"
    r"|<(?P<tag>[A-Za-z][^\s/>]*+)(?P<rest>(?:(?>[^>\"']|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z)))"
    r"|(?P<text>[^<]++|<)",
    re.S,
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr br".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their text is never shown as text of the page.
SKIPPED = frozenset("script style noscript template iframe svg math canvas object audio video title textarea".split())
#: Tag opened: open tags that it closes, up to the nearest of the third set.
CLOSES = {
    "li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
    "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select datalist"),
    "thead": ("thead tbody tfoot tr td th", "table"), "tbody": ("thead tbody tfoot tr td th", "table"),
    "tfoot": ("thead tbody tfoot tr td th", "table"), "body": ("head", "html"),
}
CLOSES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSES.items()}
GROUPS = {
    "article": "article main", "paragraph": "p blockquote pre", "heading": "h1 h2 h3 h4 h5 h6 hgroup", "nav": "nav menu",
    "header": "header", "footer": "footer", "aside": "aside dialog",
    "form": "form button input select fieldset label option datalist optgroup legend", "list": "ul ol li dl dt dd",
    "table": "table thead tbody tfoot tr td th caption", "head": "head", "root": "html body #root",
    "figure": "figure figcaption", "box": "",
}
KIND = {tag: i for i, tags in enumerate(GROUPS.values()) for tag in tags.split()}
NAMES = list(GROUPS)
BOX = NAMES.index("box")
WASTE = re.compile(
    r"\b(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?s?|banner|nav|navbar|navigation|menu|"
    r"breadcrumbs?|sidebar|side|aside|footer|foot|header|masthead|topbar|cookies?|consent|gdpr|notice|alert|popup|modal|"
    r"overlay|newsletter|subscribe|subscription|signup|login|share|sharing|social|related|recommended|trending|comments?|"
    r"replies|reply|discussion|disqus|respond|widget|toolbar|pagination|pager|search|legal|copyright|disclaimer)\b"
)
GOOD = re.compile(r"\b(?:article|content|post|entry|main|story|body|text|maincontent|prose)\b")
ATTRIBUTE = re.compile(r"(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
FEATURES = [*NAMES, "waste", "good", "text", "length", "links", "linked", "sentence", "copyright", "bias"]
F_AT = {name: i for i, name in enumerate(FEATURES)}


@dataclass(frozen=True)
class Extractor:
    """pages, longest: labelled pages learned from, and characters of the longest. hidden: share of marks hidden."""

    pages: int = 300
    longest: int = 100_000
    steps: int = 80
    hidden: float = 0.35
    pull: float = 0.02
    seed: int = 5


class Page:
    """Block elements in page order (parents first), and text in page order.

    text: (element, text) or (element, None) where a block begins or ends.
    """

    def __init__(self, source: str):
        self.tags, self.parent, self.marks = ["#root"], [-1], [""]
        self.chars, self.link_chars, self.links, self.tails = [0], [0], [0], [""]
        self.text: list[tuple[int, str | None]] = []
        stack: list[tuple[str, int]] = [("#root", 0)]
        in_link, at, end = 0, 0, len(source)
        low = None
        while at < end:
            m = TOKEN.match(source, at)
            at = m.end()
            kind = m.lastgroup
            if kind == "text":
                self._add(stack[-1][1], html.unescape(m["text"]), in_link)
            elif kind == "end":
                tag = m["end"].lower()
                if tag == "a":
                    in_link = 0
                if tag in INLINE:
                    continue
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        del stack[i:]
                        self.text.append((stack[-1][1], None))
                        in_link = 0
                        break
            elif kind in ("tag", "rest"):
                tag = m["tag"].lower()
                if tag in SKIPPED and not m["rest"].endswith("/>"):
                    low = low or source.lower()
                    # lower() may change lengths outside ASCII; then the end is searched without it.
                    where = low.find("</" + tag, at) if len(low) == end else self._close(source, tag, at)
                    at = end if where < 0 else where
                    self.text.append((stack[-1][1], None))
                    continue
                if tag == "br":
                    self._add(stack[-1][1], " ", 0)
                    continue
                if tag == "a":
                    in_link = 1
                    self.links[stack[-1][1]] += 1
                if tag in INLINE or tag in SKIPPED:
                    continue
                self._open(stack, tag, m["rest"])
                if tag in VOID:
                    del stack[-1]
        self.text.append((0, None))

    @staticmethod
    def _close(source: str, tag: str, at: int) -> int:
        m = re.compile("</" + re.escape(tag), re.I).search(source, at)
        return m.start() if m else -1

    def _open(self, stack: list[tuple[str, int]], tag: str, rest: str) -> None:
        if stack[-1][0] == "p":
            del stack[-1]
        closed, until = CLOSES.get(tag, ((), ()))
        for i in range(len(stack) - 1, 0, -1) if closed else ():
            if stack[i][0] in until:
                break
            if stack[i][0] in closed:
                del stack[i:]
        node = len(self.tags)
        marks = ""
        if "=" in rest:
            marks = " ".join("".join(x) for x in ATTRIBUTE.findall(rest)).lower().replace("_", " ").replace("-", " ")
        self.tags.append(tag)
        self.parent.append(stack[-1][1])
        self.marks.append(marks)
        for x in (self.chars, self.link_chars, self.links):
            x.append(0)
        self.tails.append("")
        stack.append((tag, node))
        self.text.append((node, None))

    def _add(self, node: int, text: str, in_link: int) -> None:
        self.text.append((node, text))
        bare = text.strip()
        if bare:
            self.chars[node] += len(bare)
            self.link_chars[node] += len(bare) * in_link
            self.tails[node] = bare

    def features(self) -> np.ndarray:
        out = np.zeros((len(self.tags), len(FEATURES)))
        for i, tag in enumerate(self.tags):
            row = out[i]
            row[KIND.get(tag, BOX)] = 1
            marks, n = self.marks[i], self.chars[i]
            if marks:
                row[F_AT["waste"]] = bool(WASTE.search(marks))
                row[F_AT["good"]] = bool(GOOD.search(marks)) and not row[F_AT["waste"]]
            if n:
                row[F_AT["text"]] = 1
                row[F_AT["length"]] = min(n, 400) / 200
                row[F_AT["linked"]] = self.link_chars[i] / n
                row[F_AT["sentence"]] = self.tails[i][-1] in ".!?…。\"”"
                row[F_AT["copyright"]] = "©" in self.tails[i]
            row[F_AT["links"]] = min(self.links[i], 5) / 5
        out[:, F_AT["bias"]] = 1
        return out

    def teacher(self, features: np.ndarray) -> np.ndarray | None:
        """Labels from the page's own marks; None if it has not exactly one <article> or <main>."""
        inside = [i for i, t in enumerate(self.tags) if t in ("article", "main")]
        outer = [i for i in inside if self.tags[self.parent[i]] not in ("article", "main")]
        if len(outer) != 1:
            return None
        bad = {NAMES.index(x) for x in ("nav", "footer", "aside", "form")}
        label = np.zeros(len(self.tags))
        for i in range(outer[0], len(self.tags)):
            mine = i == outer[0] or label[self.parent[i]] == 1
            kind = int(np.argmax(features[i, : len(NAMES)]))
            label[i] = mine and kind not in bad and not features[i, F_AT["waste"]]
        return label

    def main_text(self, content: np.ndarray) -> str:
        blocks, part = [], []
        for node, text in [*self.text, (0, None)]:
            if text is None:
                block = " ".join("".join(part).split())
                if block:
                    blocks.append(block)
                part = []
            elif content[node]:
                part.append(text)
        return "\n".join(blocks)


class Forest:
    """The trees of several pages in one array, with the levels messages pass through."""

    def __init__(self, pages: list[Page], features: list[np.ndarray]):
        self.x = np.concatenate(features)
        first = np.cumsum([0] + [len(p.tags) for p in pages])
        self.parent = np.concatenate([np.array(p.parent) + at for p, at in zip(pages, first, strict=False)])
        self.parent[first[:-1]] = -1
        depth = np.zeros(len(self.parent), np.int32)
        for at in np.flatnonzero(self.parent >= 0):
            depth[at] = depth[self.parent[at]] + 1
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)[1:]
        self.kind = self.x[:, : len(NAMES)].argmax(axis=1)
        self.first = first

    def marginals(self, unary: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """P(label) per element, and P(parent's label, label) per element with a parent (others zero)."""
        n = len(self.parent)
        own = np.zeros((n, 2))
        own[:, 1] = self.x @ unary
        edge = pair[self.kind]
        up = np.zeros((n, 2))
        for level in reversed(self.levels):
            up[level] = np.logaddexp(edge[level, :, 0] + own[level, None, 0], edge[level, :, 1] + own[level, None, 1])
            np.add.at(own, self.parent[level], up[level])
        both, outer = np.zeros((n, 2, 2)), np.zeros((n, 2))
        for level in self.levels:
            above = own[self.parent[level]] + outer[self.parent[level]] - up[level]
            joint = edge[level] + above[:, :, None]
            outer[level] = np.logaddexp(joint[:, 0], joint[:, 1])
            joint = joint + own[level][:, None, :]
            joint -= joint.max(axis=(1, 2), keepdims=True)
            joint = np.exp(joint)
            both[level] = joint / joint.sum(axis=(1, 2), keepdims=True)
        total = own + outer
        total -= total.max(axis=1, keepdims=True)
        p = np.exp(total)
        return p / p.sum(axis=1, keepdims=True), both


def prior() -> tuple[np.ndarray, np.ndarray]:
    """Weights before training: what the marks of a page usually mean, and that children follow their parents."""
    unary = np.zeros(len(FEATURES))
    for name, w in {
        "article": 3, "paragraph": 1, "heading": 0.5, "nav": -8, "header": -4, "footer": -8, "aside": -8, "form": -9,
        "head": -8, "root": -1, "waste": -10, "good": 1.5, "length": 1, "linked": -2, "links": -1, "sentence": 0.7,
        "copyright": -2, "bias": -0.5, "list": -0.5,
    }.items():
        unary[F_AT[name]] = w
    pair = np.zeros((len(NAMES), 2, 2))
    pair[:, 0, 0] = pair[:, 1, 1] = 1
    for name in ("paragraph", "heading", "list", "table", "figure", "box"):
        pair[NAMES.index(name)] = [[1, -1], [-1, 3]]
    for name in ("paragraph", "heading", "list", "table", "figure"):  # waste holds no content
        pair[NAMES.index(name), 0, 1] = -5
    pair[BOX, 0, 1] = -2
    return unary, pair


def train(sources: list[str], e: Extractor) -> tuple[np.ndarray, np.ndarray]:
    unary, pair = prior()
    rng = np.random.default_rng(e.seed)
    pages, features, labels = [], [], []
    for source in sources:
        page = Page(source)
        x = page.features()
        y = page.teacher(x)
        if y is None:
            continue
        hide = rng.random(len(x)) < e.hidden
        hide &= ~x[:, [F_AT["paragraph"], F_AT["heading"], F_AT["head"], F_AT["root"]]].any(axis=1)
        x[hide, : len(NAMES)] = 0
        x[hide, BOX] = 1
        x[hide, F_AT["waste"]] = x[hide, F_AT["good"]] = 0
        pages.append(page)
        features.append(x)
        labels.append(y)
    if not pages:
        return unary, pair
    forest, y = Forest(pages, features), np.concatenate(labels).astype(int)
    start = unary.copy(), pair.copy()
    has = np.flatnonzero(forest.parent >= 0)
    seen = np.zeros((len(y), 2, 2))
    seen[has, y[forest.parent[has]], y[has]] = 1
    kinds = np.eye(len(NAMES))[forest.kind]
    speed = [np.zeros_like(unary), np.zeros_like(pair)]
    for _ in range(e.steps):
        p, both = forest.marginals(unary, pair)
        grads = [
            forest.x.T @ (y - p[:, 1]) / len(pages), np.einsum("nk,nab->kab", kinds[has], (seen - both)[has]) / len(pages)
        ]
        for w, g, v, w0 in zip((unary, pair), grads, speed, start, strict=True):
            v *= 0.8
            v += g - e.pull * (w - w0)
            w += 0.1 * v
    return unary, pair


def _extract(unary: np.ndarray, pair: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for at in range(0, batch.num_rows, 256):
                pages = [Page(x.as_py()) for x in batch.column(2).slice(at, 256)]
                forest = Forest(pages, [p.features() for p in pages])
                content = forest.marginals(unary, pair)[0][:, 1] >= 0.5
                texts += [p.main_text(content[a:b]) for p, a, b in zip(pages, forest.first, forest.first[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(x) for x in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return run


def main_texts(pages: DataFrame, e: Extractor = Extractor()) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    Character references are decoded, white space inside a block becomes one space, blocks are joined by \\n in
    page order; <br> is white space. A page without content, a null and an empty html give an empty text.
    Repeated rows each get a row; other columns are ignored. Open or crossed tags are closed as browsers do
    for paragraphs, list items and table cells.
    """
    sample = pages.where(F.length("html") <= e.longest).select("html", F.xxhash64("page_id", "html").alias("h"))
    sample = sample.orderBy("h").limit(e.pages).collect()
    unary, pair = train([r["html"] for r in sample], e)
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(
        _extract(unary, pair), f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    )
