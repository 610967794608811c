"""Main text of web pages by a tree-structured graphical model over DOM nodes."""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultsift.llm.common import mapped, pick, table
from faultsift.llm.dom import Page, read, squeezed

# Training: labelled pages, rounds of gradient ascent, step and ridge.
PAGES, ROUNDS, STEP, RIDGE = 600, 200, 0.1, 0.0005
# Pages whose nodes pass messages together.
TOGETHER = 100

_TAGS = (
    "#page html head body main article section div header footer nav aside menu form fieldset "
    "button select p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tbody tr td th blockquote pre "
    "figure figcaption details address a span".split()
)
_CUES = {
    "menu": r"nav|menu|breadcrumb|pagina|pager|toc\b|skip|tabs?\b|toolbar",
    "head": r"header|masthead|banner|topbar|site-title|logo|hero",
    "foot": r"footer|copyright|colophon|legal|bottom|imprint",
    "side": r"sidebar|aside|widget|rail\b|column-right|secondary|complementary",
    "note": r"cookie|consent|notice|alert|popup|modal|gdpr|privacy|paywall|warning|toast",
    "ad": r"\bads?\b|\bad[-_]|[-_]ads?\b|advert|sponsor|promo|doubleclick|adsense|commercial|dfp",
    "talk": r"comment|disqus|repl(?:y|ies)|discuss|respond|feedback|thread|review",
    "more": r"related|recommend|read-?more|more-?from|popular|trending|also|teaser|latest",
    "share": r"share|social|follow|tweet|facebook|byline|author-?bio|meta\b|tags?\b|rating",
    "ask": r"newsletter|subscri|signup|sign-up|login|log-in|search|form\b|contact|register|donate",
    "main": r"article|content|post\b|post-?body|entry|story|main|body|text|prose|chapter",
}
_CUE = {name: re.compile(pattern) for name, pattern in _CUES.items()}
# Elements that tell something of all they hold.
_WALLS = "article main section header footer nav aside form ul ol table blockquote p".split()
_NAMES = (
    ["bias", "list", "heading"]
    + [f"tag {t}" for t in [*_TAGS, "other"]]
    + [f"cue {c}" for c in [*_CUE, "any"]]
    + [f"text {k}" for k in range(8)]
    + [f"all {k}" for k in range(8)]
    + [f"links {k}" for k in range(5)]
    + [f"stops {k}" for k in range(4)]
    + [f"in {t}" for t in _WALLS]
    + [f"in cue {c}" for c in _CUE]
    + ["under none", "first block", "tail"]
)
_AT = {name: k for k, name in enumerate(_NAMES)}
_STOP = re.compile(r"[.!?…;:,]")


@cache
def _cues(hint: str) -> tuple[int, ...]:
    found = [_AT[f"cue {name}"] for name, p in _CUE.items() if p.search(hint)]
    return tuple(found or ([_AT["cue any"]] if hint else []))


@cache
def _within(tag: str, hint: str) -> tuple[int, ...]:
    """The features that an element gives to all below it."""
    walls = [_AT[f"in {tag}"]] if tag in _WALLS else []
    return tuple(walls + [_AT[f"in cue {name}"] for name, p in _CUE.items() if p.search(hint)])


def _bucket(n: float, most: int) -> int:
    return min(most, int(math.log2(n + 1) / 1.5)) if n > 0 else 0


def node_features(page: Page) -> list[list[int]]:
    """The features of every element, as numbers of those that hold."""
    n = len(page.tags)
    own, inside, linked, stops = [0] * n, [0] * n, [0] * n, [0] * n
    link = [False] * n
    for k in range(1, n):
        link[k] = page.tags[k] in ("a", "nav") or link[page.parents[k]]
    for node, text in page.events:
        if text and not text.isspace():
            own[node] += len(text)
            stops[node] += len(_STOP.findall(text))
    for k in range(n):
        inside[k] = own[k]
        linked[k] = own[k] if link[k] else 0
    for k in range(n - 1, 0, -1):
        inside[page.parents[k]] += inside[k]
        linked[page.parents[k]] += linked[k]
    whole, before = max(1, inside[0]), 0
    above: list[frozenset[int]] = [frozenset()] * n
    out = []
    for k in range(n):
        tag = page.tags[k]
        if k:
            parent = page.parents[k]
            above[k] = above[parent].union(_within(page.tags[parent], page.hints[parent]))
        has = [_AT["bias"], _AT.get(f"tag {tag}", _AT["tag other"]), *_cues(page.hints[k])]
        has.extend(above[k])
        if tag in ("ul", "ol", "li", "dl", "dt", "dd", "menu"):
            has.append(_AT["list"])
        elif tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            has.append(_AT["heading"])
        has.append(_AT[f"text {_bucket(own[k], 7)}"])
        has.append(_AT[f"all {min(7, int(8 * inside[k] / whole))}"])
        if inside[k]:
            has.append(_AT[f"links {int(4 * linked[k] / inside[k])}"])
            has.append(_AT[f"stops {min(3, int(60 * stops[k] / inside[k]))}"])
        else:
            has.append(_AT["under none"])
        if own[k]:
            if not before:
                has.append(_AT["first block"])
            elif before > 0.9 * whole:
                has.append(_AT["tail"])
            before += own[k]
        out.append(has)
    return out


@dataclass(frozen=True)
class Forest:
    """The nodes of many pages: features and parents, and the levels to pass messages by."""

    rows: np.ndarray
    features: np.ndarray
    parents: np.ndarray
    levels: list[np.ndarray]
    starts: list[int]


def forest(pages: list[Page]) -> Forest:
    rows, features, parents, depths, starts = [], [], [], [], [0]
    for page in pages:
        base = starts[-1]
        depth = [0] * len(page.tags)
        for k, has in enumerate(node_features(page)):
            rows.extend([base + k] * len(has))
            features.extend(has)
            if k:
                depth[k] = depth[page.parents[k]] + 1
        parents.extend(base + p if p >= 0 else -1 for p in page.parents)
        depths.extend(depth)
        starts.append(base + len(page.tags))
    levels: list[np.ndarray] = []
    if depths:
        order = np.argsort(depths, kind="stable")
        cuts = np.searchsorted(np.array(depths)[order], np.arange(max(depths) + 2))
        levels = [order[a:b] for a, b in zip(cuts, cuts[1:])]
    return Forest(np.array(rows, int), np.array(features, int), np.array(parents, int), levels, starts)


@dataclass(frozen=True)
class Model:
    """Weights of a node's features for content, and potentials of (parent, child) labels."""

    weights: np.ndarray
    pairs: np.ndarray


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    return np.logaddexp.reduce(x, axis=axis)


def beliefs(trees: Forest, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of every node (n, 2) and of every node with its parent (n, 2, 2).

    Sum-product: messages go up level by level, then down, in log space; all
    pages of a forest at once.
    """
    n = len(trees.parents)
    score = np.bincount(trees.rows, model.weights[trees.features], minlength=n)
    up = np.stack([np.zeros(n), score], 1)
    message = np.zeros((n, 2))
    for level in reversed(trees.levels[1:]):
        message[level] = _sum_exp(model.pairs[None] + up[level][:, None, :], 2)
        np.add.at(up, trees.parents[level], message[level])
    down = np.zeros((n, 2))
    both = np.zeros((n, 2, 2))
    for level in trees.levels[1:]:
        parent = trees.parents[level]
        rest = up[parent] + down[parent] - message[level]
        joint = model.pairs[None] + rest[:, :, None]
        down[level] = _sum_exp(joint, 1)
        joint = joint + up[level][:, None, :]
        both[level] = np.exp(joint - _sum_exp(joint.reshape(-1, 4), 1)[:, None, None])
    single = up + down
    return np.exp(single - _sum_exp(single, 1)[:, None]), both


def fit(sources: list[str]) -> Model:
    """Maximum likelihood on labelled pages: ``data-label`` of an element is 1 for content.

    An element without a label has that of its parent; the page has 0. The
    gradient is what the labels say minus what the messages expect.
    """
    pages = [read(source) for source in sources]
    trees = forest(pages)
    truth = []
    for page in pages:
        own = [0] * len(page.tags)
        for k in range(1, len(own)):
            own[k] = int(page.marks[k]) if page.marks[k] is not None else own[page.parents[k]]
        truth.extend(own)
    y = np.array(truth)
    children = np.flatnonzero(trees.parents >= 0)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[trees.parents[children]], y[children]), 1)
    weights, pairs = np.zeros(len(_NAMES)), np.zeros((2, 2))
    size, moments = len(y), [np.zeros(len(_NAMES) + 4) for _ in range(2)]
    for step in range(1, ROUNDS + 1):
        single, both = beliefs(trees, Model(weights, pairs))
        off = (y - single[:, 1])[trees.rows]
        slope = np.bincount(trees.features, off, minlength=len(_NAMES)) / size - RIDGE * weights
        edge = (seen - both.sum(0)) / size - RIDGE * pairs
        g = np.concatenate([slope, edge.ravel()])
        moments[0] = 0.9 * moments[0] + 0.1 * g
        moments[1] = 0.99 * moments[1] + 0.01 * g * g
        move = STEP * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8)
        weights, pairs = weights + move[:-4], pairs + move[-4:].reshape(2, 2)
    return Model(weights, pairs)


def labelled_pages(count: int = PAGES, seed: int = 11) -> list[str]:
    """Pages of many designs whose elements are labelled, made from a seed.

    Parts come and go, in semantic tags or in plain ones with telling names, or
    without any; texts are invented, as only lengths and marks matter.
    """
    r = random.Random(seed)

    def words(a: int, b: int) -> str:
        out = ["".join(r.choice("abcdeilmnorstu") for _ in range(r.randint(2, 10))) for _ in range(r.randint(a, b))]
        return " ".join(out).capitalize()

    def sentences(a: int, b: int) -> str:
        return " ".join(words(3, 16) + r.choice(".....!?") for _ in range(r.randint(a, b)))

    def tag(name: str, body: str, hint: str = "", label: int | None = None) -> str:
        mark = "" if label is None else f' data-label="{label}"'
        attribute = r.choice(["class", "id"])
        return f"<{name}{mark}" + (f' {attribute}="{hint}"' if hint else "") + f">{body}</{name}>"

    def links(a: int, b: int) -> str:
        drawn = icon() if r.random() < 0.1 else ""
        items = [tag("li", tag("a", drawn + words(1, 3))) for _ in range(r.randint(a, b))]
        return tag(r.choice(["ul", "ul", "ol"]), "".join(items))

    def paragraph() -> str:
        text = sentences(1, r.choice([1, 2, 5, 9]))
        if r.random() < 0.08:
            text = words(1, r.choice([8, 30, 90]))
        if r.random() < 0.04:
            text += " <math><mi>x</mi><mo>=</mo><mn>1</mn></math> " + words(1, 4) + "."
        if r.random() < 0.2:
            text = r.choice(["<b>{}<br>", "<em>{}</em>", '{} <a href="#">' + words(1, 3) + "</a>."]).format(text)
        return f"<p>{text}" + ("</p>" if r.random() < 0.9 else "")

    def block() -> str:
        kind = r.random()
        if kind < 0.7:
            return paragraph()
        if kind < 0.78:
            return tag(r.choice(["h2", "h3"]), words(2, 8))
        if kind < 0.84:
            return tag(r.choice(["ul", "ol"]), "".join(tag("li", sentences(1, 2)) for _ in range(r.randint(2, 5))))
        if kind < 0.89:
            return tag("blockquote", paragraph())
        if kind < 0.92:
            return tag("pre", sentences(1, 3))
        if kind < 0.95:
            cells = lambda: "".join(tag("td", words(1, 4)) for _ in range(3))
            return tag("table", "".join(tag("tr", cells()) for _ in range(r.randint(2, 4))))
        if kind < 0.97:
            return tag("figure", tag("figcaption", sentences(1, 1)))
        if kind < 0.98:
            return tag("object", tag("p", sentences(1, 2)))
        return tag("div", paragraph() + paragraph())

    def icon() -> str:
        return r.choice(['<svg><path d="m1"/></svg>', "<svg><title>x</title><circle r=1 /><path/></svg>", "<svg></svg>"])

    def advert() -> str:
        text = r.choice([sentences(1, 2), words(2, 6), tag("a", words(2, 6)), paragraph()])
        hint = r.choice(["ad", "ads", "advert", "ad-slot", "sponsored", "promo", "advertisement"])
        return tag(r.choice(["div", "div", "aside", "section"]), text, hint, 0)

    def menu() -> str:
        if r.random() < 0.6:
            return tag("nav", links(3, 9), r.choice(["", "", "main-nav"]), 0)
        return tag("div", links(3, 9), r.choice(["menu", "navbar", "breadcrumbs", "nav"]), 0)

    def head() -> str:
        body = r.choice([tag("h1", words(1, 4)), tag("p", words(2, 7)), tag("div", words(1, 3), "logo")])
        if r.random() < 0.6:
            return tag("header", body + (menu() if r.random() < 0.5 else ""), "", 0)
        return tag("div", body, r.choice(["header", "masthead", "topbar", "banner"]), 0)

    def foot() -> str:
        body = r.choice([sentences(1, 3), links(2, 5), tag("p", "&copy; " + sentences(1, 2)), paragraph()])
        if r.random() < 0.7:
            return tag("footer", body, "", 0)
        return tag("div", body, r.choice(["footer", "copyright", "site-footer"]), 0)

    def notice() -> str:
        if r.random() < 0.1:
            return tag(r.choice(["noscript", "iframe"]), sentences(1, 2), "", 0)
        hint = r.choice(["cookie", "cookie-banner", "notice", "consent", "alert", "gdpr-notice", "popup"])
        more = tag("button", words(1, 2)) if r.random() < 0.5 else ""
        return tag(r.choice(["div", "section", "p"]), sentences(1, 3) + more, hint, 0)

    def side() -> str:
        body = tag("h3", words(1, 3)) + r.choice([links(2, 6), paragraph(), tag("div", sentences(1, 3))])
        if r.random() < 0.6:
            return tag("aside", body, r.choice(["", "sidebar"]), 0)
        return tag("div", body, r.choice(["sidebar", "widget", "right-rail", "secondary"]), 0)

    def form() -> str:
        body = f"<label>{words(1, 3)}</label><input>" + tag("p", sentences(1, 1)) + tag("button", words(1, 2))
        if r.random() < 0.7:
            return tag("form", body, r.choice(["", "newsletter", "login"]), 0)
        return tag("div", body, r.choice(["newsletter", "signup", "search-box", "subscribe"]), 0)

    def talk() -> str:
        one = lambda: tag(
            r.choice(["div", "li", "article"]),
            tag(r.choice(["p", "div"]), sentences(1, 4)),
            r.choice(["comment", "reply", "comment-body"]),
        )
        body = tag("h3", words(1, 2)) + "".join(one() for _ in range(r.randint(1, 5)))
        return tag(r.choice(["section", "div", "div"]), body, r.choice(["comments", "discussion", "responses"]), 0)

    def more() -> str:
        body = tag("h3", words(1, 2)) + links(2, 6)
        return tag(r.choice(["div", "section", "aside"]), body, r.choice(["related", "more-from", "popular", "share"]), 0)

    def article() -> str:
        body = tag("h1", words(2, 10)) if r.random() < 0.8 else ""
        kind = r.random()
        if r.random() < 0.1:
            body += icon()
        if kind < 0.06:
            body = tag("p", words(1, 4) + r.choice(".!?"))
        elif kind < 0.12:
            body += links(3, 12)
        else:
            for _ in range(r.choice([1, 2, 4, 8, 14])):
                body += block()
                if r.random() < 0.1:
                    body += r.choice([advert, more, form, notice, side])()
            if r.random() < 0.15:
                body += r.choice([talk, more, advert, foot])()
        kind = r.random()
        if kind < 0.5:
            return tag("article", body, r.choice(["", "", "post", "story"]), 1)
        if kind < 0.62:
            return tag("main", body, r.choice(["", "content"]), 1)
        if kind < 0.72:
            return tag("main", tag("article", body), "", 1)
        if kind < 0.93:
            hint = r.choice(["content", "article-body", "post", "entry-content", "main", "story-text"])
            return tag(r.choice(["div", "section"]), body, hint, 1)
        if kind < 0.97:
            return tag("div", body, "", 1)
        return re.sub(r"<(p|h1|h2|h3|ul|ol|blockquote|pre|table|figure)>", r'<\1 data-label="1">', body)

    out = []
    for _ in range(count):
        before = [f() for f in (head, menu, notice, advert, form) if r.random() < 0.45]
        after = [f() for f in (foot, side, talk, more, advert, notice, form) if r.random() < 0.4]
        if r.random() < 0.1:
            before, after = [], []
        if r.random() < 0.2:
            before.append(icon())
        r.shuffle(before)
        r.shuffle(after)
        body = "".join(before) + article() + "".join(after)
        if r.random() < 0.3:
            body = tag("div", body, r.choice(["", "wrapper", "page", "container"]))
        out.append(f"<html><head><title>{words(2, 5)}</title></head><body>{body}</body></html>")
    return out


@cache
def default_model() -> Model:
    """Trained once a process, on ``PAGES`` labelled pages, the same each time."""
    return fit(labelled_pages())


def main_text(page: Page, content: np.ndarray) -> str:
    """The blocks of content elements, one a line."""
    blocks: list[str] = []
    open_block: list[str] = []

    def end() -> None:
        text = squeezed("".join(open_block))
        if text:
            blocks.append(text)
        open_block.clear()

    for node, text in page.events:
        if text is None:
            end()
        elif content[node]:
            open_block.append(text)
    end()
    return "\n".join(blocks)


def main_texts(sources: list[str | None], model: Model) -> list[str]:
    out = []
    for at in range(0, len(sources), TOGETHER):
        pages = [read(source or "") for source in sources[at : at + TOGETHER]]
        trees = forest(pages)
        content = beliefs(trees, model)[0][:, 1] >= 0.5
        cuts = zip(trees.starts, trees.starts[1:])
        out.extend(main_text(page, content[a:b]) for page, (a, b) in zip(pages, cuts))
    return out


def extracted(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html).

    Every element is content or not: potentials of parent and child and of an
    element's own features, marginals by message passing over the whole page.
    The text of an element counts where its marginal is at least one half.
    Character references are decoded, white space in a block becomes one space,
    blocks are joined by a newline. Null and empty pages, and pages without
    content, have an empty text. Rows may repeat, ids and urls be null; other
    columns are ignored.
    """
    sent = pages.sparkSession.sparkContext.broadcast(model or default_model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = main_texts(batch.column(2).to_pylist(), sent.value)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pick(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
    )
    return mapped(rows, run, "page_id long, url string, text string, n_chars long")


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))
