import itertools

import numpy as np
import pytest

from faultsift.llm import dom
from faultsift.llm.extract import (
    Model,
    beliefs,
    default_model,
    extracted,
    fit,
    forest,
    labelled_pages,
    main_texts,
)

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{{}}</style>
<script>var t="</p>";track(0);</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav>
<div class="cookie-notice">We use cookies to improve this site.</div><!-- ad <p>no</p> -->
<div class="ad">Buy now, pay later.</div>{article}
<aside class="sidebar"><h3>Popular</h3><ul><li><a href="#">One</a></li></ul></aside>
<section id="comments"><h3>Comments</h3><div class="comment"><p>I liked this one.</p></div></section>
<form class="newsletter"><label>Mail</label><input><button>Send</button></form>
<footer>&copy; example.com &middot; All of it.</footer>{end}"""

BODY = (
    "<h1>A  headline\n&amp; more</h1><p><b>First sentence, which says a thing.<br><p>Second&nbsp;one is "
    "longer, with <a href='#'>a link</a> in it &lt;here&gt;.</p><p>Third, short."
    "<div class=advert>Sponsored text here.</div><ul><li>An item of it.<li>Another item.</ul>"
    "<script>hidden()</script><p>The end of the story, at last.</p>"
)
TEXT = (
    "A headline & more\nFirst sentence, which says a thing.\nSecond one is longer, with a link in it "
    "<here>.\nThird, short.\nAn item of it.\nAnother item.\nThe end of the story, at last."
)


@pytest.mark.parametrize("article,end", [
    (f"<article>{BODY}</article>", "</body></html>"),
    (f"<ARTICLE class='post'>{BODY}</ARTICLE>", ""),
    (f"<main><article>{BODY}</article></main>", ""),
    (f"<div id='content'>{BODY}</div>", "</body>"),
])
def test_the_article_and_nothing_else(article, end):
    assert main_texts([PAGE.format(article=article, end=end)], default_model()) == [TEXT]


def test_pages_of_unseen_seeds():
    """Labels of pages that the model was not trained on, by element."""
    sources = labelled_pages(150, seed=4242)
    pages = [dom.read(s) for s in sources]
    got = beliefs(forest(pages), default_model())[0][:, 1] >= 0.5
    want = []
    for page in pages:
        own = [0] * len(page.tags)
        for k in range(1, len(own)):
            own[k] = int(page.marks[k]) if page.marks[k] is not None else own[page.parents[k]]
        want += own
    assert (got == np.array(want, bool)).mean() > 0.97


def test_messages_give_the_exact_marginals():
    page = dom.read("<div><p>a.</p><ul><li>b</li><li>c</li></ul></div><p>d</p>")
    trees = forest([page, dom.read("<p>x")])
    rng = np.random.default_rng(0)
    model = Model(rng.normal(size=400), rng.normal(size=(2, 2)))
    single, both = beliefs(trees, model)
    n = len(page.tags)
    score = np.bincount(trees.rows, model.weights[trees.features], minlength=len(trees.parents))
    total, ones, pair = 0.0, np.zeros(n), np.zeros((n, 2, 2))
    for labels in itertools.product((0, 1), repeat=n):
        energy = sum(score[k] for k in range(n) if labels[k])
        energy += sum(model.pairs[labels[page.parents[k]], labels[k]] for k in range(1, n))
        mass = np.exp(energy)
        total += mass
        ones += mass * np.array(labels)
        for k in range(1, n):
            pair[k, labels[page.parents[k]], labels[k]] += mass
    assert np.allclose(single[:n, 1], ones / total)
    assert np.allclose(both[1:n], pair[1:] / total)


def test_training_learns_from_labels():
    sources = ['<div data-label="1">yes.</div><section data-label="0">no.</section>'] * 5
    assert main_texts(["<div>a b</div><section>c d</section>"], fit(sources)) == ["a b"]


@pytest.mark.parametrize("source", [
    None, "", "   ", "no tags at all", "<", "<p", "<!-- open", "<script>open", "</p></div>", "<p>a<p>b<",
    "<a href=\"x>y", "&#0;&#xFFFFFFF;&bogus;", "<div>" * 3_000 + "deep" + "</div>" * 3_000,
    "<table><tr><td>a<td>b<tr><td>c</table>", "<p>" + "w. " * 200_000,
])
def test_unusual_pages_do_not_crash(source):
    (text,) = main_texts([source], default_model())
    assert isinstance(text, str)


# Written by hand, apart from the generator: (page, its main text).
WRITTEN = [
    ("<svg><article><p>A whole article text. It has sentences.</p></article>", "A whole article text. It has sentences."),
    ("<noscript><article><p>A whole article text. It has sentences.</p></article>", "A whole article text. It has sentences."),
    ("<article><p>Yes.</p></article>", "Yes."),
    ("<nav><a href=/>Home</a> <a href=/n>News</a></nav><article><h1>T</h1><p>Yes.</p></article><footer>&copy; us</footer>", "T\nYes."),
    ("<article><ul><li><a href=x>One thing</a><li><a href=y>Another thing</a><li><a>Third</a></ul></article>", "One thing\nAnother thing\nThird"),
    ("<article><p>Formula <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds.</p></article>", "Formula x=1 holds."),
    ("<article><object><p>Fallback text of it.</p></object><p>More.</p></article>", "Fallback text of it.\nMore."),
    ("<script>var x = 1;<article><p>Some text that follows, of a story.</p></article>", "Some text that follows, of a story."),
    ("<body><svg viewBox=0><path d='m'/><circle r=1 /></svg><article><p>Icon first, then text.</p></article>", "Icon first, then text."),
    ("<header><h1>Site</h1><nav><ul><li><a>Home</a></ul></nav></header><main><h1>Tea</h1><p>Boil water, then wait.</p>"
     "<p>Pour it over the leaves.</p></main><aside class=sidebar><h3>Popular</h3><ul><li><a>One</a></ul></aside>",
     "Tea\nBoil water, then wait.\nPour it over the leaves."),
    ("<div class=cookie-banner>We use cookies.<button>OK</button></div><div class=post><h2>Rain</h2><p>It rained all day, and then it stopped.</p>"
     "<blockquote><p>It was wet, she said.</p></blockquote></div><section id=comments><h3>Comments</h3><div class=comment><p>Nice.</p></div></section>",
     "Rain\nIt rained all day, and then it stopped.\nIt was wet, she said."),
    ("<article><h1>List of lakes</h1><table><tr><th>Lake<th>Depth<tr><td>Blue<td>12 m</table><p>All of them are deep.</p></article>"
     "<form class=newsletter><label>Mail</label><input><button>Join</button></form>",
     "List of lakes\nLake\nDepth\nBlue\n12 m\nAll of them are deep."),
]


@pytest.mark.parametrize("page,text", WRITTEN)
def test_pages_written_by_hand(page, text):
    assert main_texts([page], default_model()) == [text]


def test_a_very_long_article_is_kept_whole():
    body = "".join(f"<p>Sentence number {k}, of very many.</p>" for k in range(5_000))
    (text,) = main_texts([f"<nav><a>x</a></nav><article>{body}</article>"], default_model())
    assert text.split("\n") == [f"Sentence number {k}, of very many." for k in range(5_000)]


def test_rows(spark):
    rows = [(1, "u", PAGE.format(article=f"<article>{BODY}</article>", end=""), "x", 9), (1, None, None, "x", 9),
            (None, "v", "", "x", 9), (1, None, None, "x", 9)]
    frame = spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING, text STRING, n_chars LONG")
    got = extracted(frame).collect()
    assert sorted((r.n_chars, r.text) for r in got) == [(0, "")] * 3 + [(len(TEXT), TEXT)]
    assert extracted(frame.limit(0)).collect() == []
