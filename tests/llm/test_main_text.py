"""Main texts of pages: inference against enumeration, held-out layouts, pages of several kinds."""

import itertools
import re
from html import unescape

import numpy as np
import pytest
from screenloom.llm import dom
from screenloom.llm.queries import op12_main_text

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{SF}/pages.parquet")


@pytest.fixture(scope="module")
def potentials(pages):
    return dom.train(pages)


def test_marginals_are_those_of_all_labellings():
    dice = np.random.default_rng(4)
    trees = [dom.parse("<div class=menu><p>a<b>b</b></p></div><p>c"), dom.parse("<article><p>x</article>"), dom.parse("")]
    woods = dom.forest(trees)
    own, pair = dice.normal(size=dom.BEGINS[-1]), dice.normal(size=(len(dom.GROUPS), 2, 2))
    chance, edge, total = dom.marginals(woods, dom.Potentials(own, pair))
    n, weights, want = len(woods.parent), 0.0, np.zeros(len(woods.parent))
    pairs = np.zeros((n, 2, 2))
    for labels in itertools.product([0, 1], repeat=n):
        score = sum(own[woods.features[i]].sum() for i in range(n) if labels[i]) + sum(pair[woods.kind[i], labels[woods.parent[i]], labels[i]] for i in range(n) if woods.parent[i] >= 0)
        weight = np.exp(score)
        weights += weight
        want += weight * np.array(labels)
        for i in range(n):
            if woods.parent[i] >= 0:
                pairs[i, labels[woods.parent[i]], labels[i]] += weight
    assert np.allclose(chance, want / weights)
    assert np.allclose(edge, pairs / weights)
    assert np.isclose(total, np.log(weights))


def test_pages_of_the_table_are_read_whole(spark, pages):
    def plain(page):
        body = page[page.index("<article>") + 9 : page.index("</article>")]
        lines = (" ".join(unescape(re.sub("<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", body))
        return "\n".join(x for x in lines if x)

    html = {r["page_id"]: (r["url"], plain(r["html"])) for r in pages.collect()}
    got = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in op12_main_text(spark, SF).collect()}
    assert got == {k: (url, text, len(text)) for k, (url, text) in html.items()}


def test_held_out_layouts(pages, potentials):
    """Articles that weren't trained on, laid out by another seed: nearly every text is told apart."""
    rows = [r["html"] for r in pages.orderBy("page_id").collect()]
    held = list(dom.relaid(rows, seed=77))[len(rows) :]
    wrong = texts = whole = 0
    for tree, labels in held:
        chance = dom.marginals(dom.forest([tree]), potentials)[0] > 0.5
        own = np.asarray(tree.tag) == dom.TAG_NUMBER["#text"]
        wrong += (off := int((chance != labels)[own].sum()))
        texts += int(own.sum())
        whole += off == 0
    assert wrong <= 0.002 * texts and whole >= 0.97 * len(held)


@pytest.mark.parametrize(
    "page,text",
    [
        ('<header class="site"><h1>My Site</h1><p>The best site there is.</p></header><div class="cookie"><p>We use cookies. Accept?</p><button>OK</button></div><div class="left-sidebar"><h3>Popular</h3><ul><li><a href=1>One</a></ul></div><div class="main-column"><h1>The &eacute;t&eacute;</h1><p>First,  with <b>bold</b> and <a href=x>a link</a>.</p><div class="ad-box"><p>Buy this now, it is good.</p></div><p>Second&nbsp;one.<br>Line two.</p><ul><li>one</li><li>two</li></ul></div><div id="comments"><h2>2 comments</h2><div class="comment"><p>I like this a lot, thank you.</p></div></div><footer>&copy; me</footer>', "The été\nFirst, with bold and a link.\nSecond one. Line two.\none\ntwo"),
        ("<p>Just a paragraph, with no other thing.</p><p>And another one, a bit longer than the one above it.</p>", "Just a paragraph, with no other thing.\nAnd another one, a bit longer than the one above it."),
        ("<nav><a href=/>Home</a></nav><main><h1>T</h1><p>One two three four five six seven.</p><aside>Related: <a href=z>other story</a></aside><p>Last words.</p><section class='reader-comments'><article class='comment'><p>Nice text, I have read it all and it was good.</p></article></section></main><form><p>Sign up for our letter, it is free.</p></form>", "T\nOne two three four five six seven.\nLast words."),
        ("<article><p>Text of the article, a & b < c &amp;lt; d.</p><script>var x = '<p>no</p>';</script><style>p{}</style><div role=alert>Please update your browser.</div><p>x<!-- not this --></p></article>", "Text of the article, a & b < c &lt; d.\nx"),
        ("text only", "text only"), ("<ul><li>a<li>b</ul>", "a\nb"), ("<b>x", "x"), ("<a", ""), ("<!-- ", ""), ("", ""), (None, ""), ("<script>a", ""), ("</p></div>x</x>", "x"),
    ],
)
def test_kinds_of_pages(potentials, page, text):
    assert dom.texts([page], potentials) == [text]


def test_nothing_is_dropped_from_long_and_deep_pages(potentials):
    line = "A line of the text, as long as it needs to be. "
    long = "<article>" + f"<p>{line}</p>" * 20_000 + "</article>"
    assert dom.texts([long], potentials) == ["\n".join([line.strip()] * 20_000)]
    deep = "<div>" * 3000 + line + "</div>" * 3000
    assert dom.parse(deep).parent[-1] == 3000 and isinstance(dom.texts([deep], potentials)[0], str)


def test_other_columns_empty_tables_and_no_labels(spark, potentials):
    rows = [(1, "<article>A b.</article>", "old", 5), (1, "<article>A b.</article>", "old", 5), (None, None, None, None)]
    docs = spark.createDataFrame(rows, "page_id long, html string, text string, _row int")
    out = dom.extract(docs, potentials)
    assert sorted(out.columns) == sorted(docs.columns)
    assert sorted(map(tuple, out.select("page_id", "text", "_row").collect()), key=str) == [(1, "A b.", 5), (1, "A b.", 5), (None, "", None)]
    assert dom.extract(docs.limit(0), potentials).count() == 0
    none = dom.train(docs.limit(0))
    assert dom.extract(docs, none).where("text <> ''").count() == 0
