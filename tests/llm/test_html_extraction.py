"""HTML extraction: messages against enumeration, parsing rules, held-out accuracy."""

import itertools

import numpy as np
import pytest

from corvane.llm import html_extraction as he
from corvane.llm import html_pages

PAGE = """<!DOCTYPE html><html lang="en"><head><title>T &amp; t</title><style>p{margin:0}</style><script>var t="</p>";</script></head>
<body><header class="site-header"><h2>Site name</h2></header><nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>
<!-- ad --><div class="ad">Buy this thing now.</div><article><h1>A  headline\there</h1><p><b>Some text of the article, which goes on
for a while.<br>Next&nbsp;line &lt;here&gt;.<p>Second paragraph with <a href="/x">a link</a> in it, and more words to read.</p><div class="advert"><p>Cheap offers.</p></div>
<p>Third paragraph, the last one of this text.</p></article><section class="comments"><h3>Comments</h3><div class="comment"><p>I liked it very much, thanks.</p></div></section>
<form><p>Your mail</p><input type=text><button>Send</button></form><aside class="sidebar"><h3>Related</h3><p>Other texts you may like.</p></aside>
<div class="cookie-notice">We use cookies.</div><footer>&copy; example.com &middot; words</footer></body></html>"""
TEXT = (
    "A headline here Some text of the article, which goes on for a while. Next line <here>. "
    "Second paragraph with a link in it, and more words to read. Third paragraph, the last one of this text."
)


@pytest.fixture(scope="module")
def model():
    return he.trained()


def test_a_page_by_hand(model):
    assert he.extract([PAGE], model) == [TEXT]


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<article><header><h1>T one</h1><p class=byline>By Ann</p></header><p>Body text goes here. More of it follows.</p><aside>Side note.</aside><div class=ad>Buy!</div><form>Sign up <button>Go</button></form><p>Last words.</p><footer>Filed under x</footer></article>", "Body text goes here. More of it follows. Last words."),
        ("<article><h1>Head</h1><p>The article text is here, in one paragraph.</p><section id=comments><h3>Comments</h3><article class=comment><p>I think this is good, very good.</p></article></section></article>", "Head The article text is here, in one paragraph."),
        ("<div class=notice role=alert>We changed our terms, please read them now.</div><article><p>Short.</p></article>", "Short."),
        ("<div id=header>Site</div><div id=content><h2>Head line</h2><p>Some words here, and more.</p></div><div id=sidebar><p>See also this and that page, it is nice.</p></div><div id=footer>Copyright words</div>", "Head line Some words here, and more."),
        ("plain text &amp; nothing else", "plain text & nothing else"),
    ],
)
def test_more_pages(model, html, text):
    assert he.extract([html], model) == [text]


FOREIGN = """<html><body><div class="globalnav"><a href=/a>Shop</a> <a href=/b>Help</a></div><article class="post"><h1>Rain over the hills</h1>
<p>It rained for three days, and the river rose above its banks.</p><p class="{}">The farmers moved their sheep to higher ground, as they do each spring.</p>
<p>On Sunday the sun came back, and the roads were open again.</p></article><footer>&copy; Hill Post</footer></body></html>"""


@pytest.mark.parametrize("name", ["top-story", "bottom-line", "more-info", "alert-level", "tag-line", "popular", "reviews", "print-only", "hero-image-caption", "css-1x9k2", "lede", "main-text"])
def test_a_paragraph_of_an_article_stays_whatever_its_class(model, name):
    assert he.extract([FOREIGN.format(name)], model) == [
        "Rain over the hills It rained for three days, and the river rose above its banks. The farmers moved their sheep to higher ground, as they do each spring. "
        "On Sunday the sun came back, and the roads were open again."
    ]


@pytest.mark.parametrize("name", ["ad", "advertisement", "cookie-banner", "newsletter-signup", "sponsored"])
def test_a_paragraph_that_is_no_article_goes(model, name):
    assert "farmers" not in he.extract([FOREIGN.format(name)], model)[0]


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("plain < text & more", "plain < text & more"),
        ("<p>a<p>b<div>c</span></p>d", "a b c d"),
        ("<body>" + "<div>" * 300 + "<p>A paragraph far down the tree, with some words.</p>" + "</div>" * 300, "A paragraph far down the tree, with some words."),
        ("<table><tr><td><font>It was a dark night.</font></td></tr><tr><td>The wind blew, and no one slept.</td></tr></table>", "It was a dark night. The wind blew, and no one slept."),
    ],
)
def test_bare_and_broken_pages(model, html, text):
    assert he.extract([html], model) == [text]


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(4)
    page = he.Page('<body><div class="content"><p>a b c.<p>d</div><nav><a href=x>y</a></nav><h1>t</h1></body>')
    forest = he.Forest([page])
    weights, edges = rng.normal(size=len(he.NAMES)), rng.normal(size=(he.KINDS, 2, 2))
    own = np.bincount(forest.node, weights=weights[forest.feature], minlength=forest.n)
    total, on = 0.0, np.zeros(forest.n)
    for y in itertools.product((0, 1), repeat=forest.n):
        s = sum(own[i] * y[i] for i in range(forest.n)) + sum(edges[forest.kind[i]][y[forest.parent[i]], y[i]] for i in range(1, forest.n))
        total += np.exp(s)
        on += np.exp(s) * np.array(y)
    marginal, joint = forest.messages(weights, edges)
    assert marginal == pytest.approx(on / total)
    assert joint[1:].sum(axis=(1, 2)) == pytest.approx(np.ones(forest.n - 1))
    assert joint[1:, :, 1].sum(axis=1) == pytest.approx(marginal[1:])


def test_held_out_pages(model):
    parsed, labels = he.labelled(html_pages.labelled_pages(200, 1234))
    forest = he.Forest(parsed)
    marginal, _ = forest.messages(*model)
    own = np.concatenate([p.own for p in parsed])
    right = (marginal > 0.5) == labels
    assert (right * own).sum() / own.sum() > 0.97


@pytest.mark.parametrize(
    ("html", "tags"),
    [
        ("<p>a<p>b</p></p>c", ["html", "p", "p"]),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>", ["html", "ul", "li", "li", "ul", "li"]),
        ("<div>a</b></span>b</div>", ["html", "div"]),
        ("a < b <3 &amp; <p class='x>y'>c", ["html", "p"]),
        ('<p title="unclosed>text<p>more', ["html", "p", "p"]),
        ("<script>if (a < b) '</p>'", ["html"]),
    ],
)
def test_trees(html, tags):
    assert he.Page(html).tag == tags


def test_text_of_all_nodes_keeps_everything_visible():
    page = he.Page("<body>x &eacute;<!-- no --><div>a<b>b</b> c<br>d</div>tail<script>no</script> end")
    assert page.text(np.ones(len(page.parent), bool)) == "x é ab c d tail end"


def test_rows(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "y"), (None, "v", "", None), (4, "w", "<p>" + "word, " * 60000 + "end.", "z")]
    got = he.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert len(got) == 5 and got[0]["text"] == got[1]["text"] == TEXT and got[0]["n_chars"] == len(TEXT)
    assert (got[2]["text"], got[2]["n_chars"]) == ("", 0) and got[3]["text"] == ""
    assert got[4]["n_chars"] == 60000 * 6 + 4
    assert he.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
