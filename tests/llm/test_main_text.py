from __future__ import annotations

import random
import re
import time
from html import unescape

import pytest

from tests.comparing import connect
from tidemart.llm.main_text import Sequence, Weights, best_stretch, counted, learn_weights, main_text, main_texts
from tidemart.llm.page_markup import read_page
from tidemart.llm.queries import LLM_QUERIES

# The last columns clash with names that the operator uses itself.
SCHEMA = "page_id bigint, url string, html string, text int, n_chars string"


def plain(html):
    """The given pages' article: what is between its tags, cut at paragraphs and headings."""
    article = re.search(r"<article>(.*?)</article>", html or "", re.S)
    blocks = re.split(r"</?(?:p|h1)>", article[1].replace("<br>", " ")) if article else []
    blocks = [" ".join(unescape(re.sub(r"<[^>]*>", "", block)).split()) for block in blocks]
    return "\n\n".join(block for block in blocks if block)


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_matches_plain_version(spark, sf_dir):
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in LLM_QUERIES["op12_main_text"](spark, sf_dir).collect()}
    pages = connect(sf_dir).execute("SELECT page_id, url, html FROM pages").fetchall()
    assert got == {page_id: (url, plain(html), len(plain(html))) for page_id, url, html in pages}


@pytest.fixture(scope="module")
def weights():
    pages = connect("/root/testdata/sf0.01").execute("SELECT html FROM pages").fetchall()
    return Weights(counted(Sequence(read_page(html)) for (html,) in pages))


def test_stretch_against_all_stretches():
    rng = random.Random(3)
    for _ in range(300):
        scores = [rng.choice([-2.0, -1.0, 0.5, 1.0, 3.0]) for _ in range(rng.randint(0, 12))]
        sums = {(a, b): sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)}
        best = max(sums.values(), default=0.0)
        start, end = best_stretch(scores)
        assert (start, end) == (0, 0) if best <= 0 else sums[start, end] == best


def test_words_gain_and_tags_cost(weights):
    for (kind, *context), _ in weights.sums.items():
        if len(context) == 3:
            assert (weights.score(kind, tuple(context)) > 0) == (kind == "word")
    assert weights.score("tag", ("none", "cut", "nav")) < -4.9 < -0.1 < weights.score("tag", ("none", "p", ""))
    assert weights.score("word", ("in", "p", "")) > 1.4 and weights.score("word", ("out", "p", "")) < 0.1
    # What labelled pages do not show has the coarser context's weight.
    assert weights.score("word", ("in", "blockquote", "")) > 1.4 and weights.score("word", ("none", "blockquote", "")) == pytest.approx(1.005)


PAGES = [
    # Marked articles, with things in and around them.
    (
        "<title>t</title><header><h2>Site name</h2></header><nav><ul><li><a href=/>Home</a></li></ul></nav><main><article>"
        "<header><h1>Heading</h1></header><p>One &amp; two<br>three&nbsp;four.</p><aside>See also this long list of other things</aside>"
        "<div class='ad-slot ad'>Buy now, it is cheap and good and near you</div><blockquote>Quoted <b>bold</b>, <a href=x>linked</a>.</blockquote>"
        "<form>Your name <input><button>Send</button></form><ul><li>a</li><li>b</li></ul><footer>Filed under</footer></article>"
        "<section id=comments><article><p>A reader says a great many words here, more than all of it.</p></article></section></main>"
        "<div class=sidebar>Popular stories of today and other days</div><footer>Rights reserved</footer>",
        "Heading\n\nOne & two three four.\n\nQuoted bold, linked.\n\na\n\nb",
    ),
    # No article is named, and class names tell what is around it.
    (
        "<div id=page><div class='cookie-notice'>We use cookies on this site to make it better.</div><div class=topbar>Sign in</div>"
        "<div class='c1'><h1>Head</h1><p>The first paragraph has some words.</p><p>So has the second one.</p>"
        "<ul><li>short</li><li>list</li></ul><p>Last.</p></div>"
        "<div id=respond><p>Reader one thinks this and that about it all.</p></div><div class=copyright>2024</div></div>",
        "Head\n\nThe first paragraph has some words.\n\nSo has the second one.\n\nshort\n\nlist\n\nLast.",
    ),
    # Neither names nor classes: links and single words against paragraphs.
    (
        "<table><tr><td><a href=1>One</a><br><a href=2>Two</a></td><td><p>A story of many words in a table cell."
        "<p>It goes on for a while.</td><td>Ads</td></tr></table>",
        "A story of many words in a table cell.\n\nIt goes on for a while.",
    ),
    # A form around the whole page, an article named by a property, hidden scripts.
    (
        "<form action=/><div>menu</div><div itemprop='articleBody'><p>Text 1 &lt; 2.</p><script>var p = '<p>no</p>';</script>"
        "<style>p{}</style><noscript>Turn scripts on</noscript><!-- <p>no</p> --><p>Text &#233;&#x1F600;.</p></div></form>",
        "Text 1 < 2.\n\nText é😀.",
    ),
    ("<p>Unclosed <b>tags <i>and <a href='x>y'>odd</a> quotes<p>here & there &copy 1 < 2</b>", "Unclosed tags and odd quotes\n\nhere & there © 1 < 2"),
    ("<article><p class='has-ads'>Kept text.</p><span class=ad>Not kept.</span><p>A<span class='advert'>no</span>B</p></article>", "Kept text.\n\nAB"),
    ("No markup at all,\n just text", "No markup at all, just text"),
    ("<html><head><title>Only a title</title></head><body><nav>menu</nav><footer>foot</footer></body></html>", ""),
    ("<article></article><div class=menu>menu</div>", ""),
    ("", ""),
    (None, ""),
    ("  \n ", ""),
]


@pytest.mark.parametrize("html,expected", PAGES)
def test_pages(weights, html, expected):
    assert main_text(read_page(html), weights) == expected


def test_odd_rows(spark):
    rows = [(k, f"u{k}", html, 1, "x") for k, (html, _) in enumerate(PAGES)]
    rows += [(None, None, "<article><p>same</p></article>", 1, "x")] * 2 + [(0, "again", "<article><p>x</p></article>", 1, "x")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(((r.page_id is None, r.page_id or 0, r.url or "", r.text, r.n_chars) for r in main_texts(spark, frame).collect()))
    assert [x[3] for x in got if x[0]] == ["same"] * 2 and len(got) == len(rows)
    assert (False, 0, "again", "x", 1) in got and (False, 10, "u10", "", 0) in got
    assert main_texts(spark, frame.limit(0)).collect() == []


def test_weights_are_summed_over_all_pages(spark, weights):
    assert learn_weights(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).sums == weights.sums


LONG = [
    "<" * 200_000,
    '<a "' * 100_000,
    '<a x="' * 100_000,
    '<a x=">"' * 100_000,
    "<a " + "a" * 300_000 + " x=>",
    "<a " + "a b/ " * 100_000 + "x=1>",
    "<!--" * 100_000,
    "<div>" * 100_000,
    "</div>" * 100_000,
    "<p><b>" * 100_000,
    "<script>" * 100_000,
    "<span class=ad>" * 100_000,
    "<article>" * 50_000,
    "<article></article>" * 50_000,
    "<ul>" + "<li>a b c</li>" * 100_000,
    "<a href=x>b</a> " * 100_000,
    "&amp" * 100_000,
    f"<article><p>{'word ' * 500_000}</p></article>",
]


@pytest.mark.parametrize("html", LONG, ids=lambda html: html[:12])
def test_time_grows_with_the_length(weights, html):
    start = time.perf_counter()
    main_text(read_page(html), weights)
    assert time.perf_counter() - start < 8
