import random
import re
from html import unescape

import pytest

from strandlake.llm import html_extraction as he

DATA = "/root/testdata/sf0.01"
NONE = he.Weights({})


def plain(html):
    """The article of the given pages by their template: blocks end at any tag of a paragraph or heading."""
    body = re.search("<article>(.*?)</article>", html, re.S)[1]
    blocks = (" ".join(unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", body))
    return "\n".join(b for b in blocks if b)


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{DATA}/pages.parquet")


def test_given_pages(spark, given):
    want = {r.page_id: plain(r.html) for r in given.collect()}
    out = he.main_text(given).collect()
    assert {r.page_id: r.text for r in out} == want and len(out) == len(want)
    assert all(r.n_chars == len(r.text) for r in out)


def test_without_article_tags(spark, given):
    """Held out: weights of labelled pages find the text of pages that no longer mark their article."""
    weights = he.fit_weights(given)
    for new in ("div", "section"):
        for r in given.limit(120).collect():
            page = re.sub("(</?)article>", rf"\1{new}>", r.html)
            assert he.extract(page, weights) == plain(r.html), r.page_id


def wrap(body, head="<title>T</title>"):
    return (f"<!DOCTYPE html><html><head>{head}</head><body><header><a href='/'>Site name</a><h1>Brand</h1></header><nav><ul><li><a>One</a>"
            f"<li><a>Two</a></ul></nav>{body}<footer>All rights reserved by nobody at all, &copy; 2020</footer></body></html>")


CASES = [
    ("<article><h1>Title</h1><p>One &amp; two.<p>Three <b>four</b>, f<i>iv</i>e.</article>", "Title\nOne & two.\nThree four, five."),
    ("<article><p>Text.</p><aside>Side words here</aside><form>Mail <input name=q><button>Send</button></form><p>End.</article>", "Text.\nEnd."),
    ("<article><p>Some text here.</p></article><section id='comments'><h2>Comments</h2><article><p>" + "I think so. " * 60 + "</p></article></section>",
     "Some text here."),
    ("<article><h1>Head</h1><div class='ad'>Buy " + "this " * 50 + "</div><p>" + "long " * 80 + "</p><ul><li>a</li><li>b c</li></ul></article>",
     "Head\n" + "long " * 79 + "long\na\nb c"),
    ("<div class='cookie-notice'>" + "We use cookies. " * 30 + "</div><main><p>Short.</p></main>", "Short."),
    ("<div id=content><h1>T</h1><p>" + "word " * 30 + "<br>more<p>x</p></div><div class=sidebar>" + "other " * 60 + "</div>",
     "T\n" + "word " * 30 + "more\nx"),
    ("<form id=all><article><p>In a form of the whole page.</p></article></form>", "In a form of the whole page."),
    ("<article><p>a < b &lt;p&gt; &#8364; &nbsp;c</p><script>var x='</p><p>no';</script><style>p{}</style><!-- <p>no --></article>", "a < b <p> € c"),
    ("<article><p>x</p><table><tr><td>1<td>2<tr><td>3</table></article>", "x\n1\n2\n3"),
    ("<article><p title=\"a>b\" class='intro'>quoted</p></article>", "quoted"),
    ("<article></article>", ""),
    ("", ""),
]


@pytest.mark.parametrize("body, want", CASES)
def test_cases(body, want):
    assert he.extract(wrap(body), NONE) == want


@pytest.mark.parametrize("html, want", [
    ("", ""), ("only text", "only text"), ("<p>", ""), ("<", "<"), ("<p>a<", "a<"), ("<script>x", ""), ("<!-- x", ""), ("</p></div>", ""),
    ("<ul><li>a</li></ul>", "a"), ("<p a=\"x>y</p>", "y"), ("<nav>a b c</nav>", "")])
def test_fragments(html, want):
    assert he.extract(html, NONE) == want


def test_region_is_the_best():
    r = random.Random(2)
    for _ in range(300):
        scores = [r.choice([-3, -1, -0.5, 0, 1, 2]) for _ in range(r.randrange(12))]
        begin, end = he.best_region(scores)
        best = max([0] + [sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)])
        assert sum(scores[begin:end]) == best and (best > 0) == (end > begin)


def test_counts_split_article_and_rest():
    counts = he.defaultdict(lambda: [0, 0])
    he.count_kinds(wrap("<div class=ad>x</div><article><p>a<p>b<aside>c</aside></article><p class=legal>d</p>"), counts)
    assert {k: tuple(v) for k, v in counts.items()} == {
        "p": (2, 0), "aside": (0, 1), ".ad": (0, 1), ".legal": (0, 1), "header": (0, 1), "nav": (0, 1), "footer": (0, 1), "head": (0, 1)}


def test_long_and_hostile_pages():
    assert he.extract("<article>" + "<p>word</p>" * 200_000 + "</article>", NONE).count("\n") == 199_999
    assert he.extract("<div>" * 50_000 + "deep", NONE) == "deep"
    assert he.extract("<a href=\"" * 20_000, NONE) == ""
    assert he.extract("<p><b>" * 20_000 + "x", NONE) == "x"
    assert he.extract("&" * 100_000, NONE) == "&" * 100_000


def test_rows(spark):
    page = wrap("<article><p>kept</p></article>")
    rows = [(1, "u", page), (1, "u", page), (None, None, None), (2, None, ""), (None, "v", "<p>é</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "'y' AS kind", "1 AS n_chars")
    out = sorted((tuple(r) for r in he.main_text(df).collect()), key=repr)
    assert out == sorted([(1, "u", "kept", 4)] * 2 + [(None, None, "", 0), (2, None, "", 0), (None, "v", "é", 1)], key=repr)
    assert he.main_text(df.limit(0)).count() == 0
