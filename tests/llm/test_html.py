"""Main text: markup of many kinds, the site style tree against a plain count, planted noise."""

import html
import math
import re
from collections import Counter

import pytest

from tabulon.llm import html_extract as hx
from tabulon.llm.html_tree import parse

from tests.conftest import SF_SMALL

PAGES = {
    # blocks, white space, references, inline markup, unclosed elements
    "<article><h1>A &amp; B</h1><p>one <b>two</b>\n three<br>four<p>fi<i>ve</i>&nbsp;x&#39;s &lt;b&gt;</article>":
        "A & B\none two three four\nfive x's <b>",
    "<ARTICLE CLASS=post><P>Upper<P>case</ARTICLE><FOOTER>no</FOOTER>": "Upper\ncase",
    # scripts, styles, comments, attributes with brackets and quotes
    "<body><script>var a='</p><article>no';</script><style>p{}</style><!-- <p>no</p> --><article title='a>b'>"
    "<p data-x=\"</article>\" title=it's>yes</p></article>": "yes",
    # roles by tag, class, id, ARIA; words only as whole words
    "<header>no</header><nav>no</nav><main><p>yes</p><div class='ad-slot ad'>no</div><div id=cookieNotice>no</div>"
    "<div class=loadable>also</div><aside>no</aside><form><p>no</form><div role=complementary>no</div>"
    "<section class='comments'><p>no</section></main><footer>no": "yes\nalso",
    "<article><header><h1>Title</h1></header><p>text</p><div hidden>no</div><div style='display: none'>no</div></article>":
        "Title\ntext",
    # no article: everything that is not noise
    "<div class='sidebar'>no</div><div><h2>Head</h2><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></div>": "Head\na\nb\nc d",
    "<p>a <span class='share'>no <span>no</span></span> b": "a b",
    "plain text": "plain text",
    "a < b and <p>c": "a < b and\nc",
    "<p>kept<p class='": "kept",
    "": "",
    "<nav>menu</nav>": "",
}


@pytest.mark.parametrize("page", list(PAGES))
def test_markup(page):
    assert hx.main_text(page, set()) == PAGES[page]


def site(i):
    words = [f"w{i * 7 + k}" for k in range(5)]
    return (f"<body><div class=x><p>Welcome to our site</p><ul><li>Home<li>About</ul></div><div class=y><h2>T{i}</h2>"
            f"{''.join(f'<p>{w} text {i}</p>' for w in words[: 1 + i % 5])}<div class=z>All rights reserved</div></div></body>")


def test_repeated_branches_are_removed(spark, monkeypatch):
    rows = [(i, f"https://user@Site.example.com:80/{i}", site(i)) for i in range(60)]
    rows += [(100 + i, f"http://small.example.com/{i}", site(i)) for i in range(3)]  # too few pages to tell
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    by_broadcast = {r["id"]: r["text"] for r in hx.extract(pages).collect()}
    monkeypatch.setattr(hx, "BROADCAST_NODES", -1)
    assert {r["id"]: r["text"] for r in hx.extract(pages).collect()} == by_broadcast
    for i in range(60):
        own = [f"T{i}"] + [f"w{i * 7 + k} text {i}" for k in range(1 + i % 5)]
        assert by_broadcast[i] == "\n".join(own)
    copies = pages.filter("page_id = 3").crossJoin(spark.range(40)).drop("id")  # nothing to tell apart: all stays
    assert {r["text"] for r in hx.extract(copies).collect()} == {hx.main_text(site(3), set())}
    assert by_broadcast[100].startswith("Welcome to our site\nHome\nAbout\nT0")


def test_importance_against_a_plain_count(spark):
    pages = [(1, site(i % 4)) for i in range(30)] + [(2, site(i)) for i in range(9)]
    seen = {}
    for host, page in pages:
        shown = {}
        todo = [parse(page)[0]]
        while todo:
            e = todo.pop()
            todo += e.children[::-1]
            if e.children:
                shown.setdefault((e.key, 0), []).append(tuple(c.key for c in e.children))
            if e.own:
                shown.setdefault((e.key, 1), []).append(tuple(e.own))
        for (key, kind), values in shown.items():
            seen.setdefault((host, key, kind), Counter())[tuple(values)] += 1
    want = {}
    for (host, node, _), c in seen.items():
        m = sum(c.values())
        entropy = 1.0 if m == 1 else -sum(n / m * math.log(n / m, m) for n in c.values())
        was = want.get((host, node), (0, 0.0))
        want[host, node] = (max(was[0], m), max(was[1], entropy))
    df = spark.createDataFrame(pages, "host long, html string").repartition(3)
    got = {(r["host"], r["node"]): (r["pages"], r["importance"]) for r in hx.site_style_tree(df).collect()}
    assert got.keys() == want.keys()
    for k, (m, v) in want.items():
        assert got[k][0] == m and got[k][1] == pytest.approx(v, abs=1e-9)


def test_corpus_pages_against_a_pattern(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = {r["id"]: r["text"] for r in hx.extract(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        body = re.search(r"<article>(.*?)(?:</article>|<footer)", r["html"], re.S)[1]
        parts = [html.unescape(re.sub(r"</?b>", "", p.replace("<br>", " "))) for p in re.split(r"</?(?:p|h1)>", body)]
        assert got[r["page_id"]] == "\n".join(t for t in (" ".join(p.split()) for p in parts) if t)


def test_nulls_repeats_long_and_empty(spark):
    schema = "page_id long, url string, html string, host int, id int, text int"
    assert hx.extract(spark.createDataFrame([], schema)).count() == 0
    deep = "<div>" * 3000 + "x" + "<p>y " * 20000
    rows = [(None, None, None, 1, 1, 1), (1, "::odd", "<p>a", 1, 1, 1), (1, "::odd", "<p>a", 1, 1, 1), (2, "", deep, 1, 1, 1)]
    got = sorted((r["id"] or 0, r["text"]) for r in hx.extract(spark.createDataFrame(rows, schema)).collect())
    assert got[:3] == [(0, ""), (1, "a"), (1, "a")] and got[3][1].split("\n") == ["x"] + ["y"] * 20000


#: Words of a role in other attributes' names and values; the first of a repeated attribute holds.
WHOLE_ATTRIBUTES = {
    "<article title='Hidden gems'><p>a</article>": "a",
    "<article title=\"The hidden life\"><p>a</article>": "a",
    "<section data-testid='article-share'><p>a</section>": "a",
    "<div data-id=related data-class='ad' aria-role=search><p>a</div>": "a",
    "<p>a <a href='/hidden/x'>b</a> <a href='?id=comments'>c</a> <a href=/x?class=ad>d</a>": "a b c d",
    "<p title='style = display:none' data-hidden>a</p>": "a",
    "<p>a</p><div class=ok class=ad><p>b</div>": "a\nb",
    "<p>a</p><div data-x='1'class=ad><p>b</div><div title=it's HIDDEN>c</div><div x=/ id = 'ad'>d</div>": "a",
}


@pytest.mark.parametrize("page", list(WHOLE_ATTRIBUTES))
def test_whole_attributes_only(page):
    assert hx.main_text(page, set()) == WHOLE_ATTRIBUTES[page]


#: A role word in class or id does not take the article with it.
ROLE_WORDS = {
    "<div class='content with-sidebar'><p>a long text of its own</div><div class=sidebar>no</div>": "a long text of its own",
    "<div class='site has-sidebar'><nav>no</nav><article><p>a</article><div class=related>no, longer than a</div></div>": "a",
    "<article class='post category-legal comments-open'><p>a</article>": "a",
    "<div role=main class=widgets><p>a</div><p>b": "a",
    "<article><h1>T</h1><div class='elementor-widget elementor-widget-theme-post-content'><p>a text</div>"
    "<div class=share>no</div></article>": "T\na text",
    # the only article or the main element, however short
    "<div class=has-sidebar><article>a</article></div><div>a text that is much longer</div>": "a",
    "<div id=top-login><main>a</main></div><div>a text that is much longer</div>": "a",
    # an article beside it, or articles that are of the same role
    "<article>a text</article><div class=related><article>no</article><article>no</article></div>": "a text",
    "<div class=has-sidebar><article>a b</article><div class=related><article>n</article></div></div>": "a b",
    "<div><p>the post</div><ol class=comments><li class=comment><article class=comment-body>no</ol>": "the post",
    # nothing else on the page
    "<nav>no</nav><p><span class=widget>a</span>": "a",
    "<p>a <span class=share><button>no</button>no <span>no</span> no</span> b": "a b",
    "<div class=widget><p>a</p></div><div class=promo><p>b</p></div>": "a\nb",
}


@pytest.mark.parametrize("page", list(ROLE_WORDS))
def test_role_words_are_hints(page):
    assert hx.main_text(page, set()) == ROLE_WORDS[page]


#: Parts that an article has itself; what they are called is no reason to drop them.
OWN_PARTS = ["<p class=byline>{}</p>", "<p class=teaser>{}</p>", "<div class=legal>{}</div>", "<div class=toc>{}</div>",
             "<blockquote class=social>{}</blockquote>", "<p class=search-results>{}</p>", "<p>see <a class=share href=x>{}</a></p>",
             "<div class='related widget'>{}</div>"]


@pytest.mark.parametrize("part", OWN_PARTS)
def test_an_articles_own_parts_stay(part):
    body = "<p>" + " ".join(f"w{k}" for k in range(60)) + "</p>"
    page = f"<nav>Home</nav><article>{body}{part.format('its own words')}{body}<div class=comments><p>so true</p></div></article><p class=teaser>more"
    text = hx.main_text(page, set())
    assert "its own words" in text and "so true" not in text and "Home" not in text and "more" not in text


def test_a_page_of_role_words_keeps_what_the_entropy_keeps(spark):
    menu = "<div class=a>Welcome to our site, here is all that you may find on it</div>"
    rows = [(i, "http://x.example/", f"{menu}<div class='c widget'><p>w{i} text</div>") for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["id"]: r["text"] for r in hx.extract(pages).collect()} == {i: f"w{i} text" for i in range(40)}


#: Drawings go, closed by their own tag or not; formulas are inline markup.
DRAWINGS = {
    "<p>one <svg class=\"i\" /> two</p><p>three</p>": "one two\nthree",
    "<p>one <svg/>two <svg viewBox/>three <SVG a='1'/>four</p><svg><text>no</text></svg><p>five": "one two three four\nfive",
    "<p>a<svg class=i/><path d='M0'/></svg> b": "a b",  # the slash is part of the bare value
    "<p>a<svg><title/><style/><svg><text>no</text></svg><desc><p>no</p></desc><text>no</text></svg> b": "a b",
    "<p>a<svg><foreignObject><div>no</div><br></foreignObject><path><path></svg> b": "a b",
    "<p>a <a href=x><svg class=i><path></a> b</p><p>c": "a b\nc",  # never closed
    "<p>a <svg class=i> no</p><p>b <svg><span>c</span>": "a\nb c",
    "<table><tr><td>a<svg></td><td>b</td></table></svg><p>c": "a b\nc",
    "<p>so <math><semantics><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding='tex'>no</annotation></semantics></math> holds":
        "so x=2 holds",
    "<p>a <math display=block /> b <math><mi>y</mi> c</p><p>d": "a b y c\nd",
}


@pytest.mark.parametrize("page", list(DRAWINGS))
def test_drawings_and_formulas(page):
    assert hx.main_text(page, set()) == DRAWINGS[page]


def test_small_hosts_lose_what_all_their_pages_show(spark):
    sizes = [1, 3, 4, 5, 8, 12, 19, 20, 40]
    rows = [(1000 * n + i, f"http://of{n}.example/{i}", site(i)) for n in sizes for i in range(n)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r["id"]: r["text"] for r in hx.extract(pages).collect()}
    for n in sizes:
        for i in range(n):
            own = [f"T{i}"] + [f"w{i * 7 + k} text {i}" for k in range(1 + i % 5)]
            menu, end = (["Welcome to our site", "Home", "About"], ["All rights reserved"]) if n <= 3 else ([], [])
            assert got[1000 * n + i] == "\n".join(menu + own + end)


def test_what_few_pages_differ_in_stays(spark):
    # one of n pages has another text in the same node: told from a repeated one only by more pages
    def page(i):
        return f"<div class=a>{'other' if i == 0 else 'same'}</div><div class=b><p>w{i}</div>"

    rows = [(1000 * n + i, f"http://of{n}.example/{i}", page(i)) for n in (4, 6, 8, 40) for i in range(n)]
    got = {r["id"]: r["text"] for r in hx.extract(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for n in (4, 6, 8):
        assert got[1000 * n] == "other\nw0" and got[1000 * n + 1] == "same\nw1"
    assert got[40000] == "w0" and got[40001] == "w1"


def test_copies_do_not_make_a_template(spark):
    # many copies of one article beside pages of another layout
    rows = [(i, "http://x.example/", "<div class=d>1 May</div><div class=post><p>an article</div>") for i in range(30)]
    rows += [(100 + i, "http://x.example/", f"<div class=d>{i} June</div><div class=list><p>w{i}</div>") for i in range(15)]
    got = {r["id"]: r["text"] for r in hx.extract(
        spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert {got[i] for i in range(30)} == {"1 May\nan article"}
