from __future__ import annotations

import html as entities
import re

import pytest

from millrace.llm.html import extract, main_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="with-sidebar">
<header><a href=/>Home</a> The site</header><nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav>
<div id="cookieNotice">We use cookies. Really, we do.</div><div class="top ad-box">Buy this, now.</div>
<div class="menu"><a href=1>One</a> <a href=2>Two</a></div>
<div class="content"><h1>News, big news</h1><p>First <b>bold</b>
 part with <a href="x>y">a link</a>, &amp;c.<p>Second &#x41;&nbsp;B; done.<br>Next line.
<ul><li>one, two<li>three.</ul><script>var t="</p>Not this.";</script><!-- nor this. -->
<div class="share"><a>Tweet</a></div><form><label>Mail.</label><input></form><p style="display: none">Hidden text.</p></div>
<aside>Side story, long enough to matter.</aside><section id="comments"><p>I disagree, strongly.</p></section>
<footer>&copy; 2020, all rights.</footer></body></html>"""


def test_a_page_with_everything():
    want = ["News, big news", "First bold part with a link, &c.", "Second A B; done. Next line.", "one, two", "three."]
    assert main_text(PAGE) == "\n\n".join(want)


def test_cut_off_pages():
    whole = main_text(PAGE)
    for cut in range(0, len(PAGE), 7):
        main_text(PAGE[:cut])
    assert main_text(PAGE[: PAGE.index("<aside")]) == whole


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("   ", ""), ("just text, no tags", "just text, no tags"), ("<p>a.<p>b.", "a.\n\nb."),
        ("<nav>only a menu</nav>", ""), ("<script>x", ""), ("a < b and b > c.", "a < b and b > c."), ("&lt;b&gt; stays.", "<b> stays."),
        ("<article><h1>T</h1><b>loose.<p>x</b> y.</article>", "T\n\nloose.\n\nx y."),
        ("<article><table><tr><td>a<td>b.<tr><td>c</table></article>", "a b.\n\nc"),
        ('<article class="post comments-open"><p>Text, here.</p></article><article class="comment"><p>No, there.</p></article>', "Text, here."),
        ('<div class="article-header"><h1>Title</h1></div><div class="header">Site</div><div class="article-body"><p>Text, here.</p></div>', "Title\n\nText, here."),
        ("<article><p>Text, here.</p><footer>By me.</footer></article><p>More text, there.</p>", "Text, here."),
    ],
)
def test_small_pages(page, text):
    assert main_text(page) == text


def test_large_odd_pages_end():
    for page in ("<div>" * 30000 + "x.", "<p><b>a.</i>" * 20000, "<" * 50000, '<a b="' * 5000, "<!--" * 20000, "</div>" * 50000):
        main_text(page)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_given_pages(spark, sf):
    """On the given pages the article is marked, so a plain reading of it is the answer."""
    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    got = extract(pages).collect()
    assert len(got) == len(html)
    for r in got:
        body = html[r.page_id].split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(entities.unescape(re.sub(r"</?b>|<br>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n\n".join(b for b in blocks if b)
        assert r.n_chars == len(r.text)


def test_odd_rows(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, "<p>x, y.</p>"), (2, "", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as N_Chars")
    got = sorted(map(tuple, extract(df).collect()), key=str)
    assert got == sorted([(1, "u", "", 0), (1, "u", "", 0), (None, None, "x, y.", 5), (2, "", "", 0)], key=str)
    assert extract(df.limit(0)).count() == 0


LONG = "One sentence, of some words, that goes on for a while; it ends here. " * 3
BODY = f"<p>{LONG}</p><p>{LONG}</p>"
WHOLE = f"{LONG.strip()}\n\n{LONG.strip()}"


@pytest.mark.parametrize(
    "page, text",
    [
        (f'<div class="content-sidebar-wrap"><main><article>{BODY}</article></main></div><p>Site, rights.</p>', WHOLE),
        (f'<div id="page" class="has-sidebar"><div>{BODY}</div></div>', WHOLE),
        (f'<div class="rail"><main>{BODY}</main></div><p>Site, rights.</p>', WHOLE),
        (f'<div class="overlay"><article>{BODY}</article></div>', WHOLE),
        (f'<div class="modal">{BODY}</div><p><a href=1>Home</a></p>', WHOLE),
        (f'<article>{BODY}<section id="search-algorithms"><h2 id="related-work">Work</h2><p id="notice-period">Short, so.</p></section></article>',
         f"{WHOLE}\n\nWork\n\nShort, so."),
        (f'<article>{BODY}<p>We <span class="alert">must not</span> fail.</p><pre>x = 1 <span class="hljs-comment"># one</span></pre></article>',
         f"{WHOLE}\n\nWe must not fail.\n\nx = 1 # one"),
        (f'<div>{BODY}</div><div class="related">{LONG}</div><div class="cookie-bar">Cookies, here.</div>', WHOLE),
        (f'<div>{BODY}</div><div id="comments"><article class="comment-body"><p>{LONG}</p></article></div>', WHOLE),
        ('<article><table><tr><td class="menu">a.<td>b, c.</table></article>', "b, c."),
    ],
)
def test_names_of_parts(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        (f'<p class="article-lead">Lead, here. {LONG}</p>{BODY}', f"Lead, here. {LONG.strip()}\n\n{WHOLE}"),
        (f'<div><p class="story-intro">{LONG}</p><p>Body, all of it. And more, here.</p></div>', f"{LONG.strip()}\n\nBody, all of it. And more, here."),
        (f'<div class="entry">Lead, here.</div>{BODY}', f"Lead, here.\n\n{WHOLE}"),
        (f'<h1 class="post-title">Title</h1><div class="post-body">{BODY}</div><p>Site, rights.</p>', f"Title\n\n{WHOLE}"),
        (f'<div class="post-body">{BODY}</div><p>Site, rights.</p>', WHOLE),
    ],
)
def test_one_marked_block(page, text):
    assert main_text(page) == text


FIELDS = '<input type="hidden" name="__VIEWSTATE" value="x">' * 9 + '<label>Find.</label><input name="q"><button>Go, now.</button><select><option>One.</select>'


@pytest.mark.parametrize(
    "page, text",
    [
        (f'<body><form id="aspnetForm" runat="server">{FIELDS}<div>{BODY}</div></form></body>', WHOLE),
        (f'<form class="form">{FIELDS}<article>{BODY}</article></form><p>Site, rights.</p>', WHOLE),
        (f'<form>{FIELDS}<div class="overlay">{BODY}</div></form>', WHOLE),
        ("<form><p>Only a few words, and no more.</p></form>", "Only a few words, and no more."),
        (f'{BODY}<form><p>Tell us, please.</p><input></form>', WHOLE),
        (f"{BODY}<form>{'<p>Name of it, please, and more of it.</p><input>' * 20}</form>", WHOLE),
        ("<p>So <math><mi>E</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac><mspace/><annotation>\\frac</annotation></math> holds.</p>", "So E= 1 2 holds."),
        (f"<p>Let <math><mi>x</mi> be.</p>{BODY}", f"Let x be.\n\n{WHOLE}"),
        (f"<div><svg><path d=1>{BODY}</div>", WHOLE),
        (f"<div><svg><path d=1></div>{BODY}<svg><text>no</text></svg>", WHOLE),
        (f"<svg><foreignObject><p>{LONG}</p></foreignObject><text>no.</text></svg>{BODY}", WHOLE),
    ],
)
def test_forms_formulas_and_drawings(page, text):
    assert main_text(page) == text


def test_large_odd_forms_and_drawings_end():
    for page in ("<svg><foreignObject><p>" * 20000, "<form><p>a." * 20000, '<div class="menu"><main>a.' * 10000, "<math><mi>" * 20000, "<svg>" * 20000):
        main_text(page)


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<article><p>One, two.</p><p><a title=it's href=x>Link</a> and more, here.</p><p>It's \"so\".</p>{BODY}</article>",
         f"One, two.\n\nLink and more, here.\n\nIt's \"so\".\n\n{WHOLE}"),
        (f'<article><p class="lead"">Lead, of it.</p><p>Second, one.</p><p>Third "quoted" one.</p>{BODY}</article>',
         f'Lead, of it.\n\nSecond, one.\n\nThird "quoted" one.\n\n{WHOLE}'),
        ('<p title="a>b" lang=x>One, two.</p><p data-x=a"b>Three, four.</p>', "One, two.\n\nThree, four."),
        ("<p title = 'a>b'>One, two.<p title= >Three, four.", "One, two.\n\nThree, four."),
    ],
)
def test_a_stray_quote_does_not_swallow_text(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        (f'<article><header><h1>TITLE</h1></header><div class="body">{BODY}</div></article>', f"TITLE\n\n{WHOLE}"),
        (f"<article><ul><li><p>item</p></li><li><p>two</p></li></ul>{BODY}</article>", f"item\n\ntwo\n\n{WHOLE}"),
        (f"<article>{BODY}<table><tr><td>1</td><td>2</td></tr></table></article>", f"{WHOLE}\n\n1 2"),
        (f"<article>{BODY}<div><div><p>So</p></div></div></article>", f"{WHOLE}\n\nSo"),
        (f"<article>{BODY}<section><header><h2>Head</h2></header>{BODY}</section></article>", f"{WHOLE}\n\nHead\n\n{WHOLE}"),
        (f"<div>{BODY}<section><header><h2>Head</h2></header>{BODY}</section></div>", f"{WHOLE}\n\nHead\n\n{WHOLE}"),
        (f"<div><ul><li><p>item</p></li></ul>{BODY}<table><tr><td>1</td></tr></table><div><div><p>So</p></div></div></div><div><a href=1>Home</a></div>",
         f"item\n\n{WHOLE}\n\n1\n\nSo"),
        (f'<article>{BODY}<div class="widget"><table><tr><td>1<td>2</table></div></article>', f"{WHOLE}\n\n1 2"),
        (f"<article>{BODY}<object data=x><p>Fallback, of it.</p></object></article>", f"{WHOLE}\n\nFallback, of it."),
        (f"<article>{BODY}<aside>A word beside it.</aside>{BODY}</article>", f"{WHOLE}\n\nA word beside it.\n\n{WHOLE}"),
        (f"<article>{BODY}<blockquote><p>Said so.</p><footer>Someone</footer></blockquote><footer>By me.</footer></article>",
         f"{WHOLE}\n\nSaid so.\n\nSomeone"),
        (f'<article><header><h1>T</h1></header><div class="entry-content">{BODY}<ul><li>x</ul></div></article>', f"T\n\n{WHOLE}\n\nx"),
    ],
)
def test_all_below_the_content_node_stays(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "page",
    [
        f"<main><article>{BODY}</article><aside>Side story, long enough to matter.</aside></main>",
        f'<article>{BODY}<aside class="related">More, here.</aside><aside><a href=1>One story</a> <a href=2>Two</a></aside></article>',
        f'<article>{BODY}<div class="widget"><a href=1>One</a></div><div class="share"><a>Tweet</a> it, now.</div></article>',
        f'<article>{BODY}<section class="comments"><p>I disagree, strongly.</p></section><form><label>Say.</label><input></form></article>',
        f'<div class="widget"><p>Weather, today.</p></div><article>{BODY}</article><object><p>Player, missing.</p></object>',
        f'<header><h2>Site, of news</h2></header><article>{BODY}</article>',
        f'<article>{BODY}<nav>Next, previous</nav><div hidden>Not, seen.</div><aside role="complementary">Side, of it.</aside></article>',
    ],
)
def test_what_is_no_part_of_the_article_stays_out(page):
    assert main_text(page) == WHOLE
