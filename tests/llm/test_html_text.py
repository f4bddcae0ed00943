import html
import re

import pytest
from pyspark.sql import functions as F

from stayledger.llm.common import table
from stayledger.llm.html_text import blocks, main_text
from tests.llm.helpers import prose

PAGE = ('<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var x="</p>";</script></head><body>'
        '<nav><ul><li><a href="/">home</a></li></ul></nav><!-- <p>no</p> --><div class="ad">buy</div>{}'
        '<footer>&copy; host</footer></body></html>')


@pytest.mark.parametrize("body, want", [
    ("<article><h1>A  &amp;\n B</h1><p><b>one.<br><p>two<br>three</p></article>", "A & B\none.\ntwo three"),
    ("<main><p>x &lt;p&gt; &#233;&eacute;&nbsp;y</p><form><p>mail</p></form><aside>s</aside></main>", "x <p> éé y"),
    ('<article><p>a</p><div class="share-bar">s</div><section id="comments"><article><p>c</p></article></section>'
     "<p>b</p></article>", "a\nb"),
    ('<article><p title="a > b">t</p><p hidden>h</p><p style="display: none">n</p></article>', "t"),
    ("<article></article>", ""), ("<article><p>cut of", "cut of"), ("<article><p>x &am", "x &am"),
    ("<article>a<span>b</span>c<div>d</div>e</article>", "abc\nd\ne"),
    ("<ARTICLE><P>up</P></ARTICLE>", "up"),
    ('<div role="main"><table><tr><td>1</td><td>2</td></tr></table></div>', "1\n2"),
    ("<article><textarea><p>no</p></textarea><button>no</button><p>yes</article>", "yes")])
def test_pages_that_name_their_text(body, want):
    named, found = blocks(PAGE.format(body))
    assert named and "\n".join(found) == want


def rows(spark, *pages):
    return spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string")


def texts(df):
    return {r.page_id: r.text for r in df.collect()}


def test_host_repeats_decide_where_structure_is_silent(spark):
    common = "<div>" + prose(1, 12) + "</div><div>about us here</div>"
    own = [(prose(10 + i, 25), prose(50 + i, 4)) for i in range(6)]
    pages = [("https://one.example/%d" % i, PAGE.format(f"{common}<p>{a}</p><p>{b}</p>")) for i, (a, b) in enumerate(own)]
    pages += [("https://two.example/", PAGE.format(f"{common}<p>alone</p>")), pages[0]]
    got = texts(main_text(rows(spark, *pages)))
    for i, (a, b) in enumerate(own):
        assert got[i] == f"{a}\n{b}"
    assert got[7] == got[0]  # a copy is no second page
    assert got[6].endswith("about us here\nalone")  # another host has not seen it before


def test_copies_of_an_article_stay_whole(spark):
    page = PAGE.format(f"<article><p>{prose(2, 40)}</p></article>")
    got = texts(main_text(rows(spark, *[("http://h.example/%d" % i, page) for i in range(5)])))
    assert set(got.values()) == {prose(2, 40)}


def test_null_and_empty_pages(spark):
    odd = spark.createDataFrame([(1, None, None), (2, "u", ""), (None, "u", "<p>x"), (3, None, "<p>y</p>" + "z" * 200_000),
                                 (4, "u", "<<<>>><"), (4, "u", "<<<>>><")], "page_id long, url string, html string")
    got = main_text(odd.withColumn("text", F.lit("clash")).withColumn("row", F.lit(1)))
    found = sorted((str(r.page_id), r.text[:3]) for r in got.collect())
    assert found[:2] == [("1", ""), ("2", "")] and found[-1] == ("None", "x") and len(found) == 6
    assert main_text(odd.limit(0)).collect() == []


def test_given_pages(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    given = {r.page_id: r.html for r in pages.collect()}
    got = texts(main_text(pages))
    assert len(got) == len(given)
    for i, page in given.items():
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1].replace("<b>", "")
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article))
        assert got[i] == "\n".join(x for x in parts if x)


def test_a_word_of_structure_in_a_comment_or_beside_names_no_text(spark):
    common = "<div>" + prose(1, 12) + "</div>"
    odd = ["<!-- <article> -->", '<script>var x="<main>";</script>', "<aside><article>see also</article></aside>",
           '<article class="comment">me too</article>']
    pages = [("http://h.example/%d" % i, PAGE.format(f"{common}{x}<p>{prose(10 + i, 25)}</p>")) for i, x in enumerate(odd)]
    assert texts(main_text(rows(spark, *pages))) == {i: prose(10 + i, 25) for i in range(4)}


def test_repeats_inside_articles_and_counts_over_all_pages(spark):
    notice, quote = prose(1, 12), prose(2, 12)
    named = [f"<article><p>{prose(10 + i, 25)}</p><div>{notice}</div><p>{quote}</p></article>" for i in range(3)]
    page = PAGE.format(f"<div>{notice}</div><p>{prose(20, 25)}</p>")  # no article; the notice is known from the others
    got = texts(main_text(rows(spark, *[("http://h.example/%d" % i, x) for i, x in enumerate(
        [*map(PAGE.format, named), page])])))
    assert got == {**{i: f"{prose(10 + i, 25)}\n{quote}" for i in range(3)}, 3: prose(20, 25)}


@pytest.mark.parametrize("tag", ["article", "div"])
def test_near_copies_of_an_article_are_one_page(spark, tag):
    text = f"<div>{prose(1, 40)}</div><div>{prose(2, 30)}</div>"
    pages = [("http://h.example/%d" % i, PAGE.format(f"<{tag}>{text}<div>on day {i}</div></{tag}>")) for i in range(4)]
    got = texts(main_text(rows(spark, *pages)))
    assert got == {i: f"{prose(1, 40)}\n{prose(2, 30)}\non day {i}" for i in range(4)}


@pytest.mark.parametrize("body", [
    '<article class="post has-sidebar"><p>own text</p></article>', '<main class="with-sidebar"><p>own text</p></main>',
    '<div class="no-sidebar"><article><p>own text</p></article></div>', '<main id="share"><p>own text</p></main>',
    '<article class="post sponsored"><p>own text</p><div class="sidebar">s</div></article>',
    '<div id="sidebar-left-layout"><nav>n</nav><article><p>own text</p><div class="comments">c</div></article></div><p>x</p>'])
def test_classes_do_not_hide_the_article(body):
    assert blocks(PAGE.format(body)) == (True, ["own text"])


@pytest.mark.parametrize("body", [
    '<div class="no-sidebar"><p>own text</p></div><div class="sidebar"><p>s</p></div>',
    '<p>own text</p><div class="sidebar"><article>see</article></div>', '<p>own text</p><article class="comment">c</article>',
    '<p>own text</p><div class="comments"><article id="div-comment-7" class="comment-body">a longer text</article></div>'])
def test_articles_beside_the_text_do_not_name_it(body):
    assert blocks(PAGE.format(body)) == (False, ["own text"])


def test_the_bar_does_not_grow_with_the_host_and_runs_go_from_blocks(spark):
    menu, notice = prose(1, 12), prose(2, 12)
    body = ["<div>{0}</div><p>{1}</p>", "<p>{1} {2} {3}</p>", "<p>{1}</p>"]
    pages = [("http://h.example/%d" % i, PAGE.format(body[min(i // 3, 2)].format(
        menu, prose(10 + i, 25), notice, prose(100 + i, 8)))) for i in range(60)]
    got = texts(main_text(rows(spark, *pages)))
    assert got == {i: prose(10 + i, 25) + (" " + prose(100 + i, 8) if i // 3 == 1 else "") for i in range(60)}


@pytest.mark.parametrize("body, want", [
    ('<div class="social-history"><p>own text of the page</p></div>', (False, ["own text of the page"])),
    ('<div class="content widget"><h1>T</h1><p>own text</p></div>', (False, ["T", "own text"])),
    ('<div id="comment-free"><p>own text</p></div>', (False, ["own text"])),
    ('<article><p>one</p><div class="login-history"><p>two two</p></div></article>', (True, ["one", "two two"]))])
def test_a_class_word_never_hides_what_outweighs_the_rest(body, want):
    assert blocks(PAGE.format(body)) == want


def test_common_phrases_stay_in_running_text(spark):
    phrase = "at the end of the day we"
    pages = [("http://h.example/%d" % i, PAGE.format(f"<p>{prose(10 + i, 25)} {phrase} {prose(40 + i, 9)}</p>")) for i in range(5)]
    assert texts(main_text(rows(spark, *pages))) == {i: f"{prose(10 + i, 25)} {phrase} {prose(40 + i, 9)}" for i in range(5)}
