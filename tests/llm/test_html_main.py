"""Main text: blocks, boilerplate, broken markup and the hosts' votes."""

import html
import re
import time

from dwellspark.llm.common import table
from dwellspark.llm.html_main import best_container, extract, read_page, text_on

ARTICLE = "<article><h1>Title &amp; more</h1><p>First   para&nbsp;graph <a href=x>link</a> text.<p>Second<br>line<ul><li>one<li>two</ul></article>"
TEXT = "Title & more\nFirst para graph link text.\nSecond line\none\ntwo"


def main_text(page):
    read = read_page(page)
    return text_on(read, best_container(read)[0])


def test_boilerplate_goes():
    around = ("<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a='</p><p>x';</script></head><body><header class=top><h1>Site</h1></header>"
              "<nav><ul><li>menu</ul></nav><div id='cookie-notice'>We use cookies</div><div class='ad'>Buy</div><aside>Side</aside>{}"
              "<section class='comments'><article class=comment><p>a very long reader comment, longer than all of the article together, on and on and on and on and on"
              "</article></section><form><p>Name</form><footer>&copy; foot</footer></body></html>")
    assert main_text(around.format(ARTICLE)) == TEXT
    assert main_text(around.format(ARTICLE.replace("article", "div"))) == TEXT
    assert main_text(around.format(ARTICLE.replace("<p>Second", "<!-- <p>no</p> --><div class=share>Share</div><div hidden>no</div><p>Second"))) == TEXT


def test_broken_and_odd_pages():
    assert main_text("") == "" and main_text("<p>") == "" and main_text("plain &lt;b&gt; <b>text") == "plain <b> text"
    assert main_text("<article><p>cut off <b>here") == "cut off here"
    assert main_text("<article><p>a < b and c &amp d &#233; &bogus;</p></article>") == "a < b and c & d é &bogus;"
    assert len(main_text("<article>" + "<p>word</p>" * 50_000)) == 50_000 * 5 - 1
    assert main_text("<p a='" * 3000) is not None and main_text("<div>" * 3000 + "deep") == "deep"
    assert main_text("<article><table><tr><td>a<td>b<tr><td>c</table></article>") == "a\nb\nc"
    assert main_text("<script>never closed <p>x") == ""


def test_names_inside_articles():
    """Names that only contain a boilerplate word, and ids of headings and sections, leave article text alone."""
    assert main_text("<article><h2 id='related-work'>Related</h2><p>a</p><section id=discussion><p>b</p></section>"
                     "<div class='section' id='search'><p>c</p></div></article>") == "Related\na\nb\nc"
    assert main_text("<div class='page hidden-scroll has-sidebar'><article><p>kept</p></article></div>") == "kept"
    assert main_text("<body><header><h1>Site</h1><p>slogan</p></header><article><header><h1>T</h1><p>standfirst</p></header><p>a</p></article>") == "T\nstandfirst\na"
    links = "<section id=related><ul><li><a href=x>one more</a><li><a href=y>and another</a></ul></section>"
    assert main_text(f"<article><p>text of it</p>{links}</article>") == "text of it"
    for name in ("ad", "sidebar-left", "cookieNotice", "post-comments", "share", "newsletter_box", "notice"):
        assert main_text(f"<article><p>text of it</p><div class='{name}'>something else</div></article>") == "text of it", name
    assert main_text("<article><p>text</p><section id='comments'><p>nice</p></section><div id='cookie-banner'>We use cookies</div></article>") == "text"


def test_deep_pages_are_linear():
    """200,000 open elements, stray end tags and blocks at every depth: no walk up the page for any of them."""
    began = time.process_time()
    assert main_text("<div>" * 200_000 + "deep") == "deep"
    assert len(main_text("<article>" + "<div>x" * 100_000)) == 200_000 - 1
    assert main_text("<article><p>a" + "<div><i>" * 50_000 + "b" + "</u></p></td>" * 50_000) == "a\nb"
    assert main_text("<article><p>a</p><table>" + "<tr><td>" * 50_000 + "b</article>").split("\n")[0] == "a"
    assert time.process_time() - began < 20


def test_path_of_a_winner_is_found_again():
    read = read_page("<body><div class='b a12'><p>text</p></div><div class='x>y'>more text than there</div>")
    path, _ = best_container(read)
    assert path == "html>body>div.x_y" and text_on(read, path) == "more text than there"
    assert text_on(read, "html>body>div.a#.b") == "text" and text_on(read, "html>nothing") == ""


def test_pages_of_the_test_tables(spark):
    sf = "/root/testdata/sf0.01"
    raw = {r["page_id"]: r["html"] for r in table(spark, sf, "pages").collect()}
    for r in extract(table(spark, sf, "pages")).collect():
        inner = re.search(r"<article>(.*?)</article>", raw[r["page_id"]], re.S)[1]
        parts = re.split(r"</?(?:p|h1|br)\b[^>]*>", inner)
        want = "\n".join(x for x in (" ".join(html.unescape(re.sub(r"<[^>]+>", "", p)).split()) for p in parts) if x)
        assert r["text"] == want


def test_hosts_vote(spark):
    """One page's comment-like box is longer than its text; the host's other pages decide."""
    page = "<body><div class='story s{}'><p>{}</p></div><div class='box'><p>{}</p></div>"
    rows = [(i, f"http://a.org/{i}", page.format(i, "the story itself goes here " * 9, "small"), 0) for i in range(8)]
    rows += [(8, "http://a.org/8", page.format(8, "short story", "a box with more text than the story " * 9), 0),
             (9, None, None, 0), (10, "http://b.org/", "", 0), (11, "nothing", "<p>x</p>", 0), (None, None, ARTICLE, 0), (11, "nothing", "<p>x</p>", 0)]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int"))
    assert got.count() == len(rows)
    text = {r["page_id"]: r["text"] for r in got.collect()}
    assert text[8] == "short story" and text[9] == "" and text[10] == "" and text[11] == "x" and text[None] == TEXT
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
