import pytest

from earshot.llm.main_text import main_text, main_texts
from tests.llm.cases import table

NOISE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body>"
    "<header><h1>Site</h1><a href=/>home</a></header><nav><ul><li><a href='/a'>One</a></li><li><a href='/b'>Two</a></li></ul></nav>"
    "<div class='cookie-notice'>We use cookies on this site and you must accept them all right now.</div><!-- c --><div class=\"ad\">Buy now! Buy this!</div>"
    "ARTICLE<aside><p>Related stories that are quite long as well</p></aside><form><input name=q><label>Search</label></form>"
    "<section id='comments'><p>First! A reader comment which is rather long too, longer than the text.</p></section>"
    "<footer>&copy; 2024 Someone</footer></body></html>"
)


@pytest.mark.parametrize(
    "article, text",
    [
        ("<article><h1>Head</h1><p>One <b>two</b>\n three.</p><p>Fo<i>ur</i>.</p></article>", "Head One two three. Four."),
        ("<article><h1>A&amp;B &lt;</h1><p><b>open<br><p>next&nbsp;one</article>", "A&B < open next one"),
        ("<div id=main><p>Just a paragraph of some length here.</p><p>And another, shorter.</p></div>", "Just a paragraph of some length here. And another, shorter."),
        ("<article><p>x</p></article>", "x"),
        ("<article><ul><li>a<li>b</ul><table><tr><td>1<td>2</table></article>", "a b 1 2"),
        ("<article><p>before</p><div class='share social'>Tweet</div><p>after &#233; &bogus;</p></article>", "before after é &bogus;"),
        ("<article><p>quoted '<b title=\"a>b\">x</b>' 1 < 2 & so</p></article>", "quoted 'x' 1 < 2 & so"),
        ("<div class='page has-sidebar'><article><p>Held by a marked element.</p></article></div>", "Held by a marked element."),
        ("", ""),
    ],
)
def test_the_article_is_left(article, text):
    assert main_text(NOISE.replace("ARTICLE", article)) == text


BODY = "<h1>The title</h1><p>A first paragraph that says what the page is about, at some length.</p><p>A second one, which ends it.</p>"
BODY_TEXT = "The title A first paragraph that says what the page is about, at some length. A second one, which ends it."


@pytest.mark.parametrize(
    "article, text",
    [
        (f"<div class='has-sidebar'>{BODY}<div class='sidebar'><p>Popular now</p></div></div>", BODY_TEXT),
        (f"<div class='no-header'>{BODY}</div>", BODY_TEXT),
        (f"<div id='search-results'>{BODY}</div>", BODY_TEXT),
        (f"<div class='search'><div>{BODY}</div><div class='ad'>Buy now!</div></div>", BODY_TEXT),
        (f"<form action='x.aspx'><input type=hidden><article>{BODY}</article><select><option>One</select></form>", BODY_TEXT),
        (f"<form action='x.aspx'><div id='content'>{BODY}</div><label>Name</label></form>", BODY_TEXT),
        ("<article><div class='article-header'><h1>The title</h1><p>The lead.</p></div><p>The body of it.</p></article>", "The title The lead. The body of it."),
        ("<article><div class='header'><h1>The title</h1></div><p>The body of it.</p></article>", "The title The body of it."),
        ("<div>" + "<div class='page-widget'><p>Every paragraph in its own widget.</p></div>" * 3 + "</div>", " ".join(["Every paragraph in its own widget."] * 3)),
        (f"<div>{BODY}</div><form><p>Sign up here</p></form><div class='sidebar'><p>Popular now</p></div>", BODY_TEXT),
        (f"<div>{BODY}</div><div id='comments'>{'<p>A reader who writes a lot about this and that.</p>' * 20}</div>", BODY_TEXT),
    ],
)
def test_marks_cut_only_what_the_text_does_not_speak_for(article, text):
    assert main_text(NOISE.replace("ARTICLE", article)) == text


def test_a_page_inside_one_marked_element():
    for wrapper in ("<form>", "<div class='has-sidebar'>", "<div class='no-header'>", "<div id='search-results'>", "<div class='comments'>"):
        close = "</form>" if wrapper == "<form>" else "</div>"
        assert main_text(f"<html><body>{wrapper}<nav><a href=/>Home</a></nav>{BODY}<p>A third.</p>{close}</body></html>") == BODY_TEXT + " A third."


@pytest.mark.parametrize("html", [None, "", "   ", "<", "<p", "<!--", "<script>", "</p></div>", "<a href='", "&", "<html><body></body></html>", "<div class=ad>only</div>"])
def test_odd_pages_have_no_text(html):
    assert main_text(html) in ("", "&", "<")  # a lone sign is text


def test_plain_text_unclosed_and_deep_pages():
    assert main_text("no markup at all") == "no markup at all"
    assert main_text("<article><p>cut off in a ta<b cl") == "cut off in a ta"
    assert main_text("<div>" * 3_000 + "deep" + "</div>" * 10) == "deep"


def test_pages(spark):
    import html as h
    import re

    rows = {r.page_id: r for r in main_texts(table(spark, "pages")).collect()}
    for r in table(spark, "pages").collect():
        inner = re.search("<article>(.*?)</article>", r.html, re.DOTALL)[1]
        want = " ".join(h.unescape(re.sub(r"</?(p|br|h1)[^>]*>", " ", inner).replace("<b>", "").replace("</b>", "")).split())
        assert rows[r.page_id].text == want and rows[r.page_id].n_chars == len(want) and rows[r.page_id].url == r.url
    odd = spark.createDataFrame([(None, None, None, "x"), (1, "u", "", "x"), (1, "u", "<p>hi</p>", "x"), (1, "u", "<p>hi</p>", "x")], "page_id long, url string, html string, text string")
    assert sorted((r.text, r.n_chars) for r in main_texts(odd).collect()) == [("", 0), ("", 0), ("hi", 2), ("hi", 2)]
    assert main_texts(odd.limit(0)).collect() == []
