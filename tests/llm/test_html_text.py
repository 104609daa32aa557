import html
import re

import pytest

from srcweave.llm.html_text import extract_text, main_text

PAGES = "/root/testdata/sf0.01/pages.parquet"
CASES = [
    ("<p>just a paragraph", "just a paragraph"),
    ("<article><h1>T</h1><p>a &amp; b&nbsp;&#233;\n c<p>d<br>e</article><footer>f</footer>", "T a & b é c d e"),
    ('<div class="ad">buy</div><main><p>x</p><aside>y</aside><form>z</form><p>w</p></main>', "x w"),
    ('<article><p>x</p><div class="ad"><div>in</div>ner</div><p>y</p><div id="comments"><p>c</p></div></article>', "x y"),
    ('<article><p class="notice">cookies<p>real<p>text</article>', "real text"),
    ('<div class="layout sidebar-left"><article><p>x</p></article></div>', "x"),
    ("<script>if (a < b) '</p>'</script><style>p>a{}</style><p>x <!-- <p>no --> y</p>", "x y"),
    ('<article><p title="a > b">x</p><p title=\'"\'>y</p></article>', "x y"),
    ("<nav><ul><li>a<li>b</ul></nav><article>x<script>1", "x"),
    ("<article><p>x</p><ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table></article>", "x one two c1 c2"),
    ("1 < 2 and <b>bold</b>er", "1 < 2 and bolder"),
    ("", ""),
    ("<html><head><title>t</title></head><body></body></html>", ""),
]


@pytest.mark.parametrize("page, text", CASES)
def test_cases(page, text):
    assert main_text(page) == text


def test_unmarked_page_keeps_the_text_between_surge_and_dive():
    long = "word " * 30
    noise = "".join(f"<div>m{i}</div><div></div><div></div><div></div>" for i in range(4))
    page = f"<html><body>{noise}<p>{long}</p><p>{long}</p><p>end</p><div></div><div></div><div></div>{noise}</body></html>"
    assert main_text(page) == f"{long}{long}end"


@pytest.mark.parametrize(
    "lead", ["<h1>Title</h1><p>By A. Nother</p><p>A short lead.</p>", "<p>one verse<br>two verse<br>three</p>", "<ul><li>a<li>b</ul>"]
)
def test_unmarked_page_keeps_what_leads_up_to_the_surge(lead):
    long = "word " * 30
    noise = "<div>menu</div><div></div><div></div><div></div>"
    body = f"{lead}<p>{long}</p><p>{long}</p>"
    words = re.sub("<[^>]*>", " ", body).split()
    page = f"<html><body>{noise}{body}<div></div><div></div>{noise}{body}<div></div><div></div>{noise}</body></html>"
    found = main_text(page).split()
    assert found[: len(words)] == words
    assert found[-len(words) :] == words
    assert found.count("menu") == 1  # between two stretches; neither before nor behind them


def test_pages_of_the_table(spark):
    """Every page of the table has one article; its blocks, taken plainly, are the text."""
    pages = spark.read.parquet(PAGES)
    for r in extract_text(pages).collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.DOTALL).group(1)
        plain = " ".join(html.unescape(re.sub(r"</?(?:h1|p|b|br)>", " ", article)).split())
        assert r.text.replace(" ", "") == plain.replace(" ", "")
        assert r.n_chars == len(r.text)


def test_odd_rows(spark):
    schema = "page_id long, html string, text string, n_chars string"
    rows = [(1, None, "a", "b"), (1, None, "a", "b"), (2, "", None, None), (3, "<article>" + "<p>word</p>" * 50_000, "x", "y")]
    found = extract_text(spark.createDataFrame(rows, schema))
    assert found.columns == ["page_id", "html", "text", "n_chars"]
    assert sorted(r.n_chars for r in found.collect()) == [0, 0, 0, 249_999]
    assert extract_text(spark.createDataFrame([], schema)).count() == 0
