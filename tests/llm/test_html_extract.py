import re
import time

import pytest

from meridia.llm import html_extract

PROSE = "The river ran under the bridge and the people of the town stood on it to watch the water go by in the evening light."


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<html><body></body></html>", ""),
        ("<nav><a href=x>Home</a></nav><article><h1>A &amp; B</h1><p>One\n  two &eacute;&#x21;<br>three</p></article><footer>&copy; me</footer>", "A & B\n\nOne two é! three"),
        ("<article><p>a<p>b<ul><li>c<li>d</ul><div class='comments'><p>no</p></div><p>e</article>", "a\n\nb\n\nc\n\nd\n\ne"),
        ("<script>var t='</p>';<p>x</p></script><article><p>y<!-- <p>z</p> --></p><style>p{}</style></article>", "y"),
        ("<aside>side<div>more</div><article><p>text</p></article>", "text"),
        ("<article><form>name <input><button>go</button></form><p hidden>h</p><p style='display:none'>n</p><p>t</p></article>", "t"),
        ("<article><p>1 < 2 and <b>bold</b>er</p><p>cut <a href='", "1 < 2 and bolder\n\ncut <a href='"),
        (f"<div><a href=1>menu one</a> <a href=2>menu two</a></div><div>{PROSE}</div><div>Short line.</div><div>{PROSE}</div>", f"{PROSE}\n\nShort line.\n\n{PROSE}"),
        (f"<div><a href=1>menu</a></div><div>ad here</div><h2>Title</h2><div>{PROSE}</div><div><a href=2>links</a></div><div>tail</div>", f"Title\n\n{PROSE}"),
    ],
)
def test_pages(page, text):
    assert html_extract.main_text(page) == text


def test_all_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = html_extract.extract(pages).collect()
    html = {r.page_id: r.html for r in pages.collect()}
    assert len(found) == len(html)
    for r in found:
        assert r.n_chars == len(r.text) > 0
        assert "<p>" not in r.text and "track(" not in r.text
        assert r.text.count("\n\n") >= 1 or html[r.page_id].count("<p>") <= 1


def test_nulls_repeats_and_clashing_names(spark):
    rows = [(1, "u", "<p>x", "n"), (1, "u", "<p>x", "n"), (None, None, None, None), (2, None, "x" * 300_000, "n")]
    found = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string, n_chars string"))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert found.count() == 4
    assert html_extract.extract(found.select("page_id", "url", found.text.alias("html")).limit(0)).count() == 0


def article(page):
    """The blocks of the test tables' pages by their one article element, which the operator does not go by."""
    inside = re.search(r"<article>(.*?)</article>", page, re.DOTALL)[1]
    plain = lambda x: " ".join(html_extract.html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<!--.*?-->", "", x.replace("<br>", " "), flags=re.DOTALL))).split())
    return "\n\n".join(filter(None, map(plain, re.split(r"</?(?:p|h1|ul|li|div)>", inside))))


def test_all_pages_by_their_articles(spark, sf_dir):
    pages = [r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    assert [html_extract.main_text(p) for p in pages] == [article(p) for p in pages]


def test_most_blocks_are_decided_by_the_two_passes(spark, sf_dir):
    found = [b for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect() for b in html_extract.classify(html_extract.blocks(r.html))]
    assert sum(b.by in ("block", "neighbour") for b in found) >= 0.9 * len(found)


@pytest.mark.parametrize("page", ["<p " + "\"'" * 5000, "<p " + "\"" * 10_001 + "x", "<p x='" + "<p '" * 2000, "<p>x</p><!-- " + "'" * 10_000])
def test_unclosed_tags_end(page):
    began = time.monotonic()
    html_extract.main_text(page)
    assert time.monotonic() - began < 1


def test_a_class_word_of_the_whole_page_tells_nothing():
    for wrapper in ('body class="has-sidebar"', 'div class="content no-sidebar"', 'div id="share-page"'):
        page = f"<{wrapper}><div class='comments'>{PROSE}</div>" + f"<div>{PROSE}</div>" * 5 + f"</{wrapper.split()[0]}>"
        assert html_extract.main_text(page) == "\n\n".join([PROSE] * 5)


def test_an_advert_larger_than_the_article():
    assert html_extract.main_text(f"<div class='ad'>{PROSE}</div><article><p>Short.</p></article>") == "Short."
