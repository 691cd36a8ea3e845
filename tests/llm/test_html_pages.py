"""Main text of pages: articles in several boxes, hostile markup, and the whole test table against brute force."""

import html
import random
import re
import time

import pytest

from cairnbook.llm import html_extract, queries
from cairnbook.llm.shared import prepare


@pytest.fixture(scope="module", autouse=True)
def ready(spark):
    prepare(spark)


def said(n, rng):
    return " ".join(rng.choice(["stone", "river", "willow", "amber", "quiet", "north", "hollow", "lantern"]) + str(rng.randrange(50)) for _ in range(n))


def layouts(rng, i):
    """An article with lead, body and closing section in boxes of their own; an article in one box with its paragraphs."""
    lead, body, more, close, title = said(14, rng), said(80, rng), said(70, rng), said(25, rng), said(4, rng)
    short = said(3, rng)
    first = f'<h1>{title}</h1><div class="lead"><p>{lead}</p></div><div class="body"><p>{body}</p><p>{more}</p></div><section><h2>In the end</h2><p>{close}</p></section>'
    second = f"<h1>{title}</h1><div><p>{short}</p></div><div><div><p>{body}</p></div><div><p>{more}</p></div></div><div><p>{close}</p></div>"
    return (first, [title, lead, body, more, "In the end", close]) if i % 2 else (second, [title, short, body, more, close])


@pytest.mark.parametrize("named", [True, False])
@pytest.mark.parametrize("kind", [0, 1])
def test_an_article_in_several_boxes_is_whole(spark, named, kind):
    rng, rows, want = random.Random(4), [], {}
    for i in range(6):
        article, parts = layouts(rng, kind)
        menu = "".join(f'<li><a href="/{x}">{x}</a></li>' for x in ("home", "news", "about us", "contact"))
        tag, nav, foot = ("article", "nav", "footer") if named else ("div", "div", "div")
        page = f"<html><body><{nav}><ul>{menu}</ul></{nav}><div class='ad'>{said(5, rng)}</div><{tag}>{article}</{tag}><{foot}><p>All rights reserved by the owners of this very site, 2024.</p></{foot}></body></html>"
        rows.append((i, f"http://boxes.example/{i}", page))
        want[i] = parts
    out = html_extract.op7(spark, spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = {r.page_id: r.text.split("\n\n") for r in out.collect()}
    for i, parts in want.items():
        # a heading that all pages have in that place is template
        assert [x for x in got[i] if x != "In the end"] == [x for x in parts if x != "In the end"]


HOSTILE = {
    "unclosed boxes": "<div>x" * 20_000,
    "unended tags": "<a " * 350_000,
    "inline around rules": "<b>" * 30_000 + "<hr>" * 30_000,
    "stray inline ends": "<b>" + "<div>" * 20_000 + "</b>" * 20_000,
    "stray ends": "<div>" * 20_000 + "</p></span>" * 20_000,
    "scripts": "<script " * 100_000,
    "declarations": "<!" * 300_000,
    "quotes": '<a "' * 100_000,
    "deep": "<div>" * 50_000 + "found " * 20,
}


@pytest.mark.parametrize("name", sorted(HOSTILE))
def test_hostile_pages_take_linear_time(name):
    page = HOSTILE[name]
    began = time.process_time()
    text = html_extract.main_text(page)
    assert time.process_time() - began < 8  # a quadratic reader takes minutes
    assert ("found" in text) == (name == "deep")


def test_deep_pages_of_one_host(spark):
    rows = [(i, "http://deep.example/x", "<p>menu of all pages</p>" + "<div>" * 5000 + f"<p>{said(30, random.Random(i))}</p>") for i in range(3)]
    rows += [(9, "http://deep.example/x", "<div>x" * 20_000), (10, "http://deep.example/x", "<a " * 350_000)]
    got = {r.page_id: r.text for r in html_extract.op7(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(said(30, random.Random(i)) in got[i] for i in range(3)) and got[9].count("x") == 20_000 and got[10] == ""


def test_tags_without_end_and_quotes():
    assert html_extract.main_text("<p>one<b two</p><p class=\"a>b\">three") == "one\n\nthree"
    assert html_extract.main_text("<p title='x>y' hidden>gone</p><p>here 1 < 2 and 3 > 2") == "here 1 < 2 and 3 > 2"


def brute_text(page):
    """The blocks of the article, read off its markup: enough for the test pages, whose articles hold nothing beside it."""
    page = re.sub(r"(?s)<!--.*?-->|<(script|style)\b.*?</\1>", "", page or "")
    inside = re.search(r"(?s)<article>(.*?)</article>", page)
    if not inside:
        return ""
    parts = re.split(r"</?(?:p|h[1-6]|div|section|ul|ol|li|table|tr|td|blockquote)\b[^>]*>", re.sub(r"<br\s*/?>", " ", inside[1]))
    plain = (" ".join(html.unescape(re.sub(r"</?[a-z][^>]*>", "", x)).split()) for x in parts)
    return "\n\n".join(x for x in plain if x)


def test_query_against_brute_force(spark, folder):
    pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = queries.QUERIES["op7_html_extract"](spark, folder).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        assert r.text == brute_text(pages[r.page_id].html) and r.url == pages[r.page_id].url and r.n_chars == len(r.text)
