"""Listings over several HTML pages: tables whose header is checked, and links to their next pages followed by joins.

SQL expressions only. A page is its url and HTML. Tables must not contain tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import kept

#: The class of a listing's table, rows a page, and pages a listing is followed for.
TABLE_CLASS, ROWS, PAGES = "tableFile2", 100, 10
_ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def text_of(html: Column) -> Column:
    """A cell's text, or where it has a line break the text before the first one; trimmed, references decoded."""
    text = F.regexp_replace(F.split_part(F.regexp_replace(html, r"(?i)<br\b[^>]*>", "\u0000"), F.lit("\u0000"), F.lit(1)), r"<[^>]*>", "")
    for name, char in _ENTITIES.items():
        text = F.replace(text, F.lit(name), F.lit(char))
    return F.regexp_replace(text, "^[\\s ]+|[\\s ]+$", "")


def _all(html: Column, tag: str) -> Column:
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)(?=</{tag}\s*>|<{tag}\b|$)"), F.lit(1))


def read_tables(pages: DataFrame, columns: Sequence[str], table_class: str = TABLE_CLASS, rows_a_page: int = ROWS) -> DataFrame:
    """url, cells (rows of the wanted columns' HTML, in their order) and next_url of each page that has a table of that class
    with all wanted columns in its header; other pages are left out.

    The first row is the header. A row that is too short has null cells. The next page is what the button named
    "Next <rows>" goes to. Of several rows with one url, the one with the least HTML stands; null urls or HTML have no table.
    """
    one = pages.where("url is not null").groupBy("url").agg(F.min("html").alias("html"))
    table = F.regexp_extract("html", rf'(?is)<table\b[^>]*class="(?:[^"]*\s)?{table_class}(?:\s[^"]*)?"[^>]*>(.*?)</table\s*>', 1)
    button = F.regexp_extract("html", rf'(?is)<input\b([^>]*value="Next {rows_a_page}"[^>]*)>', 1)
    target = F.regexp_extract(button, r"""(?is)parent\.location='([^']*)'""", 1)
    rows = one.select("url", _all(table, "tr").alias("rows"), F.nullif(target, F.lit("")).alias("next_url"))
    head = F.transform(_all(F.element_at("rows", 1), "th"), text_of)
    rows = rows.where(F.size("rows") > 0).withColumn("head", head).where(F.forall(F.array(*map(F.lit, columns)), lambda c: F.array_contains("head", c)))
    places = F.transform(F.array(*map(F.lit, columns)), lambda c: F.array_position("head", c).cast("int"))
    body = F.transform(F.slice("rows", 2, F.size("rows")), lambda r: _all(r, "td"))
    cells = F.transform(body, lambda r: F.transform("places", lambda p: F.get(r, p - 1)))
    return rows.withColumn("places", places).select("url", cells.alias("cells"), "next_url")


def followed(starts: DataFrame, links: DataFrame, pages: int | None = PAGES) -> DataFrame:
    """listing, url, page: the pages of each listing, from its first (listing, url), page 0, along (url, next_url).

    Links are followed by doubling: each round joins what is known with jumps of 1, 2, 4, ... pages and joins the jumps with
    themselves, so a listing of n pages takes log2(n) rounds. A url that a listing has met stays at its first page, so
    circles end. ``pages``: the most pages a listing has, or as many as there are. A url without a row in ``links`` is no page.
    """
    links = kept(links.select("url", "next_url"), "links")
    known = kept(starts.select("listing", "url").distinct().join(links.select("url"), "url", "left_semi").select("listing", "url", F.lit(0).cast("long").alias("page")), "pages")
    jumps = kept(links.where("next_url is not null").join(links.select(F.col("url").alias("next_url")), "next_url", "left_semi").select("url", "next_url"), "jumps")
    step, n = 1, known.count()
    while pages is None or step < pages:
        more = known.join(jumps, "url").select("listing", F.col("next_url").alias("url"), (F.col("page") + step).alias("page"))
        both = known.unionByName(more).groupBy("listing", "url").agg(F.min("page").alias("page"))
        known = kept(both if pages is None else both.where(F.col("page") < pages), "pages")
        found = known.count()
        if found == n:
            break
        n, step = found, step * 2
        jumps = kept(jumps.join(jumps.toDF("next_url", "far"), "next_url").select("url", F.col("far").alias("next_url")), "jumps")
    return known


def listed(pages: DataFrame, starts: DataFrame, columns: Sequence[str], limit: int | None = PAGES, **options) -> DataFrame:
    """listing, page, row, cells, texts: all rows of each listing, its pages in order; cells as HTML, and their texts."""
    read = kept(read_tables(pages, columns, **options), "tables")
    found = followed(starts, read.select("url", "next_url"), limit).join(read, "url")
    rows = found.select("listing", "page", F.posexplode("cells").alias("row", "cells"))
    return rows.withColumn("texts", F.transform("cells", text_of))
