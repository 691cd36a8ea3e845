"""What a crawl of filings decides on tables: which are new, which files to fetch, how far it has come."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rows import new_rows

#: Forms and exhibits of interest.
FORMS, EXHIBITS = ("10-D", "10-D/A", "ABS-EE", "ABS-EE/A"), ("EX-102",)
KEYS = ("filing_date", "trust")


def wanted(filings: DataFrame, since: str, name_prefix: str = "", forms: Sequence[str] = FORMS) -> DataFrame:
    """Filings of the forms, from a date on, of trusts whose name starts with a prefix."""
    return filings.where(F.col("form").isin(*forms) & (F.col("filing_date") >= F.lit(since).cast("date")) & F.col("trust").startswith(name_prefix))


def not_seen(filings: DataFrame, watermark: DataFrame) -> DataFrame:
    return new_rows(filings, watermark, KEYS)


def manifest(filings: DataFrame, exhibits: DataFrame, watermark: DataFrame, since: str, **options) -> DataFrame:
    """One row per file to fetch: trust, exhibit, filing date, url."""
    new = not_seen(wanted(filings, since, **options), watermark)
    files = exhibits.where(F.col("exhibit").isin(*EXHIBITS))
    return new.join(files, "filing_id").select("trust", "exhibit", "filing_date", "url").dropDuplicates(["url"])


def advanced(watermark: DataFrame, done: DataFrame) -> DataFrame:
    """The watermark with what has been fetched, each key once."""
    return watermark.select(*KEYS).unionByName(done.select(*KEYS)).distinct()
