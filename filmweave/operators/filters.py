"""Row filters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, infobox, pages


def film_pages(dump: DataFrame, text: str = "revision.text._VALUE") -> DataFrame:
    """Pages that hold a film infobox."""
    return dump.filter(infobox.is_film(F.col(text)))


def not_yet_parsed(pages_df: DataFrame, catalogue: DataFrame, key: str = "url") -> DataFrame:
    """Pages whose url the catalogue does not have. AQE splits a hot url on the page side."""
    return pages_df.join(catalogue.select(key).distinct(), key, "left_anti")


def exclude_prefix(
    df: DataFrame, column: str = "url", prefixes: Iterable[str] = fixed.SKIPPED_PREFIXES
) -> DataFrame:
    return df.filter(~pages.has_prefix(F.col(column), prefixes))


def heading_spellings(keyword: Column) -> Column:
    """The three headings a keyword matches."""
    plain = pages.strip(keyword)
    return F.array(
        F.lower(plain),
        F.lower(pages.strip(F.concat(keyword, F.lit(" (TV series)")))),
        F.lower(pages.strip(F.concat(keyword, F.lit(" (film)")))),
    )


def match_heading(pages_df: DataFrame, keyword: str, html: str = "html") -> DataFrame:
    """Pages headed by the keyword, or by the keyword marked as film or series."""
    wanted = heading_spellings(F.lit(keyword))
    return pages_df.filter(F.array_contains(wanted, pages.heading(F.col(html))))


def match_headings(
    pages_df: DataFrame, keywords: DataFrame, keyword: str = "keyword", html: str = "html"
) -> DataFrame:
    """:func:`match_heading` for a keyword table, as a semi join on the exploded spellings.

    The keyword side holds each spelling once, so a hot heading only weighs on the page side, which AQE
    can split. Spark broadcasts the keywords when they prove small and shuffles them when not.
    """
    spellings = keywords.select(F.explode(heading_spellings(F.col(keyword))).alias("_heading")).distinct()
    headed = pages_df.withColumn("_heading", pages.heading(F.col(html)))
    return headed.join(spellings, "_heading", "left_semi").drop("_heading")
