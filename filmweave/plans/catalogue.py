"""Stored pages to catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pages
from ..functions.text import clean_text, split_directors, strip
from ..operators.dedup import first_per_director, new_keys
from ..operators.filters import not_yet_parsed


def pages_to_store(
    fetched: DataFrame, stored: DataFrame, catalogue: DataFrame, ordinal: str = "ordinal"
) -> DataFrame:
    """Fetched pages to append to the store: url in neither store nor catalogue, the first page per url."""
    return not_yet_parsed(new_keys(stored, fetched, "url", ordinal), catalogue).select(*fetched.columns)


def title_rows(stored: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """``(ordinal, url, title, director, cast)`` of the title pages among ``stored``.

    A page without title, or with an empty director text, gives no row. The fields go through an exploded list of
    one, behind which the test on them stays, so that no pattern is searched twice.
    """
    html = F.col("html")
    fields = F.struct(
        F.col(ordinal).alias(ordinal),
        strip(F.col("url")).alias("url"),
        pages.page_title(html).alias("title"),
        pages.page_director(html).alias("director"),
        pages.page_cast(html).alias("cast"),
    )
    rows = stored.filter(pages.is_title_url(F.col("url"))).select(F.explode(F.array(fields)).alias("_row")).select("_row.*")
    rows = rows.filter(F.col("title").isNotNull() & (F.col("director") != ""))
    return rows.withColumn("director", pages.placeholder_director(F.col("director")))


def new_catalogue_rows(stored: DataFrame, catalogue: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """Catalogue rows of pages not parsed before, one per director text."""
    rows = title_rows(not_yet_parsed(stored, catalogue), ordinal)
    return first_per_director(rows, catalogue, ordinal)


def cleaned_catalogue(catalogue: DataFrame) -> DataFrame:
    """Titles and directors cleaned, directors as a list."""
    return catalogue.select(
        "url",
        clean_text(F.col("title")).alias("title"),
        split_directors(clean_text(F.col("director"))).alias("director_list"),
        "cast",
    )
