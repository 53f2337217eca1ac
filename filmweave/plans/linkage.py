"""Dump to linked table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import details, folds, infobox
from ..functions.pages import dump_links
from ..operators.filters import film_pages
from ..operators.linking import enrich, film_keywords, keyword_links, link_catalogue
from ..session import stage


def extract_infobox(films: DataFrame, text: str = "revision.text._VALUE", nested: bool = False) -> DataFrame:
    """``(title_wiki, director_wiki, music, release)`` of film pages.

    With ``nested`` the box is read once, by depth, into a map of its fields, and names and years come from those: inner
    templates, lists and piped links are read for what they are. Otherwise each field is a pattern of its own.
    The box and the directors are generated columns then: a test on them, as linking has one, would otherwise be pushed
    down to the page and would read the box anew for each place where it stands.
    """
    body = F.col(text)
    if nested:
        title, box = infobox.clean_title(F.col("title")).alias("title_wiki"), F.col("_box")
        boxes = films.select(title, F.explode(F.array(folds.infobox_fields(body))).alias("_box"))
        boxes = boxes.select("title_wiki", "_box", F.explode(F.array(folds.names_in(box, "director"))).alias("director_wiki"))
        return boxes.select(
            "title_wiki",
            "director_wiki",
            folds.names_in(box, "music").alias("music"),
            folds.year_in(box, "released").alias("release"),
        )
    return films.select(
        infobox.clean_title(F.col("title")).alias("title_wiki"),
        infobox.infobox_directors(body).alias("director_wiki"),
        infobox.infobox_music(body).alias("music"),
        infobox.infobox_release_year(body).alias("release"),
    )


def linked_table(catalogue: DataFrame, dump: DataFrame, nested: bool = False) -> DataFrame:
    """Catalogue ``(title, director_list, …)`` with its encyclopedia partners in a page dump."""
    return link_catalogue(catalogue, extract_infobox(film_pages(dump), nested=nested))


def detail_records(pages: DataFrame, key: str, html: str = "html", nested: bool = False) -> DataFrame:
    """Detail record of each encyclopedia page in HTML; with ``nested``, rows, lists and cells are read by depth."""
    page = F.col(html)
    if nested:
        found = pages.select(key, folds.detail_fields(page).alias("_found"))
        return found.select(
            key,
            F.col("_found.release").alias("release_date"),
            F.coalesce("_found.writers", F.array().cast("array<string>")).alias("writers"),
            F.get("_found.composers", F.lit(0)).alias("composer"),
            F.col("_found.directors").alias("directors"),
        )
    return pages.select(
        key,
        details.detail_release(page).alias("release_date"),
        details.detail_writers(page).alias("writers"),
        details.detail_composer(page).alias("composer"),
        details.detail_directors(page).alias("directors"),
    )


def enrich_from_links(
    catalogue: DataFrame, lines: DataFrame, pages: DataFrame, text: str = "text", url: str = "url", nested: bool = False
) -> DataFrame:
    """Catalogue enriched from the stored pages behind the dump links that name a film's director.

    The dump's links are mined once for all films. Only links with a stored page count; the fixed keyword
    is left out, since it would lead every film to the same links. All links of a film count: each field
    comes from the first page, in link order, that has it. Pages are brought down to one row per keyword
    before films are joined, so films and links are never paired.
    """
    links = lines.select(F.explode(dump_links(F.col(text))).alias("link"))
    stored = links.join(pages.select(F.col(url).alias("link")), "link", "left_semi")
    words = film_keywords(catalogue, always=None)
    pairs = stage(keyword_links(words.select("keyword"), stored).distinct(), "keyword-links")  # two readers
    named = pages.join(pairs.select(F.col("link").alias(url)).distinct(), url, "left_semi")
    records = detail_records(named, url, nested=nested).withColumnRenamed(url, "link")
    fields = [c for c in records.columns if c != "link"]

    def first(name: str, found: Column) -> Column:
        return F.min(F.when(found.isNotNull(), F.struct(F.col("link"), F.col(name)))).alias(name)

    by_keyword = pairs.join(records, "link").groupBy("keyword").agg(*[first(c, F.col(c)) for c in fields])
    film = ["title", "director_list"]
    by_film = words.join(by_keyword, "keyword").groupBy(*film).agg(*[F.min(c).alias(c) for c in fields])
    return enrich(catalogue, by_film.select(*film, *[F.col(c)[c].alias(c) for c in fields]), film)
