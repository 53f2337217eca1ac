"""Fields of a film infobox in encyclopedia markup."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .text import bind, collapse_ws, first_match, split_trimmed, strip


def _absent_list() -> Column:
    return F.array(F.lit(fixed.ABSENT))


def is_film(text: Column) -> Column:
    """The cheap containment test comes first: it reaches the Parquet scan and spares the regex."""
    return text.contains(fixed.FILM_MARK) & text.rlike(fixed.FILM_BOX)


def clean_title(title: Column) -> Column:
    return strip(F.regexp_replace(title, fixed.BRACKETED, ""))


def _strict_directors(text: Column) -> Column:
    """Every listed or broken-off name, a link by its target; an empty value is an absent one."""
    items = F.split(first_match(text, fixed.BOX_DIRECTOR_STRICT), fixed.BOX_ITEM_BREAK)

    def name(item: Column) -> Column:
        bare = F.regexp_replace(F.regexp_replace(item, fixed.BOX_SHOWN, ""), fixed.BRACKETED, "")
        return strip(F.replace(F.replace(bare, F.lit("[["), F.lit("")), F.lit("]]"), F.lit("")))

    names = F.filter(F.transform(items, name), lambda n: n != "")
    return bind(names, lambda n: F.when(F.size(n) > 0, n))


def infobox_directors(text: Column, strict: bool = False) -> Column:
    """Directors of the first ``director =`` line.

    Kept as found: text after the first pipe is lost, and an empty value takes the following line. The strict form
    reads piped links, plain lists and empty values for what they are.
    """
    if strict:
        return F.coalesce(_strict_directors(text), _absent_list())
    line = first_match(text, fixed.BOX_DIRECTOR)
    line = F.replace(line, F.lit("<br>"), F.lit("; "))
    line = strip(F.replace(F.replace(line, F.lit("]]"), F.lit("")), F.lit("[["), F.lit("")))
    line = F.substring_index(F.regexp_replace(line, fixed.BRACKETED, ""), "|", 1)
    return F.coalesce(split_trimmed(strip(line), ";"), _absent_list())


def infobox_music(text: Column) -> Column:
    """Composers: one joined string per ``;`` segment of a plain list, else the linked text."""
    body = F.rtrim(first_match(text, fixed.BOX_MUSIC_BODY), F.lit(fixed.WS_CHARS))
    for mark in ("*", "[[", "]]"):
        body = F.replace(body, F.lit(mark), F.lit(""))
    body = collapse_ws(strip(F.replace(body, F.lit("\n"), F.lit(", "))))
    body = strip(F.ltrim(body, F.lit(",")))
    # One copy per segment; the segments themselves are not used.
    listed = bind(body, lambda b: F.when(b.isNotNull(), F.array_repeat(b, F.size(F.split(b, ";")))))
    link = first_match(text, fixed.BOX_MUSIC_LINK)
    linked = bind(link, lambda e: F.when(e.isNotNull(), F.array(e)))
    return F.coalesce(listed, linked, _absent_list())


def infobox_release_year(text: Column, strict: bool = False) -> Column:
    """Year of the first of three date layouts that is present; the strict form reads named fields and two-digit days too."""
    if strict:
        found = [first_match(text, p) for p in (fixed.BOX_YEAR_STRICT, fixed.BOX_YEAR_DAY)]
        return F.coalesce(*found, F.lit(fixed.ABSENT))
    return F.coalesce(
        first_match(text, fixed.BOX_YEAR_DATED),
        first_match(text, fixed.BOX_YEAR_PLAIN),
        first_match(text, fixed.BOX_YEAR_SHORT),
        F.lit(fixed.ABSENT),
    )
