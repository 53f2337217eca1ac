"""Fields of an encyclopedia page in HTML. Rows of the info table are cut out by pattern."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .pages import literal_pattern, page_text
from .text import all_matches, bind, first_item, first_match


def header_cell(headers: Iterable[str]) -> str:
    """Pattern of a ``<th>`` that holds exactly one of the headers."""
    names = "|".join(literal_pattern(h) for h in headers)
    return rf"(?i:<th\b[^>]*>)(?:<[^>]*>)*+(?:{names})(?:</(?!(?i:th)\b)[^>]*>)*+(?i:</th>)"


def header_row(html: Column, headers: Iterable[str]) -> Column:
    """From the first ``<th>`` holding exactly one of the headers to the end of its row; NULL without one."""
    pattern = header_cell(headers) + r"[\s\S]*?(?i:</tr>|\z)"
    return F.regexp_substr(html, F.lit(pattern))


def detail_release(html: Column) -> Column:
    return page_text(first_match(header_row(html, fixed.RELEASE_HEADERS), fixed.LIST_ITEM))


def detail_writers(html: Column) -> Column:
    """Set of writers: list items of the row, or its cells when it has no list."""

    def names(row: Column) -> Column:
        items = all_matches(row, fixed.LIST_ITEM, 1)
        return F.when(F.size(items) > 0, items).otherwise(all_matches(row, fixed.TABLE_CELL, 1))

    texts = F.transform(bind(header_row(html, fixed.WRITER_HEADERS), names), page_text)
    return F.coalesce(F.array_distinct(texts), F.array().cast("array<string>"))


def detail_composer(html: Column) -> Column:
    """Link text after ``Music by``, before a later header starting with P on the same line.

    The text sought stands before the last ``</a>`` that a ``<th…>P`` follows. Each step cuts the line at
    a last occurrence, so the work is linear in the line where one pattern with several wildcards is not.
    """

    def composer(line: Column) -> Column:
        before_p = F.regexp_substr(line, F.lit(r"^[^\n]*>P"))
        before_header = F.regexp_extract(before_p, r"^([^\n]*)<th[^\n]*$", 1)
        before_close = F.regexp_extract(before_header, r"^([^\n]*)</a>", 1)
        linked = before_close.rlike(r"<a[^\n]*>")
        return F.when(linked, F.substring_index(before_close, ">", -1))

    lines = all_matches(html, r"Music by[^\n]*")
    return first_item(F.filter(F.transform(lines, composer), lambda c: c.isNotNull()))


def _linked_names(html: Column, pattern: str) -> Column:
    return all_matches(first_match(html, pattern), fixed.ANCHOR_TEXT, 1)


def _one(html: Column, pattern: str) -> Column:
    """Text of the last link of the cell's line, as a list of one; NULL without it.

    The greedy reading of the markup is kept: a line that ends in a tag lends its next line to the name.
    """

    def name(cell: Column) -> Column:
        either = F.concat(F.regexp_extract(cell, pattern, 1), F.regexp_extract(cell, pattern, 2))
        return F.when(cell.isNotNull(), F.array(either))

    return bind(F.regexp_substr(html, F.lit(pattern)), name)


def detail_directors(html: Column) -> Column:
    """One creator, else the creators' list, else one director, else the directors' list, else NULL."""
    return F.coalesce(
        _one(html, fixed.ONE_CREATOR),
        _linked_names(html, fixed.CREATOR_LIST),
        _one(html, fixed.ONE_DIRECTOR),
        _linked_names(html, fixed.DIRECTOR_LIST),
    )


def quote(c: Column) -> Column:
    """Percent-encode all but letters, digits and ``_ . - ~``."""
    c = F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))
    return F.replace(F.replace(c, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def wiki_links(html: Column, base: Column, keyword: Column) -> Column:
    """The page's own url and every ``/wiki/`` link holding the keyword, each once."""
    site = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)
    wanted = F.replace(keyword, F.lit(" "), F.lit("_"))
    hrefs = F.filter(all_matches(html, fixed.WIKI_HREF, 1), lambda h: h.contains(wanted))
    links = F.transform(hrefs, lambda h: F.concat(site, F.lit("/wiki/"), quote(h)))
    return F.array_distinct(F.concat(F.array(base), links))
