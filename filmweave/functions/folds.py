"""Nested markup read by depth: one pass from left to right over the marks of a text, within the row.

A text is cut into pieces that end in a mark, and the pieces are folded with counters for what is open and the place of the
current segment. Segments are kept as places, not as texts, so a step costs the same however long the text is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .details import header_cell
from .pages import page_text
from .text import all_matches, bind, first_item, first_match, strip

_CUTS = "array<struct<at:int,n:int>>"


def _marks(text: Column, piece: str, mark: str) -> Column:
    """Array of ``(kind, start, n)``: each piece's mark in lower case, and the lengths of the mark and the whole piece."""

    def read(p: Column) -> Column:
        tag = F.regexp_substr(p, F.lit(mark))
        kind = F.lower(F.regexp_extract(p, mark, 1))
        return F.struct(kind.alias("kind"), F.coalesce(F.length(tag), F.lit(0)).alias("mark"), F.length(p).alias("n"))

    return F.transform(all_matches(text, piece), read)


def _fold(text: Column, piece: str, mark: str, start: dict[str, int], step: Callable[..., dict[str, Column]]) -> Column:
    """Segments of ``text`` as an array of texts, NULL for NULL.

    ``step(state, kind, before, after)`` gives the new values of what changes; ``cut`` is true where a segment ends, which
    is the text from ``since`` to ``before``. A negative ``since`` means that no segment is open; one that is open at the end
    of the text ends there.
    """
    first = {"since": -1, **start}
    zero = F.struct(F.lit(0).alias("at"), *[F.lit(v).alias(k) for k, v in first.items()], F.array().cast(_CUTS).alias("cuts"))

    def merge(acc: Column, piece_: Column) -> Column:
        after = acc["at"] + piece_["n"]
        before = after - piece_["mark"]
        new = step({k: acc[k] for k in first}, piece_["kind"], before, after)
        segment = F.struct(acc["since"].alias("at"), (before - acc["since"]).alias("n"))
        cuts = F.when(new["cut"] & (acc["since"] >= 0), F.concat(acc["cuts"], F.array(segment))).otherwise(acc["cuts"])
        return F.struct(after.alias("at"), *[new.get(k, acc[k]).alias(k) for k in first], cuts.alias("cuts"))

    def end(acc: Column) -> Column:
        rest = F.struct(acc["since"].alias("at"), (acc["at"] - acc["since"]).alias("n"))
        return F.when(acc["since"] >= 0, F.concat(acc["cuts"], F.array(rest))).otherwise(acc["cuts"])

    def segments(whole: Column) -> Column:
        cuts = F.aggregate(_marks(whole, piece, mark), zero, merge, end)
        return F.transform(cuts, lambda c: F.substring(whole, c["at"] + 1, c["n"]))

    return bind(text, segments)


# -- templates ------------------------------------------------------------------------------------------


def without_comments(text: Column) -> Column:
    return F.regexp_replace(text, fixed.COMMENT, "")


def template_parts(text: Column) -> Column:
    """Name and arguments of the template that ``text`` starts with, as they stand; an unclosed one ends with the text.

    A pipe separates arguments unless it stands in an inner template or in a link. A link ends with its line. Templates that
    one pattern can read are read by it, which costs a small part of the fold.
    """

    def parts(whole: Column) -> Column:
        plain = F.regexp_substr(whole, F.lit(fixed.PLAIN_TEMPLATE))
        read = bind(plain, lambda p: F.when(p.isNotNull(), all_matches(p, fixed.TEMPLATE_ARGUMENT, 1)))
        return F.coalesce(read, _folded_parts(whole))

    return bind(text, parts)


def _folded_parts(text: Column) -> Column:
    """:func:`template_parts` mark by mark, for any text."""

    def step(now: dict[str, Column], kind: Column, before: Column, after: Column) -> dict[str, Column]:
        first = (now["braces"] == 0) & (kind == "{{") & (now["done"] == 0)
        last = (now["braces"] == 1) & (kind == "}}")
        pipe = (now["braces"] == 1) & (now["links"] == 0) & (kind == "|")
        braces = F.when(now["done"] == 1, 0).when(kind == "{{", now["braces"] + 1).when(kind == "}}", now["braces"] - 1)
        links = F.when(kind == "[[", now["links"] + 1).when(kind == "]]", F.greatest(now["links"] - 1, F.lit(0))).when(kind == "\n", 0)
        return {
            "cut": last | pipe,
            "since": F.when(first | pipe, after).when(last, F.lit(-1)).otherwise(now["since"]),
            "braces": F.coalesce(braces, now["braces"]),
            "links": F.coalesce(links, now["links"]),
            "done": F.when(last, F.lit(1)).otherwise(now["done"]),
        }

    return _fold(text, fixed.TEMPLATE_PIECE, fixed.TEMPLATE_MARK, {"braces": 0, "links": 0, "done": 0}, step)


def outside_templates(text: Column) -> Column:
    """``text`` without its templates, whatever they hold; a stray end stays."""

    def kept(whole: Column) -> Column:
        without = F.regexp_replace(whole, fixed.INNER_TEMPLATE, "")
        plain = F.when(whole.rlike(fixed.PLAIN_OUTSIDE), without).otherwise(_folded_outside(whole))
        return F.when(whole.contains("{{"), plain).otherwise(whole)

    return bind(text, kept)


def _folded_outside(text: Column) -> Column:
    """:func:`outside_templates` mark by mark, for any text."""

    def step(now: dict[str, Column], kind: Column, before: Column, after: Column) -> dict[str, Column]:
        opens, closes = kind == "{{", (kind == "}}") & (now["braces"] > 0)
        begin = opens & (now["braces"] == 0)
        return {
            "cut": begin,
            "since": F.when(begin, F.lit(-1)).when(closes & (now["braces"] == 1), after).otherwise(now["since"]),
            "braces": F.when(opens, now["braces"] + 1).when(closes, now["braces"] - 1).otherwise(now["braces"]),
        }

    # The first segment begins with the text.
    return F.array_join(_fold(text, fixed.TEMPLATE_PIECE, fixed.TEMPLATE_MARK, {"since": 0, "braces": 0}, step), "")


def infobox_fields(text: Column) -> Column:
    """Named fields of the film infobox as ``map<string,string>``: names and values trimmed, of equal names the last.

    Values are whole, with their inner templates and links. NULL without a film infobox.
    """
    box = F.regexp_substr(without_comments(text), F.lit(fixed.FILM_BOX + fixed.REST))

    def entries(parts: Column) -> Column:
        named = F.filter(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: p.contains("="))

        def split(p: Column) -> Column:
            name = F.substring_index(p, "=", 1)
            return F.struct(strip(name).alias("key"), strip(F.substring(p, F.length(name) + 2, F.length(p))).alias("value"))

        return F.filter(F.transform(named, split), lambda e: e["key"] != "")

    def last_ones(e: Column) -> Column:
        keys = F.transform(e, lambda x: x["key"])
        later = lambda x, i: F.array_contains(F.slice(keys, i + 2, F.size(keys)), x["key"])
        return F.map_from_entries(F.filter(e, lambda x, i: ~later(x, i)))

    return bind(template_parts(box), lambda parts: F.when(parts.isNotNull(), bind(entries(parts), last_ones)))


def listed_names(value: Column) -> Column:
    """Items of a field's value: of a list template its arguments or its starred lines, else what line breaks part.

    A link counts by its target; inner templates and brackets go; empty items are left out. NULL for NULL.
    """

    def items(parts: Column) -> Column:
        name = F.lower(F.replace(strip(first_item(parts)), F.lit("_"), F.lit(" ")))
        arguments = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
        # An argument "1=…" is a plain one by number.
        plain = F.transform(arguments, lambda a: F.regexp_replace(a, fixed.NUMBERED_ARGUMENT, ""))
        return F.when((F.size(parts) > 0) & name.isin(*fixed.LIST_TEMPLATES), F.array_join(plain, "\n*"))

    body = F.when(value.startswith("{{"), bind(template_parts(value), items))
    broken = F.split(F.coalesce(body, value), fixed.ITEM_BREAK)

    def name(item: Column) -> Column:
        linked = F.regexp_replace(outside_templates(item), fixed.LINK_TARGET, "$1")
        bare = F.regexp_replace(linked, fixed.BRACKETED, "")
        return strip(F.regexp_replace(bare, r"\[\[|\]\]", ""))

    return F.filter(F.transform(broken, name), lambda n: n != "")


def names_in(fields: Column, field: str) -> Column:
    """Names in a field of :func:`infobox_fields`; ``[not found]`` where there is none."""
    names = listed_names(F.element_at(fields, field))
    return bind(names, lambda n: F.when(F.size(n) > 0, n).otherwise(F.array(F.lit(fixed.ABSENT))))


def year_in(fields: Column, field: str) -> Column:
    """The first number of four digits in a field, in a date template or not; ``not found`` where there is none."""
    return F.coalesce(first_match(F.element_at(fields, field), fixed.YEAR), F.lit(fixed.ABSENT))


def infobox_names(text: Column, field: str) -> Column:
    """:func:`names_in` the film infobox of a page."""
    return bind(infobox_fields(text), lambda fields: names_in(fields, field))


# -- info tables ----------------------------------------------------------------------------------------


def table_row(html: Column, headers: tuple[str, ...]) -> Column:
    """From the first ``<th>`` that holds exactly one of the headers to the end of its own row; NULL without one.

    Tables in its cells are part of the row. A row that isn't closed ends where another begins or its table ends.
    """
    rest = F.regexp_substr(without_comments(html), F.lit(header_cell(headers) + fixed.REST))

    def step(now: dict[str, Column], kind: Column, before: Column, after: Column) -> dict[str, Column]:
        here = now["tables"] == 0
        end = here & kind.isin("/tr", "tr", "/table") & (now["since"] >= 0)
        tables = F.when(kind == "table", now["tables"] + 1).when((kind == "/table") & ~here, now["tables"] - 1)
        return {"cut": end, "since": F.when(end, F.lit(-1)).otherwise(now["since"]), "tables": F.coalesce(tables, now["tables"])}

    return first_item(_fold(rest, fixed.ROW_PIECE, fixed.ROW_MARK, {"since": 0, "tables": 0}, step))


def list_items(row: Column) -> Column:
    """Markup of the items of the outer lists of a row; a list in an item is part of it, and the next item ends an unclosed one."""

    def step(now: dict[str, Column], kind: Column, before: Column, after: Column) -> dict[str, Column]:
        outer = now["lists"] <= 1
        item, end = outer & (kind == "li"), outer & kind.isin("/li", "/ul", "/ol")
        lists = F.when(kind.isin("ul", "ol"), now["lists"] + 1).when(kind.isin("/ul", "/ol"), F.greatest(now["lists"] - 1, F.lit(0)))
        return {
            "cut": item | end,
            "since": F.when(item, after).when(end, F.lit(-1)).otherwise(now["since"]),
            "lists": F.coalesce(lists, now["lists"]),
        }

    return _fold(row, fixed.ITEM_PIECE, fixed.ITEM_MARK, {"lists": 0}, step)


def table_cells(row: Column) -> Column:
    """Markup of the cells of a row, tables in them included."""

    def step(now: dict[str, Column], kind: Column, before: Column, after: Column) -> dict[str, Column]:
        here = now["tables"] == 0
        cell, end = here & (kind == "td"), here & kind.isin("/td", "th", "/th")
        tables = F.when(kind == "table", now["tables"] + 1).when(kind == "/table", F.greatest(now["tables"] - 1, F.lit(0)))
        return {
            "cut": cell | end,
            "since": F.when(cell, after).when(end, F.lit(-1)).otherwise(now["since"]),
            "tables": F.coalesce(tables, now["tables"]),
        }

    return _fold(row, fixed.CELL_PIECE, fixed.CELL_MARK, {"tables": 0}, step)


def row_texts(html: Column, headers: tuple[str, ...]) -> Column:
    """Visible texts of a row's items, or of its cells where it has no list, each once and none empty; NULL without the row."""

    def texts(row: Column) -> Column:
        parts = bind(list_items(row), lambda items: F.when(F.size(items) > 0, items).otherwise(table_cells(row)))
        shown = F.transform(parts, lambda p: strip(F.regexp_replace(page_text(p), f"[{fixed.WS}]+", " ")))
        return F.array_distinct(F.filter(shown, lambda t: t != ""))

    return bind(table_row(html, headers), lambda row: F.when(row.isNotNull(), texts(row)))


def detail_fields(html: Column) -> Column:
    """``struct<release, writers, composers, directors>`` of an encyclopedia page, read by rows; creators go before directors."""
    return F.struct(
        first_item(row_texts(html, fixed.RELEASE_HEADERS)).alias("release"),
        row_texts(html, fixed.WRITER_HEADERS).alias("writers"),
        row_texts(html, fixed.COMPOSER_HEADERS).alias("composers"),
        F.coalesce(row_texts(html, fixed.CREATOR_HEADERS), row_texts(html, fixed.DIRECTOR_HEADERS)).alias("directors"),
    )
