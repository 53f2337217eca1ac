"""Cleaning and splitting of short texts, and predicates on lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def first_item(c: Column) -> Column:
    """First item of a list; NULL for an empty list, in ANSI mode too."""
    return F.get(c, F.lit(0))


def bind(c: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``c`` once and hand it to an expression that needs it several times."""
    return first_item(F.transform(F.array(c), use))


def strip(c: Column) -> Column:
    """Trim Unicode whitespace, not only blanks, from both ends."""
    return F.btrim(c, F.lit(fixed.WS_CHARS))


def collapse_ws(c: Column) -> Column:
    return strip(F.regexp_replace(c, f"[{fixed.WS}]+", " "))


def clean_text(c: Column) -> Column:
    """Undo the two character references that titles and names carry, collapse whitespace, trim."""
    c = F.replace(c, F.lit("&#x27;"), F.lit("'"))
    c = F.replace(c, F.lit("&quot;"), F.lit('"'))
    return collapse_ws(c)


def split_trimmed(c: Column, separator: str) -> Column:
    """Split on a one-character separator, the parts trimmed: separators take the whitespace around them.

    A pattern to split on is compiled for every row, one to replace once; a plain separator needs none.
    """
    return F.split(F.regexp_replace(strip(c), f"[{fixed.WS}]*{separator}[{fixed.WS}]*", separator), separator)


def split_directors(c: Column) -> Column:
    return split_trimmed(c, ",")


def parse_list_text(c: Column) -> Column:
    """Read the text form of a list, ``['A', 'B']``, back to an array; NULL gives an empty array."""
    parts = F.split(F.btrim(c, F.lit("[]")), ",")
    items = F.transform(parts, lambda e: F.btrim(e, F.lit(" '")))
    return F.coalesce(items, F.array().cast("array<string>"))


def list_text(c: Column) -> Column:
    """Text form of a list, the inverse of :func:`parse_list_text`; the CSV form of an array column."""
    return F.when(F.size(c) == 0, F.lit("[]")).otherwise(
        F.concat(F.lit("['"), F.array_join(c, "', '"), F.lit("']"))
    )


def strip_blank_lines(c: Column) -> Column:
    """Drop blank lines and trim the right end of the others."""
    lines = F.transform(F.split(c, fixed.LINE_BREAK), lambda e: F.rtrim(e, F.lit(fixed.WS_CHARS)))
    return F.array_join(F.filter(lines, lambda e: e != ""), "\n")


def lists_overlap(a: Column, b: Column) -> Column:
    """True when the lists share an item; an empty or missing list shares none."""
    return F.coalesce(F.arrays_overlap(a, b), F.lit(False))


def overlap_or_unknown(a: Column, b: Column) -> Column:
    """:func:`lists_overlap`, or the first list says the directors are unknown."""
    return F.coalesce(F.array_contains(a, fixed.UNKNOWN), F.lit(False)) | lists_overlap(a, b)


def first_match(c: Column, pattern: str, group: int = 1) -> Column:
    """Group of the first match, NULL without a match.

    ``regexp_extract`` gives '' both for no match and for an empty group. Here the long text is searched
    once for the whole match (which is never empty), and the group is taken from that short piece.
    """
    return bind(F.regexp_extract(c, pattern, 0), lambda m: F.when(m != "", F.regexp_extract(m, pattern, group)))


def all_matches(c: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), group)
