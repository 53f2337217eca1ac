"""Pieces of SQL text for the checking engine."""

from __future__ import annotations

from filmweave.functions import fixed

WS = "'" + fixed.WS_CHARS + "'"


def strip(e: str) -> str:
    return f"trim({e}, {WS})"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def group(e: str, pattern: str, n: int = 1) -> str:
    """Group of the first match, NULL without a match."""
    return f"CASE WHEN regexp_matches({e}, {lit(pattern)}) THEN regexp_extract({e}, {lit(pattern)}, {n}) END"


def every(e: str, pattern: str, n: int = 0) -> str:
    return f"regexp_extract_all({e}, {lit(pattern)}, {n})"


def sub(e: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({e}, {lit(pattern)}, {lit(by)}, 'g')"


def swap(e: str, *pairs: tuple[str, str]) -> str:
    for old, new in pairs:
        e = f"replace({e}, {lit(old)}, {lit(new)})"
    return e


def split_trimmed(e: str, sep: str) -> str:
    return f"list_transform(string_split({e}, {lit(sep)}), lambda x: {strip('x')})"


def in_order(e: str) -> str:
    """Distinct items of a list, first places kept."""
    return f"list_filter({e}, lambda x, i: list_position({e}, x) = i)"


def joined(e: str) -> str:
    return f"array_to_string({e}, '|')"


def text_of(e: str) -> str:
    return swap(sub(e, fixed.INVISIBLE), *fixed.ENTITIES)
