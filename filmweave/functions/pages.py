"""Fields, links and text of stored HTML pages, and tests on urls."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed
from .text import all_matches, bind, first_match, strip


def literal_pattern(text: str) -> str:
    """Escape a literal for both Java and RE2."""
    return re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", text)


def is_title_url(
    url: Column,
    prefix: str = fixed.TITLE_PREFIX,
    restricted: Iterable[str] = fixed.RESTRICTED_WORDS,
) -> Column:
    """Plain containment tests, so that all of them can be pushed to the scan."""
    return reduce(lambda c, word: c & ~url.contains(word), restricted, url.startswith(prefix))


def has_prefix(url: Column, prefixes: Iterable[str] = fixed.SKIPPED_PREFIXES) -> Column:
    return reduce(lambda c, prefix: c | url.startswith(prefix), prefixes, F.lit(False))


def url_scheme_default(link: Column) -> Column:
    has_scheme = link.startswith("http://") | link.startswith("https://")
    return F.when(has_scheme, link).otherwise(F.concat(F.lit("https:"), link))


def page_title(html: Column, suffix: str = fixed.TITLE_SUFFIX) -> Column:
    """Title element up to a bracket, when the element ends in ``suffix``; NULL otherwise."""
    end = suffix + "</title"
    pattern = rf"<title>([^\n]*?)\([^\n]*?{literal_pattern(end)}"
    return F.when(html.contains(end), strip(first_match(html, pattern)))


def page_director(html: Column) -> Column:
    """Creators of a series or directors of a film, as one text."""
    found = F.when(html.contains(fixed.SERIES_MARK), first_match(html, fixed.CREATED)).otherwise(
        first_match(html, fixed.DIRECTED)
    )
    return F.coalesce(found, F.lit(fixed.UNKNOWN))


def placeholder_director(director: Column) -> Column:
    return F.when(director.contains(fixed.PLACEHOLDER_DIRECTOR), F.lit(fixed.UNKNOWN)).otherwise(director)


def page_cast(html: Column, drop_last: bool = True) -> Column:
    """Names listed on the cast line. The last one is dropped unless ``drop_last`` is off."""
    names = all_matches(F.regexp_extract(html, fixed.CAST_TAIL, 1), fixed.CAST_NAME, 1)
    if not drop_last:
        return names
    return bind(names, lambda n: F.slice(n, F.lit(1), F.greatest(F.size(n) - 1, F.lit(0))))


def absolute_pattern(host: str = fixed.SITE_HOST) -> str:
    return fixed.ABSOLUTE_LINK.replace("HOST", literal_pattern(host))


def absolute_links(html: Column, host: str = fixed.SITE_HOST) -> Column:
    return all_matches(html, absolute_pattern(host), 1)


def relative_links(
    html: Column,
    site: str = fixed.SITE,
    patterns: Iterable[str] = (fixed.TITLE_PATH, fixed.NAME_PATH),
) -> Column:
    """Site paths made absolute, one pattern after the other, each link once."""
    found = F.concat(*[all_matches(html, p) for p in patterns])
    return F.array_distinct(F.transform(found, lambda path: F.concat(F.lit(site), path)))


def page_text(html: Column) -> Column:
    """Visible text. Tags go by pattern, not by a parse tree; numeric character references stay."""
    text = F.regexp_replace(html, fixed.INVISIBLE, "")
    for entity, char in fixed.ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def dump_links(text: Column) -> Column:
    return all_matches(text, fixed.DUMP_LINK)


def heading(html: Column) -> Column:
    """First ``<h1>`` as trimmed lower-case text; NULL without one."""
    return F.lower(strip(page_text(first_match(html, fixed.HEADING))))
