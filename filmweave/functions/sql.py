"""The functions for SQL users, as temporary SQL functions: scalar ones and ones that give a table.

Spark inlines them into the plan, so a query that calls them has the plan of the Column form.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import fixed


def _text(value: str) -> str:
    """SQL literal of any text, every character escaped."""
    return "'" + "".join(f"\\u{ord(c):04x}" for c in value) + "'"


def _pattern(value: str) -> str:
    return f"r'{value}'"


_WS = _text(fixed.WS_CHARS)
_ABSENT = f"array('{fixed.ABSENT}')"


def _strip(e: str) -> str:
    return f"trim(BOTH {_WS} FROM {e})"


def _first(pattern: str) -> str:
    return f"regexp_extract(regexp_substr(wikitext, {_pattern(pattern)}), {_pattern(pattern)}, 1)"


def _split(e: str, separator: str) -> str:
    around = _pattern(f"[{fixed.WS}]*{separator}[{fixed.WS}]*")
    return f"split({_strip(e)}, {around})"


_BLANKS = _pattern(f"[{fixed.WS}]+")
_DIRECTOR_LINE = f"replace(replace(replace({_first(fixed.BOX_DIRECTOR)}, '<br>', '; '), ']]', ''), '[[', '')"
_DIRECTOR_TEXT = f"substring_index(regexp_replace({_strip(_DIRECTOR_LINE)}, {_pattern(fixed.BRACKETED)}, ''), '|', 1)"
_MUSIC_BODY = f"trim(TRAILING {_WS} FROM {_first(fixed.BOX_MUSIC_LIST)})"
_MUSIC_LINE = f"replace(replace(replace(replace({_MUSIC_BODY}, '*', ''), '[[', ''), ']]', ''), '\\n', ', ')"
_MUSIC_TEXT = _strip(f"trim(LEADING ',' FROM {_strip(f'regexp_replace({_strip(_MUSIC_LINE)}, {_BLANKS}, {_text(chr(32))})')})")

# name -> (parameters, result type, body)
FUNCTIONS = {
    "clean_title": (
        "title STRING", "STRING", _strip(f"regexp_replace(title, {_pattern(fixed.BRACKETED)}, '')"),
    ),
    "infobox_directors": (
        "wikitext STRING", "ARRAY<STRING>", f"coalesce({_split(_strip(_DIRECTOR_TEXT), ';')}, {_ABSENT})",
    ),
    "infobox_music": (
        "wikitext STRING",
        "ARRAY<STRING>",
        f"coalesce(get(transform(array({_MUSIC_TEXT}), b -> if(b IS NULL, NULL, array_repeat(b, size(split(b, ';'))))), 0),"
        f" get(transform(array({_first(fixed.BOX_MUSIC_LINK)}), b -> if(b IS NULL, NULL, array(b))), 0), {_ABSENT})",
    ),
    "infobox_release_year": (
        "wikitext STRING",
        "STRING",
        f"coalesce({_first(fixed.BOX_YEAR_DATED)}, {_first(fixed.BOX_YEAR_PLAIN)}, {_first(fixed.BOX_YEAR_SHORT)},"
        f" '{fixed.ABSENT}')",
    ),
    "clean_text": (
        "dirty STRING",
        "STRING",
        _strip(f"regexp_replace(replace(replace(dirty, '&#x27;', {_text(chr(39))}), '&quot;', '\"'), {_BLANKS}, ' ')"),
    ),
    "split_directors": ("directors STRING", "ARRAY<STRING>", _split("directors", ",")),
    "parse_list_text": (
        "list_text STRING",
        "ARRAY<STRING>",
        f"coalesce(transform(split(trim(BOTH '[]' FROM list_text), ','), e -> trim(BOTH {_text(' ' + chr(39))} FROM e)),"
        " CAST(array() AS ARRAY<STRING>))",
    ),
    "lists_overlap": ("a ARRAY<STRING>, b ARRAY<STRING>", "BOOLEAN", "coalesce(arrays_overlap(a, b), false)"),
    "overlap_or_unknown": (
        "a ARRAY<STRING>, b ARRAY<STRING>",
        "BOOLEAN",
        f"coalesce(array_contains(a, '{fixed.UNKNOWN}'), false) OR coalesce(arrays_overlap(a, b), false)",
    ),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Create the functions in the session; gives their names."""
    for name, (parameters, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return list(FUNCTIONS)


_STOPS = "array(" + ", ".join(_text(w) for w in fixed.STOP_WORDS) + ")"
_TERMS = (
    f"array_distinct(filter(regexp_extract_all(lower(query), {_pattern(fixed.TOKEN)}, 0),"
    f" w -> length(w) >= {fixed.MIN_TOKEN} AND NOT array_contains({_STOPS}, w)))"
)

# name -> (parameters, columns, body); {postings} is the name of a table or view of postings, {doc} the type of its documents.
TABLE_FUNCTIONS = {
    "dump_links": ("body STRING", "link STRING", f"SELECT explode(regexp_extract_all(body, {_pattern(fixed.DUMP_LINK)}, 0))"),
    "query_terms": ("query STRING", "term STRING", f"SELECT explode({_TERMS})"),
    "prefix_counts": (
        "prefix STRING, fields ARRAY<STRING>",
        "docs BIGINT",
        # A document is one row first, so that a prefix of most documents is counted in parallel.
        "SELECT count(1) FROM (SELECT doc FROM {postings} WHERE startswith(term, lower(prefix)) AND array_contains(fields, field) GROUP BY doc)",
    ),
    "search": (
        "query STRING, fields ARRAY<STRING>, n_docs BIGINT",
        "doc {doc}, score DOUBLE",
        f"""WITH hits AS (SELECT doc, field, term, tf FROM {{postings}} WHERE array_contains({_TERMS}, term) AND array_contains(fields, field)),
          weights AS (SELECT field, term, ln(n_docs / (count(1) + 1)) + 1 AS idf FROM hits GROUP BY field, term)
        SELECT doc, sum(tf * idf) FROM hits JOIN weights USING (field, term) GROUP BY doc HAVING count(DISTINCT term) = size({_TERMS})""",
    ),
}


def register_table_functions(spark: SparkSession, postings: str = "postings") -> list[str]:
    """Create the table functions in the session; gives their names.

    ``postings`` names a table or view as :func:`.operators.search.postings` makes it. Spark inlines the bodies, so a test on
    terms or fields with constants is part of the scan's filters::

        SELECT page.id, link FROM page, LATERAL dump_links(page.text)
        SELECT * FROM search('star trek', array('title'), 1000) ORDER BY score DESC LIMIT 10
    """
    doc = spark.table(postings).schema["doc"].dataType.simpleString()
    for name, (parameters, columns, body) in TABLE_FUNCTIONS.items():
        body = body.replace("{postings}", postings)
        columns = columns.replace("{doc}", doc)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE({columns}) RETURN {body}")
    return list(TABLE_FUNCTIONS)
