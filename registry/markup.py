"""Infobox markup, list texts and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from filmweave.functions import fixed, infobox, text
from filmweave.functions.sql import register_functions
from filmweave.operators.filters import film_pages
from filmweave.plans.linkage import extract_infobox

from . import inputs
from .checks import Checks
from .sqltext import every, group, joined, lit, split_trimmed, strip, sub, swap

CHECKS = Checks()

# -- the same values in SQL ------------------------------------------------------------------------------
TITLE = strip(sub("title", fixed.BRACKETED))

_line = swap(group("txt", fixed.BOX_DIRECTOR), ("<br>", "; "), ("]]", ""), ("[[", ""))
DIRECTORS = f"coalesce({split_trimmed(strip(f'string_split({sub(strip(_line), fixed.BRACKETED)}, {lit(chr(124))})[1]'), ';')}, ['not found'])"

_body = swap(f"rtrim({group('txt', fixed.BOX_MUSIC_LIST)}, '{fixed.WS_CHARS}')", ("*", ""), ("[[", ""), ("]]", ""), ("\n", ", "))
_body = strip(f"ltrim({strip(sub(strip(_body), f'[{fixed.WS}]+', ' '))}, ',')")
MUSIC = f"""CASE WHEN regexp_matches(txt, {lit(fixed.BOX_MUSIC_LIST)})
  THEN list_transform(string_split({_body}, ';'), lambda x: {_body})
  WHEN regexp_matches(txt, {lit(fixed.BOX_MUSIC_LINK)}) THEN [regexp_extract(txt, {lit(fixed.BOX_MUSIC_LINK)}, 1)]
  ELSE ['not found'] END"""

YEAR = f"""coalesce({group("txt", fixed.BOX_YEAR_DATED)}, {group("txt", fixed.BOX_YEAR_PLAIN)},
  {group("txt", fixed.BOX_YEAR_SHORT)}, 'not found')"""

IS_FILM = f"contains(txt, 'Infobox film') AND regexp_matches(txt, {lit(fixed.FILM_BOX)})"

LISTED = """CASE WHEN txt IS NULL THEN CAST([] AS VARCHAR[])
  ELSE list_transform(string_split(trim(txt, '[]'), ','), lambda x: trim(x, ' ''')) END"""


def _films(spark, sf_dir):
    return film_pages(inputs.wiki_pages(spark, sf_dir), "txt").select("k", "s", "title")


CHECKS.queries["film_pages"] = _films
CHECKS.oracles["film_pages"] = f"WITH t AS ({inputs.WIKI_PAGES}) SELECT k, s, title FROM t WHERE {IS_FILM}"

CHECKS.column("clean_title", inputs.WIKI_PAGES, lambda: infobox.clean_title(F.col("title")), TITLE, "k, s", "title_wiki")
CHECKS.column("infobox_directors", inputs.WIKI_PAGES, lambda: infobox.infobox_directors(F.col("txt")), DIRECTORS, "k, s",
     "director_wiki", True)
CHECKS.column("infobox_music", inputs.WIKI_PAGES, lambda: infobox.infobox_music(F.col("txt")), MUSIC, "k, s", "music", True)
CHECKS.column("infobox_release_year", inputs.WIKI_PAGES, lambda: infobox.infobox_release_year(F.col("txt")), YEAR, "k, s",
     "release")

_items = f"string_split_regex({group('txt', fixed.BOX_DIRECTOR_STRICT)}, {lit(fixed.BOX_ITEM_BREAK)})"
_name = strip(swap(sub(sub("x", fixed.BOX_SHOWN), fixed.BRACKETED), ("[[", ""), ("]]", "")))
_names = f"list_filter(list_transform({_items}, lambda x: {_name}), lambda x: x <> '')"
CHECKS.column("infobox_directors_strict", inputs.WIKI_PAGES, lambda: infobox.infobox_directors(F.col("txt"), strict=True),
     f"CASE WHEN len({_names}) > 0 THEN {_names} ELSE ['not found'] END", "k, s", "director_wiki", True)
CHECKS.column("infobox_release_year_strict", inputs.WIKI_PAGES, lambda: infobox.infobox_release_year(F.col("txt"), strict=True),
     f"coalesce({group('txt', fixed.BOX_YEAR_STRICT)}, {group('txt', fixed.BOX_YEAR_DAY)}, 'not found')", "k, s", "release")


def _infobox(spark, sf_dir):
    rows = extract_infobox(film_pages(inputs.wiki_pages(spark, sf_dir), "txt"), "txt")
    return rows.select(
        "title_wiki",
        F.array_join("director_wiki", "|").alias("director_wiki"),
        F.array_join("music", "|").alias("music"),
        "release",
    )


WIKI_SQL = f"""SELECT {TITLE} AS title_wiki, {DIRECTORS} AS director_wiki, {MUSIC} AS music, {YEAR} AS release
  FROM ({inputs.WIKI_PAGES}) w WHERE {IS_FILM}"""

CHECKS.queries["extract_infobox"] = _infobox
CHECKS.oracles["extract_infobox"] = f"""SELECT title_wiki, {joined("director_wiki")} AS director_wiki, {joined("music")} AS music,
  release FROM ({WIKI_SQL}) x"""

_clean = swap("txt", ("&#x27;", "'"), ("&quot;", '"'))
CHECKS.column("clean_text", inputs.DIRTY_TEXTS, lambda: text.clean_text(F.col("txt")), strip(sub(_clean, f"[{fixed.WS}]+", " ")))
CHECKS.column("split_directors", inputs.CATALOGUE, lambda: text.split_directors(F.col("director")),
     split_trimmed("director", ","), is_list=True)
CHECKS.column("parse_list_text", inputs.LIST_TEXTS, lambda: text.parse_list_text(F.col("txt")), LISTED, is_list=True)

_lines = f"string_split_regex(txt, {lit(fixed.LINE_BREAK)})"
CHECKS.column(
    "strip_blank_lines",
    "SELECT doc_id AS k, concat(text, '  ', chr(10), ' ', chr(9), chr(13), chr(10), ' ', text, chr(160), chr(11), 'x') AS txt"
    " FROM documents",
    lambda: text.strip_blank_lines(F.col("txt")),
    f"array_to_string(list_filter(list_transform({_lines}, lambda x: rtrim(x, '{fixed.WS_CHARS}')), lambda x: x <> ''), chr(10))",
)


def _registered(spark, sf_dir):
    """The same fields through the SQL functions."""
    register_functions(spark)
    return inputs.load(
        spark,
        sf_dir,
        f"""SELECT k, s, clean_title(title) AS title_wiki, array_join(infobox_directors(txt), '|') AS director_wiki,
  array_join(infobox_music(txt), '|') AS music, infobox_release_year(txt) AS release,
  lists_overlap(infobox_directors(txt), infobox_music(txt)) AS overlap FROM ({inputs.WIKI_PAGES}) w""",
    )


CHECKS.add(
    "sql_functions",
    _registered,
    f"""SELECT k, s, title_wiki, {joined("d")} AS director_wiki, {joined("m")} AS music, release, list_has_any(d, m) AS overlap
FROM (SELECT k, s, {TITLE} AS title_wiki, {DIRECTORS} AS d, {MUSIC} AS m, {YEAR} AS release FROM ({inputs.WIKI_PAGES}) w) x""",
)

_CLEAN = strip(sub(_clean, f"[{fixed.WS}]+", " "))


def _registered_texts(spark, sf_dir):
    """The functions over list texts and dirty texts."""
    register_functions(spark)
    return inputs.load(
        spark,
        sf_dir,
        f"""SELECT d.k, clean_text(d.txt) AS cleaned, array_join(split_directors(clean_text(d.txt)), '|') AS parts,
  array_join(parse_list_text(l.txt), '|') AS listed,
  overlap_or_unknown(parse_list_text(l.txt), split_directors(clean_text(d.txt))) AS overlap
  FROM ({inputs.DIRTY_TEXTS}) d JOIN ({inputs.LIST_TEXTS}) l ON d.k = l.k""",
    )


CHECKS.add(
    "sql_functions_texts",
    _registered_texts,
    f"""WITH d AS (SELECT k, {_CLEAN} AS cleaned FROM ({inputs.DIRTY_TEXTS}) a), l AS (SELECT k, {LISTED} AS items FROM ({inputs.LIST_TEXTS}) b),
  p AS (SELECT k, cleaned, {split_trimmed("cleaned", ",")} AS parts FROM d)
SELECT p.k, cleaned, {joined("parts")} AS parts, {joined("items")} AS listed,
  list_contains(items, 'more') OR list_has_any(items, parts) AS overlap FROM p JOIN l ON p.k = l.k""",
)
