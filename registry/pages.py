"""Stored pages: url tests, page fields, links, text, detail records."""

from __future__ import annotations

from pyspark.sql import functions as F

from filmweave.functions import details, fixed, pages
from filmweave.operators import budget, dedup, filters, quality
from filmweave.operators.linking import enrich
from filmweave.plans.catalogue import cleaned_catalogue, new_catalogue_rows, pages_to_store, title_rows
from filmweave.plans.linkage import detail_records, enrich_from_links
from filmweave.session import staging_path
from filmweave.sources.store import page_store

from . import inputs
from .checks import Checks
from .sqltext import every, group, in_order, joined, lit, split_trimmed, strip, sub, swap, text_of

CHECKS = Checks()


# -- url tests -------------------------------------------------------------------------------------------
def _title_url_sql(url: str) -> str:
    words = " AND ".join(f"NOT contains({url}, {lit(w)})" for w in fixed.RESTRICTED_WORDS)
    return f"(starts_with({url}, {lit(fixed.TITLE_PREFIX)}) AND {words})"


CHECKS.column("is_title_url", inputs.TITLE_PAGES, lambda: pages.is_title_url(F.col("url")), _title_url_sql("url"), "ordinal, url")

STORE_WORDS = ("utm_source", "#top")


def _store_urls(spark, sf_dir):
    df = inputs.table(spark, sf_dir, "pages")
    return df.select("page_id", "url").filter(pages.is_title_url(F.col("url"), "https://", STORE_WORDS))


CHECKS.queries["title_urls_parametric"] = _store_urls
CHECKS.oracles["title_urls_parametric"] = """SELECT page_id, url FROM pages
WHERE starts_with(url, 'https://') AND NOT contains(url, 'utm_source') AND NOT contains(url, '#top')"""

KNOWN_URLS = "SELECT url FROM pages WHERE contains(url, 'utm_source')"


def _not_parsed(spark, sf_dir):
    store = inputs.table(spark, sf_dir, "pages")
    return filters.not_yet_parsed(store, inputs.load(spark, sf_dir, KNOWN_URLS)).select("page_id", "url")


CHECKS.queries["not_yet_parsed"] = _not_parsed
CHECKS.oracles["not_yet_parsed"] = f"SELECT page_id, url FROM pages WHERE url NOT IN ({KNOWN_URLS})"

PREFIXES = ("https://blog.", "http://m.")
CHECKS.queries["exclude_prefix"] = lambda spark, sf_dir: filters.exclude_prefix(
    inputs.table(spark, sf_dir, "pages").select("page_id", "url"), "url", PREFIXES
)
CHECKS.oracles["exclude_prefix"] = """SELECT page_id, url FROM pages
WHERE NOT (starts_with(url, 'https://blog.') OR starts_with(url, 'http://m.'))"""

BARE_URLS = "SELECT page_id AS k, replace(url, 'http://', '//') AS txt FROM pages"
CHECKS.column("url_scheme_default", BARE_URLS, lambda: pages.url_scheme_default(F.col("txt")),
        "CASE WHEN regexp_matches(txt, '^https?://') THEN txt ELSE concat('https:', txt) END")

# -- fields of title pages -------------------------------------------------------------------------------
PAGE_TITLE = strip(group("html", r"<title>([^\n]*?)\([^\n]*? - IMDb</title"))
PAGE_DIRECTOR = f"""coalesce(CASE WHEN contains(html, '(TV Series ') THEN {group("html", fixed.CREATED)}
  ELSE {group("html", fixed.DIRECTED)} END, 'more')"""
KNOWN_DIRECTOR = f"CASE WHEN contains({PAGE_DIRECTOR}, '{fixed.PLACEHOLDER_DIRECTOR}') THEN 'more' ELSE {PAGE_DIRECTOR} END"
_names = every(f"regexp_extract(html, {lit(fixed.CAST_TAIL)}, 1)", fixed.CAST_NAME, 1)
CAST = f"list_slice({_names}, 1, greatest(len({_names}) - 1, 0))"

CHECKS.column("page_title", inputs.TITLE_PAGES, lambda: pages.page_title(F.col("html")), PAGE_TITLE, "ordinal", "title")
CHECKS.column("page_director", inputs.TITLE_PAGES, lambda: pages.page_director(F.col("html")), PAGE_DIRECTOR, "ordinal",
        "director")
CHECKS.column("placeholder_director", inputs.TITLE_PAGES,
        lambda: pages.placeholder_director(pages.page_director(F.col("html"))), KNOWN_DIRECTOR, "ordinal", "director")
CHECKS.column("page_cast", inputs.TITLE_PAGES, lambda: pages.page_cast(F.col("html")), CAST, "ordinal", "names", is_list=True)
CHECKS.column("page_cast_whole", inputs.TITLE_PAGES, lambda: pages.page_cast(F.col("html"), drop_last=False), _names,
        "ordinal", "names", is_list=True)

TITLE_ROWS_SQL = f"""SELECT * FROM (SELECT ordinal, {strip("url")} AS url, {PAGE_TITLE} AS title,
    {KNOWN_DIRECTOR} AS director, {CAST} AS names
  FROM ({inputs.TITLE_PAGES}) t WHERE {_title_url_sql("url")}) r WHERE title IS NOT NULL AND director <> ''"""
EXISTING = f"SELECT ordinal, url, director FROM ({TITLE_ROWS_SQL}) e WHERE contains(title, '/en/')"


def _existing(spark, sf_dir):
    rows = title_rows(inputs.load(spark, sf_dir, inputs.TITLE_PAGES))
    return rows.filter(F.col("title").contains("/en/")).select("url", "director")


def _first_per_director(spark, sf_dir):
    rows = title_rows(inputs.load(spark, sf_dir, inputs.TITLE_PAGES))
    kept = dedup.first_per_director(rows, _existing(spark, sf_dir))
    return kept.select("ordinal", "url", "title", "director")


FIRST_SQL = f"""WITH r AS ({TITLE_ROWS_SQL}), e AS ({EXISTING}),
  fresh AS (SELECT * FROM r WHERE url NOT IN (SELECT url FROM e) AND director NOT IN (SELECT director FROM e))
  SELECT * FROM fresh QUALIFY row_number() OVER (PARTITION BY director ORDER BY ordinal) = 1"""
CHECKS.queries["first_per_director"] = _first_per_director
CHECKS.oracles["first_per_director"] = f"SELECT ordinal, url, title, director FROM ({FIRST_SQL}) f"


def _catalogue(spark, sf_dir):
    stored = inputs.load(spark, sf_dir, inputs.TITLE_PAGES)
    rows = new_catalogue_rows(stored, _existing(spark, sf_dir))
    return cleaned_catalogue(rows).select(
        "url", "title", F.array_join("director_list", "|").alias("director_list"), F.array_join("cast", "|").alias("names")
    )


def _clean_sql(e: str) -> str:
    return strip(sub(swap(e, ("&#x27;", "'"), ("&quot;", '"')), f"[{fixed.WS}]+", " "))


CHECKS.queries["catalogue_from_pages"] = _catalogue
CHECKS.oracles["catalogue_from_pages"] = f"""SELECT url, {_clean_sql("title")} AS title,
  {joined(split_trimmed(_clean_sql("director"), ","))} AS director_list, {joined("names")} AS names FROM ({FIRST_SQL}) f"""

# -- links and text --------------------------------------------------------------------------------------
ABSOLUTE = every("html", pages.absolute_pattern(), 1)
_paths = f"list_concat({every('html', fixed.TITLE_PATH)}, {every('html', fixed.NAME_PATH)})"
RELATIVE = f"list_transform({in_order(_paths)}, lambda x: concat('{fixed.SITE}', x))"
CHECKS.column("absolute_links", inputs.SITE_PAGES, lambda: pages.absolute_links(F.col("html")), ABSOLUTE, is_list=True)
CHECKS.column("relative_links", inputs.SITE_PAGES, lambda: pages.relative_links(F.col("html")), RELATIVE, is_list=True)


def edges_sql(stored: str) -> str:
    return f"""WITH t AS ({stored}),
  e AS (SELECT url AS src_url, unnest(list_concat({ABSOLUTE}, {RELATIVE})) AS dst_url FROM t)
SELECT DISTINCT src_url, dst_url FROM e WHERE NOT starts_with(dst_url, 'https://apps.apple.com')"""


EDGES_SQL = edges_sql(inputs.SITE_PAGES)
CHECKS.column("page_text", "SELECT page_id AS k, html FROM pages", lambda: pages.page_text(F.col("html")), text_of("html"))


def _dump_links(spark, sf_dir):
    df = inputs.load(spark, sf_dir, inputs.DUMP_TEXTS)
    return df.select("k", F.explode(pages.dump_links(F.col("txt"))).alias("link"))


CHECKS.queries["dump_links"] = _dump_links
CHECKS.oracles["dump_links"] = f"WITH t AS ({inputs.DUMP_TEXTS}) SELECT k, unnest({every('txt', fixed.DUMP_LINK)}) AS link FROM t"

_hrefs = f"list_filter({every('html', fixed.WIKI_HREF, 1)}, lambda h: contains(h, 'e'))"
_links = f"list_transform({_hrefs}, lambda h: concat('https://en.example.org/wiki/', url_encode(h)))"
_set = f"list_concat([base], {_links})"


def _wiki_links(spark, sf_dir):
    df = inputs.load(spark, sf_dir, inputs.WIKI_LINK_PAGES)
    links = details.wiki_links(F.col("html"), F.col("base"), F.lit("e"))
    return df.select("k", F.array_join(F.array_sort(links), "|").alias("links"))


CHECKS.queries["wiki_links"] = _wiki_links
CHECKS.oracles["wiki_links"] = f"""WITH t AS ({inputs.WIKI_LINK_PAGES})
SELECT k, array_to_string(list_sort(list_distinct({_set})), '|') AS links FROM t"""

# -- detail pages ----------------------------------------------------------------------------------------
HEAD_TEXT = f"lower({strip(text_of(group('html', fixed.HEADING)))})"


def _heading(spark, sf_dir):
    df = inputs.load(spark, sf_dir, inputs.DETAIL_PAGES)
    return filters.match_headings(df, inputs.load(spark, sf_dir, inputs.HEADING_KEYWORDS)).select("k", "url")


CHECKS.queries["match_heading"] = _heading
CHECKS.oracles["match_heading"] = f"""WITH t AS (SELECT k, url, {HEAD_TEXT} AS head FROM ({inputs.DETAIL_PAGES}) d),
  w AS ({inputs.HEADING_KEYWORDS})
SELECT k, url FROM t WHERE EXISTS (SELECT 1 FROM w WHERE head IN
  (lower(keyword), lower(concat(keyword, ' (TV series)')), lower(concat(keyword, ' (film)'))))"""


def _heading_one(spark, sf_dir):
    df = inputs.load(spark, sf_dir, inputs.DETAIL_PAGES.replace("' <i>', p.p_brand, '</i>'", "''"))
    return filters.match_heading(df, "Large Ring").select("k", "url")


CHECKS.queries["match_heading_one"] = _heading_one
CHECKS.oracles["match_heading_one"] = f"""WITH t AS (SELECT k, url, {HEAD_TEXT} AS head
  FROM ({inputs.DETAIL_PAGES.replace("' <i>', p.p_brand, '</i>'", "''")}) d)
SELECT k, url FROM t WHERE head IN ('large ring', 'large ring (tv series)', 'large ring (film)')"""


def _row(headers: str) -> str:
    return f"regexp_extract(html, '(?i:<th\\b[^>]*>)(?:<[^>]*>)*(?:{headers})(?:</[^>]*>)*(?i:</th>)[\\s\\S]*?(?i:</tr>|\\z)')"


RELEASE = text_of(group(_row("Release dates|Release|Release date"), fixed.LIST_ITEM))
_items = every(_row("Written by|Story by"), fixed.LIST_ITEM, 1)
_cells = every(_row("Written by|Story by"), fixed.TABLE_CELL, 1)
WRITERS = f"""list_sort(list_distinct(list_transform(CASE WHEN len({_items}) > 0 THEN {_items} ELSE {_cells} END,
  lambda x: {text_of("x")})))"""
COMPOSER = group("html", fixed.PLAIN_COMPOSER)


def _linked(pattern: str) -> str:
    return f"CASE WHEN regexp_matches(html, {lit(pattern)}) THEN {every(f'regexp_extract(html, {lit(pattern)}, 1)', fixed.ANCHOR_TEXT, 1)} END"


def _single(pattern: str) -> str:
    return f"CASE WHEN regexp_matches(html, {lit(pattern)}) THEN [regexp_extract(html, {lit(pattern)}, 1)] END"


DETAIL_DIRECTORS = f"""coalesce({_single(fixed.PLAIN_CREATOR)}, {_linked(fixed.CREATOR_LIST)},
  {_single(fixed.PLAIN_DIRECTOR)}, {_linked(fixed.DIRECTOR_LIST)})"""

CHECKS.column("detail_release", inputs.DETAIL_PAGES, lambda: details.detail_release(F.col("html")), RELEASE, out="release_date")
CHECKS.column("detail_writers", inputs.DETAIL_PAGES, lambda: F.array_sort(details.detail_writers(F.col("html"))), WRITERS,
        out="writers", is_list=True)
CHECKS.column("detail_composer", inputs.DETAIL_PAGES, lambda: details.detail_composer(F.col("html")), COMPOSER, out="composer")
CHECKS.column("detail_directors", inputs.DETAIL_PAGES, lambda: details.detail_directors(F.col("html")), DETAIL_DIRECTORS,
        out="directors", is_list=True)

# Catalogue rows of the pages, some with unknown directors, to be enriched from the detail pages.
ENRICH_CATALOGUE = """SELECT page_id AS k, url AS title,
  CASE WHEN contains(url, 'utm_source') THEN 'more' ELSE concat('Ann, ', CAST(page_id AS STRING)) END AS director FROM pages"""


def _enrich(spark, sf_dir):
    cat = inputs.load(spark, sf_dir, ENRICH_CATALOGUE)
    cat = cat.select("k", "title", F.split("director", ", ").alias("director_list"))
    records = detail_records(inputs.load(spark, sf_dir, inputs.DETAIL_PAGES), "k")
    rows = enrich(cat, records, "k")
    return rows.select(
        "k", "title", F.array_join("director_list", "|").alias("director_list"), "release",
        F.array_join(F.array_sort("writer"), "|").alias("writer"), "music",
    )


CHECKS.queries["enrich"] = _enrich
CHECKS.oracles["enrich"] = f"""WITH c AS (SELECT k, title, string_split(director, ', ') AS director_list FROM ({ENRICH_CATALOGUE}) x),
  d AS (SELECT k, {RELEASE} AS release, {WRITERS} AS writer, {COMPOSER} AS music, {DETAIL_DIRECTORS} AS directors
        FROM ({inputs.DETAIL_PAGES}) y)
SELECT c.k, c.title, {joined("CASE WHEN list_contains(c.director_list, 'more') AND d.directors IS NOT NULL THEN d.directors ELSE c.director_list END")}
  AS director_list, d.release, {joined("d.writer")} AS writer, d.music FROM c LEFT JOIN d ON c.k = d.k"""

# Films whose director is named in the urls of the detail pages, which the dump's text links to.
FILMS = "SELECT concat('F', CAST(p_partkey AS STRING)) AS title, concat(p_name, ' ', p_brand) AS director FROM part"
LINKED_PAGES = f"""SELECT concat('https://en.example.org/wiki/', replace(p_name, ' ', '_'), '_', brand, '_', CAST(k AS STRING))
    AS url, html FROM (SELECT d.*, q.p_brand AS brand FROM ({inputs.DETAIL_PAGES}) d JOIN part q ON q.p_partkey = d.k) x"""


def _from_links(spark, sf_dir):
    films = inputs.load(spark, sf_dir, FILMS).select("title", F.array("director").alias("director_list"))
    store = inputs.load(spark, sf_dir, LINKED_PAGES)
    lines = store.select(F.concat(F.lit("see "), "url", F.lit(", and https://en.example.org/none_"), "url").alias("text"))
    rows = enrich_from_links(films, lines, store)
    return rows.select(
        "title", F.array_join("director_list", "|").alias("director_list"), "release",
        F.array_join(F.array_sort("writer"), "|").alias("writer"), "music",
    )


CHECKS.add(
    "enrich_from_links",
    _from_links,
    f"""WITH f AS ({FILMS}), p AS ({LINKED_PAGES}),
  d AS (SELECT url, {RELEASE} AS release, {WRITERS} AS writer, {COMPOSER} AS music FROM p),
  m AS (SELECT f.title, d.* FROM f JOIN d ON contains(url, replace(director, ' ', '_'))),
  r AS (SELECT title, arg_min(release, url) AS release FROM m WHERE release IS NOT NULL GROUP BY title),
  w AS (SELECT title, arg_min(writer, url) AS writer FROM m WHERE writer IS NOT NULL GROUP BY title),
  c AS (SELECT title, arg_min(music, url) AS music FROM m WHERE music IS NOT NULL GROUP BY title)
SELECT f.title, f.director AS director_list, r.release, {joined("w.writer")} AS writer, c.music
FROM f LEFT JOIN r ON f.title = r.title LEFT JOIN w ON f.title = w.title LEFT JOIN c ON f.title = c.title""",
)

# -- store: merge, union, sizes --------------------------------------------------------------------------
# Pages keyed by url without its query part and scheme, so that keys repeat.
KEYED = "SELECT page_id AS ordinal, split_part(split_part(url, '?', 1), '/', 3) AS url, html FROM pages"
OLD_ROWS = f"SELECT * FROM ({KEYED}) a WHERE contains(html, 'lang=\"en\"')"
NEW_ROWS = f"SELECT * FROM ({KEYED}) a WHERE contains(url, 'blog') OR NOT contains(html, 'lang=\"en\"')"
PARSED = f"SELECT url FROM ({KEYED}) a WHERE contains(url, 'blog')"


def _merge(spark, sf_dir):
    old, new = inputs.load(spark, sf_dir, OLD_ROWS), inputs.load(spark, sf_dir, NEW_ROWS)
    return dedup.merge_by_key(old, new)


CHECKS.queries["merge_by_key"] = _merge
CHECKS.oracles["merge_by_key"] = f"""SELECT ordinal, url, html FROM
  (SELECT 0 AS turn, * FROM ({OLD_ROWS}) o UNION ALL SELECT 1 AS turn, * FROM ({NEW_ROWS}) n) u
QUALIFY row_number() OVER (PARTITION BY url ORDER BY turn, ordinal) = 1"""


def _append(spark, sf_dir):
    old, new = inputs.load(spark, sf_dir, OLD_ROWS), inputs.load(spark, sf_dir, NEW_ROWS)
    return dedup.merge_by_key(dedup.distinct_url(old, "ordinal"), new, existing_is_unique=True)


CHECKS.queries["merge_by_key_append"] = _append
CHECKS.oracles["merge_by_key_append"] = CHECKS.oracles["merge_by_key"]


def _store_merges(spark, sf_dir):
    """Both batches merged into a bucketed store, the second one twice, as after a failed job."""
    path = staging_path(spark, "pages")
    page_store(spark, path).merge(inputs.load(spark, sf_dir, OLD_ROWS), 0)
    for _ in range(2):
        store = page_store(spark, path)
        store.merge(inputs.load(spark, sf_dir, NEW_ROWS), 1)
    return store.table().select("ordinal", "url", "html")


CHECKS.add("page_store_merge", _store_merges, CHECKS.oracles["merge_by_key"])


def _to_store(spark, sf_dir):
    fetched, old = inputs.load(spark, sf_dir, KEYED), inputs.load(spark, sf_dir, OLD_ROWS)
    return pages_to_store(fetched, old, inputs.load(spark, sf_dir, PARSED))


CHECKS.add(
    "pages_to_store",
    _to_store,
    f"""SELECT * FROM ({KEYED}) a WHERE url NOT IN (SELECT url FROM ({OLD_ROWS}) o)
  AND url NOT IN (SELECT url FROM ({PARSED}) n) QUALIFY row_number() OVER (PARTITION BY url ORDER BY ordinal) = 1""",
)

CHECKS.queries["distinct_url"] = lambda spark, sf_dir: dedup.distinct_url(inputs.load(spark, sf_dir, KEYED), "ordinal")
CHECKS.oracles["distinct_url"] = f"SELECT * FROM ({KEYED}) a QUALIFY row_number() OVER (PARTITION BY url ORDER BY ordinal) = 1"

CHECKS.queries["union_by_name"] = lambda spark, sf_dir: dedup.union_by_name(
    inputs.load(spark, sf_dir, OLD_ROWS), inputs.load(spark, sf_dir, f"SELECT html, ordinal, url FROM ({NEW_ROWS}) b")
)
CHECKS.oracles["union_by_name"] = f"{OLD_ROWS} UNION ALL {NEW_ROWS}"

CHECKS.queries["table_size_mb"] = lambda spark, sf_dir: quality.table_size_mb(
    inputs.table(spark, sf_dir, "pages"), ["url", "html"]
)
CHECKS.oracles["table_size_mb"] = "SELECT sum(strlen(url) + strlen(html)) / (1024.0 * 1024.0) AS size_mb FROM pages"


def _budget(spark, sf_dir):
    store = inputs.table(spark, sf_dir, "pages")
    half = store.agg((F.sum(quality.row_bytes(store, ["url", "html"])) / 2).cast("bigint")).first()[0]
    return budget.byte_budget(store, half, "page_id").select("page_id", "url")


CHECKS.queries["byte_budget"] = _budget
CHECKS.oracles["byte_budget"] = """SELECT page_id, url FROM
  (SELECT page_id, url, sum(strlen(url) + strlen(html)) OVER (ORDER BY page_id) AS run FROM pages) r
WHERE run <= (SELECT sum(strlen(url) + strlen(html)) // 2 FROM pages)"""
