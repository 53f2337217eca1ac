"""Inputs derived from the test tables.

The tables hold no film pages, so these SELECTs build markup, pages and links from whole tables. The text
runs unchanged in Spark and in the checking engine; remainders choose a layout, never rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmweave.functions import fixed

TEXT_TABLES = ("documents", "pages")
TABLES = ("supplier", "part", "orders", "lineitem", "customer", "documents", "pages")


def load(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run a SELECT over the test tables."""
    for name in TABLES:
        if name in sql:
            table(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(sql)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; a text table that is a single file, as no large one is, is dealt to all cores."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    alone = name in TEXT_TABLES and len(df.inputFiles()) == 1
    return df.repartition(spark.sparkContext.defaultParallelism) if alone else df


def wiki_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The encyclopedia pages, each text built once.

    A filter on the text would be pushed into the join that the text is built from and would build it anew for each
    test, in methods too long to be compiled. It isn't pushed below a generated column.
    """
    built = F.explode(F.array("txt")).alias("txt")
    return load(spark, sf_dir, WIKI_PAGES).select("k", "s", "title", built)


# One encyclopedia page per part and supplier that meet in lineitem.
WIKI_PAGES = """
SELECT d.k, d.s, concat(p.p_name, ' ', CAST(d.k AS STRING), ' (film)') AS title,
  replace(concat(
    CASE WHEN (d.k + d.s) % 11 = 0 THEN 'About Infobox film markup.NL'
         WHEN (d.k + d.s) % 13 = 0 THEN '{{Infobox  film|NL'
         WHEN (d.k + d.s) % 2 = 0 THEN '{{Infobox film |NL' ELSE '{{ Infobox filmNL' END,
    '| name = ', p.p_name, 'NL',
    CASE (d.k + d.s) % 7
         WHEN 0 THEN concat('| director       = [[Zoë ', s.s_name, ']]NL')
         WHEN 1 THEN concat('| director = [[Zoë ', s.s_name, '|Zoë]]<br>[[', p.p_brand, ' Unit]]NL')
         WHEN 2 THEN concat('| director = [[Zoë ', s.s_name, ']]<br>[[', p.p_brand, ' Unit]]NL')
         WHEN 3 THEN '| director = {{plainlist|NL* [[A]]NL}}NL'
         WHEN 4 THEN '| director =NL'
         WHEN 5 THEN concat('| director = ', p.p_brand, ' Unit (director)NL')
         ELSE '' END,
    CASE (3 * d.k + d.s) % 6
         WHEN 0 THEN concat('| music = {{plainlist|NL* [[', s.s_name, ']]NL* [[', p.p_type, ']]NL}}NL')
         WHEN 1 THEN concat('| music = [[', s.s_name, ']]NL')
         WHEN 2 THEN concat('| music = [[', s.s_name, '|S]] and [[', p.p_type, ']]NL')
         WHEN 3 THEN concat('| music = ', s.s_name, 'NL')
         WHEN 4 THEN concat('| music={{plainlist|NL* [[', s.s_name, ']];  ', p.p_brand, ' NL}}NL')
         ELSE '' END,
    CASE (d.k + 2 * d.s) % 5
         WHEN 0 THEN concat('| released = {{Film date|', CAST(1950 + d.k % 70 AS STRING), '|4|6}}')
         WHEN 1 THEN concat('| released = 4 May ', CAST(1950 + d.k % 70 AS STRING))
         WHEN 2 THEN concat('| released = 14 May ', CAST(1950 + d.k % 70 AS STRING))
         WHEN 3 THEN concat('| released = {{Film date|', CAST(1950 + d.k % 70 AS STRING), '}}')
         ELSE concat('| released = {{Film date|df=yes|', CAST(1950 + d.k % 70 AS STRING), '|1|2}}') END,
    'NL}}NL'), 'NL', chr(10)) AS txt
FROM (SELECT DISTINCT l_partkey AS k, l_suppkey AS s FROM lineitem) d
JOIN part p ON p.p_partkey = d.k JOIN supplier s ON s.s_suppkey = d.s
"""

# One catalogue row per ordered part; a fifth has unknown directors.
CATALOGUE = """
SELECT p.p_partkey AS k, concat(p.p_name, ' ', CAST(p.p_partkey AS STRING)) AS title,
  CASE WHEN p.p_partkey % 5 = 0 THEN 'more'
       ELSE concat('Zoë ', s.s_name, ', ', p.p_brand, ' Unit') END AS director
FROM part p
JOIN (SELECT l_partkey, min(l_suppkey) AS lo FROM lineitem GROUP BY l_partkey) d ON d.l_partkey = p.p_partkey
JOIN supplier s ON s.s_suppkey = d.lo
"""

# List texts of several shapes.
LIST_TEXTS = """
SELECT c_custkey AS k,
  CASE c_custkey % 5 WHEN 0 THEN concat('[', chr(39), c_name, chr(39), ', ', chr(39), c_mktsegment, chr(39), ']')
       WHEN 1 THEN concat('["', c_name, '"]') WHEN 2 THEN '' WHEN 3 THEN NULL
       ELSE concat(c_name, ' ,', c_mktsegment, ',', c_mktsegment) END AS txt
FROM customer
"""

DIRTY_TEXTS = """
SELECT c_custkey AS k, concat(chr(9), '&quot;', c_name, '&quot;  ', chr(10), c_mktsegment, ',  O&#x27;', c_mktsegment,
  ' &amp; ', chr(160)) AS txt
FROM customer
"""

# Stored pages dressed as title pages of the site: head and cast line before the real page.
TITLE_PAGES = f"""
SELECT page_id AS ordinal,
  CASE page_id % 6 WHEN 0 THEN url WHEN 1 THEN concat('{fixed.TITLE_PREFIX}tt', CAST(page_id AS STRING), '/reviews')
       ELSE concat('{fixed.TITLE_PREFIX}tt', CAST(page_id AS STRING), '/') END AS url,
  concat('<html><head><title>', CASE page_id % 8 WHEN 0 THEN 'Untitled' ELSE
           concat(' ', url, ' (',
                  CASE WHEN page_id % 5 = 3 THEN 'TV Series ' ELSE '' END, CAST(1950 + page_id % 70 AS STRING), ')') END,
         ' - IMDb</title><meta name="description" content="',
         CASE page_id % 5 WHEN 0 THEN 'A page'
           WHEN 1 THEN concat('Directed by Ann ', CAST(page_id % 211 AS STRING), ', Bo  O&#x27;Ray. With C')
           WHEN 2 THEN 'Directed by {fixed.PLACEHOLDER_DIRECTOR}. With C'
           WHEN 3 THEN concat('Created by &quot;Cy&quot; ', CAST(page_id % 101 AS STRING), '. With D. Directed by X. With')
           ELSE concat('Directed by Di ', CAST(page_id AS STRING), '. With C') END,
         '.">', chr(10), '{{"cast":{{"edges":[',
         CASE page_id % 4 WHEN 0 THEN '' WHEN 1 THEN concat('{{"nameText":{{"text":"N ', url, '","__typename":"NameText"}}')
           ELSE concat('{{"nameText":{{"text":"Ed","__typename":"NameText"}},{{"nameText":{{"text":"N ', url,
                       '","__typename":"NameText"}},{{"nameText":{{"text":"Last","__typename":"NameText"}}') END,
         ']', chr(10), html) AS html
FROM pages
"""

# Stored pages dressed as encyclopedia pages: heading and info table before the real page.
DETAIL_PAGES = """
SELECT g.page_id AS k, g.url, p.p_name, concat('<html><body><H1 id="x"> ', upper(p.p_name), ' <i>', p.p_brand, '</i>',
    CASE g.page_id % 4 WHEN 0 THEN ' (film)' WHEN 1 THEN ' (TV series)' WHEN 2 THEN '' ELSE ' (disc)' END,
    '</h1><table><tr><th scope="row">Title</th><td class="t">T</td></tr>',
    CASE g.page_id % 6 WHEN 0 THEN concat('<tr><th>Created by</th><td class="c"><a href="/wiki/C">Cy ', p.p_brand,
                                          '</a></td></tr>')
      WHEN 1 THEN concat('<tr><th>Created by</th><td><ul><li><a href="/wiki/A">Ann ', p.p_brand,
                         '</a></li><li><a href="/wiki/B">Bo</a></li></ul></td></tr>')
      WHEN 2 THEN concat('<tr><th>Directed by</th><td class="d"><a href="/wiki/D">Di ', p.p_brand, '</a></td></tr>')
      WHEN 3 THEN concat('<tr><th>Directed by</th><td><ul><li><a href="/wiki/E">Ed ', p.p_brand,
                         '</a></li></ul></td></tr>')
      ELSE '' END,
    chr(10),
    CASE g.page_id % 5 WHEN 0 THEN concat('<tr><th>Written by</th><td><ul><li>W <b>', p.p_brand,
                                          '</b></li><li>Wu &amp; Co</li><li>Wu &amp; Co</li></ul></td></tr>')
      WHEN 1 THEN concat('<tr><th><div>Story by</div></th><td>', p.p_brand, '</td><td>Zed</td></tr>')
      WHEN 2 THEN '<tr><th>Written by someone</th><td>No</td></tr>' ELSE '' END,
    CASE g.page_id % 3 WHEN 0 THEN concat('<tr><th>Release date</th><td><ul><li>', CAST(1950 + g.page_id % 70 AS STRING),
                                          ' <span>(US)</span></li><li>x</li></ul></td></tr>')
      WHEN 1 THEN '<tr><th>Release dates</th><td>none</td></tr>' ELSE '' END,
    chr(10),
    CASE g.page_id % 4 WHEN 0 THEN concat('<tr><th>Music by</th><td><a href="/wiki/M">Mo ', p.p_brand,
                                          '</a></td></tr><tr><th scope="row">Produced by</th><td>P</td></tr>')
      WHEN 1 THEN '<tr><th>Music by</th><td><a href="/wiki/M">Mo</a></td></tr><tr><th>Starring</th></tr>'
      ELSE '' END,
    '</table>', g.html) AS html
FROM pages g JOIN (SELECT page_id AS id, coalesce(p_name, 'none') AS p_name, coalesce(p_brand, 'none') AS p_brand
                   FROM pages LEFT JOIN part ON p_partkey = page_id) p ON p.id = g.page_id
"""

HEADING_KEYWORDS = "SELECT DISTINCT concat(p_name, ' ', p_brand) AS keyword FROM part"

# The links of the stored pages, made to point to the site in three ways.
SITE_PAGES = f"""
SELECT page_id AS k, url, replace(replace(replace(html,
    'href="/', CASE page_id % 3 WHEN 0 THEN 'href="/title/' WHEN 1 THEN 'href="/name/'
                    ELSE 'class="l" href="{fixed.SITE}/' END),
    '<nav>', '<nav><a class="s" href="/title/tt1/"><a rel="x" href="https://apps.apple.com/imdb.com/">'),
    '</nav>', '<a href="/name/nm1/"><a href="/title/tt1/"></nav>') AS html
FROM pages
"""

WIKI_LINK_PAGES = """
SELECT page_id AS k, concat('https://en.example.org/wiki/Page_', CAST(page_id AS STRING), '?x=1') AS base,
  replace(html, 'href="/', 'href="/wiki/A*~(x)_') AS html
FROM pages
"""

DUMP_TEXTS = """
SELECT page_id AS k, concat('See https://en.example.org/wiki/P_', CAST(page_id AS STRING), ', then https://en.w.org/a:b ',
  url, ' and', chr(160), 'https://english.example.net/', lower(replace(url, ':', '')), chr(10), html, ' https://en') AS txt
FROM pages
"""

# Links that hold part, brand and supplier names, and keywords of which some occur in them.
KEYWORD_LINKS = """
SELECT DISTINCT concat('https://en.example.org/wiki/', replace(p.p_name, ' ', '_'), '_', p.p_brand, '_', s.s_name) AS link
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey JOIN supplier s ON s.s_suppkey = l.l_suppkey
"""
KEYWORDS = """
SELECT DISTINCT concat(p_name, ' ', p_brand) AS keyword FROM part
UNION SELECT concat(s_name, CASE s_suppkey % 3 WHEN 0 THEN '' ELSE ' x' END) AS keyword FROM supplier
UNION SELECT c_name AS keyword FROM customer
UNION SELECT concat(lower(c_mktsegment), ' ') AS keyword FROM customer
"""

# Customers link to the parts they ordered; parts and suppliers link to each other.
GRAPH_EDGES = """
SELECT DISTINCT concat('c', CAST(o.o_custkey AS STRING)) AS src_url, concat('p', CAST(l.l_partkey AS STRING)) AS dst_url
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
UNION ALL
SELECT DISTINCT concat('p', CAST(l_partkey AS STRING)) AS src_url, concat('s', CAST(l_suppkey AS STRING)) AS dst_url
FROM lineitem
UNION ALL
SELECT DISTINCT concat('s', CAST(l_suppkey AS STRING)) AS src_url, concat('p', CAST(l_partkey AS STRING)) AS dst_url
FROM lineitem
"""
GRAPH_SEEDS = """
SELECT concat('c', CAST(c_custkey AS STRING)) AS url FROM customer
WHERE c_acctbal = (SELECT min(c_acctbal) FROM customer)
"""

# Stored pages that link to each other: each to two others, of which those beyond the last page aren't stored.
WALK_PAGES = f"""
SELECT concat('{fixed.TITLE_PREFIX}tt', CAST(page_id AS STRING)) AS url,
  concat(html, '<a href="/title/tt', CAST(2 * page_id AS STRING), '">', '<a class="n" href="{fixed.TITLE_PREFIX}tt',
         CAST(2 * page_id + 1 AS STRING), '">') AS html
FROM pages
"""
WALK_SEEDS = f"SELECT concat('{fixed.TITLE_PREFIX}tt', CAST(min(page_id) + 1 AS STRING)) AS url FROM pages"
