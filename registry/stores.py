"""Sources and sinks: whole tables written to the staging folder and scanned back."""

from __future__ import annotations

from pyspark.sql import functions as F

from filmweave.functions import pages, text
from filmweave.session import staging_path
from filmweave.sources import dump, sinks, tables

from . import inputs
from .checks import Checks
from .linking import LINKED_SQL, linked
from .sqltext import joined, every, lit, split_trimmed
from filmweave.functions import fixed

CHECKS = Checks()


def _escaped(c):
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(char), F.lit(entity))
    return c


PAGES_PER_FILE = 200_000  # of a written dump: a compressed file is read by one task


def _page_dump(spark, sf_dir):
    """Write the encyclopedia pages as an XML dump, compressed as real dumps are, scan it, keep what the scan gives."""
    path = staging_path(spark, "dump")
    rows = inputs.load(spark, sf_dir, inputs.WIKI_PAGES)
    xml = F.concat(
        F.lit("  <page>\n    <title>"), _escaped(F.col("title")), F.lit("</title>\n    <ns>0</ns>\n    <revision>\n"),
        F.lit('      <id>1</id><text bytes="9" xml:space="preserve">'), _escaped(F.col("txt")),
        F.lit("</text>\n    </revision>\n  </page>"),
    )
    dump_rows = rows.select(xml.alias("value")).write.option("compression", "gzip").option("maxRecordsPerFile", PAGES_PER_FILE)
    dump_rows.text(path)
    pages_read = dump.scan_page_dump(spark, path)
    return pages_read.select("title", F.col("revision.text._VALUE").alias("txt"))


CHECKS.add("scan_page_dump", _page_dump, f"SELECT title, txt FROM ({inputs.WIKI_PAGES}) w")


def _dump_text(spark, sf_dir):
    path = staging_path(spark, "abstracts")
    rows = inputs.load(spark, sf_dir, inputs.WIKI_PAGES)
    line = F.concat(
        F.lit("<doc>\n<!-- hidden\nhttps://en.example.org/wiki/Hidden\n--><title\n lang='en'>"), _escaped(F.col("title")),
        F.lit("</title>\n<script>\nvar a = 'https://en.example.org/wiki/Script';\n</script>\n<url>https://en.example.org/wiki/"),
        F.replace(F.col("title"), F.lit(" "), F.lit("_")), F.lit("</url>\n \n</doc>"),
    )
    rows.select(line.alias("value")).write.text(path)
    lines = dump.scan_dump_text(spark, path)
    return lines.select("text", F.size(pages.dump_links(F.col("text"))).cast("bigint").alias("links"))


CHECKS.add(
    "scan_dump_text",
    _dump_text,
    f"""SELECT title AS text, CAST(0 AS BIGINT) AS links FROM ({inputs.WIKI_PAGES}) w
UNION ALL SELECT concat('https://en.example.org/wiki/', replace(title, ' ', '_')) AS text, CAST(1 AS BIGINT) AS links
FROM ({inputs.WIKI_PAGES}) w""",
)


def _load_catalogue(spark, sf_dir):
    path = staging_path(spark, "catalogue")
    rows = inputs.load(spark, sf_dir, inputs.CATALOGUE).select(
        F.concat(F.lit("u"), "k").alias("url"), "title", text.split_directors(F.col("director")).alias("director"),
        F.array(F.lit('A "B"'), F.lit("C, D")).alias("cast"),
    )
    sinks.write_csv(rows.unionByName(rows), path)
    loaded = tables.load_catalogue(spark, path)
    return loaded.select("title", F.array_join("director_list", "|").alias("director_list"))


CHECKS.add(
    "load_catalogue",
    _load_catalogue,
    f"SELECT title, {joined(split_trimmed('director', ','))} AS director_list FROM ({inputs.CATALOGUE}) c",
)


def _scan_pages(spark, sf_dir):
    stored = tables.scan_pages(spark, f"{sf_dir}/pages.parquet")
    return stored.unionByName(tables.scan_pages(spark, staging_path(spark, "nothing")))


CHECKS.add("scan_pages", _scan_pages, "SELECT url, html FROM pages")


def _write_linked(form):
    def run(spark, sf_dir):
        path = staging_path(spark, "linked")
        sinks.write_linked(linked(spark, sf_dir), path, form)
        if form == "csv":
            # Quoted in full, so that an empty text and a missing one stay apart.
            names = "title, director_list, title_wiki, director_wiki, music, release"
            schema = ", ".join(f"{n} STRING" for n in names.split(", "))
            back = spark.read.option("header", True).option("escape", '"').schema(schema).csv(path)
            lists = ("director_list", "director_wiki", "music")
            return back.select(
                *[
                    F.when(F.col(c).isNotNull(), F.array_join(text.parse_list_text(F.col(c)), "|")).alias(c)
                    if c in lists else F.col(c)
                    for c in back.columns
                ]
            )
        back = spark.read.parquet(path)
        lists = ("director_list", "director_wiki", "music")
        return back.select(*[F.array_join(c, "|").alias(c) if c in lists else F.col(c) for c in back.columns])

    return run


_LINKED = f"""SELECT title, {joined("director_list")} AS director_list, title_wiki, {joined("director_wiki")} AS director_wiki,
  @music AS music, release FROM ({LINKED_SQL}) l"""
CHECKS.add("write_linked", _write_linked("parquet"), _LINKED.replace("@music", joined("music")))
# The text form of a list does not keep commas inside an item apart from those between items.
CHECKS.add(
    "write_linked_csv",
    _write_linked("csv"),
    _LINKED.replace("@music", joined("list_transform(string_split(array_to_string(music, ','), ','), lambda x: trim(x))")),
)


def _search_input(spark, sf_dir):
    filled, unique = staging_path(spark, "filled"), staging_path(spark, "distinct")
    rows = linked(spark, sf_dir)
    sinks.write_search_input(rows.unionByName(rows), filled, unique, "parquet")
    both = spark.read.parquet(filled).withColumn("part", F.lit("filled"))
    return both.unionByName(spark.read.parquet(unique).withColumn("part", F.lit("distinct")))


def _list_text(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN 'not found' ELSE concat('[''', array_to_string({c}, ''', '''), ''']') END"


CHECKS.add(
    "write_search_input",
    _search_input,
    f"""WITH l AS ({LINKED_SQL}), f AS (SELECT title, {_list_text("director_list")} AS director_list,
  coalesce(title_wiki, 'not found') AS title_wiki, {_list_text("director_wiki")} AS director_wiki,
  {_list_text("music")} AS music, coalesce(release, 'not found') AS release FROM l)
SELECT *, 'filled' AS part FROM f UNION ALL SELECT *, 'filled' AS part FROM f
UNION ALL SELECT DISTINCT *, 'distinct' AS part FROM f""",
)
