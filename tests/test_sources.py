"""Scans and sinks over small files."""

import os

from pyspark.sql import functions as F

from filmweave.functions.sql import register_functions
from filmweave.functions import infobox, text
from filmweave.session import stage, staging_root
from filmweave.sources import dump, sinks, tables
from registry import inputs, stores

SF = "/root/testdata/sf0.001"

HEAD = '<mediawiki xmlns="http://x.org/" xml:lang="en">\n  <siteinfo><sitename>W</sitename></siteinfo>\n'


def page(i, body):
    return (
        f"  <page>\n    <title>T {i}</title>\n    <ns>0</ns>\n    <revision>\n      <id>{i}</id>\n"
        f'      <text bytes="5" xml:space="preserve">{body}</text>\n    </revision>\n  </page>\n'
    )


def test_page_dump_is_read_whole_and_in_splits(spark, tmp_path):
    bodies = [f" {{{{Infobox film\n| a = &lt;br&gt; &amp; &quot;é&quot; {i}" + "x" * (i % 700) + " " for i in range(3000)]
    path = tmp_path / "dump.xml"
    path.write_text(HEAD + "".join(page(i, b) for i, b in enumerate(bodies)) + "</mediawiki>\n", encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = dump.scan_page_dump(spark, str(path))
        assert df.rdd.getNumPartitions() > 10
        got = {r.title: r.t for r in df.select("title", F.col("revision.text._VALUE").alias("t")).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    plain = [b.replace("&lt;", "<").replace("&gt;", ">").replace("&quot;", '"').replace("&amp;", "&") for b in bodies]
    assert got == {f"T {i}": b for i, b in enumerate(plain)}


def test_page_dump_without_text(spark, tmp_path):
    path = tmp_path / "dump.xml"
    path.write_text(HEAD + "<page><title>A</title></page><page ><title>B</title><revision><text x='1'>b</text></revision></page></mediawiki>")
    got = dump.scan_page_dump(spark, str(path)).select("title", "revision.text._VALUE").collect()
    assert [tuple(r) for r in got] == [("A", None), ("B", "b")]


def test_missing_store_is_empty(spark, tmp_path):
    assert tables.scan_pages(spark, str(tmp_path / "none")).columns == ["url", "html"]
    assert tables.scan_catalogue(spark, str(tmp_path / "none")).count() == 0


def test_catalogue_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "cat")
    rows = [("u1", 'A "q", b', ["Ann Lee", "Bo Ray"], ["x"]), ("u2", "B", ["more"], []), ("u3", "B", ["more"], ["y"])]
    df = spark.createDataFrame(rows, "url string, title string, director array<string>, cast array<string>")
    sinks.write_csv(df, path)
    got = sorted(tuple(r) for r in tables.load_catalogue(spark, path).collect())
    assert got == [('A "q", b', ["Ann Lee", "Bo Ray"]), ("B", ["more"])]


def test_search_input(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("a", None), (None, ["b", "c"])], "title string, music array<string>")
    sinks.write_search_input(df, str(tmp_path / "f"), str(tmp_path / "d"))
    filled = spark.read.option("header", True).csv(str(tmp_path / "f"))
    assert sorted(tuple(r) for r in filled.collect()) == [
        ("a", "not found"), ("a", "not found"), ("not found", "['b', 'c']")]
    assert spark.read.option("header", True).csv(str(tmp_path / "d")).count() == 2


def test_staging_uses_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    root = staging_root(spark)
    assert root == shared.rstrip("/") if shared else "filmweave-" in root
    staged = stage(spark.range(5), "numbers")
    assert staged.count() == 5 and root in staged.inputFiles()[0]


def test_sql_functions_agree_with_the_columns(spark):
    assert len(register_functions(spark)) == 9
    wikis = [
        "director = [[Ann|A]]<br>[[Bo]]\n| music = {{plainlist|\n* [[C]]; D\n}}\n| released = {{Film date|2001|1}}",
        "director =\n| music = [[E]] x\n| released = 4 May 1999", "", None, " (a) b &#x27;c&quot; \xa0\t d ",
        "['Ann Lee', 'Bo']", "| released = |1987",
    ]
    df = spark.createDataFrame([(w,) for w in wikis], "x string")
    x = F.col("x")
    forms = {
        "clean_title": infobox.clean_title, "infobox_directors": infobox.infobox_directors,
        "infobox_music": infobox.infobox_music, "infobox_release_year": infobox.infobox_release_year,
        "clean_text": text.clean_text, "split_directors": text.split_directors, "parse_list_text": text.parse_list_text,
    }
    df.createOrReplaceTempView("wikis")
    for name, form in forms.items():
        ours = [r[0] for r in df.select(form(x)).collect()]
        assert [r[0] for r in spark.sql(f"SELECT {name}(x) FROM wikis").collect()] == ours, name
    row = spark.sql(
        "SELECT lists_overlap(array('a'), array('b', 'a')), lists_overlap(NULL, array('a')),"
        " overlap_or_unknown(array('more'), array('a')), overlap_or_unknown(array('b'), array('a'))"
    ).first()
    assert tuple(row) == (True, False, True, False)


def test_malformed_page_is_marked(spark, tmp_path):
    path = tmp_path / "dump.xml"
    path.write_text(HEAD + "<page><title>A</title></page><page><title>B</page><page><title>C</title></page></mediawiki>")
    got = dump.scan_page_dump(spark, str(path)).select("title", "corrupt").collect()
    assert [r.title for r in got if r.corrupt is None] == ["A", "C"]
    assert [r.corrupt for r in got if r.corrupt] == ["<page><title>B</page>"]


def test_dump_text_over_several_lines(spark, tmp_path):
    path = tmp_path / "abstracts.xml"
    path.write_text(
        "<doc>keep <!-- hidden\nstill hidden --> <a\n href='https://en.x.org/wiki/A'>x</a>\n<script>\nvar a=1;\n</script>\n"
        "</doc>\n<doc>\r\n<title>two</title>\r\n \n</doc>\n"
    )
    assert [r.text for r in dump.scan_dump_text(spark, str(path)).collect()] == ["keep  x", "two"]


def test_the_dump_of_the_query_is_written_compressed_and_scanned_whole(spark):
    def written():
        root = staging_root(spark).removeprefix("file:")
        return {os.path.join(d, n) for d, _, names in os.walk(root) for n in names if "/dump-" in d and n.startswith("part-")}

    before = written()
    assert stores._page_dump(spark, SF).count() == inputs.load(spark, SF, inputs.WIKI_PAGES).count()
    fresh = written() - before
    assert fresh and all(n.endswith(".txt.gz") for n in fresh)
