"""Shape of the plans: what reaches the scan, what is shuffled, what never appears."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from filmweave.functions import pages
from filmweave.operators import dedup, filters, linking, search
from filmweave.plans.catalogue import title_rows
from filmweave.plans.linkage import extract_infobox
from filmweave.plans.retrieval import read_index, write_index
from filmweave.session import stage
from filmweave.sources.dump import PAGE_SCHEMA

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().toString()


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_and_no_cross_join_in_any_query(spark):
    """Of the catalogue queries; the optional ones may use Python where they say so."""
    bad = {}
    for name, run in [q for group in entry.GROUPS for q in group.CHECKS.queries.items()]:
        text = plan(run(spark, SF))
        found = [w for w in ("EvalPython", "MapInPandas", "CartesianProduct", "NestedLoopJoin", "Cross") if w in text]
        if found:
            bad[name] = found
    assert not bad


@pytest.fixture
def dump_parquet(spark, tmp_path):
    path = str(tmp_path / "dump")
    df = spark.createDataFrame([("A", (("{{Infobox film\n| director = [[B]]\n}}",),))], PAGE_SCHEMA)
    df.withColumn("other", F.lit("x")).write.parquet(path)
    return spark.read.parquet(path)


def test_film_filter_and_columns_reach_the_scan(dump_parquet):
    text = plan(extract_infobox(filters.film_pages(dump_parquet)))
    assert "StringContains(revision.text._VALUE,Infobox film)" in text
    assert "other" not in text.split("ReadSchema")[-1]
    assert "Exchange" not in text


def test_title_url_tests_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "pages")
    spark.createDataFrame([("u", "h")], "url string, html string").write.parquet(path)
    text = plan(spark.read.parquet(path).filter(pages.is_title_url(F.col("url"))).select("url"))
    assert "StringStartsWith(url,https://www.imdb.com/title/)" in text and "Not(StringContains(url,langua" in text
    assert "html" not in text.split("ReadSchema")[-1]


def test_postings_shuffle_nothing_and_search_reads_them_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    posts = search.postings(docs, "doc_id", ["text", "source"])
    assert "Exchange" not in plan(posts)
    found = search.search(posts, "tion src1", 200, ["text", "source"])
    text = final_plan(found)
    assert "ReusedExchange" in text or text.split("Initial Plan")[0].count("FileScan") == 1


def test_first_per_key_combines_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 1, "x")], "url string, ordinal int, html string")
    text = plan(dedup.first_per_key(df, ["url"], F.col("ordinal")))
    assert "partial_min_by" in text and "Window" not in text


def test_linking_is_an_equi_join_on_title_and_director(spark):
    left = spark.createDataFrame([("a", ["b"])], "title string, director_list array<string>")
    right = spark.createDataFrame([("a", ["b"], ["m"], "1")],
                                  "title_wiki string, director_wiki array<string>, music array<string>, release string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(linking.matching_pairs(left, right))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [title" in text and "_left" in text.split("SortMergeJoin")[-1].split("\n")[0]


def test_hot_link_key_is_split_at_run_time(spark):
    """A director under one title holds most encyclopedia rows; AQE cuts its partition up."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        wiki = spark.range(40000).repartition(8).select(
            F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("title_wiki"),
            F.array(F.lit("d")).alias("director_wiki"), F.array(F.sha2(F.col("id").cast("string"), 256)).alias("music"),
            F.lit("1").alias("release"),
        )
        left = spark.range(100).select(
            F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("t"), "id")).alias("title"),
            F.array(F.lit("d")).alias("director_list"),
        )
        pairs = linking.matching_pairs(stage(left, "left"), stage(wiki, "wiki"))
        assert pairs.count() == 20000 + 50
        assert "skew=true" in final_plan(pairs)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_title_patterns_are_searched_once(spark, tmp_path):
    path = str(tmp_path / "pages")
    spark.createDataFrame([(1, "u", "h")], "ordinal int, url string, html string").write.parquet(path)
    physical = title_rows(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert physical.count("regexp_extract(html") == 4  # title, created, directed, cast
    assert "StringStartsWith(url" in physical


def test_search_pushes_its_terms_to_the_written_index(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    write_index(docs, str(tmp_path / "index"), "doc_id", ["text", "source"])
    text = plan(search.search(read_index(spark, str(tmp_path / "index")), "tion src1", 200, ["text", "source"]))
    assert "In(term, [src1,tion])" in text or "In(term, [tion,src1])" in text
