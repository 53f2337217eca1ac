"""Early stop at k and counts from the term dictionary: same answers as the full search, from fewer postings."""

import random

import pytest
from pyspark.sql import functions as F

from filmweave.operators import prefixes, ranked, search
from filmweave.session import stage as search_stage

FIELDS = ("title", "body")
SCHEMA = "id long, title string, body array<string>"


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)] + ["rare.one", "Łódź", "the"]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = [(i, rng.choice([None, "", "w1 w2", "w3"]), rng.choices(words, weights, k=rng.choice([0, 1, 5, 20, 200]))) for i in range(600)]
    rows += [(1000 + i, rows[7][1], rows[7][2]) for i in range(30)]  # ties
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="module")
def index(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ranked") / "index")
    ranked.write_blocks(docs, path, "id", FIELDS, block=16)
    return ranked.BlockIndex(spark, path)


@pytest.mark.parametrize(
    ("query", "k"),
    [("w1", 10), ("w1 w2", 1), ("W30 w31", 1000), ("łódź", 10), ("rare.one w0", 10), ("the w0 w1 w2 w3", 10), ("", 10), ("w39 nothing", 10)],
)
def test_same_hits_as_the_full_search(docs, index, query, k):
    posts = search.postings(docs, "id", FIELDS)
    full = search.search(posts, query, docs.count(), FIELDS).select("doc", F.round("score", 6).alias("score"))
    assert index.search(query, k, FIELDS).collect() == search.top_hits(full, k).collect()


def test_two_terms_read_fewer_postings(index):
    found = index.search("w1 w2", 10, FIELDS).count()
    opened = sum(rows.agg(F.sum("n")).first()[0] or 0 for rows in index.opened)
    held = index.blocks.where(F.col("term").isin("w1", "w2")).agg(F.sum("n")).first()[0]
    assert found == 10 and 0 < opened < held / 2


def test_terms_and_blocks_reach_the_scan_and_bounds_read_no_list(index):
    index.search("w1 w2", 10, FIELDS).count()
    for rows in index.opened:
        text = rows._jdf.queryExecution().executedPlan().toString()
        pushed = text.split("PushedFilters: ")[1]
        assert "In(term" in pushed and "(block" in pushed
    heads = index._rows(["w1"], FIELDS).select("term", "field", "block", "most", "n")._jdf.queryExecution().executedPlan().toString()
    assert "entries" not in heads.split("ReadSchema")[-1]


def test_no_documents(spark, docs, tmp_path):
    ranked.write_blocks(docs.limit(0), str(tmp_path / "none"), "id", FIELDS)
    assert ranked.BlockIndex(spark, str(tmp_path / "none")).search("w1", 10, FIELDS).count() == 0


@pytest.fixture(scope="module")
def dictionary(spark, docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("prefixes") / "terms")
    prefixes.write_dictionary(docs, path, FIELDS)
    return prefixes.read_dictionary(spark, path)


GROUPS = {"titles": ["title"], "bodies": ["body"], "either": ["title", "body"], "none": ["other"]}


@pytest.mark.parametrize("prefix", ["w", "W1", "w12", "rare", "rare.o", "ł", "łódź", "x", "", "the"])
def test_same_counts_as_the_search(docs, dictionary, prefix):
    posts = search.postings(docs, "id", FIELDS)
    assert prefixes.prefix_counts(dictionary, prefix, GROUPS).first() == search.prefix_search(posts, prefix, GROUPS).first()


def test_frequent_terms_are_bitmaps(spark, tmp_path):
    many = spark.range(70000).select("id", F.lit("all words").alias("title"), F.array(F.col("id").cast("string")).alias("body"))
    prefixes.write_dictionary(many, str(tmp_path / "terms"), FIELDS)
    terms = prefixes.read_dictionary(spark, str(tmp_path / "terms"))
    assert terms.where("level = 0 AND bits IS NOT NULL").select("key").distinct().count() == 2
    counts = prefixes.prefix_counts(terms, "wor", GROUPS).first()
    assert counts["titles"] == 70000 and prefixes.prefix_counts(terms, "words", GROUPS).first() == counts
    assert prefixes.prefix_counts(terms, "12", GROUPS).first()["bodies"] == sum(str(i).startswith("12") for i in range(70000))


def test_counts_shuffle_bitmaps_only(dictionary):
    text = prefixes.prefix_counts(dictionary, "w1", GROUPS)._jdf.queryExecution().executedPlan().toString()
    for line in (row for row in text.split("\n") if "Exchange" in row):
        assert "group" in line or "SinglePartition" in line
    assert "EqualTo(level,2)" in text and "EqualTo(key,w1)" in text


def test_lists_hold_numbers_that_ascend_with_the_documents(index):
    """A long id stands once in the index, not with each term."""
    assert dict(index.blocks.dtypes)["entries"] == "array<struct<doc:bigint,tf:bigint>>"
    named = [r["doc"] for r in index.documents.orderBy("_number").collect()]
    assert named == sorted(named) and len(named) == 630


def test_text_ids_and_ties_as_in_the_full_search(spark, docs, tmp_path):
    named = docs.withColumn("id", F.concat(F.lit("film | "), F.sha2(F.col("id").cast("string"), 256)))
    ranked.write_blocks(named, str(tmp_path / "index"), "id", FIELDS, block=16)
    index = ranked.BlockIndex(spark, str(tmp_path / "index"))
    assert "film" not in str(index.blocks.first())
    full = search.search(search.postings(named, "id", FIELDS), "w1", named.count(), FIELDS)
    full = full.select("doc", F.round("score", 6).alias("score"))
    for k in (1, 10, 25, 1000):
        assert index.search("w1", k, FIELDS).collect() == search.top_hits(full, k).collect()


def test_a_dictionary_counts_terms_once(spark, docs, tmp_path, monkeypatch):
    """The postings are read by one job's plan; bitmaps and prefixes follow from what is staged."""
    staged = []
    monkeypatch.setattr(prefixes, "stage", lambda df, label: staged.append(label) or search_stage(df, label))
    prefixes.write_dictionary(docs, str(tmp_path / "terms"), FIELDS)
    assert staged == ["numbered", "terms"]
