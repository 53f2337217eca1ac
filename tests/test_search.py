"""The search scenarios, as assertions, and postings against a plain count."""

import math
from collections import Counter

import pytest

from filmweave.functions import fixed
from filmweave.operators import search
from filmweave.plans import retrieval

LINKED = "title string, title_wiki string, director_list array<string>, director_wiki array<string>, music array<string>, release string"


@pytest.fixture(scope="module")
def films(spark):
    rows = [
        ("Seven", "Seven", ["David Fincher"], ["David Fincher"], ["Howard Shore"], "1995"),
        ("David", None, ["Fincher", "Bo"], None, None, None),
        ("300", "300", ["Zack Snyder"], ["Zack Snyder"], ["Tyler Bates"], "not found"),
        ("3000 Miles", None, ["more"], None, None, None),
        ("Found", "Found", ["Ann"], ["Ann"], ["David Low"], "3001"),
        ("Found", "Found", ["Ann"], ["Ann"], ["David Low"], "3001"),
    ]
    return retrieval.search_documents(spark.createDataFrame(rows, LINKED)).cache()


@pytest.fixture(scope="module")
def posts(films):
    return search.postings(films, "doc", fixed.SEARCH_FIELDS).cache()


def titles(films, hits):
    return sorted(r.title for r in films.join(hits, "doc").select("title").collect())


def test_simple_and_case(films, posts):
    n = films.count()
    assert n == 5
    simple = search.search(posts, "David Fincher", n)
    assert titles(films, simple) == ["David", "Seven"]
    upper = search.search(posts, "DAVID FINCHER", n)
    assert {tuple(r) for r in simple.collect()} == {tuple(r) for r in upper.collect()}
    # Both terms stand in both director fields of one film; "david" is in the title of the other.
    idf = {("director_list", "david"): 1, ("director_list", "fincher"): 2, ("director_wiki", "david"): 1,
           ("director_wiki", "fincher"): 1}
    score = sum(math.log(n / (d + 1)) + 1 for d in idf.values())
    best = search.top_hits(simple, 1).first()
    assert best.score == pytest.approx(score)


def test_missing(films, posts):
    hits = search.search_missing(posts, films.count())
    assert titles(films, hits) == ["300", "3000 Miles", "David", "Found"]
    assert sorted(r.title for r in search.rows_missing(films).collect()) == ["300", "3000 Miles", "David"]


def test_prefix(films, posts):
    assert search.prefix_search(posts, "David", search.PEOPLE_GROUPS).first().asDict() == {
        "titles": 1, "directors": 1, "music": 1}
    assert search.prefix_search(posts, "300", search.NUMBER_GROUPS).first().asDict() == {"titles": 2, "releases": 1}
    assert search.prefix_search(posts, "zzz", search.NUMBER_GROUPS).first().asDict() == {"titles": 0, "releases": 0}


def test_stop_words_only_find_nothing(films, posts):
    assert search.search(posts, "not the", films.count()).count() == 0


def test_top_hits_break_ties_by_document(spark):
    hits = spark.createDataFrame([(i % 20, 1.0 if i < 15 else 2.0) for i in range(20)], "doc int, score double")
    assert [r.doc for r in search.top_hits(hits).collect()] == [15, 16, 17, 18, 19, 0, 1, 2, 3, 4]


def test_postings_count_every_word(spark):
    texts = ["a.b A.B ab. ab the x", "", None, "é É_1 é", "zz " * 500 + "yy"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = {(r.doc, r.term): r.tf for r in search.postings(df, "id", ["t"]).collect()}
    expected = Counter({(0, "a.b"): 2, (0, "ab"): 2, (3, "é_1"): 1, (4, "zz"): 500, (4, "yy"): 1})
    assert got == dict(expected)
    assert search.analyse("The A.B é x zz ZZ") == ["a.b", "zz"]


def test_written_index_gives_the_same_hits(spark, films, posts, tmp_path):
    path = str(tmp_path / "index")
    retrieval.write_index(films, path)
    index = retrieval.read_index(spark, path)
    n = films.count()
    assert {tuple(r) for r in search.search(index, "david", n).collect()} == {
        tuple(r) for r in search.search(posts, "david", n).collect()}


def test_table_functions_from_sql(spark):
    from filmweave.functions import sql

    docs = spark.createDataFrame([(1, "Star Trek", "v1.2 u.s"), (2, "the star", "trek TREK"), (3, None, "")], "id long, title string, body string")
    search.postings(docs, "id", ["title", "body"]).createOrReplaceTempView("fn_postings")
    assert sql.register_table_functions(spark, "fn_postings") == ["dump_links", "query_terms", "prefix_counts", "search"]
    both = "array('title', 'body')"
    got = {r["doc"]: round(r["score"], 6) for r in spark.sql(f"SELECT * FROM search('The STAR trek', {both}, 3)").collect()}
    want = {r["doc"]: round(r["score"], 6) for r in search.search(spark.table("fn_postings"), "star trek", 3, ["title", "body"]).collect()}
    assert got == want and set(got) == {1, 2}
    assert spark.sql("SELECT * FROM search('star', array('body'), 3)").count() == 0
    assert spark.sql("SELECT * FROM search('the', array('title'), 3)").count() == 0
    assert [r["term"] for r in spark.sql("SELECT * FROM query_terms('A Star, v1.2 star')").collect()] == ["star", "v1.2"]
    assert spark.sql(f"SELECT docs FROM prefix_counts('TR', {both})").first()["docs"] == 2
    texts = spark.createDataFrame([(1, "see https://en.x.org/a, https://en.y.org/b:c"), (2, "none"), (3, None)], "k long, txt string")
    texts.createOrReplaceTempView("fn_texts")
    links = spark.sql("SELECT k, link FROM fn_texts, LATERAL dump_links(txt)").collect()
    assert [tuple(r) for r in links] == [(1, "https://en.x.org/a"), (1, "https://en.y.org/b")]
    text = spark.sql("SELECT * FROM search('star', array('title'), 3)")._jdf.queryExecution().toString()
    assert "Python" not in text


def test_words_are_sorted_and_stop_words_found_without_a_comparing_expression(spark):
    physical = search.postings(spark.createDataFrame([(1, "the b a b")], "id int, x string"), "id", ["x"])
    text = physical._jdf.queryExecution().optimizedPlan().toString()
    assert "sort_array(" in text and "array_sort(" not in text and "INSET" in text and "array_contains(" not in text
