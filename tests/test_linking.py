"""Linking under titles of few and of many catalogue rows, and what it reads of a row."""

import random

import pytest
from pyspark.sql import functions as F

from filmweave.functions import fixed, infobox, text
from filmweave.operators import linking
from filmweave.plans.linkage import extract_infobox
from filmweave.session import stage
from registry import linking as queries

LEFT = "title string, director_list array<string>, year int"
RIGHT = "title_wiki string, director_wiki array<string>, music array<string>, release string"


def _tables(spark, titles, crowd, seed=5):
    rnd = random.Random(seed)

    def people(extra):
        return [rnd.choice(["d1", "d2", "d3", "*", "", None, *extra]) for _ in range(rnd.randint(0, 3))]

    left = [(rnd.choice(titles), rnd.choice([people(["more"]), None]), i) for i in range(2 * len(titles))]
    left += [("hot", people(["more"]), i) for i in range(crowd)]
    right = [(rnd.choice([*titles, "hot"]), people([]), ["m"], str(i)) for i in range(120)]
    expected = []
    for t, d, y in left:
        known = set(d or []) - {None}
        found = [r for r in right if t is not None and t == r[0] and ("more" in known or known & set(r[1]))]
        expected += [(t, d, y, *r) for r in found] or [(t, d, y, None, None, None, None)]
    return spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), sorted(expected, key=str)


@pytest.mark.parametrize("crowd", [0, linking.FEW_ROWS + 1, 60])
def test_link_is_the_left_outer_join_under_few_and_many_rows(spark, crowd):
    left, right, expected = _tables(spark, [*[f"t{i}" for i in range(20)], None], crowd)
    assert sorted(map(tuple, linking.link_catalogue(left, right).collect()), key=str) == expected


def test_encyclopedia_rows_are_shuffled_once_under_titles_of_few_rows(spark):
    left, right, _ = _tables(spark, [f"t{i}" for i in range(200)], 0)
    left = left.dropDuplicates(["title"])
    text_of = linking._pairs(stage(left, "left"), stage(right, "right"))._jdf.queryExecution().toString()
    assert "explode" not in text_of
    crowded = left.limit(1).unionByName(left.limit(1).withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(20)))).drop("n"))
    text_of = linking._pairs(stage(crowded, "left"), stage(right, "right"))._jdf.queryExecution().toString()
    assert "explode" in text_of


def test_no_pattern_is_compiled_for_each_row_and_no_class_holds_all_characters(spark):
    df = spark.createDataFrame([("a",)], "x string")
    columns = [text.split_directors(F.col("x")), infobox.infobox_music(F.col("x"))]
    shown = df.select(*columns)._jdf.queryExecution().analyzed().toString()
    assert ", ,, -1)" in shown  # split on the comma alone
    assert r"[\s\S]" not in shown


@pytest.mark.parametrize(
    ("given", "expected"),
    [("a, b", ["a", "b"]), (" a , , b ,", ["a", "", "b", ""]), (",", ["", ""]), ("", [""]), (" a b ", ["a b"]), (None, None)],
)
def test_split_takes_the_whitespace_around_separators(value, given, expected):
    assert value(text.split_directors, given) == expected


@pytest.mark.parametrize("body", ["* [[A]]\n* [[B]]\n", "A } B", "", "x" * 50_000, "\U0001f600 \r y"])
def test_music_list_ends_at_the_first_closing_marks(value, body):
    page = f"{{{{Infobox film|\n| music = {{{{plainlist|{body}}}}}}}\n}}}} more }}}}"
    assert value(infobox.infobox_music, page) == value(_with(fixed.BOX_MUSIC_LIST), page)


def _with(pattern):
    def run(c):
        held, fixed.BOX_MUSIC_BODY = fixed.BOX_MUSIC_BODY, pattern
        try:
            return infobox.infobox_music(c)
        finally:
            fixed.BOX_MUSIC_BODY = held

    return run


def test_a_generated_page_is_built_once(spark):
    """Pushed into the join beneath, the film test built it again for each of its two conditions."""
    shown = queries.wiki(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert shown.count("About Infobox film markup") == 1


def test_nested_boxes_are_read_once_though_linking_tests_the_directors(spark):
    pages = spark.createDataFrame([("A (film)", "{{Infobox film\n| director = [[B]]\n| music = C\n}}"), ("D", "none")], "title string, txt string")
    left = stage(spark.createDataFrame([("A", ["B"])], "title string, director_list array<string>"), "left")
    pairs = linking._pairs(left, extract_infobox(pages, "txt", nested=True))
    assert pairs._jdf.queryExecution().executedPlan().toString().count("<!--") == 1
    assert [tuple(r) for r in pairs.collect()] == [("A", ["B"], "A", ["B"], ["C"], "not found")]


def test_places_of_links_are_tested_by_compiled_code_and_a_gram_counts_once(spark):
    links = ["abcabcabcabc_abcabcabcabc", "naïve_café_au_lait_naïve_café_au_lait", "", "é", "abcabc", "xabc", None]
    words = ["abcabc", "naïve café au lait", "é", "bc", "", "abcabcabcabc", "zz"]
    df = spark.createDataFrame([(x,) for x in links], "link string")
    keywords = spark.createDataFrame([(w,) for w in words], "keyword string")
    expected = sorted((w, x) for w in words for x in links if x is not None and w.replace(" ", "_") in x)
    found = linking.keyword_links(keywords, df)
    assert sorted(map(tuple, found.collect())) == expected
    rows = df.select(F.monotonically_increasing_id().alias("_id"), F.col("link").alias("_link"))
    grams = keywords.select(F.col("keyword").alias("_gram"))
    cut = linking._wanted(rows, grams, [12, 6, 2, 1])
    assert sorted((r["_link"], r["_gram"]) for r in cut.collect()) == sorted(set((r["_link"], r["_gram"]) for r in cut.collect()))
    assert "lambda" not in cut._jdf.queryExecution().executedPlan().toString()
