"""Operators against brute force on small fixtures, hot keys included."""

import random

import pytest
import regex
from pyspark.sql import functions as F

from filmweave.functions import details, fixed, infobox
from filmweave.operators import budget, dedup, graph, linking, quality


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# -- linking ---------------------------------------------------------------------------------------------
LEFT = "title string, director_list array<string>"
RIGHT = "title_wiki string, director_wiki array<string>, music array<string>, release string"


def test_link_golden_and_scores(spark):
    left = spark.createDataFrame([("Alpha", ["Ann Lee"]), ("Beta", ["more"]), ("Zed", ["x"])], LEFT)
    right = spark.createDataFrame([("Alpha", ["Ann Lee"], ["m"], "1"), ("Beta", ["q"], ["m"], "2")], RIGHT)
    linked = linking.link_catalogue(left, right)
    assert rows(linked, "title", "title_wiki") == [("Alpha", "Alpha"), ("Beta", "Beta"), ("Zed", None)]
    score = quality.linkage_quality(linked).first()
    assert (score.tp, score.fp, score.fn, round(score.precision, 9), score.recall) == (1, 2, 0, round(1 / 3, 9), 1.0)
    running = quality.linkage_quality_running(linked).first()
    assert (running.tp, running.fp, running.fn) == (2, 3, 1)
    assert running.precision == pytest.approx(2 / 5) and running.recall == pytest.approx(2 / 3)
    other = linking.link_catalogue(left.limit(1), spark.createDataFrame([("Alpha", ["Other"], ["m"], "1")], RIGHT))
    assert rows(other, "title", "title_wiki") == [("Alpha", None)]


def test_scores_of_no_rows(spark):
    empty = spark.createDataFrame([], LEFT + ", " + RIGHT)
    assert tuple(quality.linkage_quality(empty).first()) == (0, 0, 0, 0.0, 0.0)
    assert tuple(quality.linkage_quality_running(empty).first()) == (0, 0, 0, 0.0, 0.0)


@pytest.mark.parametrize("seed", [1, 2])
def test_link_is_the_left_outer_join(spark, seed):
    """One title and one director hold a third of the rows; lists repeat items, are empty or missing."""
    rnd = random.Random(seed)

    def title():
        return "hot" if rnd.random() < 0.4 else rnd.choice(["a", "b", "c", None])

    def people(extra):
        if rnd.random() < 0.1:
            return None if extra else []
        return [rnd.choice(["hot", "d1", "d2", "d3", "*", "=d1", "d4", *extra]) for _ in range(rnd.randint(1, 3))]

    left = [(title(), people(["more"])) for _ in range(60)]
    right = [(title(), people([]), ["m"], str(i)) for i in range(60)]
    expected = []
    for t, d in left:
        found = [
            r for r in right if t is not None and t == r[0] and d and ("more" in d or set(d) & set(r[1] or []))
        ]
        expected += [(t, d, *r) for r in found] or [(t, d, None, None, None, None)]
    got = linking.link_catalogue(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT))
    assert rows(got, "*") == sorted(expected, key=str)


KEYWORDS = ["Star Trek", "é_ü", "a", "_", "", "abc", "Ann Lee", "https://en.w.org/wiki/Star_Trek", "trek", "aaaaaaaaaaaa", "x" * 40]


def test_keyword_links_are_all_containments(spark):
    rnd = random.Random(7)
    links = ["https://en.w.org/wiki/Star_Trek" + str(i % 5) for i in range(30)]  # a crowd under every gram
    links += ["".join(rnd.choice("aab_éü") for _ in range(rnd.randint(0, 30))) for _ in range(60)] + [None, "", "x" * 41]
    expected = {(k, l) for k in KEYWORDS for l in links if l is not None and k.replace(" ", "_") in l}
    words = spark.createDataFrame([(k,) for k in KEYWORDS + ["a", None]], "keyword string")
    table = spark.createDataFrame([(l, i) for i, l in enumerate(links)], "link string, id int")
    got = rows(linking.keyword_links(words, table), "keyword", "link")
    assert got == sorted(expected, key=str)
    some = spark.createDataFrame([("Star Trek",), ("é ü",)], "keyword string")
    kept = rows(linking.match_keywords_to_links(some, table), "id")
    assert kept == sorted(((i,) for i, l in enumerate(links) if l and ("Star_Trek" in l or "é_ü" in l)), key=str)
    none = spark.createDataFrame([], "keyword string")
    assert linking.match_keywords_to_links(none, table).count() == 0


def test_enrich_overwrites_only_what_is_found(spark):
    cat = spark.createDataFrame([("a", ["more"], "1999"), ("b", ["x"], None), ("c", ["more"], None)],
                                "title string, director_list array<string>, release string")
    det = spark.createDataFrame([("a", "2000", ["w"], None, ["d"]), ("b", None, [], "m", ["d"])],
                                "title string, release_date string, writers array<string>, composer string, directors array<string>")
    got = {r.title: (r.director_list, r.release, r.writer, r.music) for r in linking.enrich(cat, det).collect()}
    assert got == {"a": (["d"], "2000", ["w"], None), "b": (["x"], None, [], "m"), "c": (["more"], None, None, None)}


# -- dedup -----------------------------------------------------------------------------------------------
def in_turn(existing, new):
    urls, directors, kept = {u for u, _ in existing}, {d for _, d in existing}, []
    for ordinal, url, director in new:
        if url not in urls and director not in directors:
            urls.add(url)
            directors.add(director)
            kept.append((ordinal, url, director))
    return sorted(kept, key=str)


@pytest.mark.parametrize("unique", [True, False])
def test_first_per_director(spark, unique):
    rnd = random.Random(3)
    new = [(i, f"u{i if unique else rnd.randint(0, 25)}", "hot" if rnd.random() < 0.3 else f"d{rnd.randint(0, 30)}")
           for i in range(120)]
    existing = [("u1", "d1"), ("u2", "d2")]
    got = dedup.first_per_director(
        spark.createDataFrame(new, "ordinal int, url string, director string"),
        spark.createDataFrame(existing, "url string, director string"), unique_urls=unique,
    )
    assert rows(got, "ordinal", "url", "director") == in_turn(existing, new)


def test_merge_keeps_the_existing_row_and_is_idempotent(spark):
    old = spark.createDataFrame([(5, "a", "old"), (6, "b", "old"), (7, "a", "later")], "ordinal int, url string, v string")
    new = spark.createDataFrame([(1, "a", "new"), (2, "c", "new"), (3, "c", "later")], "ordinal int, url string, v string")
    merged = dedup.merge_by_key(old, new)
    assert rows(merged, "url", "v") == [("a", "old"), ("b", "old"), ("c", "new")]
    assert rows(dedup.merge_by_key(merged, new), "*") == rows(merged, "*")
    assert rows(dedup.merge_by_key(merged, new, existing_is_unique=True), "*") == rows(merged, "*")


# -- size ------------------------------------------------------------------------------------------------
def test_byte_budget_is_the_longest_prefix(spark, monkeypatch):
    monkeypatch.setattr(budget, "FANOUT", 3)
    rnd = random.Random(5)
    ordinals = sorted(rnd.sample(range(-50, 5000), 40))
    pages = [(o, "u" * rnd.randint(0, 5), None if rnd.random() < 0.1 else "é" * rnd.randint(0, 9)) for o in ordinals]
    df = spark.createDataFrame(pages, "ordinal int, url string, html string").coalesce(1).cache()
    total = sum(len(u) + 2 * len(h or "") for _, u, h in pages)
    for limit in (-1, 0, 1, total // 3, total - 1, total, total + 1):
        run, expected = 0, []
        for o, u, h in pages:
            run += len(u) + 2 * len(h or "")
            if run <= limit:
                expected.append((o,))
        assert rows(budget.byte_budget(df, limit), "ordinal") == sorted(expected, key=str), limit
    assert budget.byte_budget(df.filter("false"), 10).count() == 0


def test_null_fill(spark):
    df = spark.createDataFrame([(None, None, 1)], "a string, b array<string>, c int")
    assert tuple(quality.null_fill(df).first()) == ("not found", ["not found"], 1)


# -- graph -----------------------------------------------------------------------------------------------
@pytest.mark.parametrize("hub_degree", [1_000_000, 5])
def test_reach_has_least_depths(spark, hub_degree):
    rnd = random.Random(11)
    edges = [("hub", f"n{i}") for i in range(40)] + [(f"n{rnd.randint(0, 60)}", f"n{rnd.randint(0, 60)}") for _ in range(70)]
    edges += [("s", "hub"), ("n3", "hub"), ("n1", "s")]
    depth, level = {"s": 0, "lone": 0}, {"s", "lone"}
    for d in range(1, 5):
        level = {b for a, b in edges if a in level} - set(depth)
        depth.update({n: d for n in level})
    got = graph.reach(
        spark.createDataFrame(edges, "src_url string, dst_url string"),
        spark.createDataFrame([("s",), ("lone",), ("s",)], "url string"), 4, hub_degree=hub_degree,
    )
    assert rows(got, "url", "depth") == sorted(depth.items(), key=str)


# -- detail pages: linear forms against the plain patterns -----------------------------------------------
PIECES = ["Music by", "<a href=x>", "<a>", "</a>", "<th>", "<th c>", ">P", ">Q", "Mo", "\n", " ", "<abbr>", "P",
          "Directed by</th><td ", "<th>Created by</th><td ", "</a></td>", "<a href", ">", "<b>"]


def pieced(seed, n):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(3, 22))) for _ in range(n)]


def test_composer_and_single_names_follow_the_plain_patterns(spark):
    texts = pieced(1, 3000) + ["Music by" + t for t in pieced(2, 3000)]
    texts += ["<th>Created by</th><td " + t for t in pieced(3, 2000)] + ["Directed by</th><td " + t for t in pieced(4, 2000)]
    composer, creator, director = map(regex.compile, (fixed.PLAIN_COMPOSER, fixed.PLAIN_CREATOR, fixed.PLAIN_DIRECTOR))
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    x = F.col("x")
    got = df.select("x", details.detail_composer(x).alias("m"), details.detail_directors(x).alias("d")).collect()
    hits = 0
    for row in got:
        music = composer.search(row.x)
        assert row.m == (music.group(1) if music else None), row.x
        one, two = creator.search(row.x), director.search(row.x)
        names = [one.group(1)] if one else [two.group(1)] if two else None
        assert row.d == names, row.x
        hits += (music is not None) + (names is not None)
    assert hits > 300


# -- pages: first of wide rows, strict infobox fields ----------------------------------------------------
def test_wide_rows_with_missing_keys_ordinals_and_ties(spark):
    data = [("a", 2, "x"), ("a", 1, "y"), ("a", 1, "z"), (None, 5, "n"), (None, None, "m"), ("b", None, "p"), ("c", 3, "q"), ("c", 3, "q")]
    df = spark.createDataFrame(data, "url string, ordinal int, html string")
    got = rows(dedup.distinct_url(df, "ordinal"), "url", "ordinal", "html")
    assert [r[:2] for r in got] == sorted([("a", 1), (None, None), ("b", None), ("c", 3)], key=str)
    assert got == rows(dedup.distinct_url(df.orderBy(F.desc("html")), "ordinal"), "url", "ordinal", "html")
    merged = dedup.merge_by_key(df.filter("url = 'a'"), df.filter("url IS NULL OR url <> 'b'"))
    assert rows(merged, "url", "ordinal") == sorted([("a", 1), (None, None), ("c", 3)], key=str)
    assert dedup.distinct_url(df.limit(0), "ordinal").isEmpty()


def test_unique_wide_rows_are_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "pages")
    spark.range(50).select(F.concat(F.lit("u"), "id").alias("url"), F.col("id").alias("ordinal"), F.lit("h").alias("html")).write.parquet(path)
    plan = dedup.distinct_url(spark.read.parquet(path), "ordinal")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "hashpartitioning" not in plan and "BroadcastHashJoin" in plan


@pytest.mark.parametrize(
    "line, directors, year",
    [
        ("| director = [[Ann Lee|Ann]]<br>[[Bo]] (TV)\n| released = 14 May 1960", ["Ann Lee", "Bo"], "1960"),
        ("| director = {{plainlist|\n* [[A]]\n* B C\n}}\n| released = {{Film date|df=yes|1999|1|2}}", ["A", "B C"], "1999"),
        ("| director =\n| released = {{Film date|2001}}", ["not found"], "2001"),
        ("| music = X", ["not found"], "not found"),
    ],
)
def test_strict_infobox(value, line, directors, year):
    text = "{{Infobox film\n" + line + "\n}}"
    assert value(lambda c: infobox.infobox_directors(c, strict=True), text) == directors
    assert value(lambda c: infobox.infobox_release_year(c, strict=True), text) == year


def test_reach_salts_hubs_and_lays_edges_out_once(spark):
    edges = [("h", f"n{i}") for i in range(40)] + [("n1", "z"), ("z", "h"), ("h", "h"), (None, "n2")]
    df = spark.createDataFrame(edges, "src_url string, dst_url string")
    seeds = spark.createDataFrame([("h",), (None,)], "url string")
    expected = sorted([("h", 0), ("z", 2)] + [(f"n{i}", 1) for i in range(40)], key=str)
    for degree in (10, 1_000_000):
        assert rows(graph.reach(df, seeds, 5, hub_degree=degree), "url", "depth") == expected


def test_very_many_keywords_are_pruned_and_shuffled_with_the_same_pairs(spark, monkeypatch):
    """Keywords that share their commonest gram with no link are left out; no link is fetched by its number again."""
    monkeypatch.setattr(linking, "MANY_GRAMS", 0)
    monkeypatch.setattr(linking, "SMALL_BYTES", 0)
    words = [f"Customer#{i:09}" for i in range(40)] + [f"Supplier#{i:09}" + " x" * (i % 2) for i in range(40)] + ["ab", "é", "", None]
    links = [f"http://a/hot_Supplier#{i:09}" for i in range(30)] + ["", None, "cab", "é"]
    table = spark.createDataFrame([(l,) for l in links], "link string")
    keywords = spark.createDataFrame([(w,) for w in words], "keyword string")
    expected = {(w, l) for w in words if w is not None for l in links if l is not None and w.replace(" ", "_") in l}
    found = linking.keyword_links(keywords, table)
    assert rows(found, "keyword", "link") == sorted(expected, key=str)
    text = found._jdf.queryExecution().analyzed().toString()
    assert text.count("Join") == 2  # grams and the empty keyword
    kept = rows(linking.match_keywords_to_links(keywords, table), "link")
    assert kept == sorted(((l,) for l in links if l is not None), key=str)
