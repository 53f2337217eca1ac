"""The bucketed store and the walk on it: merges in place, batches again after a failure, walks gone on with."""

import random

import pytest
from pyspark.sql import functions as F

from filmweave.operators import dedup, graph
from filmweave.sources.store import BucketedStore, page_store

PAGES = "ordinal long, url string, html string"


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), PAGES)


def held(store):
    return sorted(map(tuple, store.table().drop("batch").collect()), key=str)


@pytest.fixture
def batches(spark):
    rng = random.Random(2)
    urls = [f"u{i}" for i in range(60)] + [None]
    return [pages(spark, *[(i, rng.choice(urls), f"b{b} {i}") for i in range(80)]) for b in range(3)]


def test_merges_give_what_merge_by_key_gives(spark, tmp_path, batches):
    store = page_store(spark, str(tmp_path / "store"), 4)
    whole = pages(spark)
    for i, batch in enumerate(batches):
        before = whole.count()
        whole = dedup.merge_by_key(whole, batch, existing_is_unique=True)
        assert store.merge(batch, i) == whole.count() - before
    assert held(store) == sorted(map(tuple, whole.collect()), key=str)
    again = page_store(spark, str(tmp_path / "store"), 99)
    assert again.buckets == 4 and held(again) == held(store) and list(again.batches()) == [0, 1, 2]


def test_a_batch_that_failed_is_written_again(spark, tmp_path, batches, monkeypatch):
    store = page_store(spark, str(tmp_path / "store"), 4)
    store.merge(batches[0], 0)
    before = held(store)

    class Failed(Exception):
        pass

    def fail(*_):
        raise Failed

    monkeypatch.setattr(store.spark.catalog.__class__, "refreshTable", fail)
    with pytest.raises(Failed):
        store.merge(batches[1], 1)  # written, not committed
    monkeypatch.undo()
    assert held(store) == before
    store.merge(batches[1], 1)
    once = held(store)
    store.merge(batches[1], 1)
    assert held(store) == once and len({r[1] for r in once}) == len(once)
    with pytest.raises(ValueError):
        store.append(batches[2], 0)


def above_scans(df):
    """For each scan of a bucketed store, the operators between it and the first join above it."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    found = []
    for i, line in enumerate(lines):
        if "FileScan" in line and "Bucketed: true" in line:
            at, path = depth(line), []
            for above in reversed(lines[:i]):
                if depth(above) < at:
                    at = depth(above)
                    if "Join" in above:
                        break
                    path.append(above.strip(" :+-").split(" ")[0])
            found.append(path)
    return found


def test_the_store_is_not_shuffled(spark, tmp_path, batches):
    store = page_store(spark, str(tmp_path / "store"), 4)
    store.merge(batches[0], 0)
    fresh = store.unseen(batches[1])
    assert "Exchange" not in above_scans(fresh)[0] and "Sort" in above_scans(fresh)[0]
    assert "html" not in fresh._jdf.queryExecution().executedPlan().toString().split("Bucketed: true")[1].split("\n")[0]


def test_two_walks_of_two_levels_are_one_of_four(spark, tmp_path):
    rng = random.Random(4)
    links = [(f"n{rng.randint(0, 300)}", f"n{rng.randint(0, 300)}") for _ in range(400)] + [("n1", f"h{i}") for i in range(50)] + [("n2", None)]
    edges = spark.createDataFrame(links, "src_url string, dst_url string")
    seeds = spark.createDataFrame([("n1",), ("n2",), ("n2",), (None,)], "url string")
    path = str(tmp_path / "walk")
    graph.Walk(spark, path, 4).start(edges, seeds, hub_degree=20).extend(2)
    later = graph.Walk(spark, path).start(edges.limit(0), seeds.limit(0)).extend(2)
    whole = sorted(map(tuple, graph.reach(edges, seeds, 4).collect()))
    assert sorted(map(tuple, later.reached().collect())) == whole and max(d for _, d in whole) == 4
    end = graph.Walk(spark, path).extend(50)
    assert sorted(map(tuple, end.extend(3).reached().collect())) == sorted(map(tuple, graph.reach(edges, seeds, 60).collect()))


def test_a_level_shuffles_neither_edges_nor_visited_nodes(spark, tmp_path):
    edges = spark.createDataFrame([(f"n{i}", f"n{(i * 7) % 50}") for i in range(50)], "src_url string, dst_url string")
    walk = graph.Walk(spark, str(tmp_path / "walk"), 4).start(edges, spark.createDataFrame([("n1",)], "url string")).extend(2)
    paths = above_scans(walk.found(2))
    # The edges and the visited nodes go into their joins as they lie; the frontier is read from the visited store, too.
    assert sum("Exchange" not in p for p in paths) >= 2
