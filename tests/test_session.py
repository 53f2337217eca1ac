"""Staged tables: where they go, and that a scope leaves nothing behind."""

import os

import pytest

from filmweave import session
from filmweave.operators import linking


def folders(spark):
    root = session.staging_root(spark).removeprefix("file:")
    return {os.path.join(d, n) for d, _, names in os.walk(root) for n in names if n.endswith(".parquet")}


def test_a_scope_drops_what_was_staged_in_it(spark, tmp_path):
    left = spark.createDataFrame([("a", ["b"]), ("c", ["more"])], "title string, director_list array<string>")
    right = spark.createDataFrame([("a", ["b"]), ("c", ["x"])], "title_wiki string, director_wiki array<string>")
    plain = sorted(map(str, linking.link_catalogue(left, right).collect()))
    before = folders(spark)
    with session.staging(spark):
        linked = linking.link_catalogue(left, right)
        assert folders(spark) > before
        linked.write.parquet(str(tmp_path / "linked"))
    assert folders(spark) == before
    assert sorted(map(str, spark.read.parquet(str(tmp_path / "linked")).collect())) == plain


def test_a_scope_ends_after_an_error(spark):
    before = folders(spark)
    with pytest.raises(ZeroDivisionError), session.staging(spark):
        session.stage(spark.range(3), "numbers")
        raise ZeroDivisionError
    assert folders(spark) == before and session._SCOPE.get() is None


def test_without_a_shared_folder_a_cluster_is_an_error():
    class Conf:
        def get(self, key, default=None):
            return default if key == "spark.checkpoint.dir" else "/warehouse"

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="checkpoint"):
        session.staging_root(Session)
    Session.sparkContext.master = "local[4]"
    assert session.staging_root(Session) == "/warehouse/_staging"
