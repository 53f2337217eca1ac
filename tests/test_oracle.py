"""Every registered query against its SQL, over the smallest test tables."""

import re

import pytest

import __spark_entry__ as entry

from .compare import difference, oracle

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return oracle(SF)


@pytest.mark.parametrize("name", [name for group in entry.GROUPS for name in group.CHECKS.oracles])
def test_query(spark, db, name):
    assert difference(spark, db, SF, QUERIES[name], SQL[name]) is None


def test_every_query_has_sql():
    assert {name for name in QUERIES if not re.match(r"op\d+_|pipeline$", name)} <= set(SQL) <= set(QUERIES)
