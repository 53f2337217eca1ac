"""Tokens of a line."""

import pytest
from pyspark.sql import functions as F

from filmweave.llm import templates


@pytest.mark.parametrize(
    ("line", "expected"),
    [
        ("a b", ["a", "b"]), ("  a \t b\r", ["a", "b"]), ("a\x0bb\fc\nd", ["a", "b", "c", "d"]), ("a1\tb 22", ["<*>", "b", "<*>"]),
        ("a\xa0b c\x85d", ["a\xa0b", "c\x85d"]), ("٣ x", ["٣", "x"]), (" \t ", []), ("", []), (None, None),
    ],
)
def test_tokens(value, line, expected):
    assert value(templates.tokens, line) == expected


def test_tokens_split_on_a_plain_blank(spark):
    shown = spark.createDataFrame([("a",)], "x string").select(templates.tokens(F.col("x")))._jdf.queryExecution().analyzed().toString()
    assert r"\s+" not in shown, shown
