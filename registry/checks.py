"""A group of checked queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import inputs
from .sqltext import joined


class Checks:
    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, run: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> None:
        self.queries[name] = run
        if sql is not None:
            self.oracles[name] = sql

    def column(
        self,
        name: str,
        source: str,
        expression: Callable[[], Column],
        sql: str,
        kept: str = "k",
        out: str = "value",
        is_list: bool = False,
    ) -> None:
        """A query that puts one column function over a source, lists shown as text."""

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            value = F.array_join(expression(), "|") if is_list else expression()
            return inputs.load(spark, sf_dir, source).select(*kept.split(", "), value.alias(out))

        self.add(name, run, f"WITH t AS ({source}) SELECT {kept}, {joined(sql) if is_list else sql} AS {out} FROM t")
