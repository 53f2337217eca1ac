"""Run queries and their SQL side by side.

    python -m tests.compare [sf] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    return v


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_value(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(table, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


KINDS = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def difference(spark, db, sf_dir, run, sql) -> str | None:
    """None when both give the same columns and rows, else a short description."""
    df = run(spark, sf_dir)
    mine = _sorted(df.columns, [tuple(r) for r in df.collect()])
    found = db.execute(sql)
    found_types = list(found.description)
    theirs = _sorted([d[0] for d in found_types], found.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} / {theirs[0]}"
    kinds = {d[0]: str(d[1]) for d in found_types}
    other_kinds = {c: (t, kinds[c]) for c, t in df.dtypes if KINDS.get(t, t) != kinds[c]}
    if other_kinds:
        return f"types {other_kinds}"
    if not mine[1]:
        return "no rows"
    if mine[1] != theirs[1]:
        ours, other = set(mine[1]), set(theirs[1])
        return (
            f"rows {len(mine[1])} / {len(theirs[1])}, only ours {len(ours - other)}: "
            f"{[str(r)[:600] for r in list(ours - other)[:2]]}, only SQL {len(other - ours)}: "
            f"{[str(r)[:600] for r in list(other - ours)[:2]]}"
        )
    return None


def main() -> None:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = oracle(sf_dir)
    sql = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        if name not in sql:
            continue
        start = time.time()
        try:
            found = difference(spark, db, sf_dir, run, sql[name])
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += found is not None
        print(f"{name:28} {time.time() - start:6.1f}s  {'ok' if found is None else 'DIFFERS ' + found}", flush=True)
    print("differing:", bad)


if __name__ == "__main__":
    main()
