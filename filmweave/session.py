"""Session settings and durable intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the plans are written for; all can be set on a running session.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Rows cost much more work than their bytes tell, so small shuffles keep all cores busy.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # The JVM does not compile longer methods; Spark then falls back to smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where that costs one more shuffle after the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Parquet may hold ten times its size or more. Before a run only truly small files may be broadcast;
    # during it, AQE goes by measured sizes.
    "spark.sql.sources.fileCompressionFactor": "10",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to a session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


#: The database that :func:`stage` writes to inside :func:`staging`, by context.
_SCOPE: ContextVar[str | None] = ContextVar("scope", default=None)


def staging_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the session's ``spark.checkpoint.dir``; with a local master else its warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_staging"


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh path under :func:`staging_root`."""
    return f"{staging_root(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Tables that are staged in this scope are dropped, files and all, when it ends; write results before that.

    ::

        with staging(spark):
            linked_table(catalogue, dump).write.parquet(path)
    """
    name = f"staged_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{staging_path(spark, 'scope')}'")
    token = _SCOPE.set(name)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        spark.sql(f"DROP DATABASE {name} CASCADE")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage, computes an input with several readers once, and survives the loss of executors.
    """
    spark, scope = df.sparkSession, _SCOPE.get()
    if scope:
        table = f"{scope}.t{uuid.uuid4().hex}"
        df.write.format("parquet").saveAsTable(table)
        return spark.table(table)
    path = staging_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
