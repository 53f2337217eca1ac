"""A persistent table bucketed and sorted by key, which grows by committed batches.

The buckets lie as a join wants them, so merges and anti joins read the store in place: it is never shuffled and never
rewritten, and of it only the key column is read. A batch is a partition of its own. It is written whole, then committed
by a line in the manifest; readers see committed batches alone. A batch whose write or job failed is written again over
what is left of it, with the same outcome.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import first_of_wide

BUCKETS = 64
_MANIFEST = "batch BIGINT, rows BIGINT, buckets INT"
_MODE = "spark.sql.sources.partitionOverwriteMode"


class BucketedStore:
    """The store in folder ``path``, which all executors share; opened again, also by a later session, it goes on.

    ``schema`` is a list of columns as in DDL, ``key`` one or several of them. ``buckets`` counts for a new store only: a few
    for each core that will read it.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str | list[str], buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.keys = spark, path, [key] if isinstance(key, str) else key
        lines = self._manifest()
        self.buckets = lines[-1]["buckets"] if lines else buckets
        self.committed = {line["batch"]: line["rows"] for line in lines}  # there is one writer at a time
        self.name = "store_" + hashlib.sha256(path.encode()).hexdigest()[:32]
        by = ", ".join(f"`{k}`" for k in self.keys)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({schema}, batch BIGINT) USING parquet PARTITIONED BY (batch) "
            f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{path}/rows'"
        )
        if lines:
            spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")

    def _manifest(self) -> list:
        try:
            lines = self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/commits/*").collect()  # a line for each batch
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            lines = []
        return sorted(lines, key=lambda line: line["batch"])

    def batches(self) -> dict[int, int]:
        """Rows of each committed batch, in order."""
        return dict(self.committed)

    def table(self, before: int | None = None) -> DataFrame:
        """Rows of the committed batches, or of those before one, with ``batch``."""
        seen = [b for b in self.batches() if before is None or b < before]
        return self.spark.table(self.name).where(F.col("batch").isin(seen) if seen else F.lit(False))

    def append(self, rows: DataFrame, batch: int) -> int:
        """Write a batch and commit it; gives its number of rows. The last batch may be written again, earlier ones not."""
        last = max(self.batches(), default=batch)
        if batch < last:
            raise ValueError(f"batch {batch} is behind the last one, {last}")
        table = self.spark.table(self.name)
        columns = [F.col(f"`{c}`") for c in table.columns if c != "batch"]
        # One task for each bucket, so a batch adds one file to each.
        ready = rows.repartition(self.buckets, *self.keys).select(*columns, F.lit(batch).cast("bigint").alias("batch"))
        before = self.spark.conf.get(_MODE)
        self.spark.conf.set(_MODE, "dynamic")  # what is left of this batch goes, others stay
        try:
            ready.write.mode("overwrite").insertInto(self.name)
        finally:
            self.spark.conf.set(_MODE, before)
        self.spark.catalog.refreshTable(self.name)
        count = self.spark.table(self.name).where(F.col("batch") == batch).count()  # of the files' footers
        line = self.spark.createDataFrame([(batch, count, self.buckets)], _MANIFEST)
        line.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/{batch}")
        self.committed[batch] = count
        return count

    def unseen(self, rows: DataFrame, before: int | None = None) -> DataFrame:
        """``rows`` whose key no committed batch (before one) holds. Only ``rows`` are shuffled; a missing key is a key."""
        held = self.table(before).select(*self.keys)
        some = " OR ".join(f"`{k}` IS NULL" for k in self.keys)
        fresh = rows.where(f"NOT ({some})").join(held.hint("merge"), self.keys, "left_anti")
        # Missing keys are few distinct ones; a test for NULL reaches the scan.
        holes = held.where(some).distinct().select(*[F.col(f"`{k}`").alias(f"_held{i}") for i, k in enumerate(self.keys)])
        same = [F.col(f"`{k}`").eqNullSafe(F.col(f"_held{i}")) for i, k in enumerate(self.keys)]
        return fresh.select(*rows.columns).unionByName(rows.where(some).join(holes, same, "left_anti"))

    def merge(self, new: DataFrame, batch: int, ordinal: str = "ordinal") -> int:
        """Append the rows of ``new`` with an unseen key, the first one per key; what the store holds wins. Gives their number."""
        if len(self.keys) != 1:
            raise ValueError("a merge goes by a single key")
        return self.append(first_of_wide(self.unseen(new, batch), self.keys[0], ordinal), batch)


def page_store(spark: SparkSession, path: str, buckets: int = BUCKETS) -> BucketedStore:
    """A store of fetched pages, one for each url."""
    return BucketedStore(spark, path, "ordinal BIGINT, url STRING, html STRING", "url", buckets)
