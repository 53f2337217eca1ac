"""Exact dedup over a persistent digest index.

The index is a Parquet table of ``digest, keep_id, batch``, bucketed and sorted by digest, with one row for each
distinct text ever seen. A batch is first cut to one row per digest (an aggregate, so a text that a third of all rows
share is one row per task before the shuffle), then anti-joined with the index by a sort-merge join that reads the
buckets as they lie, and what is new is appended. The index is append-only: what a failed write left is found again when
its batch is added again.

Texts are equal when identical after lower-casing A-Z. Of equal texts within a batch the row with the largest id
stays; a text that an earlier batch brought stays with that batch's row. A batch that is added again, say after its job
failed behind the append, gets the same answers and adds nothing.

Defined cases: NULL counts as empty, so NULL and empty texts are one group; a NULL id stays only if its group has no
other; of rows with the same id and text all are reported as kept; extra columns are not read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage, staging_path
from .common import text_or_empty

BATCHES = 2  # of the whole table, see deduplicate
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SCHEMA = "digest STRING, keep_id BIGINT, batch BIGINT"


def text_digest(text: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the text with A-Z lower-cased, in UTF-8."""
    return F.sha2(F.translate(text_or_empty(text), _UPPER, _LOWER).cast("binary"), 256)


class DigestIndex:
    """An index in a folder that all executors share. Opening the same folder again goes on with what it holds.

    ``buckets`` is fixed when the folder is new: a few for each core that will read it, by default the session's shuffle
    partitions. A writer deals a batch out to as many tasks, so it adds one file to each bucket.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None) -> None:
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = "digests_" + hashlib.sha256(path.encode()).hexdigest()[:32]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({SCHEMA}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) "
            f"INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def new_rows(self, batch: DataFrame) -> DataFrame:
        """Rows of ``batch`` (one per ``digest``) that the index doesn't hold; the index isn't shuffled."""
        return batch.join(self.table().select("digest").hint("merge"), "digest", "left_anti")

    def append(self, rows: DataFrame, batch: int) -> None:
        rows = rows.select("digest", F.col("keep_id").cast("long"), F.lit(batch).cast("long").alias("batch"))
        # One writer for each bucket, so a batch adds one file to each.
        rows = rows.repartition(self.buckets, "digest")
        writer = rows.write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest")
        writer.saveAsTable(self.name)

    def add(self, documents: DataFrame, batch: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """Take in a batch: ``doc_id, digest, keep_id, group_size, kept`` for each of its rows. Runs jobs when called.

        ``group_size`` counts the batch's rows with that text, ``keep_id`` is the row that stays, of whichever batch.
        """
        return self.add_digests(digests(documents, doc_id, text), batch)

    def add_digests(self, rows: DataFrame, batch: int) -> DataFrame:
        """:meth:`add` for rows ``doc_id, digest``, which are staged."""
        groups = rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        groups = stage(groups, "groups")
        self.append(self.new_rows(groups.select("digest", "keep_id")), batch)
        # Rows that stand alone and are new need no look-up. For the others both sides are shuffled plainly, so that
        # AQE can split the rows of a frequent text.
        held = self.table().where(F.col("batch") <= batch).select("digest", "keep_id", (F.col("batch") == batch).alias("_now"))
        seen = groups.select("digest", "group_size").join(held.hint("merge"), "digest").where("NOT _now OR group_size > 1")
        seen = stage(seen, "seen")
        found = rows.join(seen.withColumn("_hit", F.lit(True)), "digest", "left")
        keep_id = F.when(F.col("_hit"), F.col("keep_id")).otherwise(F.col("doc_id"))
        return found.select(
            "doc_id",
            "digest",
            keep_id.alias("keep_id"),
            F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
            (keep_id.eqNullSafe(F.col("doc_id")) & F.coalesce("_now", F.lit(True))).alias("kept"),
        )


def digests(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, digest`` of all documents; staged, so texts are read once."""
    return stage(documents.select(F.col(f"`{doc_id}`").alias("doc_id"), text_digest(F.col(f"`{text}`")).alias("digest")), "digests")


def deduplicate(documents: DataFrame, batches: int = BATCHES) -> DataFrame:
    """Verdicts on all documents, taken into a new index batch by batch, the largest ids first. Runs jobs when called.

    So the row that stays is that with the largest id of all. ``group_size`` counts the rows of all batches.
    """
    spark = documents.sparkSession
    index = DigestIndex(spark, staging_path(spark, "digest-index"))
    rows = digests(documents)
    cuts = sorted(set(rows.approxQuantile("doc_id", [i / batches for i in range(1, batches)], 0.01)), reverse=True)
    bounds = [F.col("doc_id") >= int(c) for c in cuts] + [F.lit(True)]
    found, above = None, F.lit(False)
    for batch, bound in enumerate(bounds):
        part = rows.where(F.coalesce(bound, F.lit(False)) & ~above)
        above = F.coalesce(bound, F.lit(False)) | above
        verdicts = index.add_digests(part, batch).drop("group_size")
        found = verdicts if found is None else found.unionByName(verdicts)
    sizes = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size")).where("group_size > 1")
    found = found.join(stage(sizes, "sizes"), "digest", "left")
    return found.select("doc_id", "digest", "keep_id", F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), "kept")
