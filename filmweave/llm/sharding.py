"""Sharding by proportional stratified interleaving.

Rows are put in a seeded random order within each source, a row at rank ``r`` of ``n`` gets the fraction ``(r - 1/2) /
n``, all rows are ordered by fraction and cut into shards of equal counts. So each shard, and each stretch of it,
holds the sources in the proportion of the whole.

Both orders are found without a sort of the whole by one task: rows fall into ``CELLS`` cells by hash (or fraction),
cells are counted, running sums of the counts give each cell its first rank, and rows are numbered within cells. A
source that holds most rows spreads over all cells.

The order is a hash of seed, id and text, so neither the layout of the input nor its order decides. Rows that are equal in
all of these are numbered, by partition and with running sums, and the number is hashed too: however many they are, they
lie in all cells, and which of them is which makes no difference.

Defined cases: NULL text has no bytes, checksum 0; NULL is a source of its own; rows with one id and different texts are in
an order of their own; repeated rows too; extra columns stay. An empty table gives no
rows; with fewer rows than shards some shards stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage
from .common import text_or_empty, whole_row

SHARDS = 40
CELLS = 4096
SEED = 5


def _numbered(rows: DataFrame, strata: list[str], cell: str, order: list[str], out: str) -> DataFrame:
    """``rows`` with ``out``, the 0-based place by ``cell`` and ``order`` within ``strata``; ``rows`` should be staged."""
    counts = rows.groupBy(*strata, cell).agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*strata).orderBy(cell).rowsBetween(W.unboundedPreceding, -1)
    firsts = stage(counts.select(*strata, cell, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")), "cells")
    within = rows.withColumn("_in", F.row_number().over(W.partitionBy(*strata, cell).orderBy(*order)) - 1)
    return within.join(firsts, [*strata, cell]).withColumn(out, F.col("_first") + F.col("_in")).drop("_first", "_in")


def _hashed(rows: DataFrame, seed: int) -> DataFrame:
    """``rows`` (``_row, source, doc_id, _text`` and others, staged) with ``_hash``, distinct but for chance. Runs jobs."""
    first = F.xxhash64(F.lit(seed), F.col("source"), F.col("doc_id"), F.col("_text"))
    ready = rows.withColumn("_same", first)
    repeated = stage(ready.groupBy("_same").agg(F.count(F.lit(1)).alias("_times")).where("_times > 1").select("_same"), "repeated")
    if repeated.isEmpty():
        return ready.withColumn("_hash", F.xxhash64("_same", F.lit(0).cast("long"))).drop("_same")
    # Copies are numbered within the parts of the table they lie in, behind those of the parts before.
    part = F.shiftright("_row", 33).alias("_part")
    copies = stage(ready.select("_row", "_same", part).join(repeated, "_same", "left_semi"), "copies")
    counts = copies.groupBy("_same", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("_same").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = stage(counts.select("_same", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")), "starts")
    within = copies.withColumn("_in", F.row_number().over(W.partitionBy("_same", "_part").orderBy("_row")) - 1)
    numbers = within.join(starts, ["_same", "_part"]).select("_row", (F.col("_start") + F.col("_in")).alias("_number"))
    ready = ready.join(stage(numbers, "numbers"), "_row", "left")
    return ready.withColumn("_hash", F.xxhash64("_same", F.coalesce("_number", F.lit(0).cast("long")))).drop("_same", "_number")


def interleaved(rows: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``rows`` (``_row, source, doc_id, _text`` and others, staged) with ``shard`` and ``slot``; ``_text`` is a hash of the text. Runs jobs."""
    name = F.xxhash64(F.lit(seed), F.col("source").isNull(), F.col("source"))
    ready = _hashed(rows, seed).withColumn("_stratum", name).withColumn("_cell", F.pmod("_hash", F.lit(CELLS)))
    ready = _numbered(stage(ready, "hashed"), ["_stratum"], "_cell", ["_hash", "_row"], "_rank")
    sizes = stage(rows.groupBy(name.alias("_stratum")).agg(F.count(F.lit(1)).alias("_of")), "strata")
    # Rank and size as whole numbers: the fraction is compared by its cell, then as a quotient.
    ranked = ready.join(sizes, "_stratum").withColumn("_fraction", (F.col("_rank") * 2 + 1) / (F.col("_of") * 2))
    ranked = ranked.withColumn("_slice", F.least(F.floor(F.col("_fraction") * CELLS), F.lit(CELLS - 1)).cast("int"))
    ranked = stage(ranked.drop("_cell", "_rank", "_of"), "ranked")
    placed = _numbered(ranked, [], "_slice", ["_fraction", "_hash", "_row"], "_place")
    placed = placed.withColumn("_total", F.lit(rows.count()))
    shard = F.expr(f"_place * {shards} div _total")  # the last one whose start isn't behind the place
    placed = placed.withColumn("shard", shard.cast("int"))
    start = F.expr(f"(cast(shard AS BIGINT) * _total + {shards - 1}) div {shards}")
    return placed.withColumn("slot", F.col("_place") - start).drop("_place", "_total", "_stratum", "_hash", "_fraction", "_slice", "_text")


def assign(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for each document; texts are read once and not shuffled."""
    narrow = documents.select(
        "doc_id",
        "source",
        (F.octet_length(text_or_empty(F.col("text"))).cast("long") + 16).alias("size"),
        F.crc32(text_or_empty(F.col("text")).cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("_text"),
        F.monotonically_increasing_id().alias("_row"),
    )
    return interleaved(stage(narrow, "rows"), shards).drop("_row", "source")


def sharded(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``documents`` with ``shard`` and ``slot``, other columns as they were. Rows are staged once, whole."""
    number = F.monotonically_increasing_id().alias("_row")
    rows = stage(documents.select(whole_row(documents), "doc_id", "source", F.xxhash64("text").alias("_text"), number), "rows")
    placed = interleaved(rows.select("_row", "doc_id", "source", "_text"), shards).select("_row", "shard", "slot")
    kept = [F.col("whole").getField(c).alias(c) for c in documents.columns if c not in ("shard", "slot")]
    return rows.join(placed, "_row").select(*kept, "shard", "slot")
