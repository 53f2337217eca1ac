"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint is the bitwise majority of the hashes of all word shingles of a text. Fingerprints are linked when they
differ in at most two bits. Seven bit masks are derived from a map of the 64 bits to the nonzero vectors of three
bits: mask ``v`` holds the bits whose vector has an odd product with ``v``. Any two bits lie outside one common mask,
so each pair within the radius agrees on all bits of some mask, with certainty.

Equal fingerprints become one class first. Classes that agree under a mask form a bucket: two are a pair, up to
``SMALL`` are compared with each other. Larger buckets aren't: there each class names the points within one bit of it
(of the bits outside the mask), and two classes are linked exactly if they name a common point; no more than 65
classes can name one. So nothing is capped and no bucket makes more rows than a fixed number for each member.

Defined cases: NULL counts as empty; a text without words has fingerprint zero and links like any other; rows that
share a ``doc_id`` are documents of their own for the fingerprint and one in the components; extra columns stay out.
A NULL ``doc_id`` keeps its fingerprint and takes part; it is a component's id only if no other document is in it.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import by_slices, whole_row
from .components import components

SHINGLE = 3
SEED = 42
RADIUS = 2
SMALL = 16
_BLOCK = 1 << 18


def fingerprint(text: str, width: int = SHINGLE, seed: int = SEED) -> int:
    """Signed 64-bit majority of the shingles' hashes; memory is bounded by blocks of shingles."""
    words = text.encode("utf-8", "replace").lower().split()  # bytes: only A-Z change, only ASCII whitespace separates
    if not words:
        return 0
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes)
    joined = b" ".join(words)
    width = min(width, len(words))
    total = len(words) - width + 1
    ones = np.zeros(64, np.int64)
    starts = (ends - sizes).tolist()
    stops = (ends - 1).tolist()
    digest = xxhash.xxh64_intdigest
    for block in range(0, total, _BLOCK):
        until = min(total, block + _BLOCK)
        found = [digest(joined[a:b], seed) for a, b in zip(starts[block:until], stops[block + width - 1 : until + width - 1], strict=True)]
        bits = np.unpackbits(np.array(found, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprints(width: int = SHINGLE, seed: int = SEED):
    """Column function: a text's fingerprint as a long."""

    def run(texts: pa.Array) -> pa.Array:
        return by_slices(lambda part: [fingerprint(t, width, seed) for t in part.to_pylist()], texts, pa.int64())

    return F.arrow_udf(run, "long")


def masks(radius: int = RADIUS) -> list[int]:
    """Signed masks of the bits kept: one for each nonzero vector of ``radius + 1`` bits."""
    vectors = range(1, 1 << (radius + 1))
    of_bit = [1 + bit % len(vectors) for bit in range(64)]
    kept = [sum(1 << bit for bit in range(64) if (of_bit[bit] & v).bit_count() % 2) for v in vectors]
    return [m - (1 << 64) if m >> 63 else m for m in kept]


def _tables(points: DataFrame) -> DataFrame:
    """Every class under every mask: ``v, key, fp``."""
    keyed = F.array(*[F.struct(F.lit(i).alias("v"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks())])
    return points.select("fp", F.inline(keyed)).select("v", "key", "fp")


def _near(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= RADIUS


def links(points: DataFrame) -> DataFrame:
    """``a, b``: enough links between distinct fingerprints ``fp`` for all paths of steps of at most two bits.

    Runs jobs when called. Pairs in small buckets are all given; in larger ones those that name a common point are
    linked to the least of them.
    """
    rows = _tables(points)
    buckets = rows.groupBy("v", "key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
    buckets = stage(buckets.where("n > 1"), "buckets")
    pairs = buckets.where("n = 2").select("a", "b").where(_near(F.col("a"), F.col("b")))

    more = buckets.where("n > 2").select("v", "key", "n")
    members = stage(rows.join(more, ["v", "key"]), "members")
    small = members.where(F.col("n") <= SMALL).groupBy("v", "key").agg(F.collect_list("fp").alias("fps"))
    each = small.select("fps", F.explode("fps").alias("a")).select("a", F.explode("fps").alias("b"))
    pairs = pairs.unionByName(each.where((F.col("a") < F.col("b")) & _near(F.col("a"), F.col("b"))))

    outside = F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << bit)) for bit in range(64) if not m >> bit & 1]) for m in masks()])
    named = members.where(F.col("n") > SMALL).select("fp", F.explode(F.element_at(outside, F.col("v") + 1)).alias("flip"))
    named = named.select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point")).distinct()
    common = named.groupBy("point").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)  # 65 at most
    common = common.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b")
    return pairs.unionByName(common).distinct()


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def with_components(prints: DataFrame) -> DataFrame:
    """``prints`` (columns ``id`` and ``fp``, any order by ``id``) with ``component_id``, the least id of its component.

    Runs jobs when called. ``prints`` is read twice and should be staged.
    """
    classes = stage(prints.groupBy("fp").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")), "classes")
    roots = components(links(classes.select("fp")))
    linked = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    linked = stage(linked, "linked")
    firsts = stage(linked.groupBy("root").agg(F.min("first").alias("component_id")), "firsts")
    # Only classes of several documents or of a larger component need a join; it is narrow either way.
    changed = linked.join(firsts, "root").where((F.col("n") > 1) | ~F.col("component_id").eqNullSafe(F.col("first")))
    changed = stage(changed.select("fp", "component_id", F.lit(True).alias("_hit")), "changed")
    component = F.when(F.col("_hit"), F.col("component_id")).otherwise(F.col("id"))
    return prints.join(changed, "fp", "left").select("id", "fp", component.alias("component_id"))


def near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE) -> DataFrame:
    """``doc_id, fp, component_id`` for each document. Runs jobs when called; each step is staged."""
    prints = stage(documents.select(F.col(doc_id).alias("id"), fingerprints(width)(F.col(text)).alias("fp")), "prints")
    return with_components(prints).withColumnRenamed("id", "doc_id")


def keep_first(documents: DataFrame, width: int = SHINGLE) -> DataFrame:
    """``documents`` with one row of each component, that with the smallest id, columns as they were.

    Runs jobs when called. Documents are staged with a row number, so that rows with one id are told apart.
    """
    rows = documents.select(
        whole_row(documents), "doc_id", F.monotonically_increasing_id().alias("row"), fingerprints(width)(F.col("text")).alias("fp")
    )
    rows = stage(rows, "rows")
    found = with_components(rows.select(F.struct("doc_id", "row").alias("id"), "fp"))
    repeats = found.where("id <> component_id").select(F.col("id").getField("row").alias("row"))
    return rows.join(repeats, "row", "left_anti").select("whole.*")


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
