"""Prefix counts from a term dictionary: documents as bits, so that counts need no shuffle by document.

Documents are numbered once. The dictionary has a row for each field, key and bucket of 32,768 numbers. Keys are the whole
terms and, since short prefixes cover very many of them, the prefixes of up to ``LEVELS`` characters. A row holds the
bucket's documents as a bitmap, or as a list of places where they are few, whichever is smaller. A prefix is counted
by OR-ing bitmaps by bucket: one row for a short prefix, the terms that start with it for a longer one. A document that a
prefix hits in several terms or fields is one bit. What is shuffled is a bitmap for each bucket and group of fields, at most
4 KB for 32,768 documents, combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..session import stage
from .search import postings

LEVELS = 3  # prefixes of so many characters have rows of their own
FEW = 1024  # places up to which a list is no longer than a bitmap


def numbered(documents: DataFrame) -> DataFrame:
    """``documents`` with ``_number``: distinct, and without gaps but for those between the files; staged."""
    return stage(documents.withColumn("_number", F.monotonically_increasing_id()), "numbered")


def write_dictionary(documents: DataFrame, path: str, fields=fixed.SEARCH_FIELDS, levels: int = LEVELS) -> None:
    """The dictionary of ``documents`` in ``path``, sorted by key within its files."""
    ready = numbered(documents)
    posts = postings(ready, "_number", fields).select("field", "term", F.col("doc").alias("_number"))
    place, bucket = F.bitmap_bit_position("_number").cast("int"), F.bitmap_bucket_number("_number")
    # A term's documents are distinct already; few to a bucket for most terms, and a list of at most 32,768 for any.
    terms = posts.groupBy("field", F.col("term").alias("key"), bucket.alias("bucket")).agg(F.collect_list(place).alias("places"))
    terms = stage(terms, "terms")  # three readers
    ends = terms.select("field", "bucket", "key", F.explode("places").alias("at"))
    terms = terms.select("field", "key", F.lit(0).alias("level"), "bucket", "places", F.lit(None).cast("binary").alias("bits"))
    whole = terms.where(F.size("places") <= FEW)
    many = terms.where(F.size("places") > FEW).select("field", "key", "level", "bucket", F.explode("places").alias("at"))
    many = many.groupBy("field", "key", "level", "bucket").agg(F.bitmap_construct_agg("at").alias("bits"))
    lengths = F.sequence(F.lit(1), F.least(F.lit(levels), F.length("key")))
    starts = F.transform(lengths, lambda i: F.struct(i.alias("level"), F.substring("key", F.lit(1), i).alias("key")))
    short = ends.select("field", "bucket", F.col("at").cast("long").alias("at"), F.explode(starts).alias("s"))
    short = short.groupBy("field", F.col("s.key").alias("key"), F.col("s.level").alias("level"), "bucket")
    short = short.agg(F.bitmap_construct_agg("at").alias("bits"))
    rows = whole.unionByName(many, allowMissingColumns=True).unionByName(short, allowMissingColumns=True)
    rows.hint("rebalance", "level", "key").sortWithinPartitions("level", "key").write.parquet(path)


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def matching(dictionary: DataFrame, prefix: str, levels: int = LEVELS) -> DataFrame:
    """Rows of the dictionary whose documents have a term that starts with ``prefix``; the test reaches the scan."""
    wanted = prefix.lower()
    if 0 < len(wanted) <= levels:
        return dictionary.where((F.col("level") == len(wanted)) & (F.col("key") == wanted))
    return dictionary.where((F.col("level") == 0) & F.col("key").startswith(wanted))


def prefix_counts(dictionary: DataFrame, prefix: str, groups: dict[str, list[str]], levels: int = LEVELS) -> DataFrame:
    """One row: per group of fields, the documents with a term that starts with ``prefix``, as :func:`.search.prefix_search`."""
    named = F.explode(F.array_compact(F.array(*[F.when(F.col("field").isin(f), F.lit(g)) for g, f in groups.items()])))
    rows = matching(dictionary, prefix, levels).select(named.alias("group"), "bucket", "places", "bits")
    # Bits of lists and of bitmaps, each OR-ed within the tasks, then together: a row for each group, bucket and task.
    listed = rows.where("places IS NOT NULL").select("group", "bucket", F.explode(F.col("places").cast("array<long>")).alias("at"))
    listed = listed.groupBy("group", "bucket").agg(F.bitmap_construct_agg("at").alias("bits"))
    mapped = rows.where("bits IS NOT NULL").select("group", "bucket", "bits")
    merged = listed.unionByName(mapped).groupBy("group", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    sizes = merged.select("group", F.bitmap_count("bits").alias("n"))
    return sizes.agg(*[F.coalesce(F.sum(F.when(F.col("group") == g, F.col("n"))), F.lit(0)).cast("long").alias(g) for g in groups])
