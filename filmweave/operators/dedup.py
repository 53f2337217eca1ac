"""Dedup, merge and union. First-wins rules take an explicit ordinal: Spark rows have no order.

"First per key" is an aggregate, not a window: each task keeps one row per key before the shuffle, so a key that holds
a third of all rows sends one row per task. For narrow rows it is ``min_by`` of the whole row; for pages only keys and
ordinals are aggregated, and the pages are filtered by what came out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage


def first_per_key(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """One row per key: the one with the least ``order``. Missing keys count as one key."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    # A struct is never NULL, so a row without ordinal is not skipped: it comes first.
    first = df.groupBy(*keys).agg(F.min_by(row, F.struct(order)).alias("_row"))
    return first.select("_row.*")


def distinct_title_directors(catalogue: DataFrame) -> DataFrame:
    return catalogue.dropDuplicates(["title", "director_list"])


def first_of_wide(df: DataFrame, key: str, ordinal: str) -> DataFrame:
    """One row per key, the one with the least ordinal, for rows too wide to aggregate. Runs jobs when called.

    Keys and ordinals alone are shuffled; of them the keys that repeat are staged, so the planner knows their size and
    broadcasts them if they are few: then no wide row is shuffled. Missing keys count as one key, a missing
    ordinal comes first. Rows that tie for the first place are told apart by a hash of the row.
    """
    narrow = df.select(F.col(key).alias("_key"), F.col(ordinal).alias("_at"))
    counts = narrow.groupBy("_key").agg(F.count(F.lit(1)).alias("n"), F.count("_at").alias("known"), F.min("_at").alias("at"))
    least = F.when(F.col("n") == F.col("known"), F.col("at")).alias("_least")
    repeated = stage(counts.filter("n > 1").select("_key", least, F.lit(True).alias("_again")), "repeated-keys")
    first = F.col(ordinal).eqNullSafe(F.col("_least"))
    kept = df.join(repeated, F.col(key).eqNullSafe(F.col("_key")), "left").filter(F.col("_again").isNull() | first)
    kept = kept.select(*df.columns)

    ends = repeated.select(F.col("_key").alias("_of"), "_least")
    at_least = narrow.join(ends, F.col("_key").eqNullSafe(F.col("_of")) & F.col("_at").eqNullSafe(F.col("_least")), "left_semi")
    tied = stage(at_least.groupBy("_key").count().filter("count > 1").select("_key"), "tied-keys")
    if tied.isEmpty():
        return kept
    among = F.col(key).eqNullSafe(F.col("_key"))
    settled = first_per_key(kept.join(tied, among, "left_semi"), [key], F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    return kept.join(tied, among, "left_anti").unionByName(settled)


def distinct_url(df: DataFrame, ordinal: str, key: str = "url") -> DataFrame:
    """Pages, one per url. Runs jobs when called."""
    return first_of_wide(df, key, ordinal)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def union_by_name(existing: DataFrame, new: DataFrame) -> DataFrame:
    return existing.unionByName(new)


def new_keys(existing: DataFrame, new: DataFrame, key: str = "url", ordinal: str = "ordinal") -> DataFrame:
    """Rows of ``new`` with an unseen key, one per key. Runs jobs when called.

    With a store that is unique by key, appending these is the whole merge: of the store only the key
    column is read and nothing is rewritten. The store's keys are first cut down to those of ``new``; that
    takes no shuffle of the store while the new keys prove small enough to broadcast. A missing key is a key.
    """
    added = stage(new.select(F.col(key).alias("_new")).distinct(), "new-keys")
    seen = existing.select(F.col(key).alias("_seen")).join(added, F.col("_seen").eqNullSafe(F.col("_new")), "left_semi")
    seen = stage(seen.distinct(), "seen-keys")
    fresh = new.join(seen, F.col(key).eqNullSafe(F.col("_seen")), "left_anti")
    return first_of_wide(fresh, key, ordinal)


def merge_by_key(
    existing: DataFrame,
    new: DataFrame,
    key: str = "url",
    ordinal: str = "ordinal",
    existing_is_unique: bool = False,
) -> DataFrame:
    """Append ``new`` to ``existing``; an existing row wins over a new one, an earlier one over a later. Runs jobs when called."""
    kept = existing if existing_is_unique else first_of_wide(existing, key, ordinal)
    return kept.unionByName(new_keys(existing, new, key, ordinal))


def first_per_director(
    new: DataFrame,
    existing: DataFrame,
    ordinal: str = "ordinal",
    url: str = "url",
    director: str = "director",
    unique_urls: bool = True,
) -> DataFrame:
    """Rows of ``new`` whose url and director are unseen in ``existing`` and in the rows kept before them.

    With unique urls a kept row can only block others through its director, so the first row per
    director is the exact answer. Otherwise the rule is sequential, and is worked off in rounds: a row
    that comes first both for its url and for its director is kept and blocks the rest of both groups.
    Each round settles at least the first row left; the number of rounds is the longest chain of rows
    that wait for one another, not the number of rows.
    """
    fresh = new.join(existing.select(url).distinct(), url, "left_anti").select(*new.columns)
    if unique_urls:
        firsts = first_per_key(fresh, [director], F.col(ordinal))
        return firsts.join(existing.select(director).distinct(), director, "left_anti").select(*new.columns)

    # Missing urls, directors and ordinals are values like others; a row without ordinal comes first.
    rank = F.struct(F.col(ordinal).isNotNull().alias("known"), F.col(ordinal).alias("at"), F.col("_tie"))
    rows = fresh.join(existing.select(director).distinct(), director, "left_anti").select(*new.columns)
    rows = stage(rows.withColumn("_tie", F.monotonically_increasing_id()).withColumn("_rank", rank), "candidates")
    kept = []
    while not rows.isEmpty():
        best = rows
        for key in (url, director):
            least = rows.groupBy(F.col(key).alias("_key")).agg(F.min("_rank").alias("_least"))
            best = best.join(least, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_rank") == F.col("_least")), "left_semi")
        won = stage(best, "kept")
        kept.append(won)
        for key in (url, director):
            rows = rows.join(won.select(F.col(key).alias("_key")).distinct(), F.col(key).eqNullSafe(F.col("_key")), "left_anti")
        rows = stage(rows, "candidates")
    result = rows
    for part in kept:
        result = result.unionByName(part)
    return result.select(*new.columns)
