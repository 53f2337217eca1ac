"""Mixing sources to target weights by hash-threshold histograms.

Every document has a hash; a source's share is the documents below a threshold. To find the threshold that meets a
budget of words, words are summed by source and hash bucket, the bucket in which the running sum passes the budget is
found, and only that bucket is summed again by finer buckets, down to single hash values. The mix is then a filter:
no sort of documents, no row numbers. A source whose target is above its size is taken whole, as often as it fits,
and once more below the threshold.

Sums go by source and bucket, so a source that holds most rows spreads over as many keys as there are buckets.
Windows run over the histograms, ``WIDTH`` rows for each source, and over one row for each source.

Defined cases: NULL text has size 0; NULL is a source of its own, the last one; documents without words are taken
never (they'd add nothing); rows that share an id are taken together; extra columns stay. An empty table gives an
empty mix. Reruns agree, since only ids and sizes decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage
from .common import whole_row

WEIGHTS = (5, 2, 1)  # by source in code point order, repeating
MOST = 3  # times a source's size
WIDTH, LEVELS = 1024, 5  # 1,024 buckets of 10 bits at each of five levels
SEED = "mix"
_BITS = 10


def word_count(text: Column) -> Column:
    """Number of runs of other characters than ASCII whitespace; NULL: 0."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def id_hash(doc_id: Column, seed: str = SEED) -> Column:
    """A number of 50 bits, even over ids."""
    text = F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")))
    hashed = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")
    return F.shiftright(hashed, 52 - _BITS * LEVELS)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, weight, target`` from one row per source: shares by weight, none above ``most`` times its size.

    Resharing what is above until none is means one rate per weight at which the capped sizes sum up: sources are
    capped in order of their cap per weight, as long as the rate of the rest passes it.
    """
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    last = sizes.withColumn("_last", F.col("source").isNull())
    place = F.row_number().over(W.orderBy("_last", "source"))
    ready = last.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(place - 1, F.lit(len(weights))) + 1))
    before = W.orderBy(F.col("source_size") * 1.0 / F.col("weight"), "_last", "source").rowsBetween(W.unboundedPreceding, -1)
    ready = (
        ready.withColumn("_total", F.sum("source_size").over(every))
        .withColumn("_weights", F.sum("weight").over(every))
        .withColumn("_capped", F.coalesce(F.sum("source_size").over(before), F.lit(0)) * most)
        .withColumn("_gone", F.coalesce(F.sum("weight").over(before), F.lit(0)))
    )
    rate = (F.col("_total") - F.col("_capped")) / (F.col("_weights") - F.col("_gone"))
    cap = F.col("source_size") * most
    ready = ready.withColumn("_rate", rate).withColumn("_holds", F.col("_rate") * F.col("weight") <= cap)
    final = F.max(F.when(F.col("_holds"), F.col("_rate"))).over(every)  # the first that holds; later ones are less
    target = F.least(cap.cast("double"), F.coalesce(final * F.col("weight"), cap.cast("double")))
    return ready.select("source", "source_size", "weight", target.alias("target"))


def _key(source: Column) -> Column:
    """A source as a key that is never NULL."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def thresholds(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``key, times, below``: take each document ``times`` times, and once more if its hash is less than ``below``.

    ``rows`` has ``key, size, hash``, ``sources`` has ``key, source_size, target``. Runs jobs for each level, over the
    boundary buckets alone after the first.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.greatest(F.lit(0.0), F.col("target") - whole * F.col("source_size"))
    none = F.lit(0).cast("long")
    left = stage(sources.select("key", whole.alias("times"), rest.alias("budget"), none.alias("below")), "budgets")
    inside = rows
    for level in range(LEVELS):
        shift = _BITS * (LEVELS - 1 - level)
        if level:
            edge = left.select("key", F.shiftright("below", shift + _BITS).alias("_edge"))
            inside = inside.join(edge, "key").where(F.shiftright("hash", shift + _BITS) == F.col("_edge"))
            inside = stage(inside.select("key", "size", "hash"), "boundary")
        words = inside.groupBy("key", F.shiftright("hash", shift).alias("bucket")).agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(W.partitionBy("key").orderBy("bucket"))
        sums = words.withColumn("upto", upto).join(left.select("key", "budget"), "key")
        fits = F.col("upto") <= F.col("budget")
        met = sums.groupBy("key").agg(
            F.max(F.when(fits, F.col("bucket"))).alias("_full"),
            F.coalesce(F.max(F.when(fits, F.col("upto"))), F.lit(0)).alias("_used"),
            F.min(F.when(~fits, F.col("bucket"))).alias("_edge"),  # the first bucket with words that doesn't fit
            F.min(F.when(~fits, F.col("upto"))).alias("_over"),
        )
        # At the finest level the value goes in if that comes nearer to the budget.
        nearer = F.lit(level == LEVELS - 1) & (F.col("_over") - F.col("budget") < F.col("budget") - F.col("_used"))
        edge = F.shiftleft(F.col("_edge") + nearer.cast("long"), shift)
        below = F.coalesce(edge, F.shiftleft(F.col("_full") + 1, shift), F.col("below"))
        rest = (F.col("budget") - F.coalesce("_used", F.lit(0))).alias("budget")
        left = stage(left.join(met, "key", "left").select("key", "times", rest, below.alias("below")), "budgets")
    return left.select("key", "times", "below")


def mix(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, columns: list[str] | None = None) -> DataFrame:
    """``documents`` (or the given columns) with ``_size, _source_size, _target, _times``: how often the mix takes each. Runs jobs.

    Sizes are staged narrow, so that texts are read once for them and once for the result.
    """
    kept = [F.col(f"`{c}`") for c in (documents.columns if columns is None else columns)]
    narrow = [_key(F.col("source")).alias("_key"), word_count(F.col("text")).alias("_size"), id_hash(F.col("doc_id")).alias("_hash")]
    rows = stage(documents.select("source", *narrow), "sizes")
    sizes = rows.groupBy("source", F.col("_key").alias("key")).agg(F.sum("_size").alias("source_size"))
    sources = stage(targets(sizes.drop("key"), weights, most).withColumn("key", _key(F.col("source"))), "targets")
    cuts = thresholds(rows.select(F.col("_key").alias("key"), F.col("_size").alias("size"), F.col("_hash").alias("hash")), sources)
    plan = sources.join(cuts, "key").select(
        F.col("key").alias("_key"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"),
        F.col("times").alias("_whole"), F.col("below").alias("_below"),
    )
    taken = documents.select(*kept, *narrow).join(stage(plan, "mix"), "_key", "left")
    times = F.when(F.col("_size") > 0, F.col("_whole") + (F.col("_hash") < F.col("_below")).cast("long")).otherwise(0)
    return taken.select(*kept, "_size", "_source_size", "_target", times.cast("long").alias("_times"))


def mixed(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mix itself: each document as often as it is taken, columns as they were."""
    taken = mix(documents.select(whole_row(documents), "doc_id", "source", "text"), weights, most, ["whole"])
    again = taken.where("_times > 0").select("whole", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))))
    return again.select("whole.*")
