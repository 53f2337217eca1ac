"""Top-k search with early stop: postings in blocks that fall in impact, each with a bound of its scores.

Documents are cut into blocks by falling length, since a long document can hold a term often: a class of lengths has
as many blocks as its documents fill, and a document goes to one of them by its hash. That needs the counts of at most
``CLASSES`` classes and no global order. A row of the index is one term of one field in one block: its documents with
their frequencies, their number and the highest frequency. As all postings of a document lie in the same block, scores within
a block are exact, and a block's bound is the sum of the bounds of its rows.

A search reads the rows' numbers alone (the lists are a column of their own, which Parquet skips), bounds every block that
holds all terms, opens the few with the highest bounds and gets a k-th score; of the others only those are opened whose
bound reaches it. Block numbers and terms are literals, so they reach the scan. Blocks that can't reach the k-th score
are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed
from ..session import stage
from .search import analyse, postings, top_hits

BLOCK = 1024  # documents to a block, about
CLASSES = 512  # classes of lengths: eight to each doubling
FIRST = 8  # blocks opened first; more where they hold fewer than k hits
LITERALS = 512  # block numbers that go to the scan as literals; beyond, a range does, and a semi join
DIGITS = 6  # scores are rounded, so that they don't depend on the order of a sum


def _length(df: DataFrame, fields) -> Column:
    """Characters of the fields; what matters is that longer documents come first, not by how much."""
    kinds = {f.name: f.dataType for f in df.schema}
    text = lambda f: F.array_join(f, "\n") if isinstance(kinds[f], T.ArrayType) else F.col(f).cast("string")
    return reduce(lambda a, b: a + b, [F.coalesce(F.length(text(f)), F.lit(0)) for f in fields])


def blocked(documents: DataFrame, doc: str, fields, block: int = BLOCK) -> DataFrame:
    """``documents`` with ``block``, from 0 for the longest. Runs a job when called."""
    spark = documents.sparkSession
    kind = F.greatest(F.lit(0), F.lit(CLASSES - 1) - F.floor(F.log2(_length(documents, fields) + 1) * 8)).cast("int")
    counts = documents.groupBy(kind.alias("_class")).agg(F.count(F.lit(1)).alias("n")).orderBy("_class").collect()  # CLASSES rows
    places, start = [], 0
    for row in counts:
        width = -(-row["n"] // block)
        places.append((row["_class"], start, width))
        start += width
    places = F.broadcast(spark.createDataFrame(places, "_class int, _start long, _width long"))
    number = F.col("_start") + F.pmod(F.xxhash64(doc), F.col("_width"))
    return documents.withColumn("_class", kind).join(places, "_class").select(*documents.columns, number.alias("block"))


def write_blocks(documents: DataFrame, path: str, doc: str = "doc", fields=fixed.SEARCH_FIELDS, block: int = BLOCK) -> None:
    """The block index of ``documents`` (``doc`` unique) in ``path``, and their number in ``path``.

    Lists are of bounded length, also those of a term that every document holds. They hold numbers that ascend with ``doc``,
    so that a long ``doc`` is written once and not with each of its terms; a search reads those of its hits. Runs jobs when called.
    """
    ready = blocked(documents, doc, fields, block).orderBy(doc).withColumn("_number", F.monotonically_increasing_id())
    ready = stage(ready.select("_number", F.col(doc).alias("doc"), "block", *[F.col(f).alias(f"_in_{f}") for f in fields]), "ready")
    ready.select("_number", "doc").write.parquet(f"{path}/documents")
    number = ready.select(F.struct("block", "_number").alias("_id"), *[F.col(f"_in_{f}").alias(f) for f in fields])
    posts = postings(number, "_id", fields)
    entry = F.struct(F.col("doc._number").alias("doc"), "tf")
    lists = posts.groupBy("term", "field", F.col("doc.block").alias("block")).agg(
        F.sort_array(F.collect_list(entry)).alias("entries"), F.max("tf").alias("most"), F.count(F.lit(1)).alias("n")
    )
    lists = lists.hint("rebalance", "term").sortWithinPartitions("term", "field", "block")
    # Small pages, so that a search for one term reads few of them.
    lists.write.option("parquet.page.row.count.limit", 64).parquet(f"{path}/blocks")
    documents.agg(F.count(F.lit(1)).alias("n_docs")).write.parquet(f"{path}/stats")


class BlockIndex:
    """A written block index; searches read from it what they need. ``opened`` has the postings rows that the last one read."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.blocks = spark, spark.read.parquet(f"{path}/blocks")
        self.documents = spark.read.parquet(f"{path}/documents")
        self.n_docs = spark.read.parquet(f"{path}/stats").first()["n_docs"]
        self.opened: list[DataFrame] = []

    def _rows(self, terms: list[str], fields) -> DataFrame:
        return self.blocks.where(F.col("term").isin(terms) & F.col("field").isin(list(fields)))

    def bounds(self, terms: list[str], fields) -> tuple[DataFrame, DataFrame]:
        """``block, bound`` of the blocks that hold every term, and ``term, field, idf``; no list is read."""
        heads = stage(self._rows(terms, fields).select("term", "field", "block", "most", "n"), "heads")
        idf = heads.groupBy("term", "field").agg(F.sum("n").alias("df"))
        idf = stage(idf.select("term", "field", (F.log(F.lit(float(self.n_docs)) / (F.col("df") + 1)) + 1).alias("idf")), "idf")
        bound = heads.join(F.broadcast(idf), ["term", "field"])  # terms x fields rows
        bound = bound.groupBy("block").agg(F.sum(F.col("most") * F.col("idf")).alias("bound"), F.count_distinct("term").alias("terms"))
        return stage(bound.where(F.col("terms") == len(terms)).select("block", "bound"), "bounds"), idf

    def _opened(self, blocks: DataFrame, terms: list[str], fields, idf: DataFrame) -> DataFrame:
        """All hits of some blocks, ``doc, score``, the documents by number."""
        rows = self._rows(terms, fields)
        few = [r["block"] for r in blocks.select("block").limit(LITERALS + 1).collect()]
        if len(few) <= LITERALS:
            rows = rows.where(F.col("block").isin(few))
        else:
            low, high = blocks.agg(F.min("block"), F.max("block")).first()
            rows = rows.where(F.col("block").between(low, high)).join(blocks.select("block"), "block", "left_semi")
        self.opened.append(rows)
        hits = rows.join(F.broadcast(idf), ["term", "field"]).select("block", "term", "idf", F.inline("entries"))
        # A document lies in one block, so the block with it is the document.
        per_doc = hits.groupBy("doc").agg(F.sum(F.col("tf") * F.col("idf")).alias("score"), F.collect_set("term").alias("held"))
        return per_doc.where(F.size("held") == len(terms)).select("doc", F.round("score", DIGITS).alias("score"))

    def search(self, query: str, k: int = fixed.DEFAULT_HITS, fields=fixed.SEARCH_FIELDS) -> DataFrame:
        """The best ``k`` hits ``doc, score``, as :func:`.search.top_hits` finds them in :func:`.search.search`. Runs jobs."""
        terms = analyse(query)
        self.opened = []
        bounds, idf = self.bounds(terms, fields)
        place = F.struct((-F.col("bound")).alias("bound"), "block")
        best, last, width = None, None, FIRST
        while True:
            left = bounds if last is None else bounds.where(place > last)
            some = stage(left.orderBy(place).limit(width), "opened")
            found = top_hits(self._opened(some, terms, fields, idf), k)
            best = stage(found if best is None else top_hits(best.unionByName(found), k), "best")
            end = some.agg(F.max(place)).first()[0]
            if end is None:
                break  # no block is left
            last = F.struct(F.lit(end["bound"]).cast("double").alias("bound"), F.lit(end["block"]).cast("long").alias("block"))
            worst, hits = best.agg(F.min("score"), F.count(F.lit(1))).first()
            if hits >= k:
                # Nothing in a block below this can come up to the k-th hit, rounded as scores are.
                rest = bounds.where((place > last) & (F.col("bound") >= worst - 10.0**-DIGITS))
                if not rest.isEmpty():
                    best = best.unionByName(top_hits(self._opened(rest, terms, fields, idf), k))
                break
            width *= 8
        best = stage(top_hits(best, k), "hits")
        numbers = [r["doc"] for r in best.select("doc").limit(LITERALS + 1).collect()]
        named = self.documents.where(F.col("_number").isin(numbers)) if len(numbers) <= LITERALS else self.documents
        return top_hits(named.join(F.broadcast(best.withColumnRenamed("doc", "_number")), "_number").select("doc", "score"), k)
