"""Linked table to index and answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..operators import search as s
from ..operators.quality import null_fill


def search_documents(linked: DataFrame, doc: str = "doc") -> DataFrame:
    """Distinct linked rows with missing values filled and an id that depends on the row alone."""
    rows = null_fill(linked.select(*fixed.SEARCH_FIELDS)).distinct()
    text = F.to_json(F.struct(*fixed.SEARCH_FIELDS))
    return rows.select(F.sha2(text, 256).alias(doc), *fixed.SEARCH_FIELDS)


def write_index(documents: DataFrame, path: str, doc: str = "doc", fields=fixed.SEARCH_FIELDS) -> None:
    """Postings as Parquet, sorted by term inside each file, so that a search reads few row groups.

    One shuffle brings terms together. It is a rebalance, so AQE cuts the partition of a term of very many documents
    by its measured size, and a rare term lies in one file.
    """
    posts = s.postings(documents, doc, fields)
    posts.hint("rebalance", "term").sortWithinPartitions("term", "field", "doc").write.parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def stored_hits(hits: DataFrame, documents: DataFrame, k: int = fixed.DEFAULT_HITS, doc: str = "doc") -> DataFrame:
    """Best ``k`` of ``hits`` with their score and the stored fields, best first; only ``k`` rows are broadcast."""
    best = s.top_hits(hits, k).withColumnRenamed("doc", "_doc")
    found = documents.join(F.broadcast(best), F.col(doc) == F.col("_doc"))
    return found.select("score", *documents.columns).orderBy(F.desc("score"), doc)


def prefix_hits(posts: DataFrame, documents: DataFrame, prefix: str, fields, doc: str = "doc") -> DataFrame:
    """Rows of ``documents`` with a term in one of ``fields`` that starts with ``prefix``."""
    hits = posts.filter(F.col("term").startswith(prefix.lower()) & F.col("field").isin(list(fields)))
    found = hits.select(F.col("doc").alias(doc)).distinct()
    return documents.join(found, doc, "left_semi").select(*documents.columns)
