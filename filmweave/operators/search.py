"""Ranked multi-field retrieval over a table: postings, TF-IDF search, prefix search."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed
from ..functions.text import all_matches, bind


def analyse(text: str) -> list[str]:
    """Search terms of a query text: the analysis of :func:`tokens` for one short text on the driver."""
    words = (w.lower() for w in re.findall(r"\w+(?:\.\w+)*", text))
    return list(dict.fromkeys(w for w in words if len(w) >= fixed.MIN_TOKEN and w not in fixed.STOP_WORDS))


def tokens(text: Column) -> Column:
    """Lower-case words of a text, without stop words and single characters, in order."""
    words = all_matches(F.lower(text), fixed.TOKEN)
    return F.filter(words, lambda w: (F.length(w) >= fixed.MIN_TOKEN) & ~w.isin(*fixed.STOP_WORDS))


def _counted(words: Column) -> Column:
    """Array of ``(term, tf)``: sort the words, find where each run starts, take the distances."""

    def runs(w: Column) -> Column:
        at = F.filter(
            F.sequence(F.lit(0), F.size(w)),
            lambda i: (i == 0) | (i == F.size(w)) | (F.get(w, i) != F.get(w, i - 1)),
        )
        return bind(
            at,
            lambda s: F.transform(
                F.slice(s, F.lit(1), F.greatest(F.size(s) - 1, F.lit(0))),
                lambda start, j: F.struct(
                    F.get(w, start).alias("term"), (F.get(s, j + 1) - start).cast("bigint").alias("tf")
                ),
            ),
        )

    return bind(F.sort_array(words), runs)


def postings(df: DataFrame, doc: str, fields: list[str] | tuple[str, ...]) -> DataFrame:
    """``(doc, field, term, tf)`` for each text or list field; ``doc`` is unique in ``df``.

    A document is one row, so its terms are counted inside the row and nothing is shuffled.
    """
    kinds = {f.name: f.dataType for f in df.schema}

    def text(name: str) -> Column:
        c = F.col(name)
        if isinstance(kinds[name], T.ArrayType):
            return F.array_join(c, "\n")
        return c.cast("string")

    per_field = [
        F.struct(F.lit(name).alias("field"), _counted(tokens(text(name))).alias("terms")) for name in fields
    ]
    by_field = df.select(F.col(doc).alias("doc"), F.explode(F.array(*per_field)).alias("_f"))
    exploded = by_field.select("doc", F.col("_f.field").alias("field"), F.explode("_f.terms").alias("_t"))
    return exploded.select("doc", "field", F.col("_t.term").alias("term"), F.col("_t.tf").alias("tf"))


def term_stats(posts: DataFrame) -> DataFrame:
    """Documents per ``(field, term)``."""
    return posts.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))


def search(
    posts: DataFrame,
    query: str,
    n_docs: int,
    fields: list[str] | tuple[str, ...] = fixed.SEARCH_FIELDS,
) -> DataFrame:
    """All hits as ``(doc, score)``: every term of the query stands in some field.

    The score adds tf * idf over terms and fields, with idf = ln(N / (df + 1)) + 1. The postings are read
    once: hits are grouped by document into one short row (at most terms x fields entries), from which
    both the document frequencies and the scores follow; the two readers share that shuffle. The
    frequencies are at most terms x fields rows, so they are broadcast.
    """
    terms = analyse(query)
    hits = posts.filter(F.col("term").isin(terms) & F.col("field").isin(list(fields)))
    per_doc = hits.groupBy("doc").agg(F.collect_list(F.struct("field", "term", "tf")).alias("_hits"))

    hit = per_doc.select("doc", "_hits", F.explode("_hits").alias("_h"))
    frequency = hit.groupBy("_h.field", "_h.term").agg(F.count(F.lit(1)).alias("_df"))
    idf = frequency.select("field", "term", (F.log(F.lit(float(n_docs)) / (F.col("_df") + 1)) + 1).alias("_idf"))

    complete = per_doc.filter(F.size(F.array_distinct(F.transform("_hits", lambda h: h["term"]))) == len(terms))
    entries = complete.select("doc", F.explode("_hits").alias("_h")).select("doc", "_h.field", "_h.term", "_h.tf")
    scored = entries.join(F.broadcast(idf), ["field", "term"])
    return scored.groupBy("doc").agg(F.sum(F.col("tf") * F.col("_idf")).alias("score"))


def search_missing(posts: DataFrame, n_docs: int, fields=fixed.SEARCH_FIELDS) -> DataFrame:
    """Search for the sentinel of absent fields. Its first word is a stop word."""
    return search(posts, fixed.ABSENT, n_docs, fields)


def rows_missing(df: DataFrame, fields: list[str] | tuple[str, ...] = fixed.SEARCH_FIELDS) -> DataFrame:
    """Rows where some field is exactly the sentinel, or a list holding it."""
    found = F.lit(False)
    for field in df.schema:
        if field.name in fields:
            c = F.col(field.name)
            is_list = isinstance(field.dataType, T.ArrayType)
            hit = F.array_contains(c, fixed.ABSENT) if is_list else c == fixed.ABSENT
            found = found | F.coalesce(hit, F.lit(False))
    return df.filter(found)


def prefix_search(posts: DataFrame, prefix: str, groups: dict[str, list[str]]) -> DataFrame:
    """One row: per group of fields, the documents with a term that starts with ``prefix``.

    Each document becomes one row of flags first, so a group that most documents hit is still counted in
    parallel.
    """
    hits = posts.filter(F.col("term").startswith(prefix.lower()))
    flags = [F.bool_or(F.col("field").isin(fields)).alias(name) for name, fields in groups.items()]
    per_doc = hits.groupBy("doc").agg(*flags)
    return per_doc.agg(*[F.count_if(F.col(name)).alias(name) for name in groups])


PEOPLE_GROUPS = {
    "titles": ["title", "title_wiki"],
    "directors": ["director_list", "director_wiki"],
    "music": ["music"],
}
NUMBER_GROUPS = {"titles": ["title", "title_wiki"], "releases": ["release"]}


def top_hits(hits: DataFrame, k: int = fixed.DEFAULT_HITS) -> DataFrame:
    """Best ``k`` hits; the total is the count of ``hits``. Ties go to the lesser document."""
    return hits.orderBy(F.desc("score"), "doc").limit(k)
