"""Postings, ranked search and prefix search, over documents and over the linked table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmweave.functions import fixed, sql
from filmweave.operators import prefixes, ranked
from filmweave.operators import search as s
from filmweave.operators.quality import null_fill
from filmweave.plans import retrieval
from filmweave.session import stage, staging_path

from . import inputs
from .checks import Checks
from .linking import LINKED_SQL, linked
from .sqltext import lit

CHECKS = Checks()

DOC_FIELDS = ("text", "source", "lang")
TOKEN = r"[\p{L}\p{N}_]+(?:\.[\p{L}\p{N}_]+)*"  # the checking engine has no possessive form
STOPPED = ", ".join(lit(w) for w in fixed.STOP_WORDS)


def _postings_sql(source: str, doc: str, fields) -> str:
    parts = " UNION ALL ".join(
        f"SELECT {doc} AS doc, '{f}' AS field, unnest(regexp_extract_all(lower({f}), {lit(TOKEN)}, 0)) AS term FROM {source}"
        for f in fields
    )
    return f"""SELECT doc, field, term, count(*) AS tf FROM ({parts}) w
  WHERE length(term) >= 2 AND term NOT IN ({STOPPED}) GROUP BY doc, field, term"""


DOCUMENT_POSTINGS = _postings_sql("documents", "doc_id", DOC_FIELDS)


def document_postings(spark, sf_dir):
    return s.postings(inputs.table(spark, sf_dir, "documents"), "doc_id", DOC_FIELDS)


CHECKS.add("postings", document_postings, DOCUMENT_POSTINGS)
CHECKS.add(
    "term_stats",
    lambda spark, sf_dir: s.term_stats(document_postings(spark, sf_dir)),
    f"SELECT field, term, count(*) AS df FROM ({DOCUMENT_POSTINGS}) p GROUP BY field, term",
)


def _search_sql(postings: str, terms, total: str) -> str:
    wanted = ", ".join(lit(t) for t in terms)
    return f"""WITH p AS ({postings}), h AS (SELECT * FROM p WHERE term IN ({wanted})),
  d AS (SELECT field, term, ln((SELECT count(*) FROM {total}) / (count(*) + 1)) + 1 AS idf FROM h GROUP BY field, term)
SELECT doc, round(sum(tf * idf), 6) AS score FROM h JOIN d USING (field, term)
GROUP BY doc HAVING count(DISTINCT term) = {len(terms)}"""


def _rounded(hits):
    return hits.select("doc", F.round("score", 6).alias("score"))


def _search(query):
    def run(spark, sf_dir):
        n_docs = inputs.table(spark, sf_dir, "documents").count()
        return _rounded(s.search(document_postings(spark, sf_dir), query, n_docs, DOC_FIELDS))

    return run


_TWO_TERMS = _search_sql(DOCUMENT_POSTINGS, ("tion", "src1"), "documents")
CHECKS.add("search", _search("tion src1"), _TWO_TERMS)
CHECKS.add("search_ci", _search("TION Src1"), _TWO_TERMS)


def _index(spark, sf_dir):
    """The documents and their index, written and read back."""
    docs, path = inputs.table(spark, sf_dir, "documents"), staging_path(spark, "index")
    retrieval.write_index(docs, path, "doc_id", DOC_FIELDS)
    return docs, retrieval.read_index(spark, path)


def _search_index(spark, sf_dir):
    docs, posts = _index(spark, sf_dir)
    return _rounded(s.search(posts, "tion src1", docs.count(), DOC_FIELDS))


def _search_hits(spark, sf_dir):
    docs, posts = _index(spark, sf_dir)
    hits = _rounded(s.search(posts, "tion src1", docs.count(), DOC_FIELDS))
    return retrieval.stored_hits(hits, docs.select("doc_id", *DOC_FIELDS), doc="doc_id")


def _prefix_hits(spark, sf_dir):
    docs, posts = _index(spark, sf_dir)
    return retrieval.prefix_hits(posts, docs.select("doc_id", *DOC_FIELDS), "Sr", ("source", "lang"), "doc_id")


CHECKS.add("search_index", _search_index, _TWO_TERMS)
CHECKS.add(
    "search_hits",
    _search_hits,
    f"""SELECT score, doc_id, {', '.join(DOC_FIELDS)} FROM (SELECT * FROM ({_TWO_TERMS}) h ORDER BY score DESC, doc LIMIT 10) b
JOIN documents ON doc_id = doc""",
)
CHECKS.add(
    "prefix_hits",
    _prefix_hits,
    f"""SELECT doc_id, {', '.join(DOC_FIELDS)} FROM documents WHERE doc_id IN
  (SELECT doc FROM ({DOCUMENT_POSTINGS}) p WHERE starts_with(term, 'sr') AND field IN ('source', 'lang'))""",
)


def _top(spark, sf_dir):
    n_docs = inputs.table(spark, sf_dir, "documents").count()
    return s.top_hits(_rounded(s.search(document_postings(spark, sf_dir), "the tion ered", n_docs, DOC_FIELDS)))


CHECKS.add(
    "top_hits",
    _top,
    f"SELECT * FROM ({_search_sql(DOCUMENT_POSTINGS, ('tion', 'ered'), 'documents')}) h ORDER BY score DESC, doc LIMIT 10",
)


def _topk(query):
    """The block index of all documents, written, opened and searched."""

    def run(spark, sf_dir):
        path = staging_path(spark, "blocks")
        ranked.write_blocks(inputs.table(spark, sf_dir, "documents"), path, "doc_id", DOC_FIELDS, TOPK_BLOCK)
        return ranked.BlockIndex(spark, path).search(query, fields=DOC_FIELDS)

    return run


TOPK_BLOCK = 64  # smaller than by default, so that small tables have many blocks
CHECKS.add("search_topk", _topk("the tion ered"), CHECKS.oracles["top_hits"])
CHECKS.add("search_topk_fields", _topk("Src1 tion"), f"SELECT * FROM ({_TWO_TERMS}) h ORDER BY score DESC, doc LIMIT 10")

_GROUPS = {"body": ["text"], "origin": ["source", "lang"]}


def _prefix_sql(postings: str, prefix: str, groups) -> str:
    counts = ", ".join(
        f"count(DISTINCT doc) FILTER (WHERE field IN ({', '.join(lit(f) for f in fields)})) AS {name}"
        for name, fields in groups.items()
    )
    return f"SELECT {counts} FROM ({postings}) p WHERE starts_with(term, {lit(prefix)})"


CHECKS.add(
    "prefix_search",
    lambda spark, sf_dir: s.prefix_search(document_postings(spark, sf_dir), "Src", _GROUPS),
    _prefix_sql(DOCUMENT_POSTINGS, "src", _GROUPS),
)



def _dictionary(find):
    """The term dictionary of all documents, written and read back."""

    def run(spark, sf_dir):
        path = staging_path(spark, "dictionary")
        prefixes.write_dictionary(inputs.table(spark, sf_dir, "documents"), path, DOC_FIELDS)
        return find(prefixes.read_dictionary(spark, path))

    return run


# Short prefixes, which most documents hit, and longer ones.
_PREFIXES = ("s", "th", "tio", "Src", "src1", "zzz")
CHECKS.add(
    "prefix_dictionary",
    _dictionary(
        lambda terms: reduce(
            DataFrame.unionByName,
            [prefixes.prefix_counts(terms, p, _GROUPS).select(F.lit(p).alias("prefix"), *_GROUPS) for p in _PREFIXES],
        )
    ),
    " UNION ALL ".join(f"SELECT {lit(p)} AS prefix, * FROM ({_prefix_sql(DOCUMENT_POSTINGS, p.lower(), _GROUPS)}) t" for p in _PREFIXES),
)


# -- the same from SQL ------------------------------------------------------------------------------------
def _from_sql(statement):
    """A statement over the documents and their postings, with the table functions at hand."""

    def run(spark, sf_dir):
        inputs.table(spark, sf_dir, "documents").createOrReplaceTempView("documents")
        document_postings(spark, sf_dir).createOrReplaceTempView("document_postings")
        sql.register_table_functions(spark, "document_postings")
        inputs.load(spark, sf_dir, inputs.DUMP_TEXTS).createOrReplaceTempView("dump_texts")
        return spark.sql(statement)

    return run


_ALL_FIELDS = "array('text', 'source', 'lang')"
CHECKS.add(
    "sql_search",
    _from_sql(f"SELECT doc, round(score, 6) AS score FROM search('TION Src1', {_ALL_FIELDS}, (SELECT count(*) FROM documents))"),
    _TWO_TERMS,
)
CHECKS.add(
    "sql_prefix_counts",
    _from_sql(
        "SELECT (SELECT docs FROM prefix_counts('Src', array('text'))) AS body, "
        "(SELECT docs FROM prefix_counts('Src', array('source', 'lang'))) AS origin"
    ),
    CHECKS.oracles["prefix_search"],
)
CHECKS.add(
    "sql_dump_links",
    _from_sql("SELECT k, link FROM dump_texts, LATERAL dump_links(txt)"),
    f"SELECT k, unnest(regexp_extract_all(txt, {lit(fixed.DUMP_LINK)}, 0)) AS link FROM ({inputs.DUMP_TEXTS}) d",
)

# -- the linked table, all six fields; its rows are told apart by their whole content ---------------------
_TEXT = "array_to_string({}, chr(10))".format
FILLED_SQL = f"""SELECT DISTINCT title, coalesce(title_wiki, 'not found') AS title_wiki, {_TEXT("director_list")} AS director_list,
  {_TEXT("coalesce(director_wiki, ['not found'])")} AS director_wiki, {_TEXT("coalesce(music, ['not found'])")} AS music,
  coalesce(release, 'not found') AS release FROM ({LINKED_SQL}) l"""
_DOC = f"concat_ws('|', {', '.join(fixed.SEARCH_FIELDS)})"
FILLED_POSTINGS = "WITH f AS (%s), g AS (SELECT %s AS id, * FROM f) %s" % (
    FILLED_SQL, _DOC, _postings_sql("g", "id", fixed.SEARCH_FIELDS)
)


def _film_documents(spark, sf_dir):
    rows = null_fill(linked(spark, sf_dir))
    lists = ("director_list", "director_wiki", "music")
    flat = rows.select(*[F.array_join(c, "\n").alias(c) if c in lists else F.col(c) for c in fixed.SEARCH_FIELDS])
    return flat.distinct().select(F.concat_ws("|", *fixed.SEARCH_FIELDS).alias("id"), *fixed.SEARCH_FIELDS)


def _film_search(find):
    def run(spark, sf_dir):
        docs = stage(_film_documents(spark, sf_dir), "documents")
        return find(s.postings(docs, "id", fixed.SEARCH_FIELDS), docs.count())

    return run


CHECKS.add(
    "search_films",
    _film_search(lambda posts, n: _rounded(s.search(posts, "Zoë Bolt 1951", n))),
    _search_sql(FILLED_POSTINGS, ("zoë", "bolt", "1951"), f"({FILLED_SQL}) n"),
)
CHECKS.add(
    "search_missing",
    _film_search(lambda posts, n: _rounded(s.search_missing(posts, n))),
    _search_sql(FILLED_POSTINGS, ("found",), f"({FILLED_SQL}) n"),
)


def _film_topk(spark, sf_dir):
    path = staging_path(spark, "blocks")
    ranked.write_blocks(stage(_film_documents(spark, sf_dir), "documents"), path, "id", block=TOPK_BLOCK)
    return ranked.BlockIndex(spark, path).search("Zoë Bolt 1951")


CHECKS.add(
    "search_topk_films",
    _film_topk,
    f"SELECT * FROM ({CHECKS.oracles['search_films']}) h ORDER BY score DESC, doc LIMIT 10",
)


def _film_dictionary(prefix, groups):
    def run(spark, sf_dir):
        path = staging_path(spark, "dictionary")
        prefixes.write_dictionary(_film_documents(spark, sf_dir), path)
        return prefixes.prefix_counts(prefixes.read_dictionary(spark, path), prefix, groups)

    return run


CHECKS.add(
    "prefix_dictionary_people", _film_dictionary("Bra", s.PEOPLE_GROUPS), _prefix_sql(FILLED_POSTINGS, "bra", s.PEOPLE_GROUPS)
)
CHECKS.add(
    "prefix_dictionary_numbers", _film_dictionary("19", s.NUMBER_GROUPS), _prefix_sql(FILLED_POSTINGS, "19", s.NUMBER_GROUPS)
)
CHECKS.add(
    "prefix_search_people",
    _film_search(lambda posts, n: s.prefix_search(posts, "Brand", s.PEOPLE_GROUPS)),
    _prefix_sql(FILLED_POSTINGS, "brand", s.PEOPLE_GROUPS),
)
CHECKS.add(
    "prefix_search_numbers",
    _film_search(lambda posts, n: s.prefix_search(posts, "19", s.NUMBER_GROUPS)),
    _prefix_sql(FILLED_POSTINGS, "19", s.NUMBER_GROUPS),
)


def _rows_missing(spark, sf_dir):
    return s.rows_missing(_film_documents(spark, sf_dir)).drop("id")


CHECKS.add(
    "rows_missing",
    _rows_missing,
    f"""SELECT * FROM ({FILLED_SQL}) f
WHERE 'not found' IN ({', '.join(fixed.SEARCH_FIELDS)})""",
)
