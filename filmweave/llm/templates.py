"""Line dedup by a log-template tree.

A line falls through a tree of fixed depth: its token count, then its first ``DEPTH`` tokens, tokens with digits
standing as a wildcard. A line is dropped, with all others like it, in any of three cases:

- its exact text stands in enough documents: the longer it is, the less it takes to rule out chance, so documents
  times tokens have to come to ``WEIGHT``, with two documents at least and ``LEAST_DOCUMENTS`` at most;
- lines that differ from it in tokens with digits alone stand in as many, counting tokens without digits;
- its template recurs: within the leaf a token is fixed at its place if enough documents of the leaf have it there, other
  places are variable fields. Leaf and fixed tokens are the template, and it recurs if its lines stand in
  ``LEAST_DOCUMENTS`` documents. At most a quarter of the places without digits are variable.

Documents of the same text count as one, so that copies of a document don't make its own lines recur; they are treated
alike. How many documents are enough for a template depends on the template: a field's values recur too where there are many documents, but
less than the words around them. So the bar goes up a ladder, ``LEAST_DOCUMENTS`` times powers of ``STEP``, and a line is
dropped if its template recurs at any rung. In the second and third case at least two tokens, or half of all, are
fixed. The outcome depends on counts alone, not on the order of the lines.

Only hashes of lines are shuffled until leaves that few documents reach are gone. Counts combine before the shuffle,
so a line that a third of all documents share is one row per task; where rows of such a line are joined, both sides
are shuffled plainly and AQE splits them. No leaf is gathered.

Defined cases: NULL text stays NULL, blank lines always stay, a document may end up empty; lines differ if their tokens do, whatever the whitespace; extra
columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import text_or_empty

DEPTH = 3
LEAST_DOCUMENTS = 5
WEIGHT = 100  # documents times tokens of a line that don't come about by chance
STEP = 2  # from one rung to the next
VARIABLE = 0.25  # most of a template's places without digits
WILDCARD = "<*>"


def tokens(line: Column) -> Column:
    """Tokens between whitespace, those with a digit as the wildcard."""
    # Most lines have no digit and no other whitespace than blanks: one look instead of one per token. A pattern to split
    # on would be compiled for every line; a blank isn't.
    found = F.array_remove(F.split(F.regexp_replace(line, r"\s", " "), " "), "")
    wild = F.transform(found, lambda t: F.when(t.rlike(r"\d"), F.lit(WILDCARD)).otherwise(t))
    return F.when(line.rlike(r"[\t\n\x0b\f\r\d]"), wild).otherwise(F.array_remove(F.split(line, " "), ""))


def line_id(found: Column) -> Column:
    """A number for a list of tokens; a second hash in the leaf makes chance matches a matter of 128 bits."""
    return F.xxhash64(F.lit(1), found)


def leaf_id(found: Column) -> Column:
    return F.xxhash64(F.size(found), F.slice(found, 1, DEPTH))


def _lines(text: Column) -> Column:
    return F.split(text_or_empty(text), "\n")


def raw_id(line: Column) -> Column:
    """A number for a line as it is."""
    return F.xxhash64(F.lit(2), line)


def _enough(literal: Column, size: Column) -> Column:
    """Whether so many literal tokens tell a template."""
    return (literal >= 2) | (2 * literal >= size)


def _needed(size: Column, least: int) -> Column:
    """Documents that a line of so many tokens has to stand in."""
    return F.least(F.lit(least), F.greatest(F.lit(2), F.ceil(F.lit(WEIGHT) / size))).cast("int")


def _ids(text: Column) -> Column:
    """Leaf and line of each line that isn't blank, its tokens and those without digits; the exact text only of lines with digits."""
    each = F.transform(_lines(text), lambda line: F.struct(tokens(line).alias("t"), line.alias("body")))
    each = F.filter(each, lambda x: F.size(x["t"]) > 0)

    def one(x: Column) -> Column:
        digits = F.array_contains(x["t"], WILDCARD)
        literal = F.when(digits, F.size(F.filter(x["t"], lambda t: t != WILDCARD))).otherwise(F.size(x["t"]))
        return F.struct(
            leaf_id(x["t"]).alias("leaf"), line_id(x["t"]).alias("line"), F.when(digits, raw_id(x["body"])).alias("raw"),
            F.size(x["t"]).alias("size"), literal.alias("literal"),
        )

    return F.transform(each, one)


def text_id(text: Column) -> Column:
    """Two hashes of a text, which tell texts apart: a chance match is a matter of 128 bits."""
    return F.struct(F.xxhash64(F.lit(3), text).alias("a"), F.xxhash64(F.lit(4), text).alias("b"))


def recurring_lines(documents: DataFrame, least: int = LEAST_DOCUMENTS, variable: float = VARIABLE) -> tuple[DataFrame, DataFrame]:
    """``body, leaf, line, raw, size, literal`` of all lines, and ``leaf, line`` of those to drop. Runs jobs; both are staged.

    ``body`` is :func:`text_id`; documents of one text are one.
    """
    text = F.col("text")
    rows = documents.select(text_id(text).alias("body"), F.inline(_ids(text))).distinct()
    rows = stage(rows, "lines")
    # A document may have lines that differ in digits alone; it counts once.
    once = rows.where("raw IS NULL").select("body", "leaf", "line", "size", "literal")
    once = once.unionByName(rows.where("raw IS NOT NULL").select("body", "leaf", "line", "size", "literal").distinct())
    sizes = [F.max(c).alias(c) for c in ("size", "literal")]
    counts = stage(once.groupBy("leaf", "line").agg(F.count(F.lit(1)).alias("n"), *sizes), "line-counts")
    alike = _enough(F.col("literal"), F.col("size")) & (F.col("n") >= _needed(F.greatest("literal", F.lit(1)), least))
    alike = counts.where(alike).select("leaf", "line")
    leaves = counts.groupBy("leaf").agg(F.sum("n").alias("documents")).where(F.col("documents") >= least)
    likely = stage(counts.join(stage(leaves.select("leaf"), "leaves"), "leaf", "left_semi"), "likely-lines")

    # The lines that are left, once each; texts are shuffled as they are, tokens made behind.
    whole = documents.select(F.explode(_lines(text)).alias("body")).where(F.col("body").rlike(r"\S"))
    whole = whole.withColumn("tokens", tokens(F.col("body"))).select(leaf_id(F.col("tokens")).alias("leaf"), line_id(F.col("tokens")).alias("line"), "body")
    whole = whole.join(likely.select("leaf", "line").hint("merge"), ["leaf", "line"], "left_semi")
    whole = whole.groupBy("leaf", "line").agg(F.min("body").alias("body")).withColumn("tokens", tokens(F.col("body")))
    places = whole.join(likely, ["leaf", "line"]).select("leaf", "line", "n", F.posexplode("tokens").alias("place", "token"))
    places = stage(places, "places")
    fixed = places.groupBy("leaf", "place", "token").agg(F.sum("n").alias("documents")).where(F.col("documents") >= least)
    rung = F.floor(F.log(float(STEP), F.col("documents") / F.lit(least)) + 1e-9).cast("int")
    fixed = stage(fixed.select("leaf", "place", "token", rung.alias("rung")), "fixed")
    marked = places.join(fixed, ["leaf", "place", "token"], "left")
    # Each place with the rungs up to which its token is fixed, wildcards with none.
    rung = F.when(F.col("token") == WILDCARD, -1).otherwise(F.coalesce("rung", F.lit(-1)))
    marked = marked.select("leaf", "line", "place", "token", rung.alias("rung"))
    lines = marked.groupBy("leaf", "line").agg(
        F.sort_array(F.collect_list(F.when(F.col("rung") >= 0, F.struct("place", "token", "rung")))).alias("kept"),
        F.count(F.when(F.col("token") != WILDCARD, 1)).alias("words"), F.count(F.lit(1)).alias("size"),
    )
    rungs = F.array_distinct(F.transform("kept", lambda x: x["rung"]))
    lines = lines.withColumn("at", F.explode(F.when(F.size(rungs) > 0, F.sequence(F.lit(0), F.array_max(rungs))).otherwise(F.array().cast("array<int>"))))
    lines = lines.withColumn("kept", F.filter("kept", lambda x: x["rung"] >= F.col("at")))
    literal = F.size("kept")
    lines = lines.where((literal >= (1 - variable) * F.col("words")) & _enough(literal, F.col("size")))
    own = F.xxhash64("at", F.transform("kept", lambda x: F.struct(x["place"], x["token"])))
    template = stage(lines.select("leaf", "line", own.alias("template")), "templates")
    in_documents = rows.select("leaf", "line", "body").join(template, ["leaf", "line"]).select("leaf", "template", "body").distinct()
    often = in_documents.groupBy("leaf", "template").agg(F.count(F.lit(1)).alias("documents")).where(F.col("documents") >= least)
    often = stage(often.select("leaf", "template"), "recurring")
    found = template.join(often, ["leaf", "template"], "left_semi").select("leaf", "line").unionByName(alike)
    return rows, stage(found.distinct(), "dropped")


def recurring_texts(rows: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``raw`` of lines with digits that stand in enough documents word for word. Runs jobs."""
    counts = rows.where("raw IS NOT NULL").groupBy("raw").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size"))
    return stage(counts.where(F.col("n") >= _needed(F.col("size"), least)).select("raw"), "exact-lines")


def drop_recurring(documents: DataFrame, least: int = LEAST_DOCUMENTS, variable: float = VARIABLE) -> DataFrame:
    """``documents`` without the lines of recurring templates, and ``lines_dropped``. Runs jobs."""
    rows, dropped = recurring_lines(documents, least, variable)
    gone = rows.join(dropped, ["leaf", "line"]).select("body", F.col("line").alias("gone"))
    exact = rows.where("raw IS NOT NULL").join(recurring_texts(rows, least), "raw").select("body", F.col("raw").alias("gone"))
    gone = gone.unionByName(exact).groupBy("body").agg(F.collect_set("gone").alias("_gone"))
    gone = stage(gone.withColumnRenamed("body", "_body"), "dropped-lines")
    # Under names of their own, columns can't clash with what is added here.
    own = [F.col(f"`{c}`").alias(f"column{i}") for i, c in enumerate(documents.columns) if c not in ("text", "lines_dropped")]
    back = [F.col(f"column{i}").alias(c) for i, c in enumerate(documents.columns) if c not in ("text", "lines_dropped")]
    joined = documents.select(*own, "text").join(gone.hint("merge"), text_id(F.col("text")) == F.col("_body"), "left")
    lines = _lines(F.col("text"))
    left = F.filter(lines, lambda line: ~(F.array_contains("_gone", line_id(tokens(line))) | F.array_contains("_gone", raw_id(line))))
    cut = joined.withColumn("_left", F.when(F.col("_gone").isNotNull(), left))
    return cut.select(
        *back,
        F.when(F.col("_left").isNull(), F.col("text")).otherwise(F.array_join("_left", "\n")).alias("text"),
        F.when(F.col("_left").isNull(), 0).otherwise(F.size(lines) - F.size("_left")).alias("lines_dropped"),
    )
