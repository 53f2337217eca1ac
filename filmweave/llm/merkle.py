"""Merkle manifest of a dataset: a content-addressed DAG, and inclusion proofs by descent from its root.

The leaves of one group (a language) ascend by id; while a level has several nodes, each run of ``ARITY`` consecutive
ones gets a parent, whose digest is that of the children's digests. The groups' roots, in order, are the leaves of a tree
of the same kind, whose root stands for the dataset.

Nodes are stored by content: a record leads from a node's digest to the digests below it. To keep the joins few, a record
is a *page* and holds ``LEVELS`` levels of children, at most ``ARITY ** LEVELS`` nodes at its foot. Equal subtrees are one
record. A request names a leaf by its group and its rank; the digits of the rank in base ``ARITY`` are the turns to take.
All requests descend together: those that share the digits so far are one row of the frontier, which is joined with the
records on the digest, takes the next digits and collects the children it passes by. So the work of a descent
is the leaves and a fraction more, and the frontier of the last join has a row for each page, not for each leaf.
The collected segments run from the root down; reversed, they are the proof.

Ranks need no global sort in one task: leaves are range-partitioned by group and id, the rows of each
group are counted by partition, and the running counts are added. A group that holds most rows lies in many partitions.

Defined cases: a NULL field is ``-``, unlike the empty text ``0:``; NULL ids come first in their group; rows with the
same id follow each other by digest, and wholly equal rows by nothing, as they have one digest; NULL is a group of
its own, before all others; no rows, no result; a single leaf is its group's root and has an empty proof; long texts
are hashed whole; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

ARITY = 2
LEVELS = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED = 7  # documents whose id's CRC-32 this divides are tampered with in the query
_WITHIN = (1 << 33) - 1  # monotonically_increasing_id: the partition above, the row below 33 bits


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def encoded(value: Column) -> Column:
    """``-`` for NULL, else the value's length in UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return digest(F.concat(*map(encoded, values)))


def _runs(level: Column, arity: int) -> Column:
    """Digests of the parents of a level that is not empty."""
    runs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / arity).cast("int"))
    return F.transform(runs, lambda i: digest(F.array_join(F.slice(level, i * arity + 1, F.lit(arity)), "")))


def page_levels(feet: Column, lift: Column, arity: int = ARITY) -> Column:
    """The levels of a page: its foot, then ``lift`` levels of parents, of which the last has one node."""
    steps = F.when(lift > 0, F.sequence(F.lit(1), lift)).otherwise(F.array().cast("array<int>"))
    start = F.struct(F.array(feet).alias("levels"), feet.alias("top"))

    def raise_(acc: Column, _: Column) -> Column:
        upper = F.get(F.transform(F.array(acc["top"]), lambda top: _runs(top, arity)), F.lit(0))
        bound = F.transform(F.array(upper), lambda u: F.struct(F.concat(acc["levels"], F.array(u)).alias("levels"), u.alias("top")))
        return F.get(bound, F.lit(0))

    return F.aggregate(steps, start, raise_, lambda acc: acc["levels"])


def passed_by(levels: Column, foot: Column, arity: int = ARITY) -> Column:
    """The path from a page's top to one node of its foot: for each level the siblings ``before`` and ``after``, joined."""

    def siblings(height: Column) -> Column:
        at = F.floor(foot / F.pow(F.lit(arity), height)).cast("int")
        run = (at / F.lit(arity)).cast("int") * arity
        level = F.element_at(levels, height + 1)
        before = F.slice(level, run + 1, at - run)
        after = F.slice(level, at + 2, run + arity - 1 - at)
        return F.struct(F.array_join(before, "").alias("before"), F.array_join(after, "").alias("after"))

    lift = F.size(levels) - 1
    down = F.when(lift > 0, F.sequence(lift - 1, F.lit(0), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    return F.transform(down, siblings)


def folded(leaf_digest: Column, proof: Column) -> Column:
    """The root that a leaf and the siblings of its proof, from the leaf up, lead to."""
    return F.aggregate(proof, leaf_digest, lambda acc, step: digest(F.concat(step["before"], acc, step["after"])))


def proof_digest(proof: Column) -> Column:
    return digest(F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), ""))


def _height(n: Column, arity: int) -> Column:
    """Levels above ``n`` leaves: the least ``h`` with ``arity ** h >= n``, by whole numbers."""
    powers = F.array(*[F.lit(arity**h) for h in range(64) if arity**h < 1 << 62])
    return F.size(F.filter(powers, lambda p: p < n))


def ranked(rows: DataFrame, tree: str, order: list[Column]) -> DataFrame:
    """``rows`` with ``rank``, from 0 by ``order`` within each ``tree``, and ``n``, the rows of the tree. Runs jobs when called."""
    spread = rows.repartitionByRange(F.col(tree).asc_nulls_first(), *order)
    spread = spread.sortWithinPartitions(F.col(tree).asc_nulls_first(), *order)
    placed = stage(spread.select("*", F.monotonically_increasing_id().alias("at")), "placed")
    part, at = F.shiftrightunsigned("at", 33), F.col("at").bitwiseAND(F.lit(_WITHIN))
    placed = placed.withColumn("part", part).withColumn("at", at)
    # One row for each tree and partition it lies in.
    counts = placed.groupBy(tree, "part").agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("start"))
    counts = stage(counts.withColumnRenamed(tree, "of"), "counts")
    # Their running sums: a tree has a row for each partition, which are few against its leaves.
    whole = Window.partitionBy("of")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "of", F.col("part").alias("part2"), F.sum("rows").over(whole).alias("n"),
        (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("start")).alias("shift"),
    )
    found = placed.join(offsets, F.col(tree).eqNullSafe(F.col("of")) & (F.col("part") == F.col("part2")))
    return found.select(*rows.columns, (F.col("at") + F.col("shift")).alias("rank"), "n")


class Forest:
    """Trees over ranked leaves: their pages by content, and for each tree its root and the shape to descend by.

    ``pages`` (``key, levels``) holds the records; ``key`` is the digest of a page's top with its lift, as pages of one
    top may be cut at different heights. ``roots`` has a row for each tree: ``tree, n, height, root``.
    """

    def __init__(self, feet: DataFrame, arity: int, levels: int) -> None:
        """``feet``: ``tree, page, n`` and ``nodes``, the digests at the foot of a page in order; staged."""
        self.arity, self.levels = arity, levels
        pages, self.segments = [], 0
        while True:
            height = _height(F.col("n"), arity)
            lift = F.least(F.lit(levels), height - F.lit(levels * self.segments))
            built = feet.select("tree", "page", "n", height.alias("height"), lift.alias("lift"), page_levels(F.col("nodes"), lift, arity).alias("levels"))
            built = stage(built.withColumn("top", F.get(F.element_at("levels", -1), F.lit(0))), "pages")
            pages.append(built)
            self.segments += 1
            higher = built.where(F.col("height") > levels * self.segments)
            if higher.isEmpty():
                break
            width = arity**levels
            above = higher.groupBy("tree", "n", F.floor(F.col("page") / width).alias("above"))
            nodes = F.transform(F.sort_array(F.collect_list(F.struct("page", "top"))), lambda p: p["top"])
            feet = stage(above.agg(nodes.alias("nodes")).withColumnRenamed("above", "page"), "feet")
        whole = [p.where(F.col("height") <= levels * (i + 1)) for i, p in enumerate(pages)]
        self.roots = reduce(DataFrame.unionByName, whole).select("tree", "n", "height", F.col("top").alias("root"))
        records = reduce(DataFrame.unionByName, pages).select(_key(F.col("top"), F.col("lift")).alias("key"), "levels")
        self.pages = records.dropDuplicates(["key"])

    def descend(self, requests: DataFrame) -> DataFrame:
        """Pages at the lowest segment: ``tree, page, levels`` and ``path``, the siblings from the root to the page's top.

        ``requests``: ``tree, page`` for the lowest pages asked for, each once. Rows with common digits are one.
        """
        width = self.arity**self.levels
        roots = stage(self.roots.withColumnRenamed("tree", "of"), "roots")
        asked = requests.join(roots, F.col("tree").eqNullSafe(F.col("of"))).select("tree", "page", "height", "root")
        asked = stage(asked, "asked")
        path_type = "array<struct<before:string,after:string>>"
        segment = self.segments - 1
        waiting = stage(asked.select("tree", "height", "root").distinct(), "roots")
        frontier = None
        while True:
            top = (F.greatest(F.ceil(F.col("height") / self.levels).cast("int"), F.lit(1)) - 1)
            here = waiting.where(top == segment).select(
                "tree", "height", F.lit(0).cast("long").alias("page"), F.col("root").alias("top"), F.array().cast(path_type).alias("path")
            )
            frontier = here if frontier is None else frontier.unionByName(here)
            lift = F.least(F.lit(self.levels), F.col("height") - F.lit(self.levels * segment))
            frontier = frontier.withColumn("key", _key(F.col("top"), lift)).join(self.pages, "key")
            if segment == 0:
                return frontier.select("tree", "page", "levels", "path")
            # The next digits of the requests below each row of the frontier: distinct pages one segment down.
            below = asked.select(F.col("tree").alias("of"), F.floor(F.col("page") / width ** (segment - 1)).alias("next")).distinct()
            turns = frontier.join(
                below.withColumn("up", F.floor(F.col("next") / width)), F.col("tree").eqNullSafe(F.col("of")) & (F.col("page") == F.col("up"))
            )
            foot = (F.col("next") % width).cast("int")
            frontier = stage(
                turns.select(
                    "tree", "height", F.col("next").alias("page"), F.get(F.col("levels")[0], foot).alias("top"),
                    F.concat("path", passed_by(F.col("levels"), foot, self.arity)).alias("path"),
                ),
                "frontier",
            )
            segment -= 1


def _key(top: Column, lift: Column) -> Column:
    return F.concat(top, F.lit("/"), lift.cast("string"))


def manifest(
    documents: DataFrame, altered: Column | None = None, doc_id: str = "doc_id", group: str = "lang", fields: tuple[str, ...] = FIELDS,
    arity: int = ARITY, levels: int = LEVELS,
) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof, given, folded_root, verified`` for each document. Runs jobs when called.

    ``proof`` holds the siblings from the leaf up. ``given`` is the leaf that is verified: the true one, or ``altered``,
    the digest of a document as someone else holds it. Texts are read once and leave no trace but their digests.
    """
    true = leaf([F.col(f"`{f}`") for f in fields])
    given = true if altered is None else F.coalesce(altered, true)
    leaves = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{group}`").alias("tree"), true.alias("leaf"), given.alias("given"))
    width = arity**levels
    order = [F.col("doc_id").asc_nulls_first(), F.col("leaf").asc()]
    # A leaf that is as it should be needs no second digest.
    narrow = leaves.withColumn("given", F.when(F.col("given") != F.col("leaf"), F.col("given")))
    placed = ranked(narrow, "tree", order).withColumn("page", F.floor(F.col("rank") / width))
    items = F.sort_array(F.collect_list(F.struct("rank", "doc_id", "leaf", "given")))
    grouped = stage(placed.groupBy("tree", "page", "n").agg(items.alias("items")), "leaves")

    forest = Forest(grouped.select("tree", "page", "n", F.transform("items", lambda i: i["leaf"]).alias("nodes")), arity, levels)
    subroots = forest.roots.select(F.lit(0).alias("all"), F.col("tree").alias("group"), F.col("root").alias("subroot"))
    tops = ranked(subroots, "all", [F.col("group").asc_nulls_first()]).withColumn("page", F.floor(F.col("rank") / width))
    tops = stage(tops, "subroots")
    nodes = F.transform(F.sort_array(F.collect_list(F.struct("rank", "subroot"))), lambda i: i["subroot"])
    upper = Forest(stage(tops.groupBy(F.col("all").alias("tree"), "page", "n").agg(nodes.alias("nodes")), "feet"), arity, levels)

    # Descend from the root of the dataset to the groups' roots, then from those to the pages of leaves.
    pages = upper.descend(tops.select(F.col("all").alias("tree"), "page").distinct()).select(F.col("page").alias("at"), "levels", "path")
    root = upper.roots.select(F.col("tree").alias("all"), "root")
    groups = tops.join(pages, F.col("page") == F.col("at")).join(root, "all")
    groups = groups.select(
        "group", "subroot", "root", F.concat("path", passed_by(F.col("levels"), (F.col("rank") % width).cast("int"), arity)).alias("above")
    )
    groups = stage(groups, "groups")
    lowest = forest.descend(grouped.select("tree", "page")).select(F.col("tree").alias("of"), F.col("page").alias("at"), "levels", "path")
    found = grouped.join(lowest, F.col("tree").eqNullSafe(F.col("of")) & (F.col("page") == F.col("at")))
    found = found.join(groups, F.col("tree").eqNullSafe(F.col("group")))
    found = found.select("subroot", "root", "levels", "path", "above", F.posexplode("items").alias("foot", "item"))
    found = found.select(
        F.col("item.doc_id").alias("doc_id"), F.col("item.leaf").alias("leaf"), "subroot", "root",
        F.coalesce("item.given", "item.leaf").alias("given"),
        F.reverse(F.concat("above", "path", passed_by(F.col("levels"), F.col("foot"), arity))).alias("proof"),
    )
    found = found.withColumn("folded_root", folded(F.col("given"), F.col("proof")))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def audit(documents: DataFrame) -> DataFrame:
    """The manifest of ``documents``, with ``n_chars`` of some of them one too high where they are verified."""
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    fields = [F.col("n_chars") + 1 if f == "n_chars" else F.col(f) for f in FIELDS]
    found = manifest(documents, F.when(touched & F.col("n_chars").isNotNull(), leaf(fields)))
    return found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", "verified")
