"""Joins between catalogue, encyclopedia, links and detail records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import overlap_or_unknown
from ..session import stage

ANY_DIRECTOR = "*"  # key of catalogue rows with unknown directors; a director's key begins with a mark of its own
BY_TITLE = ""  # key of rows under a title of few catalogue rows
FEW_ROWS = 8  # catalogue rows under a title that each of its encyclopedia rows may be tested against


def _director_keys(directors: Column) -> Column:
    """One key per distinct director; the mark keeps a director from ever reading as ANY_DIRECTOR."""
    return F.transform(F.array_distinct(directors), lambda d: F.concat(F.lit("="), d))


def _catalogue_keys() -> Column:
    unknown = F.array_contains("director_list", fixed.UNKNOWN)
    return F.when(unknown, F.array(F.lit(ANY_DIRECTOR))).otherwise(_director_keys(F.col("director_list")))


def _wiki_keys() -> Column:
    return F.concat(F.array(F.lit(ANY_DIRECTOR)), _director_keys(F.col("director_wiki")))


def _by_key(left: DataFrame, right: DataFrame, *others: Column) -> DataFrame:
    """Rows that meet under a title and a key, at the first director they share or for one of the ``others``."""
    # A missing name is no name: it matches nothing and doesn't hide the names behind it.
    shared = F.array_intersect(F.array_compact("director_list"), F.array_compact("director_wiki"))
    first_shared = F.concat(F.lit("="), F.get(shared, F.lit(0)))
    counts = reduce(Column.__or__, others, (F.col("_left") == ANY_DIRECTOR) | (F.col("_left") == first_shared))
    return left.join(right, (F.col("title") == F.col("title_wiki")) & (F.col("_left") == F.col("_right")) & counts)


def matching_pairs(catalogue: DataFrame, wiki: DataFrame) -> DataFrame:
    """All pairs with equal titles and a shared director, or unknown directors on the catalogue side.

    The overlap test is an equi-join on (title, director) rather than a join on title with a test behind
    it: under a title shared by very many rows the latter would compare every pair. A catalogue row with
    unknown directors has the single key ANY_DIRECTOR, which every encyclopedia row offers too. A pair
    that shares several directors meets several times and counts at the first one. What remains hot is a
    key whose pairs are all results; AQE splits it on both sides, since the join is an inner one.
    """
    left = catalogue.withColumn("_left", F.explode(_catalogue_keys()))
    right = wiki.withColumn("_right", F.explode(_wiki_keys()))
    return _by_key(left, right).select(*catalogue.columns, *wiki.columns)


def _overlap() -> Column:
    """Whether two rows of a title are a pair."""
    return F.col("director_wiki").isNotNull() & overlap_or_unknown(F.col("director_list"), F.col("director_wiki"))


def _pairs(films: DataFrame, wiki: DataFrame) -> DataFrame:
    """:func:`matching_pairs` of ``films`` (staged) with each encyclopedia row shuffled once. Runs a job.

    Under a title of few catalogue rows the overlap is tested behind a join on the title: an encyclopedia row then meets
    :data:`FEW_ROWS` at most. Only under the other titles do directors become keys; there may be none.
    """
    crowded = films.where("title IS NOT NULL").groupBy("title").agg(F.count(F.lit(1)).alias("_n"))
    crowded = stage(crowded.where(F.col("_n") > FEW_ROWS).select("title", F.lit(True).alias("_crowded")), "crowded")
    if crowded.isEmpty():
        return films.join(wiki, (F.col("title") == F.col("title_wiki")) & _overlap())

    def keys(own: Column) -> Column:
        return F.explode(F.when(F.col("_crowded"), own).otherwise(F.array(F.lit(BY_TITLE))))

    left = films.join(crowded, "title", "left").withColumn("_left", keys(_catalogue_keys())).drop("_crowded")
    right = wiki.join(crowded.withColumnRenamed("title", "title_wiki"), "title_wiki", "left")
    right = right.withColumn("_right", keys(_wiki_keys())).drop("_crowded")
    return _by_key(left, right, (F.col("_left") == BY_TITLE) & _overlap()).select(*films.columns, *wiki.columns)


def link_catalogue(catalogue: DataFrame, wiki: DataFrame) -> DataFrame:
    """Left outer join of the catalogue with all its encyclopedia partners. Runs jobs when called.

    Every given column is staged with the catalogue and the pairs, so leave out those that aren't read later.
    Both are staged once, so catalogue and encyclopedia are read once. Whether a row has partners depends only
    on its title and directors, so the rest is an anti join on those.
    """
    films = stage(catalogue, "films")
    pairs = stage(_pairs(films, wiki), "pairs")
    key = ["title", "director_list"]
    rest = films.join(pairs.select(*key).distinct(), key, "left_anti").select(*films.columns)
    return pairs.unionByName(rest, allowMissingColumns=True)


def film_keywords(catalogue: DataFrame, always: str | None = fixed.ALWAYS_KEYWORD) -> DataFrame:
    """Keywords per film: a fixed one, if any, and each director unless unknown."""
    first = F.array(*[F.lit(always)] if always else []).cast("array<string>")
    known = F.coalesce(F.array_remove("director_list", fixed.UNKNOWN), F.array().cast("array<string>"))
    words = F.array_union(first, known)
    return catalogue.select("title", "director_list", F.explode(words).alias("keyword"))


# Gram lengths of the containment join. A keyword uses the longest one that fits it.
GRAMS = (12, 6, 3, 2, 1)
FLAGS_PER_GRAM = 32  # flags of the membership filter to a wanted gram; with two to a gram, a few of a thousand others pass
MOST_FLAGS = 1 << 22  # 512 KB; with more wanted grams the filter lets more pass, and the join sorts them out
MANY_GRAMS = 1 << 15  # wanted grams from which on keywords are first left out whose commonest gram no link holds
SMALL_BYTES = 8 << 20  # keywords up to this size are broadcast


def _grams(text: Column, q: Column) -> Column:
    """All runs of q characters of a text."""
    count = F.length(text) - q + 1
    starts = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.substring(text, i, q))


def _chosen_grams(words: DataFrame) -> DataFrame:
    """``_keyword, _word, _gram, _common``: for each word the grams that fewest and most words share, of the longest length that fits; staged."""
    length = F.length("_word")
    q = reduce(lambda c, n: c.when(length >= n, n), GRAMS[1:], F.when(length >= GRAMS[0], GRAMS[0]))
    grams = words.where("_word <> ''").select("_keyword", "_word", F.explode(F.array_distinct(_grams(F.col("_word"), q))).alias("_gram"))
    shared = grams.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    pick = F.struct("_n", "_gram")
    ends = grams.join(shared, "_gram").groupBy("_keyword", "_word").agg(F.min(pick).alias("_least"), F.max(pick).alias("_most"))
    return stage(ends.select("_keyword", "_word", F.col("_least._gram").alias("_gram"), F.col("_most._gram").alias("_common")), "chosen")


class _Filter:
    """A hash filter of the chosen grams, tested within a row: two flags to a gram, as a constant list of 64-bit words."""

    def __init__(self, chosen: DataFrame, wanted: int) -> None:
        self.slots = min(MOST_FLAGS, max(64, 1 << (wanted * FLAGS_PER_GRAM - 1).bit_length()))
        slot = F.explode(F.array(*self._places(F.xxhash64("_gram")))).alias("slot")
        words = chosen.select(slot).groupBy(F.shiftright("slot", 6).alias("word"))
        words = words.agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("flags"))
        held = {r["word"]: r["flags"] for r in words.collect()}  # at most MOST_FLAGS / 64 rows
        text = ",".join(str(held.get(i, 0)) for i in range(self.slots // 64))
        self.flags = F.split(F.lit(text), ",").cast("array<bigint>")  # folded to a constant

    def _places(self, hashed: Column) -> list[Column]:
        return [h.bitwiseAND(F.lit(self.slots - 1)) for h in (hashed, F.shiftrightunsigned(hashed, 32))]

    def passes(self, hashed: Column) -> Column:
        def flag(slot: Column) -> Column:
            return F.bit_get(F.get(self.flags, F.shiftright(slot, 6).cast("int")), slot.bitwiseAND(F.lit(63)).cast("int")) == 1

        first, second = self._places(hashed)
        return flag(first) & flag(second)


def _gram_sizes(chosen: DataFrame) -> dict[int, Row]:
    """Number and bytes of the chosen grams by length: a row for each of :data:`GRAMS`."""
    bytes_ = F.sum(F.octet_length("_keyword") + F.octet_length("_word") + F.octet_length("_gram") + 64).alias("bytes")
    return {r["q"]: r for r in chosen.groupBy(F.length("_gram").alias("q")).agg(F.count(F.lit(1)).alias("n"), bytes_).collect()}


def _wanted(rows: DataFrame, grams: DataFrame, lengths: list[int]) -> DataFrame:
    """``_id, _link, _gram``: for each of ``rows`` the distinct grams of its link that pass the filter of ``grams``.

    Every place of a link is a row for as long as it takes to test it, since such rows are handled by compiled code and a
    list of all grams within the row isn't. The hashes are a generated column, below which no test is pushed: each is taken
    once. The grams themselves are cut where the filter lets one pass.
    """
    tested = _Filter(grams, grams.count())
    sizes = sorted(lengths, reverse=True)
    at = F.explode(F.sequence(F.lit(1), F.length("_link") - (sizes[-1] - 1))).alias("_at")
    placed = rows.where(F.length("_link") >= sizes[-1]).select("_id", "_link", at)
    hashes = F.array(*[F.xxhash64(F.substring("_link", F.col("_at"), F.lit(q))) for q in sizes])
    hashed = placed.select("_id", "_link", "_at", F.posexplode(hashes).alias("_which", "_hash")).where(tested.passes(F.col("_hash")))
    size = reduce(lambda c, q: c.when(F.col("_which") == q[0], q[1]), list(enumerate(sizes))[1:], F.when(F.col("_which") == 0, sizes[0]))
    cut = hashed.select("_id", "_link", "_at", size.alias("_size"), F.substring("_link", F.col("_at"), size).alias("_gram"))
    # Near the end of a link a cut is too short. A gram counts where it comes first.
    first = (F.length("_gram") == F.col("_size")) & (F.instr("_link", F.col("_gram")) == F.col("_at"))
    return cut.where(first).select("_id", "_link", "_gram")


def _held(keywords: DataFrame, rows: DataFrame, keyword: str) -> DataFrame:
    """``_keyword, _id, _link``, each once: the keywords that the links of ``rows`` (``_id, _link``, staged) hold. Runs jobs.

    A link that holds a keyword holds each of its grams, so the join runs on one gram per keyword: the one that fewest
    keywords share. Then a gram leads to few keywords, and the candidates stay in proportion to the links' characters.
    The links are read once and cut into the grams of all lengths in use; a filter tells within the row which of them are
    wanted, and only those become rows. Measured small, the keywords are broadcast and a candidate is tested where it is
    found. Otherwise the grams are shuffled with their links, so a candidate is tested there too and only true pairs go on.
    Of very many keywords those are left out first whose commonest gram is in no link; commonest grams are few.
    """
    words = keywords.select(
        F.col(keyword).alias("_keyword"), F.replace(F.col(keyword), F.lit(" "), F.lit("_")).alias("_word")
    )
    words = stage(words.filter("_word IS NOT NULL").distinct(), "keywords")
    chosen = _chosen_grams(words)
    lengths = _gram_sizes(chosen)
    if sum(r["n"] for r in lengths.values()) > MANY_GRAMS:
        common = stage(chosen.select(F.col("_common").alias("_gram")).distinct(), "common")
        hits = _wanted(rows, common, list(lengths)).select("_gram").distinct()
        chosen = stage(chosen.join(hits.withColumnRenamed("_gram", "_common"), "_common", "left_semi"), "chosen")
        lengths = _gram_sizes(chosen)
    found = []
    if lengths:
        small = sum(r["bytes"] for r in lengths.values()) <= SMALL_BYTES
        # The planner doesn't see how much the links grow when cut, and must not broadcast them.
        pairs = _wanted(rows, chosen, list(lengths)).join(F.broadcast(chosen) if small else chosen.hint("merge"), "_gram")
        found.append(pairs.filter(F.contains("_link", "_word")).select("_keyword", "_id", "_link"))
    if not lengths or not words.filter("_word = ''").isEmpty():  # every link holds the empty keyword, which is one row
        blank = words.filter("_word = ''").select("_keyword").withColumn("_all", F.lit(0))
        found.append(rows.withColumn("_all", F.lit(0)).join(F.broadcast(blank.limit(1)), "_all").select("_keyword", "_id", "_link"))
    return reduce(DataFrame.unionByName, found)


def keyword_links(
    keywords: DataFrame, links: DataFrame, keyword: str = "keyword", link: str = "link"
) -> DataFrame:
    """All (keyword, link) pairs where the link holds the keyword with blanks as underscores, each once. Runs jobs when called.

    Containment without comparing every keyword with every link, for lists of any length.
    """
    whole = links.select(F.col(link).alias("_link")).filter("_link IS NOT NULL").distinct()
    whole = stage(whole.withColumn("_id", F.monotonically_increasing_id()), "links")
    return _held(keywords, whole, keyword).select(F.col("_keyword").alias(keyword), F.col("_link").alias(link))


def match_keywords_to_links(
    keywords: DataFrame, links: DataFrame, keyword: str = "keyword", link: str = "link"
) -> DataFrame:
    """Rows of ``links`` whose link holds at least one keyword; a row stays one row. Runs jobs when called."""
    rows = stage(links.withColumn("_id", F.monotonically_increasing_id()), "links")
    texts = rows.select("_id", F.col(link).alias("_link")).filter("_link IS NOT NULL")
    held = _held(keywords, texts, keyword).select("_id").distinct()
    return rows.join(held, "_id", "left_semi").select(*links.columns)


def enrich(catalogue: DataFrame, details: DataFrame, key: str | list[str] = "title") -> DataFrame:
    """Set release, writer and music where the detail record has them; directors only where unknown.

    ``details`` holds one record per key. ``director_list`` may be replaced, the other three are added or
    overwritten.
    """
    found = details.select(
        *([key] if isinstance(key, str) else key),
        F.col("release_date").alias("_release"),
        F.col("writers").alias("_writers"),
        F.col("composer").alias("_music"),
        F.col("directors").alias("_directors"),
    )
    joined = catalogue.join(found, key, "left")

    def updated(name: str, new: str) -> Column:
        return F.coalesce(F.col(new), F.col(name)) if name in catalogue.columns else F.col(new)

    unknown = F.coalesce(F.array_contains("director_list", fixed.UNKNOWN), F.lit(False))
    directors = F.when(unknown & F.col("_directors").isNotNull(), F.col("_directors"))
    changed = {
        "release": updated("release", "_release"),
        "writer": updated("writer", "_writers"),
        "music": updated("music", "_music"),
        "director_list": directors.otherwise(F.col("director_list")),
    }
    kept = [F.col(c) for c in catalogue.columns if c not in changed]
    return joined.select(*kept, *[c.alias(name) for name, c in changed.items()])
