"""The link graph between stored pages and bounded reach in it, by walks that can be gone on with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import pages
from ..session import stage, staging_path
from ..sources.store import BucketedStore
from .skew import repeat_hot, spread_hot

HUB_DEGREE = 1_000_000  # out-links from which a page counts as a hub


def link_edges(
    pages_df: DataFrame, url: str = "url", html: str = "html", unique_urls: bool = True
) -> DataFrame:
    """Edges ``(src_url, dst_url)`` from the absolute and site-relative links of stored pages.

    Each once, and without links that a walk would not follow. A page's repeated links go within its row;
    as a page store is unique by url, no shuffle is needed.
    """
    page = F.col(html)
    links = F.array_distinct(F.concat(pages.absolute_links(page), pages.relative_links(page)))
    edges = pages_df.select(F.col(url).alias("src_url"), F.explode(links).alias("dst_url"))
    edges = edges.filter(~pages.has_prefix(F.col("dst_url")))
    return edges if unique_urls else edges.distinct()


class Walk:
    """A breadth-first walk kept in a folder: the edges, laid out by source, and the visited nodes by level.

    Both are stores bucketed by what they are joined on, so a level shuffles its frontier and the nodes it finds, never
    the edges and never the nodes visited before. A level is a batch of the visited store: it is committed whole, so a walk that
    stops, or fails within a level, goes on with the next one, in this session or a later one.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None, kind: str = "STRING") -> None:
        """``kind`` is the type of a node; ``buckets`` counts for a new walk, by default the session's shuffle partitions."""
        self.spark, self.path, self.kind, self._hubs = spark, path, kind, None
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.edges = BucketedStore(spark, f"{path}/edges", f"_src {kind}, _salt INT, _dst {kind}", ["_src", "_salt"], buckets)
        self.visited = BucketedStore(spark, f"{path}/visited", f"_node {kind}", "_node", buckets)

    def start(
        self, edges: DataFrame, seeds: DataFrame, src: str = "src_url", dst: str = "dst_url", node: str = "url", hub_degree: int = HUB_DEGREE
    ) -> Walk:
        """Lay out the edges and take the seeds as level 0; what an earlier start has committed stays.

        Links are staged and degrees counted first, combined before their shuffle. So the out-links of a hub are salted by target before
        they are laid out, and no task gets all of them.
        """
        if not self.edges.batches():
            links = edges.select(F.col(src).alias("_src"), F.col(dst).alias("_dst")).filter("_src <> _dst")
            links = stage(links, "links")
            degrees = links.groupBy("_src").agg(F.count(F.lit(1)).alias("_degree"))
            degrees.filter(F.col("_degree") >= hub_degree).select("_src").write.mode("overwrite").parquet(f"{self.path}/hubs")
            self._hubs = None
            hubs = self.hubs()
            salted = links.withColumn("_salt", F.lit(0)) if hubs is None else spread_hot(links, hubs, "_src", "_dst")
            self.edges.append(salted, 0)
        if not self.visited.batches():
            self.visited.append(seeds.select(F.col(node).alias("_node")).filter("_node IS NOT NULL").distinct(), 0)
        return self

    def hubs(self) -> DataFrame | None:
        """The hubs, if there are any."""
        if self._hubs is None:
            hubs = self.spark.read.schema(f"_src {self.kind}").parquet(f"{self.path}/hubs")
            self._hubs = (None if hubs.isEmpty() else hubs,)
        return self._hubs[0]

    def found(self, level: int) -> DataFrame:
        """Nodes that a level leads to and no level up to it holds."""
        start = self.visited.table().filter(F.col("batch") == level).select(F.col("_node").alias("_src"))
        hubs = self.hubs()
        start = start.withColumn("_salt", F.lit(0)) if hubs is None else repeat_hot(start, hubs, "_src")
        links = self.edges.table().join(start, ["_src", "_salt"], "left_semi")
        return self.visited.unseen(links.select(F.col("_dst").alias("_node")).filter("_node IS NOT NULL").distinct(), level + 1)

    def extend(self, levels: int) -> Walk:
        """Walk up to so many levels more, until one finds nothing new."""
        done = self.visited.batches()
        for level in range(max(done), max(done) + levels):
            if not done[level]:
                break
            done[level + 1] = self.visited.append(self.found(level), level + 1)
        return self

    def reached(self, node: str = "url") -> DataFrame:
        """Visited nodes and their least ``depth``."""
        return self.visited.table().select(F.col("_node").alias(node), F.col("batch").cast("int").alias("depth"))


def reach(
    edges: DataFrame,
    seeds: DataFrame,
    max_depth: int,
    src: str = "src_url",
    dst: str = "dst_url",
    node: str = "url",
    hub_degree: int = HUB_DEGREE,
) -> DataFrame:
    """Nodes within ``max_depth`` links of a seed, with their least depth: a :class:`Walk` of its own. Runs jobs when called."""
    walk = Walk(edges.sparkSession, staging_path(edges.sparkSession, "walk"), kind=edges.schema[dst].dataType.simpleString())
    return walk.start(edges, seeds, src, dst, node, hub_degree).extend(max_depth).reached(node)


def page_reach(pages_df: DataFrame, seeds: DataFrame, max_depth: int, url: str = "url", html: str = "html") -> DataFrame:
    """Urls within ``max_depth`` links of the seeds in stored pages, with their least depth. Runs jobs when called."""
    return reach(link_edges(pages_df, url, html), seeds, max_depth, node=url)
