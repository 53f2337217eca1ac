"""Cut an ordered page list at a size budget."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .quality import row_bytes

FANOUT = 1024  # ranges per step, and so the most rows that reach the driver at once


def byte_budget(
    pages: DataFrame, budget: int, ordinal: str = "ordinal", columns: tuple[str, ...] = ("url", "html")
) -> DataFrame:
    """Pages, in ordinal order, whose running size stays within ``budget`` bytes.

    No global window: sizes are never negative, so the rows kept are a prefix of the order and one cutoff
    ordinal says it all. It is found by descent. Totals over at most ``FANOUT`` equal ranges of the
    ordinal show the range in which the budget runs out, and that range alone is divided again. The result is a plain filter that the scan can use.
    """
    sized = pages.select(F.col(ordinal).cast("bigint").alias("_o"), row_bytes(pages, list(columns)).alias("_b"))
    sized = stage(sized, "sizes")  # the texts are read once, for their sizes
    low, high = sized.agg(F.min("_o"), F.max("_o")).first()
    if low is None:
        return pages
    kept = low - 1  # every row up to here fits
    left = budget
    while low <= high:
        width = max(1, -(-(high - low + 1) // FANOUT))
        totals = (
            sized.filter(F.col("_o").between(low, high))
            .groupBy(F.expr(f"(_o - {low}L) div {width}L").alias("_r"))
            .agg(F.sum("_b").alias("_b"))
            .collect()
        )
        over = None
        for r, size in sorted((t["_r"], t["_b"]) for t in totals):
            if size > left:
                over = r
                break
            left -= size
        if over is None:
            kept = high
            break
        kept = low + over * width - 1
        if width == 1:
            break
        low, high = kept + 1, min(high, kept + width)
    return pages.filter(F.col(ordinal) <= F.lit(kept))
