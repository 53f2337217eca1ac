"""Linkage scores, sizes and null filling. The scores are one global aggregate each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed


def _folded(c: Column, kind: T.DataType) -> Column:
    return F.transform(c, F.lower) if isinstance(kind, T.ArrayType) else F.lower(c)


def _same(df: DataFrame, a: str, b: str) -> Column:
    """Equal ignoring case, for two texts or two lists; NULL when either is missing."""
    return _folded(F.col(a), df.schema[a].dataType) == _folded(F.col(b), df.schema[b].dataType)


def _ratio(part: Column, other: Column) -> Column:
    total = part + other
    return F.when(total > 0, part / total).otherwise(F.lit(0.0))


def _scores(counts: DataFrame) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        "tp", "fp", "fn", _ratio(tp, fp).alias("precision"), _ratio(tp, fn).alias("recall")
    )


def _base_counts(linked: DataFrame) -> tuple[Column, Column, Column]:
    tp = F.count_if(_same(linked, "director_list", "director_wiki"))
    return tp, F.count(F.lit(1)) - tp, F.count_if(~_same(linked, "title", "title_wiki"))


def linkage_quality(linked: DataFrame) -> DataFrame:
    """Counts and ratios over the linked table: equal directors, all other rows, differing titles."""
    tp, fp, fn = _base_counts(linked)
    return _scores(linked.agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn")))


def linkage_quality_running(linked: DataFrame, fresh: bool = False) -> DataFrame:
    """Row classes (equal partner, unequal partner, no partner) on top of :func:`linkage_quality`'s counts.

    ``fresh`` starts from zero instead.
    """
    partner = F.col("title_wiki").isNotNull() & F.col("director_wiki").isNotNull()
    same = F.coalesce(
        _same(linked, "title", "title_wiki") & _same(linked, "director_list", "director_wiki"), F.lit(False)
    )
    tp, fp, fn = F.count_if(partner & same), F.count_if(partner & ~same), F.count_if(~partner)
    if not fresh:
        base_tp, base_fp, base_fn = _base_counts(linked)
        tp, fp, fn = base_tp + tp, base_fp + fp, base_fn + fn
    return _scores(linked.agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn")))


def row_bytes(df: DataFrame, columns: list[str]) -> Column:
    """Bytes of the text columns of a row."""
    size = F.lit(0).cast("bigint")
    for c in columns:
        size = size + F.coalesce(F.octet_length(F.col(c)), F.lit(0))
    return size


def table_size_mb(df: DataFrame, columns: list[str]) -> DataFrame:
    total = F.coalesce(F.sum(row_bytes(df, columns)), F.lit(0))
    return df.agg((total / (1024 * 1024)).alias("size_mb"))


def null_fill(df: DataFrame, value: str = fixed.ABSENT) -> DataFrame:
    """Fill missing texts with ``value`` and missing lists with ``[value]``."""
    filled = []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            c = F.coalesce(c, F.lit(value))
        elif isinstance(field.dataType, T.ArrayType):
            c = F.coalesce(c, F.array(F.lit(value)))
        filled.append(c.alias(field.name))
    return df.select(*filled)
