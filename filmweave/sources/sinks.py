"""Sinks. All write in parallel; nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import list_text
from ..operators.quality import null_fill
from ..session import stage


def csv_form(df: DataFrame) -> DataFrame:
    """Arrays as list text, since CSV has no arrays."""
    return df.select(
        *[
            (list_text(F.col(f.name)) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)).alias(f.name)
            for f in df.schema
        ]
    )


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    csv_form(df).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_linked(df: DataFrame, path: str, form: str = "parquet", mode: str = "errorifexists") -> None:
    """Linked table as Parquet (arrays native) or CSV."""
    if form == "csv":
        write_csv(df, path, mode)
    else:
        df.write.mode(mode).format(form).save(path)


def write_search_input(
    df: DataFrame, filled_path: str, distinct_path: str, form: str = "csv", mode: str = "errorifexists"
) -> None:
    """Two tables: missing values filled, and the same without repeated rows."""
    filled = stage(null_fill(csv_form(df)), "filled")
    for table, path in ((filled, filled_path), (filled.distinct(), distinct_path)):
        if form == "csv":
            write_csv(table, path, mode)
        else:
            table.write.mode(mode).format(form).save(path)
