"""Scans of page stores and catalogues."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import parse_list_text

PAGES_SCHEMA = T.StructType([T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])
CATALOGUE_SCHEMA = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("director", T.StringType()),
        T.StructField("cast", T.ArrayType(T.StringType())),
    ]
)


def scan_store(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet table at ``path``; an empty one when there is none yet."""
    try:
        return spark.read.parquet(path).select(*schema.fieldNames())
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def scan_pages(spark: SparkSession, path: str) -> DataFrame:
    return scan_store(spark, path, PAGES_SCHEMA)


def scan_catalogue(spark: SparkSession, path: str) -> DataFrame:
    return scan_store(spark, path, CATALOGUE_SCHEMA)


def load_catalogue(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Cleaned catalogue from CSV, one row per title and directors, the list text made an array.

    Cleaned titles hold no line breaks, so files are split among tasks unless ``multi_line`` is set.
    """
    rows = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .schema("url STRING, title STRING, director STRING, cast STRING")
        .csv(path)
    )
    listed = rows.select("title", parse_list_text(F.col("director")).alias("director_list"))
    return listed.dropDuplicates(["title", "director_list"])
