"""Scans of encyclopedia dumps. Land a dump as Parquet once; every later scan prunes and pushes down."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.pages import page_text
from ..functions.text import strip

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField(
            "revision",
            T.StructType([T.StructField("text", T.StructType([T.StructField("_VALUE", T.StringType())]))]),
        ),
    ]
)


def scan_page_dump(spark: SparkSession, path: str, row_tag: str = "page") -> DataFrame:
    """One row per ``<page>`` of an XML dump.

    The file is read as text records that end in the closing tag, which Spark splits among tasks at any
    size; Spark's own XML source gives a whole file to one task. Each record is then parsed as XML. A record that
    can't be parsed is kept whole in ``corrupt``, which is NULL for all others.
    """
    close = f"</{row_tag}>"
    records = spark.read.option("lineSep", close).text(path)
    start = F.coalesce(
        *[
            F.expr(f"nullif(locate('<{row_tag}{end}', value), 0)")
            for end in (">", " ", "\\n", "\\t", "\\r")
        ]
    )
    page = records.withColumn("_start", start).filter("_start IS NOT NULL")
    xml = F.concat(F.expr("substring(value, _start)"), F.lit(close))
    options = {"rowTag": row_tag, "ignoreSurroundingSpaces": "false", "columnNameOfCorruptRecord": "corrupt"}
    schema = T.StructType([*PAGE_SCHEMA.fields, T.StructField("corrupt", T.StringType())])
    # The text element carries attributes, which makes its content the field _VALUE.
    parsed = page.select(F.from_xml(xml, schema.simpleString(), options).alias("_p"))
    return parsed.select("_p.title", "_p.revision", "_p.corrupt")


def scan_dump_text(spark: SparkSession, path: str, row_tag: str = "doc") -> DataFrame:
    """Text lines of a dump without tags; blank lines are left out.

    Records that end in the closing tag are read whole, since tags, comments and scripts may go over several lines.
    """
    records = spark.read.option("lineSep", f"</{row_tag}>").text(path)
    lines = records.select(F.explode(F.split(page_text(F.col("value")), r"\r\n?|\n")).alias("text"))
    return lines.filter(strip(F.col("text")) != "")
