"""Salting of hot join keys, when they are known by count.

One side of the join spreads the rows of a hot key over salts, the other repeats its rows of that key once
per salt. Keys that are not hot keep the single salt 0, so nothing else grows. A table of hot keys is
bounded by rows / threshold; Spark broadcasts it when its measured size allows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 64


def spread_hot(df: DataFrame, hot: DataFrame, key: str, by: str, salts: int = SALTS) -> DataFrame:
    salt = F.when(F.col("_hot"), F.pmod(F.hash(by), F.lit(salts))).otherwise(F.lit(0))
    return df.join(hot.select(key, F.lit(True).alias("_hot")), key, "left").withColumn("_salt", salt).drop("_hot")


def repeat_hot(df: DataFrame, hot: DataFrame, key: str, salts: int = SALTS) -> DataFrame:
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return (
        df.join(hot.select(key, F.lit(True).alias("_hot")), key, "left")
        .withColumn("_salt", F.explode(every))
        .drop("_hot")
    )
