import pytest
from pyspark.sql import SparkSession

from filmweave.session import SETTINGS


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[8]").appName("tests").config("spark.ui.enabled", "false")
    builder = builder.config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "6g")
    builder = builder.config("spark.ui.showConsoleProgress", "false")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def value(spark):
    """Value of an expression over one text."""
    from pyspark.sql import functions as F

    def run(expression, text):
        df = spark.createDataFrame([(text,)], "x string")
        return df.select(expression(F.col("x")).alias("v")).first()["v"]

    return run
