from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("scrublens-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def apply(spark):
    """Run a column function over a list of cells and return the results in order."""

    def run(function, cells):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(list(enumerate(cells)), "id int, text string")
        rows = df.repartition(4).select("id", function(F.col("text")).alias("out")).collect()
        return [row.out for row in sorted(rows, key=lambda row: row.id)]

    return run
