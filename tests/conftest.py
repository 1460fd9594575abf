import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from check import database, session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return session(partitions="4")


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def duck():
    return database(SMALL)


@pytest.fixture(scope="session")
def tiny(spark):
    """Eight rows small enough to work out by hand; hr 9 and hum 0.31 occur in test rows only."""
    rows = [
        (1, 0.0, 0.24, 10.0, "train"), (2, 0.0, 0.26, 20.0, "train"), (3, 1.0, 0.24, 15.0, "train"),
        (4, 2.0, 0.26, 40.0, "train"), (5, 2.0, 0.0, 60.0, "train"), (6, 0.0, 0.24, 18.0, "test"),
        (7, 2.0, 0.26, 44.0, "test"), (8, 9.0, 0.31, 30.0, "test"),
    ]
    return spark.createDataFrame(rows, "id bigint, hr double, hum double, label double, split string")


@pytest.fixture(scope="session")
def skewed(spark):
    """30,000 rows: a third are copies of one row, a tenth have no key."""
    i = F.col("id")
    hot = i % 3 == 0
    return spark.range(30_000).select(
        F.when(hot, 0).otherwise(i).alias("id"),
        F.when(hot, 7).when(i % 10 == 1, None).otherwise(i % 997).cast("int").alias("key"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("k"), (i % 501).cast("string"))).alias("name"),
        F.when(hot, 5).otherwise(i % 41).cast("decimal(18,2)").alias("label"),
    )
