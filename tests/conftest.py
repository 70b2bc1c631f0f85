import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tillroll-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_rfm(spark):
    """The RFM table of the small test data, computed once."""
    import __spark_entry__ as entry
    from tillroll.scratch import materialize

    return materialize(entry.rfm(spark, SMALL), "test-rfm")


@pytest.fixture(scope="session")
def small_tx(spark):
    import __spark_entry__ as entry
    from tillroll.scratch import materialize

    return materialize(entry.tx(spark, SMALL), "test-tx")
