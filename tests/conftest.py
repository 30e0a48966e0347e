import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("gridops-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        # A zone with daylight saving: results must not depend on it.
        .config("spark.sql.session.timeZone", "America/New_York")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from checks.adapter import Tables

    return Tables(spark, SMALL)


@pytest.fixture
def fresh(tmp_path_factory):
    """A new scratch folder for one test."""
    return tmp_path_factory.mktemp("gridops")
