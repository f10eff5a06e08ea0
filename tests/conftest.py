import tempfile

import pytest
from pyspark.sql import SparkSession

from lakerisk.plans.lake import Lake
from tests.compare import duck

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-"))
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def con():
    return duck(SF_SMALL)


@pytest.fixture(scope="session")
def lake(spark):
    return Lake.from_tables(spark, SF_SMALL)


@pytest.fixture
def scratch(tmp_path):
    return lambda name: str(tmp_path / name)
