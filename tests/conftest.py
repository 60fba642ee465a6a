import os
import tempfile

import pytest
from pyspark.sql import SparkSession

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def make_session(cpus: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="spark-"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="spark-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    return make_session()


@pytest.fixture(scope="session")
def sf():
    return SF
