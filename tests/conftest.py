import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.support import SF_DIR  # noqa: E402, F401


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def uri(tmp_path):
    return lambda name: str(tmp_path / name)


@pytest.fixture
def column(spark):
    """Values of an expression over one column of inputs."""

    def run(build, values, dtype="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
        return [r.out for r in df.select("i", build(df.v).alias("out")).orderBy("i").collect()]

    return run
