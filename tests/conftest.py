import os

import pytest
from pyspark.sql import SparkSession

from fareflow.session import clear_scratch, prepare

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("fareflow-tests")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", tmp_path_factory.mktemp("shared").as_uri())
        .config("spark.sql.maxMetadataStringLength", "5000")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    prepare(session)
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", f"{DATA}/sf0.001")
