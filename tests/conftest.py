import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = str(tmp_path_factory.mktemp("work"))
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", f"{work}/shared")
        .config("spark.sql.warehouse.dir", f"{work}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from feedlake.session import pin

    yield pin(session)
    session.stop()


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)
