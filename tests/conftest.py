import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from ratewise.session import get_session

    SparkSession.builder.config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
    s = get_session("local[4]", 8, app_name="ratewise-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
