import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
DATA = os.environ.get("DOCSTRATA_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    """The smallest test data; tests that need it are skipped where it is absent."""
    path = f"{DATA}/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no test data")
    return path
