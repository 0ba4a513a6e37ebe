import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="nestlift-tests-")
    s = (SparkSession.builder.master("local[4]")
         .appName("nestlift-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
         .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoint"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def records(spark):
    """Build a bronze-like frame (``raw_json``) from JSON text lines."""
    def make(*lines):
        return spark.createDataFrame([(x,) for x in lines], "raw_json STRING")
    return make
