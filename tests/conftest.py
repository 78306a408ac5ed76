import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = (SparkSession.builder.master("local[4]")
               .appName("netbaseline-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC"))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        # Tests only: a bare session has no shared folder configured.
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="netbaseline-ckpt-"))
    yield s


@pytest.fixture
def scratch(spark):
    from netbaseline.session import fresh_folder
    return fresh_folder(spark, "test")


SF_SMALL = "/root/testdata/sf0.001"
