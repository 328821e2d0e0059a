import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from carelake.session import SESSION_DEFAULTS
    b = SparkSession.builder.master("local[4]").appName("carelake-tests").config("spark.sql.shuffle.partitions", "4")
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="carelake-test-ckpt-"))
    yield s


SF_SMALL = "/root/testdata/sf0.001"
