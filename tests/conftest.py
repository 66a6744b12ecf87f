import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from eventide.session import SESSION_DEFAULTS
    b = SparkSession.builder.master("local[*]").appName("eventide-tests")
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    # tests run without a cluster: give the checkpoint folder ourselves, as the rules allow
    b = (b.config("spark.sql.shuffle.partitions", "8")
          .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="eventide-test-ckpt-")))
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
