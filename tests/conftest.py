import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tastegraph.session import SESSION_DEFAULTS

    b = (SparkSession.builder.master("local[*]").appName("tastegraph-tests")
         .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g"))
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        d = tempfile.mkdtemp(prefix="tastegraph-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from checks.compare import duck

    return duck(SF_SMALL)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="tastegraph-test-")
