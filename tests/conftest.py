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

    from docforge.session import ADAPTIVE_CONF, ensure_checkpoint_dir
    b = (SparkSession.builder.master("local[*]").appName("docforge-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.driver.memory", "8g"))
    for k, v in ADAPTIVE_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="docforge-test-")
