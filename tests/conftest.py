import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from reviewlake.session import get_session
    builder_conf = {"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"}
    # tests set their own checkpoint folder only when the environment has none
    if not SparkSession.getActiveSession():
        from pyspark import SparkConf
        if not SparkConf().get("spark.checkpoint.dir", None):
            builder_conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="reviewlake-test-ckpt-")
    s = get_session("local[4]", "reviewlake-tests", conf=builder_conf)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_fresh():
    return tempfile.mkdtemp(prefix="reviewlake-test-")
