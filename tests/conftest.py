import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers import test-module fakes by reference: give them the paths.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [ROOT, os.path.join(ROOT, "tests")] + [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p])

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from moodwire.session import BASE_CONF
    b = SparkSession.builder.master("local[*]").appName("moodwire-tests").config(
        "spark.sql.shuffle.partitions", "8").config(
        "spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="moodwire-test-wh-", dir="/tmp"))
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="moodwire-test-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="moodwire-test-", dir="/tmp")
