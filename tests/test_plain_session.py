"""The stateful streams in a session made without the package's settings, from another working directory."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CODE = """
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as ent
qs = ent.queries()
for a, b in (("st_pattern_stream", "st_pattern_dense"), ("w_burst_stream", "w_burst_rule")):
    n, m = qs[a](spark, "/root/testdata/sf0.001").count(), qs[b](spark, "/root/testdata/sf0.001").count()
    assert n == m > 0, (a, n, m)
print("ALL SAME")
"""


def test_streams_in_a_plain_session(tmp_path):
    env = os.environ | {"PYTHONPATH": ROOT}
    done = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "ALL SAME" in done.stdout, done.stderr[-3000:]
