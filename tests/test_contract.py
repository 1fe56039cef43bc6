"""The entry module works from any folder, without the package on the workers' path."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("__spark_entry__", sys.argv[1])
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert entry.entry(spark).count() > 0
for name in ("tfrecord_read", "batch_predict_partitions", "udaf_combiner"):
    assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
print("fine")
"""


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables are not here")
def test_entry_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, os.path.join(ROOT, "__spark_entry__.py")],
        cwd=tmp_path,
        env=env,
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert done.stdout.strip().endswith("fine"), done.stderr[-3000:]
