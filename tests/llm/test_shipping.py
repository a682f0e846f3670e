"""Operators run where the executors do not have the package: it is sent to them."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
CODE = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
from asofmill.llm import quality, license_scan
docs = spark.createDataFrame([(i, "MIT License") for i in range(10)], "doc_id long, text string")
assert license_scan.scan(docs).filter("n_base = 1").count() == 10
assert quality.classify(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")).count() == 10
"""


def test_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert done.returncode == 0, done.stderr[-2000:]
