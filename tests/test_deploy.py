"""Queries with Arrow kernels run when Python workers cannot import the package."""

import os
import subprocess
import sys

from conftest import ROOT, SF001

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as E
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4").getOrCreate()
print("ROWS", E.queries()["fft_coreset"](spark, {SF001!r}).count())
"""


def test_runs_from_another_directory(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    env["PYSPARK_PYTHON"] = sys.executable
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, capture_output=True, text=True,
                         timeout=300, env=env)
    assert "ROWS 36" in out.stdout, out.stderr[-2000:]
