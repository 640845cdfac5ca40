"""Queries whose work runs in Python workers, from a folder where the package can't be found."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

DATA = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[1]

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {shared!r}).getOrCreate()
import __spark_entry__ as entry
found = entry.queries()
for name in ("connected_components", "hull", "bimodal_metrics", "tv_filter"):
    print(name, found[name](spark, {data!r}).count())
"""


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_workers_get_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = SCRIPT.format(root=str(ROOT), shared=f"file://{tmp_path}/shared", data=DATA)
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    counts = dict(line.split() for line in done.stdout.splitlines() if " " in line)
    assert all(int(counts[n]) > 0 for n in ("connected_components", "hull", "bimodal_metrics", "tv_filter"))
