"""Queries with Python functions run when Spark was started in another folder."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
FOLDER = "/root/testdata/sf0.001"
CODE = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("__spark_entry__", "{ROOT}/__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
assert len(entry.queries()["l04_t_test"](spark, "{FOLDER}").collect()) == 1
assert len(entry.queries()["l04_t_test"](spark, "{FOLDER}").collect()) == 1
"""


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")
def test_workers_import_the_package_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert done.returncode == 0, done.stderr[-2000:]
