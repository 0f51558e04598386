"""Workers that can't import the package run the queries: code travels with the job."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT, SF = Path(__file__).resolve().parents[2], Path("/root/testdata/sf0.001")

SCRIPT = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("entry_elsewhere", sys.argv[1])
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config(map={
    "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": sys.argv[3]}).getOrCreate()
spark.sparkContext.setLogLevel("OFF")
for name, query in entry.queries().items():
    if name.startswith("op") or name == "pipeline":
        query(spark, sys.argv[2]).write.format("noop").mode("overwrite").save()
        print("done", name)
"""


@pytest.mark.skipif(not SF.exists(), reason="test tables are not here")
def test_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    command = [sys.executable, "-c", SCRIPT, f"{ROOT}/__spark_entry__.py", str(SF), str(tmp_path / "stages")]
    out = subprocess.run(command, cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-3000:]
    assert out.stdout.count("done") == 14
