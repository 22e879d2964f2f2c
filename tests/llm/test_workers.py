"""Every query and the pipeline run from another folder, without a path to the repository."""

import pathlib
import subprocess
import sys

import pytest

import __spark_entry__ as entry

ROOT = pathlib.Path(__file__).resolve().parents[2]


@pytest.mark.parametrize("part", [0, 1])
def test_workers_need_no_copy_of_the_repository(tmp_path, part):
    names = sorted(entry.LLM_QUERIES)[part::2]
    code = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("entry", {str(ROOT / "__spark_entry__.py")!r})
entry = importlib.util.module_from_spec(spec); spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = (
    SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", {str(tmp_path / "shared")!r})
    .getOrCreate()
)
for name in {names!r}:
    assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() >= 0, name
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
