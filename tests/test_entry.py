"""The entry module works where nothing but its own folder is at hand."""

import pathlib
import subprocess
import sys

ROOT = pathlib.Path(__file__).resolve().parents[1]


def run(code, cwd):
    return subprocess.run([sys.executable, *code], cwd=cwd, capture_output=True, text=True)


def test_sql_needs_neither_spark_nor_the_library(tmp_path):
    code = (
        "import sys; sys.modules['pyspark'] = None; sys.modules['termloom'] = None;"
        f"sys.path.insert(0, {str(ROOT)!r});"
        "from catalog import oracle; assert len(oracle.oracle_sql()) >= 67"
    )
    done = run(["-c", code], tmp_path)
    assert done.returncode == 0, done.stderr


def test_python_model_runs_from_another_folder(tmp_path):
    code = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("entry", {str(ROOT / "__spark_entry__.py")!r})
entry = importlib.util.module_from_spec(spec); spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert entry.queries()["external_model"](spark, "/root/testdata/sf0.001").count() > 0
"""
    done = run(["-c", code], tmp_path)
    assert done.returncode == 0, done.stderr[-2000:]
