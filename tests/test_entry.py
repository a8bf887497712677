"""The entry as a driver reads it: names and SQL before there is a session."""

import subprocess
import sys
from pathlib import Path

ROOT = str(Path(__file__).parent.parent)
SAYS = "import __spark_entry__ as e; from pyspark import SparkContext; print(*e.queries()); e.oracle_sql(); assert SparkContext._active_spark_context is None"


def test_queries_are_named_without_a_session():
    said = subprocess.run([sys.executable, "-B", "-c", SAYS], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr[-800:]
    assert {"x04_check_catalog", "op3_near_dedup", "pipeline"} <= set(said.stdout.split())
