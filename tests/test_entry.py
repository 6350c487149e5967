"""The driver's contract, in a process that has not started a session."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_a_session():
    code = (
        "import __spark_entry__ as e; from pyspark.sql import SparkSession; "
        "assert SparkSession.getActiveSession() is None; "
        "print(len(e.queries()), len(set(e.oracle_sql()) - set(e.queries())))"
    )
    run = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    known, strange = map(int, run.stdout.split())
    assert known >= 100 and strange == 0
