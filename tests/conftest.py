import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from shelfmark.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


# Column rules need a running session when a test module is imported.
SESSION = build_session(
    "tests",
    master="local[4]",
    **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="shelfmark-warehouse-"),
    },
)
SESSION.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    yield SESSION
    SESSION.stop()


@pytest.fixture
def evaluate(spark):
    """Evaluate a column rule over a list of values, in order."""
    from pyspark.sql import functions as F

    def run(rule, values, schema="v string"):
        rows = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, "i int, " + schema).repartition(1)
        return [r[0] for r in df.orderBy("i").select(rule.alias("out")).collect()]

    return run
