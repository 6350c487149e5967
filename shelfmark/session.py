"""Session settings and the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the operators are written for.  Sizes are per task, so they hold at any data volume.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# An action's shuffle files go when it has ended; else they stay until the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "shelfmark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of the machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        base = tempfile.mkdtemp(prefix="shelfmark-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of the actions inside go when these have ended; their DataFrames are built inside, too."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
