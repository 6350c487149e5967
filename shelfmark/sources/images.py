"""Landed image files."""

from __future__ import annotations

import itertools
import os
import uuid
from collections.abc import Callable, Iterable
from urllib.parse import quote

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.urls import image_kind


def image_files(spark: SparkSession, path: str | list[str], glob: str = "*") -> DataFrame:
    """``path, modificationTime, length, content``; columns that are not used are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
    )


def checked_images(files: DataFrame) -> DataFrame:
    """Files with their kind by first bytes (null = no image)."""
    return files.withColumn("kind", image_kind(F.col("content")))


def own_path(spark: SparkSession, folder: str) -> str | None:
    """The folder's path if it lies in a file system that executors open by themselves, else None."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return found.makeQualified(path).toUri().getPath() if found.getUri().getScheme() == "file" else None


def land_objects(rows: DataFrame, name: str, content: str, n_tasks: int, path: str) -> list[str]:
    """A file ``name=value.txt`` for each value of a column, with its rows' contents, a line end after each.

    Hadoop starts processes that set the rights of every file and of its checksums, which takes far longer than the
    file itself; so tasks open their files without it.  Each task has a folder of its own, which keeps folders few and
    short; they are returned.  A file gets its name when it is whole, and a retried task puts the same files in place again.
    """
    dealt = rows.select(F.col(name).cast("string").alias("value"), F.col(content).alias("content"))
    dealt = dealt.repartition(n_tasks, "value").sortWithinPartitions("value")
    dealt.foreachPartition(_put(path, name))
    return [f"file://{_folder(path, i)}" for i in range(n_tasks)]


def _folder(path: str, task: int) -> str:
    return os.path.join(path, f"part-{task:05d}")


def _put(path: str, name: str) -> Callable[[Iterable], None]:
    def run(rows: Iterable) -> None:
        folder = _folder(path, TaskContext.get().partitionId())
        os.makedirs(folder, exist_ok=True)
        for value, same in itertools.groupby(rows, key=lambda r: r[0]):
            begun = os.path.join(folder, f".{uuid.uuid4().hex}")
            with open(begun, "wb") as file:
                for _, text in same:
                    file.write(text)
                    file.write(b"\n")
            value = "__HIVE_DEFAULT_PARTITION__" if value is None else quote(value, safe="")
            os.replace(begun, os.path.join(folder, f"{name}={value}.txt"))

    return run
