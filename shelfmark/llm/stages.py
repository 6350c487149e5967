"""Cutting lineage: a result is written as a table in the shared folder and read back."""

from __future__ import annotations

import ctypes
import gc
import inspect
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder, shuffles_go
from ..sources.tables import remove

_made: list[str] = []

WHITE = " \t\n\x0b\x0c\r"


def stage(df: DataFrame, purpose: str, **options) -> DataFrame:
    """``df`` as a table below ``spark.checkpoint.dir``; a lost executor costs no recomputation of what lies before.

    Spark's own committer writes it, so retried tasks leave no doubles.  ``options``: of the writer.
    """
    path = shared_folder(df.sparkSession, f"llm-{purpose}")
    _made.append(path)
    spark = df.sparkSession
    with shuffles_go(spark):
        df.write.options(**options).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.staged_at = path
    return table


def unstage(*tables: DataFrame) -> None:
    """Remove tables that ``stage`` has returned, once nothing reads them any more."""
    for table in tables:
        _made.remove(table.staged_at)
        remove(table.sparkSession, table.staged_at)


def discard(spark: SparkSession) -> None:
    """Remove the staged tables of this process, once no result that reads them is wanted any more."""
    while _made:
        remove(spark, _made.pop())


def quoted(name: str) -> str:
    """A column's name as it must be written where dots would be read as fields."""
    return "`" + name.replace("`", "``") + "`"


def other_fields(df: DataFrame, *names: str) -> list:
    """The fields of ``df`` but for those called like ``names``, in either case."""
    return [f for f in df.schema.fields if f.name.lower() not in {n.lower() for n in names}]


def numbered(fields: list) -> list:
    """Columns under plain names (c0, c1, ...), as functions over Arrow batches need them."""
    return [F.col(quoted(f.name)).alias(f"c{i}") for i, f in enumerate(fields)]


def without_white(column):
    """The text without the six white characters; searches for bytes, so it is faster than a pattern."""
    for character in WHITE:
        column = F.replace(column, F.lit(character), F.lit(""))
    return column


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for Arrow batches of a task, after which a worker gives back what it no longer needs.

    Workers outlive their tasks, and several wait beside those at work.
    """

    def whole(batches: Iterator) -> Iterator:
        yield from run(batches)
        gc.collect()
        _give_back()

    return whole


def tidy_group(run: Callable[..., pa.Table]) -> Callable[..., pa.Table]:
    """``run`` for a group's tables, after which a worker gives back what the next group may not need."""

    def one(table: pa.Table) -> pa.Table:
        found = run(table)
        _give_back()
        return found

    def two(left: pa.Table, right: pa.Table) -> pa.Table:
        found = run(left, right)
        _give_back()
        return found

    return two if len(inspect.signature(run).parameters) == 2 else one


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass
