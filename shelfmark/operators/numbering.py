"""Exact ordered windows that survive a hot key.

A window partitioned by a natural key puts a whole key into one task.  Here each key is cut into
slices of its own order; only one short row per slice ever meets in a window over the key, and rows
meet only inside their slice or a chunk of fixed size.  Slices come from a sample of the rows, or
from a column the caller knows to cut every key finely enough (an hour, a day).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import shared_folder

# Rows a sampled slice holds on average.
SLICE_ROWS = 100_000


def sampled_slices(df: DataFrame, keys: list[str], order: list[Column], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``df`` with ``_slice``, a number that never decreases along keys and order.

    Spark draws the borders from a sample of the rows, so a slice holds about ``slice_rows`` rows
    whatever share of them one key, day or letter has.  Rows equal in keys and order share a slice.
    The rows are written once: another sample would draw other borders.
    """
    spark = df.sparkSession
    n = max(1, -(-df.count() // slice_rows))
    folder = shared_folder(spark, "slices")
    ranged = df.repartitionByRange(n, *keys, *order).withColumn("_slice", F.spark_partition_id())
    ranged.write.parquet(folder)
    return spark.read.schema(ranged.schema).parquet(folder)


def number_rows(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    slice_by: Column | None = None,
    name: str = "position",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Row number from 1 within ``keys``.

    ``slice_by`` must not decrease along ``order``; without it slices are sampled.
    """
    sliced = sampled_slices(df, keys, order, slice_rows) if slice_by is None else df.withColumn("_slice", slice_by)
    sizes = sliced.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order)
    joined = _null_safe_join(sliced, offsets, [*keys, "_slice"])
    return joined.withColumn(name, F.col("_offset") + F.row_number().over(inside)).drop("_offset", "_slice")


def _null_safe_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    right = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    condition = None
    for c in on:
        equal = left[c].eqNullSafe(right[f"_r_{c}"])
        condition = equal if condition is None else condition & equal
    return left.join(right, condition, "left").drop(*[f"_r_{c}" for c in on])


def last_before(df: DataFrame, keys: list[str], at: str, value: Column, name: str, block: int = SLICE_ROWS) -> DataFrame:
    """The last non-null ``value`` of the rows before each row; ``at`` numbers the rows of a key from 1."""
    marked = df.withColumn("_mark", value).withColumn("_block", F.floor((F.col(at) - 1) / block))
    ends = marked.groupBy(*keys, "_block").agg(F.max_by("_mark", F.when(F.col("_mark").isNotNull(), F.col(at))).alias("_end"))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, "_block", F.last("_end", ignorenulls=True).over(earlier).alias("_carried"))
    inside = Window.partitionBy(*keys, "_block").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    joined = _null_safe_join(marked, carried, [*keys, "_block"])
    found = F.coalesce(F.last("_mark", ignorenulls=True).over(inside), F.col("_carried"))
    return joined.withColumn(name, found).drop("_mark", "_block", "_carried")


def trailing_window(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    slice_by: Column | None,
    back: int,
    compute: Callable[[Window], dict[str, Column]],
    chunk: int = 100_000,
) -> DataFrame:
    """Window functions that look at most ``back`` rows behind, in chunks of ``chunk`` rows.

    ``compute`` gets the window specification (ordered, unframed) and names the result columns.  The
    last ``back`` rows of a chunk are repeated at the head of the next one and dropped again.
    """
    if back > chunk:
        raise ValueError(f"a chunk of {chunk} rows cannot give {back} rows to the next one")
    numbered = number_rows(df, keys, order, slice_by, "_at")
    own = F.floor((F.col("_at") - 1) / chunk)
    left_over = chunk - F.pmod(F.col("_at") - 1, F.lit(chunk))
    homes = F.when(left_over <= back, F.array(own, own + 1)).otherwise(F.array(own))
    spread = numbered.withColumn("_own", own).withColumn("_chunk", F.explode(homes))
    window = Window.partitionBy(*keys, "_chunk").orderBy("_at")
    for name, value in compute(window).items():
        spread = spread.withColumn(name, value)
    return spread.where(F.col("_own") == F.col("_chunk")).drop("_own", "_chunk", "_at")
