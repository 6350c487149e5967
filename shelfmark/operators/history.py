"""Snapshots, change logs, versions, points in time, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .changes import latest_per_key
from .numbering import SLICE_ROWS, sampled_slices, trailing_window


def daily_snapshot(df: DataFrame, keys: list[str], time: str, order: list[Column], day: str = "snapshot_date") -> DataFrame:
    """Last row per key and day."""
    dated = df.withColumn(day, F.to_date(time))
    return latest_per_key(dated, [*keys, day], order)


def delta_log(changed: DataFrame, key: str, version_col: str = "data_version") -> DataFrame:
    """Full change records, to be appended: ``key, version, changes``."""
    rest = [c for c in changed.columns if c not in (key, version_col, "change_kind")]
    return changed.select(key, version_col, F.struct(*rest).alias("changes"))


def latest_delta(log: DataFrame, key: str, version_col: str = "data_version") -> DataFrame:
    """Latest change record per key."""
    return log.groupBy(key).agg(
        F.max(version_col).alias(version_col), F.max_by("changes", version_col).alias("changes")
    )


def version_since(df: DataFrame, since: int, version_col: str = "data_version") -> DataFrame:
    """Rows written by later runs than the reader's."""
    return df.where(F.col(version_col) > F.lit(since))


def latest_at(df: DataFrame, keys: list[str], time: str, at, tie: list[Column]) -> DataFrame:
    """State of every key at a point in time: its last row at or before it."""
    return latest_per_key(df.where(F.col(time) <= F.lit(at)), keys, [F.col(time), *tie])


def as_of_join(
    probes: DataFrame,
    facts: DataFrame,
    keys: list[str],
    time: str,
    tie: str,
    values: list[str],
    unit: str | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Every probe row with the values of the last fact at or before its time.

    Time is cut into sampled slices, or into those of ``unit``.  Inside a slice a running window finds
    the last fact; the state at the start of a slice comes from one row per key and slice.  A hot key
    is so worked on by as many tasks as it has slices, also when all its rows fall into one day.
    Facts without a key or time take no part; probes without find nothing.
    """
    facts = facts.dropna(subset=[*keys, time])
    p = probes.select("*", F.lit(1).alias("_probe"), F.lit(None).cast("bigint").alias("_tie"))
    fact = F.struct(F.col(time).alias("_at"), F.col(tie).alias("_tie"), *values)
    f = facts.select(*keys, time, F.lit(0).alias("_probe"), F.col(tie).cast("bigint").alias("_tie"), fact.alias("_fact"))
    both = p.unionByName(f, allowMissingColumns=True)
    if unit is None:
        both = sampled_slices(both, keys, [F.col(time), F.col("_probe"), F.col("_tie")], slice_rows)
    else:
        both = both.withColumn("_slice", F.date_trunc(unit, time))
    ends = both.groupBy(*keys, "_slice").agg(F.max("_fact").alias("_end"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select(*keys, "_slice", F.last("_end", ignorenulls=True).over(earlier).alias("_start"))
    running = (
        Window.partitionBy(*keys, "_slice")
        .orderBy(time, "_probe", "_tie")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    state = F.coalesce(F.last("_fact", ignorenulls=True).over(running), F.col("_start"))
    joined = both.join(starts, [*keys, "_slice"], "left").withColumn("_state", state)
    picked = joined.where(F.col("_probe") == 1)
    return picked.select(*probes.columns, *[F.col(f"_state.{v}").alias(v) for v in values])


def rolling_mean(
    df: DataFrame, keys: list[str], order: list[Column], slice_by: Column | None, value: str, rows: int = 10, chunk: int = 100_000
) -> DataFrame:
    """Sum and count of the last ``rows`` rows per key; exact for integers, mean = sum / count."""

    def compute(window) -> dict[str, Column]:
        frame = window.rowsBetween(-(rows - 1), Window.currentRow)
        return {"rolling_sum": F.sum(value).over(frame), "rolling_n": F.count(value).over(frame)}

    out = trailing_window(df, keys, order, slice_by, rows - 1, compute, chunk)
    return out.withColumn("rolling_mean", F.col("rolling_sum") / F.col("rolling_n"))


def change_percent(snapshots: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """Change against the previous snapshot of the key, in hundredths of a percent.

    One row per key and day: a key has no more rows here than there are days.
    """
    before = F.lag(value).over(Window.partitionBy(key).orderBy(day))
    hundredths = F.floor((F.col(value) - F.col("previous")) * 10000 / F.nullif(F.col("previous"), F.lit(0)) + 0.5)
    return snapshots.withColumn("previous", before).withColumn("change_bp", hundredths.cast("bigint"))


def restore(history: DataFrame, keys: list[str], time: str, at, tie: list[Column], group: str | None = None, value=None) -> DataFrame:
    """Table content at a point in time, optionally of one group only."""
    if group is not None:
        history = history.where(F.col(group) == F.lit(value))
    return latest_at(history, keys, time, at, tie)


def retained(df: DataFrame, time: str, cutoff) -> DataFrame:
    """Rows to keep: not older than the cutoff; rows without a time stay."""
    return df.where(F.col(time).isNull() | (F.col(time) >= F.lit(cutoff)))


def purge_counts(df: DataFrame, time: str, cutoff, by: str | None = None) -> DataFrame:
    """How many rows a purge would delete and keep."""
    old = F.coalesce(F.col(time) < F.lit(cutoff), F.lit(False))
    aggs = [F.count_if(old).alias("n_deleted"), F.count_if(~old).alias("n_kept")]
    return df.groupBy(by).agg(*aggs) if by else df.agg(*aggs)


def emptied(df: DataFrame) -> DataFrame:
    """Same schema, no rows."""
    return df.where(F.lit(False))


def drop_column(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """The table without the column, and how many rows had it."""
    affected = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count(column).alias("n_affected"))
    return df.drop(column), affected


def reset_state(df: DataFrame, column: str = "sync_status", failed: str = "failed", ready: str = "ready") -> DataFrame:
    """Failed states become ready again."""
    return df.withColumn(column, F.when(F.col(column) == failed, F.lit(ready)).otherwise(F.col(column)))


def clear_hashes(df: DataFrame, *columns: str) -> DataFrame:
    """Forget stored fingerprints, so that the next run takes every row as changed."""
    for c in columns:
        df = df.withColumn(c, F.lit(None).cast(df.schema[c].dataType))
    return df
