"""Filters, look-ups, pages and top rows (all of them reach the scan as pushed filters or top-k)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F


def by_key(df: DataFrame, key: str, value) -> DataFrame:
    """Rows whose key equals the value; ``None`` means no filter (the single-group option)."""
    return df if value is None else df.where(F.col(key) == F.lit(value))


def older_than(df: DataFrame, time: str, cutoff) -> DataFrame:
    return df.where(F.col(time) < F.lit(cutoff))


def with_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.where(F.col(column).startswith(prefix))


def present(df: DataFrame, *columns: str) -> DataFrame:
    for column in columns:
        df = df.where(F.col(column).isNotNull())
    return df


def containing(df: DataFrame, column: str, text: str) -> DataFrame:
    """Case-insensitive substring filter."""
    return df.where(F.lower(F.col(column)).contains(text.lower()))


def in_window(df: DataFrame, time: str, start, end=None, **equal) -> DataFrame:
    """Rows of a time window, optionally with equal columns (``level="ERROR"``)."""
    df = df.where(F.col(time) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(time) <= F.lit(end))
    for column, value in equal.items():
        df = df.where(F.col(column) == F.lit(value))
    return df


def page_after(df: DataFrame, key: str, last, size: int) -> DataFrame:
    """Next page in key order; ``last=None`` starts at the beginning."""
    if last is not None:
        df = df.where(F.col(key) > F.lit(last))
    return df.orderBy(key).limit(size)


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """First ``n`` rows of an order; give a total order to make the cut repeatable."""
    return df.orderBy(*order).limit(n)


def sample_first(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.orderBy(key).limit(n)


def limit_per_group(df: DataFrame, group: str, order: Iterable[Column], n: int) -> DataFrame:
    """First ``n`` rows of every group.

    Spark cuts every map task to ``n`` rows per group before the shuffle, so a hot group costs its
    share of tasks times ``n`` rows, not its size.
    """
    window = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= n).drop("_rank")


def newest_first(df: DataFrame, time: str, tie: str, n: int | None = None, **equal) -> DataFrame:
    for column, value in equal.items():
        if value is not None:
            df = df.where(F.col(column) == F.lit(value))
    ordered = df.orderBy(F.col(time).desc(), F.col(tie))
    return ordered if n is None else ordered.limit(n)


def index_order(df: DataFrame, name: str, time: str) -> DataFrame:
    """By name (or code), newest first."""
    return df.orderBy(F.col(name), F.col(time).desc())
