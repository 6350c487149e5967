"""Order-preserving array helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .text import strip

EMPTY = "array<string>"


def no_strings() -> Column:
    return F.array().cast(EMPTY)


def first_where(arr: Column, predicate: Callable[[Column], Column]) -> Column:
    """First element that satisfies the predicate, else null."""
    return F.get(F.filter(arr, predicate), 0)


def non_empty(arr: Column) -> Column:
    """Drop null and empty text elements."""
    return F.filter(arr, lambda x: x.isNotNull() & (x != ""))


def split_clean(col: Column, pattern: str) -> Column:
    """Split, strip every part, drop the empty ones."""
    return F.filter(F.transform(F.split(col, pattern, -1), strip), lambda x: x != "")


def ordered_union(*arrays: Column) -> Column:
    """Concatenate and keep the first occurrence of every element."""
    return F.array_distinct(F.concat(*arrays))


def sorted_union(*arrays: Column) -> Column:
    return F.array_sort(F.array_distinct(F.concat(*arrays)))


def overlaps(a: Column, b: Column) -> Column:
    """True when a non-null element is shared; an empty array overlaps nothing; never null for arrays."""
    return F.arrays_overlap(F.array_compact(a), F.array_compact(b))


def append_unique(arr: Column, value: Column) -> Column:
    """Append the value unless it is there already; a null array counts as empty."""
    base = F.coalesce(arr, F.array().cast("array<string>"))
    return F.when(F.array_contains(base, value), base).otherwise(F.array_append(base, value))


def normalise_set_name(col: Column) -> Column:
    return F.lower(strip(col))


def same_members(a: Column, b: Column) -> Column:
    """Order-insensitive equality of string arrays, case and outer blanks ignored.

    Sorting comes before lower-casing, as in the stored comparison rule.
    """
    return F.transform(F.array_sort(a), normalise_set_name).eqNullSafe(
        F.transform(F.array_sort(b), normalise_set_name)
    )


def move_to_front(arr: Column, value: str) -> Column:
    """Move the first occurrence of ``value`` to the front, other elements keep their order."""
    at = F.array_position(arr, F.lit(value)).cast("int")
    return F.when(
        at > 1,
        F.concat(F.array(F.lit(value)), F.slice(arr, F.lit(1), at - 1), F.slice(arr, at + 1, F.size(arr))),
    ).otherwise(arr)


def fan_out(df: DataFrame, array: Column, name: str, *keep: str) -> DataFrame:
    """One row per non-null element of an array, with some columns kept.

    The outer form and a filter on the element: for the inner form the optimiser puts a test of the
    array below it, and so has a costly array expression worked out several times per row.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())


def computed_once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Add a column that a later filter reads but cannot push down.

    A filter on a plain computed column moves below it and has the expression worked out twice; it
    cannot pass the generator that this one-element array goes through.
    """
    return df.select("*", F.explode_outer(F.array(value)).alias(name))
