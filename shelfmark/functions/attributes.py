"""Entity-attribute arrays: ``array<struct<name, display_name, value>>``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .arrays import first_where
from .text import blank_to_null


def attribute(attrs: Column, name: str) -> Column:
    """Value of the first entry with that name; empty text is null."""
    at = F.array_position(attrs["name"], F.lit(name)).cast("int")
    return blank_to_null(F.get(attrs["value"], at - 1))


def attribute_values(attrs: Column, name: str) -> Column:
    """Values of all entries with that name, in input order, nulls dropped."""
    return F.array_compact(
        F.transform(F.filter(attrs, lambda a: a["name"] == name), lambda a: a["value"])
    )


def has_any_attribute(attrs: Column, names: list[str]) -> Column:
    """True when any entry with one of the names carries a value."""
    return F.exists(attrs, lambda a: a["name"].isin(names) & F.coalesce(a["value"] != "", F.lit(False)))


def attribute_map(attrs: Column) -> Column:
    """First-wins map of a whole attribute array, for rows that read many attributes."""
    first_of_name = F.transform(
        F.array_distinct(F.transform(attrs, lambda a: a["name"])),
        lambda n: F.struct(n.alias("k"), first_where(attrs, lambda a: a["name"] == n)["value"].alias("v")),
    )
    return F.map_from_entries(first_of_name)
