"""Price structs in whole cents."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import cents

PRICE_FIELDS = ["direct_low", "high", "low", "market", "mid"]


def price_in_cents(price: Column, variant: str) -> Column:
    """Cents on all five fields; a missing price is zero, a missing direct low stays null."""
    fields = [
        (cents(price[f]) if f == "direct_low" else F.coalesce(cents(price[f]), F.lit(0))).alias(f)
        for f in PRICE_FIELDS
    ]
    return F.when(price.isNotNull(), F.struct(*fields, F.lit(variant).alias("sub_type_name")))


def has_variant(normal: Column, foil: Column) -> Column:
    return normal.isNotNull() | foil.isNotNull()


def history_form(price: Column) -> Column:
    """Price struct as kept in the history table: the five figures only."""
    return F.when(price.isNotNull(), F.struct(*[price[f].alias(f) for f in PRICE_FIELDS]))
