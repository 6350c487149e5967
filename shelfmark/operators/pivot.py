"""Price rows to one row per product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.prices import PRICE_FIELDS, has_variant, price_in_cents

# The two price variants.
VARIANTS = {"normal": "Normal", "foil": "Foil"}


def pivot_variants(
    prices: DataFrame,
    key: str = "product_id",
    variant: str = "sub_type_name",
    order: list[Column] | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per product with a struct per variant; the last row of a variant in ``order`` wins.

    Other variants create the row but no struct.  ``order`` must be total: files have no order.
    ``max_by`` reduces on the map side, so a hot product costs one row per task.
    """
    place = F.struct(*(order or [F.col("position")]))
    price = F.struct(
        *[(F.col(f) if f == "direct_low" else F.coalesce(F.col(f), F.lit(0.0))).alias(f) for f in PRICE_FIELDS]
    )
    picks = []
    for name, label in VARIANTS.items():
        chosen = F.col(variant) == label
        picks.append(F.max_by(F.when(chosen, price), F.when(chosen, place)).alias(name))
    picks += [F.max_by(c, place).alias(c) for c in keep or []]
    return prices.groupBy(key).agg(*picks)


def prices_in_cents(pivoted: DataFrame) -> DataFrame:
    for name, label in VARIANTS.items():
        pivoted = pivoted.withColumn(name, price_in_cents(F.col(name), label))
    return pivoted


def valid_prices(df: DataFrame) -> DataFrame:
    return df.where(has_variant(F.col("normal"), F.col("foil")))
