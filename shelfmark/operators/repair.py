"""Repairs of stored rows: each returns only the rows it changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.arrays import computed_once
from ..functions.codes import REPRINT, repaired_codes
from ..functions.names import repaired_name


def name_repairs(df: DataFrame, key: str, name: str = "name") -> DataFrame:
    judged = computed_once(df.select(key, F.col(name).alias("old_name")), repaired_name(F.col("old_name")), name)
    return judged.where(F.col(name) != F.col("old_name"))


def code_repairs(df: DataFrame, key: str, codes: str = "card_numbers", full: str = "full_card_number") -> DataFrame:
    """Rows whose full code begins with a reprint code that their list lacks."""
    candidates = df.where(F.col(full).startswith(REPRINT))
    fixed = candidates.select(key, F.col(codes).alias("_old"), repaired_codes(F.col(codes), F.col(full)).alias(codes))
    return fixed.where(~F.col(codes).eqNullSafe(F.col("_old"))).drop("_old")
