"""Merging rows into tables.

Keys are unique on both sides; run feeds through ``latest_per_key`` first.  Parquet has no row
update, so every operator returns the new table (or the new content of the touched partitions).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from ..schemas import nullable

PRESENT = "_present"


def _present(path: str, per_row: bool) -> Column:
    return F.array_contains(F.col(f"u.{PRESENT}"), path) if per_row else F.lit(True)


def _merged(path: str, old_type, new_type, matched: Column, per_row: bool) -> Column:
    """Value of one field: the update's where the field is present, else the stored one."""
    old, new = F.col(f"t.{path}"), F.col(f"u.{path}")
    given = matched & _present(path, per_row)
    if isinstance(old_type, StructType) and isinstance(new_type, StructType):
        new_fields = {f.name: f.dataType for f in new_type.fields}
        merged = []
        for f in old_type.fields:
            inner = f"{path}.{f.name}"
            if f.name in new_fields:
                value = _merged(inner, f.dataType, new_fields[f.name], matched, per_row)
            else:
                value = F.col(f"t.{inner}")
            merged.append(value.alias(f.name))
        known = {f.name for f in old_type.fields}
        for f in new_type.fields:
            if f.name not in known:
                inner = f"{path}.{f.name}"
                merged.append(F.when(matched & _present(inner, per_row), F.col(f"u.{inner}")).alias(f.name))
        return F.when(given & new.isNotNull(), F.struct(*merged)).when(~given, old)
    return F.when(given, new).otherwise(old)


def merge_upsert(target: DataFrame, updates: DataFrame, key: str, how: str = "full_outer") -> DataFrame:
    """Listed fields overwrite, absent fields stay, null overwrites, nested structs merge by field.

    A column the updates lack is absent for all rows.  An ``_present`` column (array of field paths,
    nested ones dotted) makes presence a matter of each row; the presence of a struct field is needed
    as well as that of its inner fields.
    """
    per_row = PRESENT in updates.columns
    t = target.alias("t")
    u = updates.withColumn("_matched", F.lit(True)).alias("u")
    joined = t.join(u, F.col(f"t.{key}") == F.col(f"u.{key}"), how)
    matched = F.coalesce(F.col("u._matched"), F.lit(False))
    columns = []
    new_types = {f.name: f.dataType for f in updates.schema.fields}
    for field in target.schema.fields:
        name, old_type, new_type = field.name, field.dataType, new_types.get(field.name)
        if name == key:
            columns.append(F.coalesce(F.col(f"t.{key}"), F.col(f"u.{key}")).alias(key))
        elif new_type is None:
            columns.append(F.col(f"t.{name}").alias(name))
        elif isinstance(old_type, StructType) and isinstance(new_type, StructType):
            columns.append(_merged(name, old_type, new_type, matched, per_row).alias(name))
        else:
            merged = _merged(name, old_type, new_type, matched, per_row)
            columns.append(merged.cast(nullable(old_type)).alias(name))
    for name in updates.columns:
        if name not in target.columns and name != PRESENT:
            columns.append(F.when(matched & _present(name, per_row), F.col(f"u.{name}")).alias(name))
    return joined.select(*columns)


def update_existing(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """As ``merge_upsert`` for rows that exist; updates of unknown keys are ignored."""
    return merge_upsert(target, updates, key, how="left")


def replace_rows(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Rows replace stored rows of the same key as a whole."""
    return target.join(rows.select(key), key, "left_anti").unionByName(rows, allowMissingColumns=True)


def fill_missing(target: DataFrame, values: DataFrame, key: str, column: str, default=None) -> DataFrame:
    """Fill a column where it is null from a keyed table (or with the default)."""
    v = values.select(F.col(key).alias("_key"), F.col(column).alias("_value"))
    filled = F.coalesce(F.col(column), F.col("_value"), F.lit(default))
    joined = target.join(v, target[key] == v["_key"], "left")
    return joined.withColumn(column, filled).select(*target.columns)


def stamp(df: DataFrame, version: int, run_ts) -> DataFrame:
    """Version and write time, one literal each per run."""
    return df.withColumn("data_version", F.lit(version).cast("bigint")).withColumn(
        "last_updated", F.lit(run_ts).cast("timestamp")
    )
