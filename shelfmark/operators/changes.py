"""Change detection by stored fingerprints."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F


# Kinds of a reconciled row whose stored values stay.
NOT_WRITTEN = ["kept", "unchanged", "stale"]


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the last in the given total order.

    An aggregate, not a window: rows of a hot key are reduced to one before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def change_kind(
    exists: Column,
    new_hash: Column,
    old_hash: Column,
    version: Column | None = None,
    derived: Column | None = None,
    force: bool = False,
) -> Column:
    """``new``, ``changed``, ``unstamped`` (no version or derived value yet), ``forced``, ``unchanged``."""
    missing = F.lit(False)
    for column in (version, derived):
        if column is not None:
            missing = missing | column.isNull()
    return (
        F.when(~exists, F.lit("new"))
        .when(~new_hash.eqNullSafe(old_hash), F.lit("changed"))
        .when(missing, F.lit("unstamped"))
        .when(F.lit(force), F.lit("forced"))
        .otherwise(F.lit("unchanged"))
    )


def classify(
    incoming: DataFrame,
    stored: DataFrame,
    key: str,
    hash_col: str = "content_hash",
    version_col: str | None = None,
    derived_col: str | None = None,
    force: bool = False,
) -> DataFrame:
    """Left join of unique incoming rows with the stored key and hash columns only."""
    wanted = [F.col(key).alias("_key"), F.col(hash_col).alias("_hash")]
    if version_col:
        wanted.append(F.col(version_col).alias("_version"))
    if derived_col:
        wanted.append(F.col(derived_col).isNotNull().alias("_derived"))
    known = stored.select(*wanted)
    joined = incoming.join(known, incoming[key] == known["_key"], "left")
    kind = change_kind(
        F.col("_key").isNotNull(),
        F.col(hash_col),
        F.col("_hash"),
        F.col("_version") if version_col else None,
        F.nullif(F.col("_derived"), F.lit(False)) if derived_col else None,
        force,
    )
    return joined.withColumn("change_kind", kind).drop("_key", "_hash", "_version", "_derived")


def to_write(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("change_kind") != "unchanged")


def split_rejects(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with the names of the rules they break.  No rule ever throws."""
    broken = F.array_compact(
        F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()])
    )
    judged = df.withColumn("reject_reasons", broken)
    good = judged.where(F.size("reject_reasons") == 0).drop("reject_reasons")
    return good, judged.where(F.size("reject_reasons") > 0)


def reconcile(
    target: DataFrame,
    incoming: DataFrame,
    key: str,
    hash_col: str = "content_hash",
    version: Column | None = None,
    version_col: str = "data_version",
    force: bool = False,
    order: list[str] | None = None,
) -> DataFrame:
    """Classify and merge in one full outer join: one shuffle of each side.

    Unchanged and untouched rows keep their stored values; new and changed rows take the incoming
    ones and, with ``version``, its stamp.  ``change_kind`` tells which (``kept`` = not in the feed).
    With ``order`` a row earlier than the stored one is ``stale`` and changes nothing.
    """
    target = target.drop("change_kind")  # a published table carries that of its own run
    t = target.withColumn("_in_target", F.lit(True)).alias("t")
    u = incoming.withColumn("_in_feed", F.lit(True)).alias("u")
    joined = t.join(u, F.col(f"t.{key}") == F.col(f"u.{key}"), "full_outer")
    exists = F.coalesce(F.col("_in_target"), F.lit(False))
    fed = F.coalesce(F.col("_in_feed"), F.lit(False))
    stamped = F.col(f"t.{version_col}") if version is not None and version_col in target.columns else None
    kind = F.when(~fed, F.lit("kept")).otherwise(
        change_kind(exists, F.col(f"u.{hash_col}"), F.col(f"t.{hash_col}"), stamped, None, force)
    )
    if order:
        earlier = F.struct(*[F.col(f"u.{c}") for c in order]) < F.struct(*[F.col(f"t.{c}") for c in order])
        kind = F.when(fed & exists & earlier, F.lit("stale")).otherwise(kind)
    take = ~kind.isin(*NOT_WRITTEN)
    columns: list[Column] = [F.coalesce(F.col(f"t.{key}"), F.col(f"u.{key}")).alias(key)]
    for c in _merged_order(target.columns, incoming.columns):
        if c == key or c == version_col and version is not None:
            continue
        if c not in incoming.columns:
            columns.append(F.col(f"t.{c}").alias(c))
        elif c not in target.columns:
            columns.append(F.when(take, F.col(f"u.{c}")).alias(c))
        else:
            columns.append(F.when(take, F.col(f"u.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
    if version is not None:
        old = F.col(f"t.{version_col}") if version_col in target.columns else F.lit(None).cast("bigint")
        columns.append(F.when(take, version).otherwise(old).alias(version_col))
    return joined.select(*columns, kind.alias("change_kind"))


def _merged_order(first: Iterable[str], second: Iterable[str]) -> list[str]:
    return list(dict.fromkeys([*first, *second]))
