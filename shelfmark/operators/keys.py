"""Key sets: differences, orphans, child counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def key_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys found on one side only: ``key, side``."""
    l = left.select(key).distinct().withColumn("_l", F.lit(True))
    r = right.select(key).distinct().withColumn("_r", F.lit(True))
    joined = l.join(r, key, "full_outer").where(F.col("_l").isNull() | F.col("_r").isNull())
    return joined.select(key, F.when(F.col("_r").isNull(), F.lit("left")).otherwise(F.lit("right")).alias("side"))


def orphans(rows: DataFrame, parents: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Rows without a partner in the other table."""
    keys = parents.select(F.col(parent_key or key).alias(key)).distinct()
    return rows.join(keys, key, "left_anti")


def child_counts(parents: DataFrame, children: DataFrame, key: str, child_key: str, name: str = "n_children") -> DataFrame:
    """Every parent with the number of its children, zero included."""
    counts = children.groupBy(F.col(child_key).alias("_key")).agg(F.count(F.lit(1)).alias(name))
    joined = parents.join(counts, parents[key] == counts["_key"], "left").drop("_key")
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(0)))


def group_totals(groups: DataFrame, key: str, **tables: DataFrame) -> DataFrame:
    """Number of rows of several tables per group (products, prices, ...)."""
    out = groups
    for name, table in tables.items():
        out = child_counts(out, table, key, key, name)
    return out


def insert_absent(target: DataFrame, candidates: DataFrame, wanted: DataFrame, on: str, key: str) -> DataFrame:
    """Candidates named in ``wanted`` (by ``on``) that the target lacks (by ``key``), to be appended."""
    return candidates.join(wanted.select(on).distinct(), on, "left_semi").join(
        target.select(key), key, "left_anti"
    )


def attach_parent_name(rows: DataFrame, parents: DataFrame, key: str, name: str, out: str = "set") -> DataFrame:
    """Name of the parent row as a one-element array; an empty array when there is none.

    The parent table is not hinted: Spark broadcasts it when its size allows and otherwise splits a
    hot parent at run time.
    """
    p = parents.select(F.col(key).alias("_key"), F.col(name).alias("_name"))
    named = F.when(F.col("_name").isNull() | (F.col("_name") == ""), F.array().cast("array<string>")).otherwise(
        F.array("_name")
    )
    return rows.join(p, rows[key] == p["_key"], "left").withColumn(out, named).drop("_key", "_name")
