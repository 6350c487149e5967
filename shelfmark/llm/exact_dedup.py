"""Exact deduplication by skew-safe combining, in DataFrame functions only.

Rows with equal content are reduced three times: in each task, in salted digest groups, and globally.  Every stage
groups by digest *and* content, so texts are compared whole and a digest alone never decides.

* In a task: the first aggregate runs before the shuffle, so a group of copies leaves a task as one row per salt.
* Salted: the salt is the task's number, so one group's partial rows spread over ``salts`` tasks.
* Globally: at most ``salts`` rows per group meet.

A row's way back to its group is a join on digest and content.  Only groups of more than one row are on the other
side, one row each, written as a table first; the adaptive skew join then splits the rows of a hot group.

Defined results: a null text counts as empty; null ids lose ties against any id and are never confused with one
another's rows (``keep_id`` is null if the winner has none).  Repeated rows with equal text and id count as several
rows; of rows that repeat the winner's id and length, one is kept.  An empty table gives an empty result.
Other columns of the input do not matter, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .stages import quoted, stage, without_white

SALTS = 16
_ID_SPAN = "100000000000000000000"  # above every 64-bit id: the rank is length * span - id


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    span = F.lit(_ID_SPAN).cast("decimal(21,0)")
    content = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("_id"),
        F.char_length(content).cast("decimal(10,0)").alias("_length"),
        without_white(content).alias("_content"),
    ).withColumn("_digest", F.sha2(F.col("_content"), 256))
    # one number orders rows: more characters first, then the smaller id, a null id last
    number = F.coalesce(F.col("_id").cast("decimal(20,0)"), F.lit("9223372036854775808").cast("decimal(20,0)"))
    ranked = rows.withColumn("_rank", (F.col("_length") * span - number).cast("decimal(38,0)"))
    salted = (
        ranked.withColumn("_salt", F.spark_partition_id() % salts)
        .groupBy("_digest", "_salt", "_content")
        .agg(F.max("_rank").alias("_rank"), F.count(F.lit(1)).alias("_n"))
    )
    groups = salted.groupBy("_digest", "_content").agg(F.max("_rank").alias("_best"), F.sum("_n").alias("_size"))
    copied = stage(groups.where("_size > 1"), "copies")
    found = ranked.join(copied, ["_digest", "_content"], "left")
    # the winner's id is read back from its rank
    best = F.coalesce("_best", "_rank")
    rest = F.pmod(best, span)  # 0 - id, or span - id
    winner = F.when(rest > span / 2, span - rest).otherwise(-rest).cast("decimal(20,0)")
    narrow = stage(
        found.select(
            F.monotonically_increasing_id().alias("_row"),
            F.col("_id").alias(id_col),
            F.when(winner <= F.lit("9223372036854775807").cast("decimal(20,0)"), winner).cast("long").alias("keep_id"),
            F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
            (F.col("_rank") == best).alias("_best_row"),
            F.col("_digest").alias("text_sha256"),
        ),
        "decisions",
    )
    # repeated rows share the best rank: the first of them stays
    first = narrow.where("_best_row AND group_size > 1").groupBy("text_sha256", id_col).agg(
        F.min("_row").alias("_row"), F.count(F.lit(1)).alias("_repeats")
    )
    marked = narrow.join(first.select("_row", "_repeats"), "_row", "left")
    return marked.select(
        id_col, "keep_id", "group_size",
        (F.col("_best_row") & ((F.col("group_size") == 1) | F.col("_repeats").isNotNull())).alias("kept"),
        "text_sha256", F.coalesce("_repeats", F.lit(1)).alias("_repeats"),
    )


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """``decisions`` without the count of repeated rows."""
    return decisions(docs, id_col, text_col, salts).drop("_repeats")


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    A row that stays is known by id and content digest; of rows that repeat one document wholly, one stays.
    """
    winners = stage(
        decisions(docs, id_col, text_col).where("kept").select(
            F.col(id_col).alias("_id"), F.col("text_sha256").alias("_digest"), "_repeats"
        ),
        "kept",
    )
    content = without_white(F.coalesce(F.col(text_col), F.lit("")))
    marked = docs.withColumns({"_key": F.col(id_col).cast("long"), "_digest": F.sha2(content, 256)})

    def staying(rows: DataFrame) -> DataFrame:
        same = marked["_key"].eqNullSafe(rows["_id"]) & (marked["_digest"] == rows["_digest"])
        return marked.join(rows, same, "left_semi")

    once = staying(winners.where("_repeats = 1"))
    repeated = staying(winners.where("_repeats > 1")).dropDuplicates(["_key", "_digest"])
    return once.unionByName(repeated).select(*[quoted(c) for c in docs.columns])
