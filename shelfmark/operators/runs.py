"""Run history.  One writer at a time; readers take the latest row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .changes import NOT_WRITTEN

# The states of a run.
IDLE, RUNNING, COMPLETED, FAILED = "idle", "in-progress", "completed", "failed"


def duration_seconds(start: Column, end: Column) -> Column:
    """Whole seconds between two times, halves up."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    return F.floor(micros / 1_000_000 + 0.5).cast("bigint")


def current_run(runs: DataFrame) -> DataFrame:
    """The latest run record (one row)."""
    return runs.orderBy(F.col("sync_start").desc_nulls_last(), F.col("run_id").desc()).limit(1)


def next_version(runs: DataFrame) -> DataFrame:
    """One row: the highest version of any run plus one; 1 before any.

    A failed run has stamped rows too, so its number is not given again; ``run_health`` tells the latest good one.
    """
    return runs.agg((F.coalesce(F.max("version"), F.lit(0)) + 1).cast("bigint").alias("version"))


def run_counters(classified: DataFrame, errors: DataFrame | None = None, by: str | None = None) -> DataFrame:
    """Processed and updated rows of a step, with the number of rejected ones.

    Rejected rows stay in their own table; the record carries their number, not a list of them.
    """
    rows = classified.select("change_kind", *([by] if by else []))
    if errors is not None:
        rejected = errors.select(F.lit("rejected").alias("change_kind"), *([by] if by else []))
        rows = rows.unionByName(rejected)
    kind = F.col("change_kind")
    aggs = [
        F.count(F.lit(1)).alias("items_processed"),
        F.count_if(~kind.isin(*NOT_WRITTEN, "rejected")).alias("items_updated"),
        F.count_if(kind == "rejected").alias("n_errors"),
    ]
    return rows.groupBy(by).agg(*aggs) if by else rows.agg(*aggs)


def match_counters(left: DataFrame, matches: DataFrame, updated: Column) -> DataFrame:
    """Total, matched and updated rows in one aggregate; ``updated`` judges a row of ``matches``."""
    tagged = left.select(F.lit("total").alias("what")).unionAll(
        matches.select(F.when(updated, F.lit("updated")).otherwise(F.lit("matched")).alias("what"))
    )
    what = F.col("what")
    return tagged.agg(
        F.count_if(what == "total").alias("total_rows"),
        F.count_if(what != "total").alias("matches_found"),
        F.count_if(what == "updated").alias("rows_updated"),
    )


def run_summary(steps: DataFrame, names: list[str], run: str = "run_id", step: str = "step") -> DataFrame:
    """One record per run with a nested struct per step."""
    rest = [c for c in steps.columns if c not in (run, step)]
    return steps.groupBy(run).agg(
        *[F.max(F.when(F.col(step) == n, F.struct(*rest))).alias(n) for n in names]
    )


def run_health(runs: DataFrame) -> DataFrame:
    """Over all runs: how many succeeded, mean duration, last good version."""
    done = F.col("sync_status") == COMPLETED
    return runs.agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.count_if(done).alias("n_completed"),
        F.floor(F.avg(F.when(done, F.col("sync_duration"))) + 0.5).cast("bigint").alias("mean_duration"),
        F.max(F.when(done, F.col("version"))).alias("latest_good_version"),
    )


def add_errors(runs: DataFrame, errors: DataFrame) -> DataFrame:
    """Append error texts (``run_id, errors``) to the run records, each text once."""
    e = errors.select(F.col("run_id").alias("_run"), F.col("errors").alias("_errors"))
    none = F.array().cast("array<string>")
    both = F.array_union(F.coalesce(F.col("sync_errors"), none), F.coalesce(F.col("_errors"), none))
    joined = runs.join(e, runs["run_id"] == e["_run"], "left")
    return joined.withColumn("sync_errors", both).drop("_run", "_errors")


def alerts(runs: DataFrame, max_seconds: int = 1800, warn_rate: float = 0.05, critical_rate: float = 0.10) -> DataFrame:
    """Threshold bands on duration and error rate of each run."""
    rate = F.col("n_errors") / F.nullif(F.col("items_processed"), F.lit(0))
    return runs.withColumn("duration_alert", F.col("sync_duration") > max_seconds).withColumn(
        "error_band", error_band(rate, warn_rate, critical_rate)
    )


def error_band(rate: Column, warn: float = 0.05, critical: float = 0.10) -> Column:
    return F.when(rate >= critical, F.lit("CRITICAL")).when(rate >= warn, F.lit("WARNING")).otherwise(F.lit("OK"))
