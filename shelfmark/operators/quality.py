"""Data quality reports and log analysis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .runs import error_band
from .select import top


def card_rules() -> dict[str, Column]:
    return {
        "product_id": F.col("product_id").isNotNull(),
        "name": F.col("name").isNotNull(),
        "last_updated": F.col("last_updated").isNotNull(),
    }


def price_rules() -> dict[str, Column]:
    return {
        "last_updated": F.col("last_updated").isNotNull(),
        "normal_mid": F.col("normal").isNull() | F.col("normal.mid").isNotNull(),
        "foil_mid": F.col("foil").isNull() | F.col("foil.mid").isNotNull(),
    }


def run_rules() -> dict[str, Column]:
    return {
        "sync_end": F.col("sync_end").isNotNull(),
        "sync_status": F.col("sync_status").isNotNull(),
        "card_count": F.col("card_count").isNotNull(),
        "sync_errors": F.col("sync_errors").isNotNull(),
    }


def image_rules(url_prefix: str) -> dict[str, Column]:
    """After a run: stored addresses follow the pattern of the storage paths, and are no placeholder."""
    low, high = F.col("low_res_url"), F.col("high_res_url")
    return {
        "url_pattern": low.startswith(url_prefix) & low.rlike(r"_[24]00w\.jpg\z") & high.rlike(r"_[24]00w\.jpg\z"),
        "no_placeholder": ~F.coalesce(F.col("is_placeholder"), F.lit(True)),
    }


def _holds(rule: Column) -> Column:
    return F.coalesce(rule, F.lit(False))


def validation_report(df: DataFrame, rules: dict[str, Column], by: str | None = None) -> DataFrame:
    """Rows checked, rows valid, and failures per rule, in one aggregate."""
    valid = F.lit(True)
    for rule in rules.values():
        valid = valid & _holds(rule)
    aggs = [F.count(F.lit(1)).alias("checked"), F.count_if(valid).alias("valid")]
    aggs += [F.count_if(~_holds(rule)).alias(f"failed_{name}") for name, rule in rules.items()]
    return df.groupBy(by).agg(*aggs) if by else df.agg(*aggs)


def validation_errors(df: DataFrame, rules: dict[str, Column], key: str) -> DataFrame:
    """One row per key and broken rule: as many as there are, and never gathered in one place."""
    failed = F.array_compact(F.array(*[F.when(~_holds(r), F.lit(n)) for n, r in rules.items()]))
    return df.select(key, F.explode(failed).alias("rule"))


def run_checks(counters: DataFrame) -> DataFrame:
    """Post-run checks on the counters of a step."""
    return counters.withColumn("has_updates", F.col("items_updated") > 0).withColumn(
        "has_errors", F.col("n_errors") > 0
    )


def error_rate(logs: DataFrame, time: str, since, is_error: Column, warn: float = 0.05, critical: float = 0.10) -> DataFrame:
    """Errors, rows and band of the rows since a time."""
    counted = logs.where(F.col(time) >= F.lit(since)).agg(
        F.count_if(is_error).alias("n_errors"), F.count(F.lit(1)).alias("n_logs")
    )
    rate = F.col("n_errors") / F.nullif(F.col("n_logs"), F.lit(0))
    return counted.withColumn("band", error_band(rate, warn, critical))


def error_patterns(logs: DataFrame, time: str, tie: str, is_error: Column, message: str, newest: int = 100) -> DataFrame:
    """How often each message occurs among the newest errors."""
    recent = top(logs.where(is_error), newest, F.col(time).desc(), F.col(tie).desc())
    return recent.groupBy(message).agg(F.count(F.lit(1)).alias("n"))


def error_aggregate(logs: DataFrame, time: str, since, is_error: Column, key: str, context: str) -> DataFrame:
    """Per error key: count, last occurrence and in how many contexts it occurred (``error_contexts`` lists them)."""
    pairs = error_contexts(logs, time, since, is_error, key, context)
    return pairs.groupBy(key).agg(
        F.sum("n").alias("n"),
        F.max("last_occurrence").alias("last_occurrence"),
        F.count(context).alias("n_contexts"),
    )


def error_contexts(logs: DataFrame, time: str, since, is_error: Column, key: str, context: str) -> DataFrame:
    """The contexts of each error key, a row each, with count and last occurrence; never gathered in a list."""
    return (
        logs.where((F.col(time) >= F.lit(since)) & is_error)
        .groupBy(key, context)
        .agg(F.count(F.lit(1)).alias("n"), F.max(time).alias("last_occurrence"))
    )


def log_summary(logs: DataFrame, time: str, start, end, level: str, duration: str) -> DataFrame:
    """Error and warning counts and the mean duration of a time window."""
    part = logs.where((F.col(time) >= F.lit(start)) & (F.col(time) <= F.lit(end)))
    return part.agg(
        F.count_if(F.col(level) == "ERROR").alias("n_errors"),
        F.count_if(F.col(level) == "WARNING").alias("n_warnings"),
        F.sum(duration).alias("total_duration"),
        F.count(duration).alias("n_durations"),
    ).withColumn("mean_duration", F.col("total_duration") / F.nullif(F.col("n_durations"), F.lit(0)))


def top_errors(logs: DataFrame, time: str, start, end, is_error: Column, message: str, n: int = 10) -> DataFrame:
    part = logs.where((F.col(time) >= F.lit(start)) & (F.col(time) <= F.lit(end)) & is_error)
    counts = part.groupBy(message).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), F.col(message)).limit(n)


def size_summary(files: DataFrame, size: str, by: str | None = None) -> DataFrame:
    """Number and total size of stored objects."""
    aggs = [F.count(F.lit(1)).alias("total_files"), F.sum(size).cast("bigint").alias("total_size")]
    return files.groupBy(by).agg(*aggs) if by else files.agg(*aggs)


def within_size(files: DataFrame, size: str = "length", low: int = 1024, high: int = 10 * 1024 * 1024) -> DataFrame:
    """Objects within the size bounds (the content is not read for it)."""
    return files.where(F.col(size).between(low, high))
