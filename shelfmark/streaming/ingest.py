"""Incremental ingest of landed feed files with exactly-once effect."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.changes import latest_per_key
from ..sources import feeds, tables


def feed_stream(spark: SparkSession, path: str, record: StructType, field: str = "results",
                layout: str = feeds.ENVELOPE, files_per_batch: int = 1000) -> DataFrame:
    """Feed documents as a stream, shaped like ``feeds.read_feed``."""
    schema = feeds.lines_schema(record) if layout == feeds.LINES else feeds.envelope_schema(record, field)
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if layout == feeds.ENVELOPE:
        reader = reader.option("multiLine", "true")
    return feeds.unwrap(reader.json(path), record, field, layout)


def table_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Files of a Parquet table (or one single file) as a stream."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if tables.is_file(spark, path):
        folder, _, name = path.rpartition("/")
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def upsert_stream(
    rows: DataFrame,
    target: str,
    checkpoint: str,
    key: str,
    order: list[str],
    content: Callable[[DataFrame], Column],
    n_buckets: int = 64,
    rejects: str | None = None,
    accept: Column | None = None,
    shape: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Fold everything that has landed into the target table, then stop; a later call goes on from there.

    Every micro-batch keeps the last row per key, fingerprints it and reconciles it into the touched
    buckets.  Within a key a row only replaces one that is not later than itself, so neither the
    order of the batches nor the repetition of one after a failure changes the result.  Rows that
    fail ``accept`` go to the ``rejects`` table, unreadable feed documents always (beside the target if no table is named), under the stream's checkpoint and batch
    number, and the batch goes on.  The version of a batch follows the highest one in the target, so it grows on when
    a stream begins anew; rows of a repeated batch are unchanged and keep theirs.
    """
    if accept is not None and rejects is None:
        raise ValueError("rows that are not accepted need a rejects table")
    if {"r", "corrupt", "source_file"} <= set(rows.columns):  # feed documents: what can't be read is never folded in
        readable = F.col("r").isNotNull()
        accept = readable if accept is None else readable & accept
        rejects = rejects or f"{target}-rejects"
    origin = hashlib.md5(checkpoint.encode(), usedforsecurity=False).hexdigest()[:12]

    def fold(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept = batch.persist() if accept is not None else batch
        hashed = None
        try:
            good = kept
            if accept is not None:
                bad = kept.where(~F.coalesce(accept, F.lit(False)))
                numbered = bad.select(F.to_json(F.struct("*")).alias("record"), F.lit(f"{origin}-{batch_id}").alias("batch"))
                tables.overwrite_partitions(numbered, rejects, ["batch"])
                good = kept.where(accept)
            if shape is not None:
                good = shape(good)
            latest = latest_per_key(good, [key], [F.col(c) for c in order])
            hashed = latest.withColumn("content_hash", content(latest)).persist()
            tables.recover(spark, target, [tables.BUCKET])
            before = 0
            if tables.exists(spark, target):
                before = spark.read.parquet(target).agg(F.max("data_version")).first()[0] or 0
            version = F.lit(before + 1).cast("bigint")
            tables.upsert_buckets(spark, target, hashed, key, n_buckets, version=version, order=order)
        finally:
            if hashed is not None:
                hashed.unpersist()
            if accept is not None:
                kept.unpersist()

    return (
        rows.writeStream.foreachBatch(fold)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
