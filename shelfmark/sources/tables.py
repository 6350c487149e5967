"""Parquet tables: versions, partitions, buckets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.changes import reconcile

BUCKET = "bucket"


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _filesystem(spark, path)
    return fs.exists(p)


def is_file(spark: SparkSession, path: str) -> bool:
    fs, p = _filesystem(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isFile()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a table this run has written for itself."""
    fs, p = _filesystem(spark, path)
    fs.delete(p, True)


def versions(spark: SparkSession, base: str) -> list[int]:
    """Completely written versions of a table, ascending."""
    fs, p = _filesystem(spark, base)
    if not fs.exists(p):
        return []
    found = []
    for status in fs.listStatus(p):
        name = status.getPath().getName()
        done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith("v") and name[1:].isdigit() and fs.exists(done):
            found.append(int(name[1:]))
    return sorted(found)


def version_path(base: str, version: int) -> str:
    return f"{base}/v{version:08d}"


def current(spark: SparkSession, base: str, columns: list[str] | None = None) -> DataFrame | None:
    """Latest complete version, optionally with a few columns only; ``None`` before the first."""
    found = versions(spark, base)
    if not found:
        return None
    df = spark.read.parquet(version_path(base, found[-1]))
    return df.select(*columns) if columns else df


def publish(df: DataFrame, base: str, partition_by: list[str] | None = None, version: int | None = None) -> str:
    """Write a new version next to the old ones.

    Readers change over when its ``_SUCCESS`` mark appears, so a failed write is never seen and the
    version being read is never overwritten.
    """
    if version is None:
        version = (versions(df.sparkSession, base) or [0])[-1] + 1
    path = version_path(base, version)
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str], sort: str | None = None) -> None:
    """Replace exactly the partitions that occur in ``df``.

    ``rebalance`` lets Spark size the files: it splits a hot partition and joins small ones.
    """
    balanced = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if sort:
        balanced = balanced.sortWithinPartitions(*partition_by, sort)
    balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def _pending(path: str) -> str:
    return f"{path.rstrip('/')}.pending"


def replace_partitions(df: DataFrame, path: str, partition_by: list[str], sort: str | None = None) -> None:
    """As ``overwrite_partitions``, for a ``df`` that reads the very partitions it replaces.

    The new content is written next to the table first and stays there until it is in.  If the writer dies while
    partitions are being replaced, ``recover`` puts them in from that copy; if it dies before, the table is as it was.
    """
    spark = df.sparkSession
    recover(spark, path, partition_by, sort)
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(_pending(path))
    recover(spark, path, partition_by, sort)


def recover(spark: SparkSession, path: str, partition_by: list[str], sort: str | None = None) -> bool:
    """Finish a replacement that was written completely; forget one that was not.  Whether there was one to finish."""
    pending = _pending(path)
    complete = exists(spark, f"{pending}/_SUCCESS")
    if complete:
        overwrite_partitions(spark.read.parquet(pending), path, partition_by, sort)
    if exists(spark, pending):
        remove(spark, pending)
    return complete


def bucket_of(key: str, n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_buckets)).cast("int")


def read_buckets(spark: SparkSession, path: str) -> DataFrame | None:
    """Table kept in hash buckets; ``None`` before its first row."""
    if not exists(spark, path):
        return None
    return spark.read.parquet(path).drop(BUCKET)


def lookup(spark: SparkSession, path: str, key: str, value, n_buckets: int) -> DataFrame:
    """Row of one key: one bucket is listed, and the key reaches the scan as a filter."""
    wanted = F.lit(value).cast(spark.read.parquet(path).schema[key].dataType)
    bucket = F.pmod(F.xxhash64(wanted), F.lit(n_buckets)).cast("int")
    return spark.read.parquet(path).where((F.col(BUCKET) == bucket) & (F.col(key) == wanted)).drop(BUCKET)


def merge_buckets(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    key: str,
    n_buckets: int,
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    empty: DataFrame | None = None,
) -> None:
    """Merge rows into a table kept in hash buckets, reading and rewriting the touched buckets only.

    The bucket is a function of the key, so a row never moves and keys spread evenly.  ``updates`` is
    read twice: give a written or persisted table.  The list of touched buckets that comes to the
    driver has at most ``n_buckets`` numbers.  ``empty`` tells the columns of a table not yet there.
    """
    touched = touched_buckets(updates, key, n_buckets)
    if not touched:
        return
    if exists(spark, path):
        base = spark.read.parquet(path).where(F.col(BUCKET).isin(touched)).drop(BUCKET)
    else:
        base = updates.where(F.lit(False)) if empty is None else empty
    merged = merge(base, updates).withColumn(BUCKET, bucket_of(key, n_buckets))
    replace_partitions(merged, path, [BUCKET])


def upsert_buckets(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    key: str,
    n_buckets: int,
    hash_col: str = "content_hash",
    version: Column | None = None,
    order: list[str] | None = None,
) -> None:
    """Reconcile unique rows into a table kept in hash buckets."""

    def fold(base: DataFrame, rows: DataFrame) -> DataFrame:
        return reconcile(base, rows, key, hash_col, version, order=order).drop("change_kind")

    merge_buckets(spark, path, updates, key, n_buckets, fold)


def touched_buckets(keys: DataFrame, key: str, n_buckets: int) -> list[int]:
    """Numbers of the buckets some keys fall into: at most ``n_buckets`` of them."""
    return [r[0] for r in keys.select(bucket_of(key, n_buckets)).distinct().collect()]


def _due(path: str) -> str:
    return f"{path.rstrip('/')}.due"


def add_due(spark: SparkSession, path: str, buckets: list[int]) -> None:
    """Note buckets of a derived table that have to be derived anew, before the table they come from is changed.

    The list outlives a dead writer.  Deriving a bucket once too often does no harm.
    """
    if buckets:
        rows = spark.createDataFrame([(b,) for b in buckets], f"{BUCKET} int")
        rows.coalesce(1).write.mode("append").parquet(_due(path))


def due(spark: SparkSession, path: str) -> list[int]:
    """Buckets noted and not yet derived anew, also those an earlier writer left; at most the number of buckets."""
    if not exists(spark, _due(path)):
        return []
    noted = spark.read.schema(f"{BUCKET} int").parquet(_due(path))
    return sorted(r[0] for r in noted.distinct().collect())


def rebuild_due(spark: SparkSession, path: str, source: str, derive: Callable[[DataFrame], DataFrame], sort: str) -> list[int]:
    """Derive the noted buckets of ``path`` anew from ``source``, then strike them off; returns them."""
    noted = due(spark, path)
    rebuild_buckets(spark, path, source, noted, derive, sort)
    if exists(spark, _due(path)):
        remove(spark, _due(path))
    return noted


def rebuild_buckets(
    spark: SparkSession, path: str, source: str, touched: list[int], derive: Callable[[DataFrame], DataFrame], sort: str
) -> None:
    """Derive some buckets of one table anew from the same buckets of another.

    ``derive`` keeps the bucket column and runs once: what it gives is written next to the table, which tells the
    buckets that came out empty, and then put in as ``replace_partitions`` does.  Files are sorted, so that row groups
    can be skipped by ``sort``.  A bucket for which nothing is derived any more is removed.
    """
    if not touched:
        return
    recover(spark, path, [BUCKET], sort)
    fresh = derive(spark.read.parquet(source).where(F.col(BUCKET).isin(touched)))
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(_pending(path))
    filled = {r[0] for r in spark.read.parquet(_pending(path)).select(BUCKET).distinct().collect()}
    recover(spark, path, [BUCKET], sort)
    for bucket in set(touched) - filled:
        remove(spark, f"{path}/{BUCKET}={bucket}")


def write_bucketed(df: DataFrame, table: str, key: str, n_buckets: int) -> None:
    """Catalogue table bucketed and sorted by key: joins on the key need no shuffle of this side."""
    df.write.mode("overwrite").bucketBy(n_buckets, key).sortBy(key).format("parquet").saveAsTable(table)


def manifest_gaps(wanted: DataFrame, manifest: DataFrame, path_col: str) -> DataFrame:
    """Objects that are wanted and not in the manifest of stored ones."""
    return wanted.join(manifest.select(path_col), path_col, "left_anti")
