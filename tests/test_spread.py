"""Small files of many rows are worked on by many tasks."""

from pyspark.sql import functions as F

from workload import derive


def test_rows_of_one_small_file_are_spread(spark, tmp_path):
    rows = spark.range(60_000).select(
        F.col("id").alias("p_partkey"), F.lit("red ring").alias("p_name"), F.lit("Brand#1").alias("p_brand"),
        F.lit("SMALL").alias("p_type"), (F.col("id") % 50).cast("int").alias("p_size"),
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    made = derive.catalogue(spark, str(tmp_path))
    assert made.rdd.getNumPartitions() == 3
    assert made.select("product_id").distinct().count() == made.count() == 60_000
    few = spark.range(20_000)
    assert derive.spread(few) is few
