"""Only hot codes are salted."""

from pyspark.sql import functions as F

from shelfmark.operators import match


def probes(spark, n, hot):
    code = F.when(F.col("id") % 3 < hot, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.col("id")))
    return spark.range(n).select(F.col("id").alias("left_id"), code.alias("code"))


def test_nothing_is_repeated_without_a_hot_code(spark):
    rows = probes(spark, 20_000, 0)
    assert match.hot_codes(rows, "code") == []
    index = rows.select("code", F.lit(1).alias("x"))
    found = match._look_up(rows, index, "left_id", ["code"])
    assert found.count() == 20_000 and "explode" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_a_code_with_a_third_of_all_rows_is_spread(spark):
    rows = probes(spark, 20_000, 1)
    assert match.hot_codes(rows, "code") == ["hot"]
    index = spark.createDataFrame([("hot", 7), ("c1", 8)], "code string, x int")
    found = match._look_up(rows, index, "left_id", ["code"])
    assert {(r.code, r.x): r.n for r in found.groupBy("code", "x").agg(F.count("*").alias("n")).collect()} == {("hot", 7): 6667, ("c1", 8): 1}


def test_no_rows(spark):
    assert match.hot_codes(probes(spark, 0, 0), "code") == []


def test_a_part_of_the_key_that_all_rows_share_repeats_nothing(spark):
    """Few codes, but no whole key is hot: the join spreads them by itself, and the index is never broadcast."""
    rows = spark.range(20_000).select(F.col("id").alias("left_id"), (F.col("id") % 3).cast("string").alias("code"), F.array("id").alias("joint"))
    index = rows.select("code", "joint", F.lit(1).alias("x"))
    found = match._look_up(rows, index, "left_id", ["code", "joint"])
    plan = found._jdf.queryExecution().toString()
    assert found.count() == 20_000 and "explode" not in plan and "Broadcast" not in plan


def test_a_whole_key_with_a_third_of_all_rows_is_spread(spark):
    name = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), F.col("id")))
    rows = spark.range(9_000).select(F.col("id").alias("left_id"), F.lit("x").alias("code"), name.alias("name"))
    index = spark.createDataFrame([("x", "hot", 7), ("x", "c1", 8), ("y", "hot", 9)], "code string, name string, v int")
    found = match._look_up(rows, index, "left_id", ["code", "name"])
    assert "explode" in found._jdf.queryExecution().optimizedPlan().toString()
    assert {r.v: r.n for r in found.groupBy("v").agg(F.count("*").alias("n")).collect()} == {7: 3000, 8: 1}
