"""Places of a feed are told apart in tasks whose number grows with the rows."""

from pyspark.sql import functions as F

from workload import derive, queries


def feed(spark, n):
    cents = F.col("id").cast("double")
    return spark.range(n).select(
        (F.col("id") % 3).alias("product_id"), F.when(F.col("id") % 2 == 0, "Foil").alias("sub_type_name"), cents.alias("high"),
        F.when(F.col("id") % 5 > 0, cents).alias("market"), F.concat(F.lit("f"), F.floor(F.col("id") / 30)).alias("source_file"), F.floor(F.col("id") / 2).alias("position"),
    )


def test_totals_are_those_of_the_plain_aggregate(spark):
    rows = feed(spark, 60).unionAll(feed(spark, 60))
    found = {(r.product_id, r.sub_type_name): tuple(r)[2:] for r in queries._feed_totals(rows, 7).collect()}
    expected = {}
    for i in range(60):
        expected.setdefault((i % 3, "Foil" if i % 2 == 0 else None), []).append(i)
    assert found == {k: (2 * len(v), 200 * sum(v), 2 * sum(i % 5 > 0 for i in v), len({i // 2 for i in v})) for k, v in expected.items()}


def test_rows_are_dealt_by_place_and_not_by_bytes(spark, tmp_path):
    rows = feed(spark, 1000)
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    n = derive.tasks_for(spark.read.parquet(str(tmp_path / "lineitem.parquet")), 100)
    plan = queries._feed_totals(rows, n)._jdf.queryExecution().executedPlan().toString()
    assert n == 10 and "10), REPARTITION_BY_NUM" in plan
    # the deal serves the distinct count: the one other exchange is by the totals' own key
    assert plan.count("Exchange hashpartitioning(") == 2 and derive.tasks_for(rows.limit(0), 100) == 1


def test_files_are_landed_by_many_tasks(spark, tmp_path):
    rows = spark.range(40, numPartitions=1).select((F.col("id") % 20).alias("page"), F.lit("x").alias("text"))
    queries._land_files(rows, "page", 5, str(tmp_path / "out"))
    files = list((tmp_path / "out").rglob("*.txt"))
    # one file a value with all its rows, and several tasks wrote them; nothing is left in a task's folder
    assert len(files) == 20 and {f.read_bytes() for f in files} == {b"x\nx\n"} and {f.parent.name for f in files} == {f"page={i}" for i in range(20)}
    assert len({f.name.split("-")[1] for f in files}) > 1 and not (tmp_path / "out" / "_temporary").exists()


def test_envelopes_are_dealt_by_their_rows(spark, tmp_path, monkeypatch):
    lines = spark.range(600, numPartitions=1).select(
        F.col("id").alias("l_orderkey"), (F.col("id") * 8).alias("l_partkey"), F.lit(1).alias("l_linenumber"), F.lit(7).cast("bigint").alias("l_suppkey"),
        *[F.lit(1.5).alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")], F.lit("N").alias("l_returnflag"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("l_shipdate"),
    )
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(queries, "ROWS_PER_TASK", 100)
    bodies = queries._price_bodies(spark, str(tmp_path))
    plan = bodies._jdf.queryExecution().executedPlan().toString()
    assert "6), REPARTITION_BY_NUM" in plan and plan.count("Exchange") == 1
    assert sorted((r.envelope, r.body.count("productId")) for r in bodies.collect()) == [(i, 24 if i == 18 else 32) for i in range(19)]
