"""Envelopes leave little on disk: their text is not kept, and a batch of them goes before the next one comes."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfmark.schemas import PRICE_RESULT
from shelfmark.sources import envelopes, feeds
from workload import queries

from test_envelopes import record


def test_text_of_elements_is_not_kept(spark, tmp_path, monkeypatch):
    staged = []
    monkeypatch.setattr(envelopes, "shared_folder", lambda _, purpose: staged.append(f"{tmp_path}/{purpose}-{len(staged)}") or staged[-1])
    (tmp_path / "in").mkdir()
    records = [{"productId": i, "other": "x" * 200} for i in range(500)]
    (tmp_path / "in" / "a").write_text(json.dumps({"results": records, "end": {"n": 1}}))
    with envelopes.passing(spark):
        feed = feeds.read_feed(spark, str(tmp_path / "in"), PRICE_RESULT, layout=feeds.SPLIT)
        assert sorted(r.r.productId for r in feed.collect()) == list(range(500))
        kept = sum(f.stat().st_size for at in staged for f in Path(at).rglob("*.parquet"))
        texts = [spark.read.parquet(at).select(F.sum(F.length("text"))).first()[0] or 0 for at in staged]
        # of 110,000 characters only what tells files without elements apart, the first fragment
        assert staged and sum(texts) < 1000 and kept < 20_000
        assert "Exchange" not in envelopes.fragments(spark, str(tmp_path / "in"))._jdf.queryExecution().executedPlan().toString()
    assert not any(Path(at).exists() for at in staged)


@pytest.mark.parametrize("size", [150])
def test_elements_through_several_splits_and_batches(spark, tmp_path, size):
    names = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1", "spark.sql.execution.arrow.maxRecordsPerBatch": "3"}
    before = {n: spark.conf.get(n) for n in names}
    rng, want = random.Random(size), {}
    for k in range(2):
        records = [record(rng, 100 * k + i) | ({"note": "{\\\"" * 60 + "}"} if i % 4 == 0 else {}) for i in range(7)]
        text = json.dumps({"first": [{"productId": -1}], "results": records, "last": {"results": [{"productId": -2}]}}, ensure_ascii=False) + "\n" * k
        (tmp_path / f"f{k}").write_text(text, encoding="utf-8")
        want |= {(f"f{k}", i): (r["productId"], r["subTypeName"]) for i, r in enumerate(records)}
    (tmp_path / "cut").write_text(text[: len(text) // 2], encoding="utf-8")
    for n, v in names.items():
        spark.conf.set(n, v)
    try:
        feed = feeds.read_feed(spark, str(tmp_path), PRICE_RESULT, layout=feeds.SPLIT)
        # the table made of it is read in usual splits
        for n, v in before.items():
            spark.conf.set(n, v)
        rows = feed.collect()
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
    assert {(r.source_file.rsplit("/", 1)[1], r.position): (r.r.productId, r.r.subTypeName) for r in rows if r.r} == want
    assert [(r.source_file.rsplit("/", 1)[1], r.position) for r in rows if not r.r] == [("cut", None)]
    assert len(rows) == len(want) + 1


@pytest.fixture
def batches(spark, tmp_path, monkeypatch):
    """Price rows of 19 envelopes, 300 rows a batch; the folders landed in and read, with the envelopes of each."""
    lines = spark.range(600, numPartitions=1).select(
        F.col("id").alias("l_orderkey"), (F.col("id") * 8).alias("l_partkey"), (F.col("id") % 4).cast("int").alias("l_linenumber"), F.lit(7).cast("bigint").alias("l_suppkey"),
        *[F.lit(1.5).alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")], F.lit("N").alias("l_returnflag"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("l_shipdate"),
    )
    lines.unionAll(lines.where("l_orderkey = 3")).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(queries, "ROWS_PER_BATCH", 300)
    folder = lambda _, purpose, made=[]: made.append(1) or f"{tmp_path}/shared/{purpose}-{len(made)}"  # noqa: B006, E731
    monkeypatch.setattr(queries.session, "shared_folder", folder)
    monkeypatch.setattr(envelopes, "shared_folder", folder)
    land, found = queries._land_files, []

    def landed(rows, name, n_tasks, at):
        land(rows, name, n_tasks, at)
        found.append(sorted(int(f.name.split("=")[1]) for f in Path(at).iterdir() if "=" in f.name))
        # of the batches before nothing is left but results
        assert [p for p in (tmp_path / "shared").iterdir() if "results" not in p.name] == [Path(at)]

    monkeypatch.setattr(queries, "_land_files", landed)
    yield found
    assert len(found) == 3 and sorted(sum(found, [])) == list(range(19)) and max(map(len, found)) < 15
    assert len(list((tmp_path / "shared").iterdir())) == 1


def test_feed_by_batches(spark, tmp_path, batches):
    rows = queries.envelope_feed(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, rows)) == [(8 * i, "Normal", n, 150 * n, 0 if i % 4 == 3 else n, n) for i in range(600) for n in [2 if i == 3 else 1]]


def test_checks_by_batches(spark, tmp_path, batches):
    rows = queries.envelope_checks(spark, str(tmp_path)).collect()
    n = {e: 33 if e == 0 else 24 if e == 18 else 32 for e in range(19)}
    assert sorted(map(tuple, rows)) == [(e, *[(n[e], 0, n[e]), (0, 0, 0), (0, 1, 0), (n[e], 1, n[e] + 1)][e % 4]) for e in range(19)]
