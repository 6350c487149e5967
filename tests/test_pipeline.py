"""Feeds, tables, whole runs and the incremental stream."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.functions import fingerprints
from shelfmark.functions.urls import ImagePolicy
from shelfmark.operators import changes, merge, quality, search
from shelfmark.plans import catalogue
from shelfmark.sources import feeds, images, tables
from shelfmark.streaming import ingest

POLICY = ImagePolicy("cdn.example.net", "https://example.org/none.jpg")


def attr(name, value):
    return {"name": name, "displayName": name, "value": value}


def product(pid, name, gid=1, image="https://img.example.com/a_200w.jpg", **attrs):
    return {
        "productId": pid, "name": name, "cleanName": name, "imageUrl": image, "categoryId": 24, "groupId": gid,
        "url": "u", "modifiedOn": "2024-01-01", "imageCount": 1,
        "extendedData": [attr(k, v) for k, v in attrs.items()],
    }


def source(code, name, sets, **over):
    base = {
        "id": "7", "code": code, "name_en": name, "type_en": "Forward", "job_en": "Knight", "text_en": "[[i]]Hi[[/]]",
        "element": ["火"], "rarity": "H", "cost": "3", "power": "7000", "category_1": "VII", "category_2": "DFF",
        "multicard": "0", "ex_burst": "0", "set": sets, "images": {"thumbs": [], "full": []},
    }
    return {**base, **over}


def put(path, document):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf8") as f:
        f.write(document if isinstance(document, str) else json.dumps(document, ensure_ascii=False))


@pytest.fixture
def landing(tmp_path):
    root = str(tmp_path)
    put(f"{root}/groups/g.json", {"results": [
        {"groupId": 1, "name": "Opus I", "abbreviation": "O1", "publishedOn": "2019-01-01T00:00:00", "modifiedOn": "a"},
        {"groupId": 2, "name": "Starter Deck", "abbreviation": "SD", "publishedOn": "2018-01-01T00:00:00", "modifiedOn": "a"},
    ]})
    put(f"{root}/products/1.json", {"results": [
        product(10, "Cloud - 1-044R (Common)", Number="1-044R", CardType="Forward", Element="wind;FIRE", Cost="5", Power="9000", Rarity="R", Description="Dull: x"),
        product(11, "Tifa - PR-055/1-045H (Full Art)", Number="PR-055/1-045H", CardType="Forward", Rarity="H"),
        product(12, "Booster Box", image=None),
    ]})
    put(f"{root}/products/2.json", {"results": [product(20, "Crystal Ball", gid=2, Number="C-4", Cost="")]})
    put(f"{root}/source/s.json", {"count": 2, "cards": [
        source("1-044R", "Cloud Strife", [" opus i "]),
        source("PR-055/1-045H", "Tifa L", ["Opus I"], type_en="Summon"),
        source("9-999L", "Nobody", ["Opus IX"]),
    ]})
    price = {"productId": 10, "lowPrice": 1.0, "midPrice": 2.0, "highPrice": 3.0, "marketPrice": 2.5, "directLowPrice": None, "subTypeName": "Normal"}
    put(f"{root}/prices/1.json", {"success": True, "errors": [], "results": [
        price, {**price, "marketPrice": 0.285}, {**price, "subTypeName": "Foil"}, {**price, "productId": 11, "subTypeName": "Promo"},
    ]})
    return catalogue.Layout(f"{root}/groups", f"{root}/products", f"{root}/prices", f"{root}/source", f"{root}/tables", n_buckets=4), root


def run(spark, layout, steps=catalogue.CATALOGUE_STEPS, **options):
    r = catalogue.Run(spark, layout, POLICY, **options)
    return r, {s.step: s for s in catalogue.run_steps(r, steps)}


def test_full_run_and_rerun(spark, landing):
    layout, root = landing
    first, steps = run(spark, layout)
    assert [s.error for s in steps.values() if not s.success] == []
    assert (steps["cards"].processed, steps["cards"].updated, steps["groups"].updated, steps["enrich"].updated) == (4, 4, 2, 2)
    cards = {r.product_id: r for r in tables.read_buckets(spark, layout.table("cards")).collect()}
    cloud, tifa, box, ball = (cards[i] for i in (10, 11, 12, 20))
    assert cloud.name == "Cloud Strife" and cloud.card_numbers == ["1-044R"] and cloud.categories == ["DFF", "VII"]
    assert cloud.rarity == "Hero" and cloud.power == 7000.0 and cloud.description == "<em>Hi</em>" and cloud.elements == ["Fire"]
    assert tifa.name == "Tifa (Full Art)" and tifa.rarity == "Promo" and tifa.job == "" and tifa.full_card_number == "PR-055/1-045H"
    assert box.is_non_card and box.set == ["Opus I"] and box.card_numbers is None and box.low_res_url == POLICY.placeholder_url
    assert ball.card_type == "Crystal" and ball.elements == ["Crystal"] and ball.set == ["Starter Deck"]
    assert "clo" in cloud.search_terms and box.search_terms is None
    facet = {r["field"]: list(r["values"]) for r in tables.current(spark, layout.table("facets")).collect()}
    # set names take the spelling of the second source; only names of a group are listed
    assert facet["cost"] == ["3"] and facet["category"] == ["DFF", "VII"] and facet["set"] == ["Opus I", "Starter Deck"]
    image = {r.product_id: r for r in tables.read_buckets(spark, layout.table("card_images")).collect()}
    assert image[12].error_message == "Image URL missing" and not image[10].is_placeholder and "image_metadata" not in cloud
    record = tables.current(spark, layout.table("runs")).first()
    assert record.version == 1 and record.sync_status == "completed" and record.card_count == 4 and record.search_indexed

    second, steps = run(spark, layout)
    assert [s.error for s in steps.values() if not s.success] == []
    assert second.version == 2
    assert {n: s.updated for n, s in steps.items()} == {
        "groups": 0, "cards": 0, "source_cards": 0, "enrich": 0, "search_index": 0, "facets": 0
    }

    put(f"{root}/products/2.json", {"results": [product(20, "Crystal Orb", gid=2, Number="C-4", Cost="2")]})
    third, steps = run(spark, layout)
    assert steps["cards"].updated == 1
    changed = tables.read_buckets(spark, layout.table("cards")).where(F.col("data_version") == 3).collect()
    assert [r.product_id for r in changed] == [20]
    assert [r.product_id for r in tables.lookup(spark, layout.table("cards"), "product_id", 20, layout.n_buckets).collect()] == [20]
    log = spark.read.parquet(layout.table("cards_deltas")).where("data_version = 3").collect()
    assert [(r.product_id, r.changes.clean_name) for r in log] == [(20, "Crystal Orb")]
    index = spark.read.parquet(layout.table("search_index"))
    hits = {q: [r.product_id for r in search.search_index(index, q, "product_id").collect()] for q in ("crystal o", "crystal b", "tif")}
    assert hits == {"crystal o": [20], "crystal b": [], "tif": [11]}


def test_unchanged_rows_are_not_cleaned(spark, landing):
    """Name and text rules stand above the filter that leaves changed rows only."""
    layout, _ = landing
    rows = feeds.products(spark, layout.products_feed)
    groups = feeds.groups(spark, layout.groups_feed)
    hashed = catalogue.hashed_products(rows)
    stored = hashed.select("product_id", "content_hash")
    changed = changes.to_write(changes.classify(hashed, stored, "product_id")).drop("change_kind")
    plan = catalogue.cleaned_rows(changed, groups, POLICY)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.split("\n")
    rules = [i for i, line in enumerate(lines) if "EX|LB" in line or "Full Art" in line]
    joined = [i for i, line in enumerate(lines) if "Join LeftOuter" in line and "product_id" in line]
    assert rules and joined and max(rules) < min(joined)


def test_single_group_and_plan_only(spark, landing):
    layout, _ = landing
    _, steps = run(spark, layout, [catalogue.sync_groups, catalogue.sync_cards], group_id=2)
    assert steps["cards"].processed == 1
    _, steps = run(spark, layout, [catalogue.sync_cards], plan_only=True)
    assert (steps["cards"].processed, steps["cards"].updated) == (4, 3)
    assert tables.read_buckets(spark, layout.table("cards")).count() == 1


def test_failed_step_stops_the_run(spark, landing):
    layout, root = landing
    put(f"{root}/source/s.json", {"count": 0})
    _, steps = run(spark, layout, [catalogue.sync_groups, catalogue.sync_source, catalogue.sync_cards])
    assert steps["sync_source"].success is False and "cards array" in steps["sync_source"].error
    assert "cards" not in steps
    assert tables.current(spark, layout.table("runs")).first().sync_status == "failed"
    retry, _ = run(spark, layout, [catalogue.sync_groups])
    assert retry.version == 2  # a number is never given twice
    record = {r.version: r for r in tables.current(spark, layout.table("runs")).collect()}
    assert record[1].sync_status == "failed" and record[2].sync_status == "completed"


def test_price_run_is_idempotent_per_day(spark, landing):
    layout, _ = landing
    run(spark, layout, [catalogue.sync_groups, catalogue.sync_cards])
    started = dt.datetime(2024, 5, 1, 12, tzinfo=dt.timezone.utc)
    _, steps = run(spark, layout, [catalogue.sync_prices], started=started)
    assert (steps["prices"].processed, steps["prices"].updated) == (1, 1), steps
    _, steps = run(spark, layout, [catalogue.sync_prices], started=started, force=True)
    assert steps["prices"].updated == 1
    shots = spark.read.parquet(layout.table("price_history")).collect()
    assert [(s.product_id, s.group_id, s.normal.market, s.foil.market, str(s.snapshot_date)) for s in shots] == [(10, 1, 28, 250, "2024-05-01")]
    later = dt.datetime(2024, 5, 2, 12, tzinfo=dt.timezone.utc)
    _, steps = run(spark, layout, [catalogue.sync_prices], started=later)
    assert steps["prices"].updated == 0
    # a day without changes has its rows all the same
    days = [str(r.snapshot_date) for r in spark.read.parquet(layout.table("price_history")).orderBy("snapshot_date").collect()]
    assert days == ["2024-05-01", "2024-05-02"]


def test_purge(spark, landing):
    layout, _ = landing
    old = dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc)
    run(spark, layout, [catalogue.sync_groups], started=old)
    last, _ = run(spark, layout, [catalogue.sync_groups])
    assert catalogue.purge(last, dt.datetime(2021, 1, 1, tzinfo=dt.timezone.utc)) == {"runs": 1}
    assert tables.current(spark, layout.table("runs")).count() == 1
    assert len(tables.versions(spark, layout.table("runs"))) == catalogue.KEPT_VERSIONS
    with pytest.raises(ValueError):
        catalogue.purge(last, old, ("no such table",))


def test_purge_of_logs(spark, landing):
    layout, root = landing
    old = dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc)
    put(f"{root}/groups/h.json", "{broken")
    run(spark, layout, [catalogue.sync_groups], started=old)
    last, _ = run(spark, layout, [catalogue.sync_groups], force=True)
    gone = catalogue.purge(last, dt.datetime(2021, 1, 1, tzinfo=dt.timezone.utc), ("groups_deltas", "groups_rejects"))
    assert gone == {"groups_deltas": 2, "groups_rejects": 1}
    assert spark.read.parquet(layout.table("groups_deltas")).count() == 2


@pytest.mark.parametrize("feed_layout", [feeds.ENVELOPE, feeds.LINES])
def test_unreadable_documents_are_rejected_and_the_rest_goes_on(spark, tmp_path, feed_layout):
    root = str(tmp_path)
    group = {"groupId": 1, "name": "One", "abbreviation": "O", "publishedOn": "2019-01-01T00:00:00", "modifiedOn": "a"}
    pack = (lambda rows, name: json.dumps({name: rows})) if feed_layout == feeds.ENVELOPE else (
        lambda rows, name: "\n".join(json.dumps(r) for r in rows))
    put(f"{root}/groups/a.json", pack([group], "results"))
    put(f"{root}/groups/b.json", "{broken")
    put(f"{root}/products/a.json", pack([product(10, "Cloud")], "results"))
    put(f"{root}/products/b.json", "{broken")
    layout = catalogue.Layout(f"{root}/groups", f"{root}/products", "", f"{root}/source", f"{root}/tables", feed_layout, 4)
    steps_wanted = [catalogue.sync_groups, catalogue.sync_cards]
    if feed_layout == feeds.LINES:  # an envelope without cards fails the step instead
        put(f"{root}/source/a.json", pack([source("1-044R", "Cloud", ["One"])], "cards") + "\n{broken")
        steps_wanted.append(catalogue.sync_source)
    _, steps = run(spark, layout, steps_wanted)
    for name in ("groups", "cards", *["source_cards"] * (feed_layout == feeds.LINES)):
        assert (steps[name].success, steps[name].processed, steps[name].n_errors) == (True, 1, 1), name
        record = spark.read.parquet(layout.table(f"{name}_rejects")).first().record
        assert "broken" in record and ".json" in record


def test_a_failed_step_is_recorded_whole_and_a_killed_run_leaves_its_start(spark, landing):
    layout, _ = landing

    def broken(_):
        raise RuntimeError("x" * 3000)

    def killed(_):
        raise KeyboardInterrupt

    _, steps = run(spark, layout, [broken])
    assert steps["broken"].error == "x" * 3000
    assert tables.current(spark, layout.table("runs")).first().sync_errors == ["x" * 3000]
    with pytest.raises(KeyboardInterrupt):
        run(spark, layout, [killed])
    states = [r.sync_status for r in tables.current(spark, layout.table("runs")).orderBy("version").collect()]
    assert states == ["failed", "in-progress"]


def test_single_group_reads_its_folder_only(spark, tmp_path):
    root = str(tmp_path)
    for g in (1, 2):
        put(f"{root}/products/group_id={g}/a.json", {"results": [product(10 * g, "Cloud", gid=g)]})
    put(f"{root}/groups/g.json", {"results": []})
    layout = catalogue.Layout(f"{root}/groups", f"{root}/products", "", "", f"{root}/tables", n_buckets=4, by_group=True)
    files = spark.read.json(layout.feed(layout.products_feed, 2)).inputFiles()
    assert len(files) == 1 and "group_id=2" in files[0]
    _, steps = run(spark, layout, [catalogue.sync_groups, catalogue.sync_cards], group_id=2)
    assert steps["cards"].processed == 1
    _, steps = run(spark, layout, [catalogue.sync_cards])
    assert steps["cards"].processed == 2


def test_feed_layouts_and_corrupt_documents(spark, tmp_path):
    root = str(tmp_path)
    put(f"{root}/env/a.json", {"results": [product(1, "A"), product(2, "B")]})
    put(f"{root}/env/b.json", "{not json")
    feed = feeds.read_feed(spark, f"{root}/env", schemas.PRODUCT_RESULT)
    assert sorted(r.r.productId for r in feeds.readable(feed).collect()) == [1, 2]
    assert feeds.unreadable(feed).count() == 1
    put(f"{root}/lines/a.json", "\n".join(json.dumps(product(i, "x")) for i in range(50)))
    lines = feeds.products(spark, f"{root}/lines", layout=feeds.LINES).orderBy("position").collect()
    assert [r.product_id for r in lines] == list(range(50))


def test_a_merge_that_dies_between_buckets_is_finished(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = spark.range(40).select("id", F.lit("a").alias("v"))
    keep = lambda base, new: merge.merge_upsert(base, new, "id")
    tables.merge_buckets(spark, path, rows, "id", 4, keep)
    real = tables.overwrite_partitions

    def dies(df, target, by, sort=None):
        real(df.where(F.col(tables.BUCKET) == 0), target, by, sort)
        tables.remove(spark, f"{target}/{tables.BUCKET}=1")  # taken out, the new one not yet moved in
        raise RuntimeError("killed")

    monkeypatch.setattr(tables, "overwrite_partitions", dies)
    with pytest.raises(RuntimeError):
        tables.merge_buckets(spark, path, rows.withColumn("v", F.lit("b")), "id", 4, keep)
    monkeypatch.setattr(tables, "overwrite_partitions", real)
    assert spark.read.parquet(path).count() < 40
    assert tables.recover(spark, path, [tables.BUCKET]) and not tables.recover(spark, path, [tables.BUCKET])
    assert spark.read.parquet(path).groupBy("v").count().collect()[0][:] == ("b", 40)


def test_versions_and_partitions(spark, tmp_path):
    base = f"{tmp_path}/t"
    assert tables.current(spark, base) is None
    tables.publish(spark.range(3).toDF("id"), base)
    grown = tables.current(spark, base).unionByName(spark.range(3, 5).toDF("id"))
    tables.publish(grown, base)
    assert tables.versions(spark, base) == [1, 2] and tables.current(spark, base).count() == 5
    path = f"{tmp_path}/p"
    tables.overwrite_partitions(spark.range(10).selectExpr("id", "id % 3 AS b"), path, ["b"])
    tables.overwrite_partitions(spark.range(1).selectExpr("id + 100 AS id", "1L AS b"), path, ["b"])
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 2, 3, 5, 6, 8, 9, 100]


def test_bucketed_table_is_not_shuffled(spark):
    df = spark.range(1000).selectExpr("id", "id * 2 AS v")
    tables.write_bucketed(df, "bucketed_rows", "id", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = spark.table("bucketed_rows")
        joined = stored.join(spark.range(50).toDF("id"), "id", "full_outer")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1, plan
    spark.sql("DROP TABLE bucketed_rows")


def test_images(spark, tmp_path):
    for name, content in {"a.jpg": b"\xff\xd8\xff" + b"0" * 2000, "b.png": b"\x89PNG" + b"0" * 10, "c.txt": b"hello"}.items():
        with open(tmp_path / name, "wb") as f:
            f.write(content)
    files = images.image_files(spark, str(tmp_path))
    kinds = {r.path.rsplit("/", 1)[1]: r.kind for r in images.checked_images(files).select("path", "kind").collect()}
    assert kinds == {"a.jpg": "jpeg", "b.png": "png", "c.txt": None}
    assert quality.within_size(files).count() == 1
    assert [tuple(r) for r in quality.size_summary(files, "length").collect()] == [(3, 2003 + 14 + 5)]
    wanted = spark.createDataFrame([("x",), ("y",)], "path string")
    assert [r.path for r in tables.manifest_gaps(wanted, wanted.where("path = 'x'"), "path").collect()] == ["y"]


def test_stream_ingest_resumes_and_quarantines(spark, tmp_path):
    root = str(tmp_path)
    put(f"{root}/in/1.json", {"results": [product(1, "A"), product(2, "B")]})
    put(f"{root}/in/2.json", "{broken")

    def ingest_once():
        rows = ingest.feed_stream(spark, f"{root}/in", schemas.PRODUCT_RESULT, files_per_batch=1)
        q = ingest.upsert_stream(
            rows, f"{root}/target", f"{root}/ckpt", "product_id", ["modified_on", "position"],
            lambda df: fingerprints.fingerprint([F.col("name")]), n_buckets=4, rejects=f"{root}/rejects",
            accept=F.col("r.productId").isNotNull(),
            shape=lambda df: feeds.shape_products(df).select("product_id", "name", "modified_on", "position"),
        )
        q.awaitTermination()
        return {r.product_id: r.name for r in spark.read.parquet(f"{root}/target").collect()}

    assert ingest_once() == {1: "A", 2: "B"}
    assert spark.read.parquet(f"{root}/rejects").count() == 1
    assert ingest_once() == {1: "A", 2: "B"}
    newer = {**product(2, "B2"), "modifiedOn": "2024-02-01"}
    older = {**product(1, "A0"), "modifiedOn": "2023-01-01"}
    put(f"{root}/in/3.json", {"results": [newer, older, product(3, "C")]})
    assert ingest_once() == {1: "A", 2: "B2", 3: "C"}


def _postings(spark, layout):
    index = spark.read.parquet(layout.table("search_index"))
    return {(r.term, r.product_id) for r in index.select("term", "product_id").collect()}


def _derived_postings(spark, layout):
    cards = tables.read_buckets(spark, layout.table("cards"))
    return {(r.term, r.product_id) for r in search.inverted_index(cards, "product_id").select("term", "product_id").collect()}


INDEX_STEPS = [catalogue.sync_groups, catalogue.sync_cards, catalogue.refresh_index]


@pytest.mark.parametrize("moment", ["before the postings", "while buckets are swapped"])
def test_index_heals_after_a_crash(spark, landing, monkeypatch, moment):
    """The card table has its new terms, the run dies before the postings have them; the next run puts them right."""
    layout, root = landing
    _, steps = run(spark, layout, INDEX_STEPS)
    assert all(s.success for s in steps.values()) and _postings(spark, layout) == _derived_postings(spark, layout)
    # one card is renamed, one loses its codes and with them all its postings
    put(f"{root}/products/2.json", {"results": [product(20, "Crystal Orb", gid=2, Number="C-4", Cost="2")]})
    put(f"{root}/products/1.json", {"results": [
        product(10, "Aerith", Number="1-044R", CardType="Forward"), product(11, "Tifa", Number="PR-055/1-045H"), product(12, "Booster Box"),
    ]})
    with monkeypatch.context() as patch:
        if moment == "before the postings":
            def dies(*_, **__):
                raise RuntimeError("killed")
            patch.setattr(tables, "rebuild_buckets", dies)
        else:
            real = tables.overwrite_partitions

            def dies(df, target, by, sort=None):
                if not target.endswith("search_index"):
                    return real(df, target, by, sort)
                one = df.select(tables.BUCKET).first()[0]
                tables.remove(spark, f"{target}/{tables.BUCKET}={one}")
                raise RuntimeError("killed")
            patch.setattr(tables, "overwrite_partitions", dies)
        _, steps = run(spark, layout, INDEX_STEPS)
        assert [s.error for s in steps.values() if not s.success] == ["killed"]
    assert _postings(spark, layout) != _derived_postings(spark, layout)
    assert tables.due(spark, layout.table("search_index"))
    _, steps = run(spark, layout, INDEX_STEPS)
    assert all(s.success for s in steps.values()) and steps["search_index"].updated == 0
    healed = _postings(spark, layout)
    assert healed == _derived_postings(spark, layout) and ("aerith", 10) in healed and ("cloud", 10) not in healed
    assert tables.due(spark, layout.table("search_index")) == []


def test_rebuilt_buckets_derive_once_and_lose_emptied_ones(spark, tmp_path):
    source, target = f"{tmp_path}/s", f"{tmp_path}/t"
    rows = spark.range(40).select("id", F.concat(F.lit("t"), F.col("id")).alias("term"))
    tables.overwrite_partitions(rows.withColumn(tables.BUCKET, tables.bucket_of("id", 4)), source, [tables.BUCKET])
    calls = []

    def derive(df, gone=-1):
        calls.append(1)
        return df.where(F.col(tables.BUCKET) != gone)

    tables.rebuild_buckets(spark, target, source, [0, 1, 2, 3], derive, "term")
    assert len(calls) == 1 and spark.read.parquet(target).count() == 40
    tables.rebuild_buckets(spark, target, source, [1, 2], lambda df: derive(df, 1), "term")
    left = {r[0] for r in spark.read.parquet(target).select(tables.BUCKET).distinct().collect()}
    assert len(calls) == 2 and left == {0, 2, 3} and not tables.exists(spark, f"{target}.pending")
    tables.rebuild_buckets(spark, f"{tmp_path}/none", source, [1], lambda df: derive(df, 1), "term")  # nothing at all
    tables.add_due(spark, target, [])
    assert tables.due(spark, target) == []
    tables.add_due(spark, target, [1])
    tables.add_due(spark, target, [1, 3])
    assert tables.due(spark, target) == [1, 3]
    assert tables.rebuild_due(spark, target, source, derive, "term") == [1, 3] and tables.due(spark, target) == []
    assert spark.read.parquet(target).count() == 40
