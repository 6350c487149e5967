"""Operators on small fixtures: exact results, brute-force comparison, plan shapes."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import codes
from shelfmark.operators import (
    changes, enrich, facets, history, keys, match, merge, numbering, pivot, quality, repair, runs, search, select,
)


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- matching

def fixture_match(spark):
    left = spark.createDataFrame(
        [
            ("a1", ["1-001C"], None, None, None, [" Opus I "], False),
            ("a2", ["1-001C"], None, None, None, ["Opus II"], False),
            ("a3", ["1-001C"], None, None, None, None, False),
            ("a4", ["1-001C"], None, None, None, [], False),
            ("a5", ["PR-055"], "PR-055/7-001H", None, None, ["Opus VII"], False),
            ("a6", ["1-001C"], None, None, None, ["Opus I"], True),
            ("a7", ["A-001"], "A-001", None, None, ["Anniv"], False),
            ("a8", ["2-002R"], None, None, None, ["x"], False),
            ("a9", ["9-999Z"], None, None, None, ["x"], False),
        ],
        "id string, c array<string>, f string, n string, p string, s array<string>, non boolean",
    )
    right = spark.createDataFrame(
        [
            ("1-001C_b", "1-001C", ["opus i"]),
            ("1-001C_a", "1-001C", ["OPUS I", "other"]),
            ("7-001H_x", "7-001H", ["opus vii"]),
            ("A-001_x", "A-001", ["anniv"]),
            ("2-002R_n", "2-002R", None),
        ],
        "doc_id string, code string, s array<string>",
    )
    l = left.select("id", codes.match_keys(F.col("c"), F.col("f"), F.col("n"), F.col("p"), F.col("non")).alias("k"), "s")
    r = right.select("doc_id", codes.source_match_keys(F.col("code")).alias("k"), "s")
    return l, r


def test_first_match_cases(spark):
    l, r = fixture_match(spark)
    out = match.first_match(l, r, "id", "k", "s", "doc_id", "k", "s")
    assert rows(out, "id", "doc_id") == [
        ("a1", "1-001C_a"),  # sets differ in case and blanks only; two hits, the smaller key wins
        ("a3", "1-001C_a"),  # null set on the left matches anything
        ("a5", "7-001H_x"),  # a promotional code matches through its remainder
        ("a7", "A-001_x"),  # codes in A- only through the whole code
        ("a8", "2-002R_n"),  # null set on the right
    ]


def test_first_match_against_nested_loop(spark):
    rng = random.Random(7)
    left = [(i, rng.sample("abcdef", rng.randint(0, 3)), rng.choice([None, [], ["x"], ["y", "X "], ["z"]])) for i in range(120)]
    right = [(i, rng.sample("abcdef", rng.randint(1, 2)), rng.choice([None, [], ["x"], ["Y"]])) for i in range(60)]

    def meets(a, b):
        if not set(a[1]) & set(b[1]):
            return False
        if a[2] is None or b[2] is None:
            return True
        return bool({s.strip().lower() for s in a[2]} & {s.strip().lower() for s in b[2]})

    expected = sorted(
        (a[0], min(b[0] for b in right if meets(a, b))) for a in left if any(meets(a, b) for b in right)
    )
    l = spark.createDataFrame(left, "a int, k array<string>, s array<string>")
    r = spark.createDataFrame(right, "b int, k array<string>, s array<string>")
    out = match.first_match(l, r, "a", "k", "s", "b", "k", "s")
    assert rows(out, "a", "b") == expected
    plan = plan_of(out)
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_scored_match_against_nested_loop(spark):
    rng = random.Random(3)
    props = ["power", "cost", "job", "rarity"]

    def side(n):
        return [
            (i, rng.choice("pq"), *[rng.choice([None, "1", "2", "3"]) for _ in props]) for i in range(n)
        ]

    left, right = side(80), side(70)
    agree = lambda a, b: sum(x is not None and x == y for x, y in zip(a[2:], b[2:]))
    pairs = [(a[0], b[0], agree(a, b)) for a, b in itertools.product(left, right) if a[1] == b[1] and agree(a, b) >= 2]
    expected = sorted(
        (i, len(hits), min(h[1] for h in hits)) for i, hits in ((a[0], [p for p in pairs if p[0] == a[0]]) for a in left) if hits
    )
    schema = "id int, stem string, " + ", ".join(f"{p} string" for p in props)
    l = spark.createDataFrame(left, schema).withColumn("stems", F.array("stem", F.lit("zz")))
    r = spark.createDataFrame(right, schema).withColumnRenamed("id", "rid")
    out = match.scored_match(l, r, "id", "stems", "rid", "stem", props).where("n_matches > 0")
    assert rows(out, "id", "n_matches", "rid") == expected


def test_a_hot_code_is_spread_over_tasks(spark):
    """Half of the left rows share a code: without broadcast they still go to several tasks."""
    left = spark.range(8000).select(
        F.col("id").alias("l"),
        F.array(F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))).alias("k"),
        F.lit(None).cast("array<string>").alias("s"),
    )
    right = spark.range(100).select(
        F.col("id").alias("r"), F.array(F.when(F.col("id") == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))).alias("k"),
        F.lit(None).cast("array<string>").alias("s"),
    )
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        probes = left.select("l", F.explode("k").alias("code"))
        index = right.select(F.explode("k").alias("code"), "r").groupBy("code").agg(F.min("r").alias("r"))
        joined = match._look_up(probes, index, "l", ["code"]).where("code = 'hot'")
        placed = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(placed) > 2 and max(r["count"] for r in placed) < 3000
        out = match.first_match(left, right, "l", "k", "s", "r", "k", "s")
        assert out.where("l % 2 = 0").agg(F.count("*"), F.sum("r")).first()[:] == (4000, 0)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_chunk_must_hold_what_the_next_one_looks_back_on(spark):
    with pytest.raises(ValueError):
        numbering.trailing_window(spark.range(3), [], [F.col("id")], F.lit(0), back=5, compute=lambda w: {}, chunk=4)


def test_tiered_match(spark):
    left = spark.createDataFrame(
        [(1, ["B", "A"], ["a"]), (2, ["x"], ["a", "b"]), (3, ["x"], ["q"])], "l int, e array<string>, k array<string>"
    )
    right = spark.createDataFrame([(10, "A", ["a"]), (11, "B", ["b"]), (9, "C", ["b"])], "r int, e string, k array<string>")
    out = match.tiered_match(left, right, "l", "e", "k", "r", "e", "k")
    assert rows(out, "l", "r", "tier") == [(1, 11, 1), (2, 9, 2)]


# ---------------------------------------------------------------- changes and merging

def test_classify(spark):
    incoming = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d"), (5, None)], "id int, content_hash string")
    stored = spark.createDataFrame(
        [(2, "b", 1), (3, "x", 1), (4, "d", None), (5, None, 1)], "id int, content_hash string, v int"
    )
    out = changes.classify(incoming, stored, "id", version_col="v")
    assert rows(out, "id", "change_kind") == [(1, "new"), (2, "unchanged"), (3, "changed"), (4, "unstamped"), (5, "unchanged")]
    forced = changes.classify(incoming, stored, "id", version_col="v", force=True)
    assert dict(rows(forced, "id", "change_kind"))[2] == "forced"


def test_reconcile_is_idempotent_and_precise(spark):
    feed = spark.createDataFrame([(i, f"n{i}") for i in range(50)], "id int, name string").withColumn(
        "content_hash", F.md5("name")
    )
    empty = feed.where("false")
    first = changes.reconcile(empty, feed, "id", version=F.lit(1).cast("bigint"))
    assert {r.change_kind for r in first.collect()} == {"new"}
    table = first.drop("change_kind")
    again = changes.reconcile(table, feed, "id", version=F.lit(2).cast("bigint"))
    assert {r.change_kind for r in again.collect()} == {"unchanged"}
    edited = feed.withColumn("name", F.when(F.col("id") == 7, "new").otherwise(F.col("name"))).withColumn("content_hash", F.md5("name"))
    third = changes.reconcile(table, edited, "id", version=F.lit(2).cast("bigint"))
    hits = third.where("change_kind <> 'unchanged'").collect()
    assert [(r.id, r.name, r.data_version, r.change_kind) for r in hits] == [(7, "new", 2, "changed")]


def test_reconcile_ignores_stale_rows(spark):
    t = spark.createDataFrame([(1, 5, "h5"), (2, 5, "h5")], "id int, at int, content_hash string")
    u = spark.createDataFrame([(1, 4, "h4"), (2, 6, "h6")], "id int, at int, content_hash string")
    out = changes.reconcile(t, u, "id", order=["at"])
    assert rows(out, "id", "at", "change_kind") == [(1, 5, "stale"), (2, 6, "changed")]


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, None), (1, 2, "b"), (2, 1, "c")], "k int, o int, v string")
    assert sorted(tuple(r) for r in changes.latest_per_key(df, ["k"], [F.col("o")]).collect()) == [(1, 3, None), (2, 1, "c")]


def test_split_rejects(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "id int, v string")
    good, bad = changes.split_rejects(df, {"id": F.col("id").isNotNull(), "v": F.col("v") == "a"})
    assert rows(good, "id") == [(1,)]
    assert sorted(tuple(r.reject_reasons) for r in bad.collect()) == [("id", "v"), ("v",)]


def test_merge_upsert_presence(spark):
    target = spark.createDataFrame(
        [(1, "a", (1, "x")), (2, "b", (2, "y")), (3, "c", None)], "id int, name string, place struct<n:int,s:string>"
    )
    updates = spark.createDataFrame(
        [(1, None, (None,), ["name"]), (2, "B", (None,), ["place", "place.n"]), (3, None, (9,), ["place", "place.n"]), (4, "d", None, ["name"])],
        "id int, name string, place struct<n:int>, _present array<string>",
    )
    out = merge.merge_upsert(target, updates, "id").orderBy("id").collect()
    assert [r.name for r in out] == [None, "b", "c", "d"]  # null overwrites, absent stays
    assert [r.place and tuple(r.place) for r in out] == [(1, "x"), (None, "y"), (9, None), None]
    assert rows(merge.update_existing(target, updates, "id"), "id") == [(1,), (2,), (3,)]
    plain = merge.merge_upsert(target, spark.createDataFrame([(1, "z")], "id int, name string"), "id")
    assert rows(plain.where("id = 1"), "name", "place.s") == [("z", "x")]


def test_replace_and_fill(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame([(2, None), (3, "c")], "id int, v string")
    assert sorted(tuple(r) for r in merge.replace_rows(base, new, "id").na.fill("-").collect()) == [(1, "a"), (2, "-"), (3, "c")]
    counts = spark.createDataFrame([(1, 5)], "id int, n bigint")
    filled = merge.fill_missing(spark.createDataFrame([(1, None), (2, None), (3, 7)], "id int, n bigint"), counts, "id", "n", 0)
    assert rows(filled, "id", "n") == [(1, 5), (2, 0), (3, 7)]


# ---------------------------------------------------------------- prices

def test_pivot_cases(spark):
    df = spark.createDataFrame(
        [
            (1, None, 2.0, 1.0, 1.5, 1.2, "Normal", 0),
            (1, 0.5, 3.0, 1.0, None, 1.2, "Foil", 1),
            (2, None, 2.0, 1.0, 1.0, 1.0, "Normal", 0),
            (2, None, 9.0, 1.0, 1.0, 1.0, "Normal", 1),
            (3, None, 2.0, 1.0, 1.0, 1.0, "Promo", 0),
        ],
        "product_id int, direct_low double, high double, low double, market double, mid double, sub_type_name string, position int",
    )
    out = {r.product_id: r for r in pivot.prices_in_cents(pivot.pivot_variants(df)).collect()}
    assert (out[1].normal.high, out[1].foil.high, out[1].foil.market, out[1].normal.direct_low, out[1].foil.direct_low) == (200, 300, 0, None, 50)
    assert out[2].normal.high == 900 and out[2].foil is None
    assert out[3].normal is None and out[3].foil is None
    assert rows(pivot.valid_prices(pivot.pivot_variants(df)), "product_id") == [(1,), (2,)]


# ---------------------------------------------------------------- ordered windows

def hot_events(spark, n=3000):
    """Two thirds of the rows belong to one key."""
    return spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 < 2, F.lit(0)).otherwise(F.col("id") % 17).alias("k"),
        F.timestamp_seconds(F.lit(1_700_000_000) + (F.col("id") * 7919 % n) * 60).alias("ts"),
        (F.col("id") * 31 % 101).alias("v"),
    )


def test_numbering_equals_row_number(spark):
    from pyspark.sql import Window

    df = hot_events(spark)
    w = Window.partitionBy("k").orderBy("ts", "id")
    expected = rows(df.select("id", F.row_number().over(w).cast("bigint").alias("position")))
    got = numbering.number_rows(df, ["k"], [F.col("ts"), F.col("id")], F.date_trunc("hour", "ts"))
    assert rows(got, "id", "position") == expected


def test_rolling_mean_equals_plain_window_across_chunks(spark):
    from pyspark.sql import Window

    df = hot_events(spark)
    w = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(-9, 0)
    expected = rows(df.select("id", F.sum("v").over(w).alias("s"), F.count("v").over(w).alias("n")))
    got = history.rolling_mean(df, ["k"], [F.col("ts"), F.col("id")], F.date_trunc("hour", F.col("ts")), "v", chunk=50)
    assert rows(got, "id", "rolling_sum", "rolling_n") == expected


def test_as_of_join_equals_brute_force(spark):
    df = hot_events(spark, 600)
    facts = df.where("v % 4 = 0").select("k", "ts", F.col("id").alias("fid"), F.col("v").alias("fv"))
    probes = df.where("v % 4 > 0").select("id", "k", "ts")
    got = rows(history.as_of_join(probes, facts, ["k"], "ts", "fid", ["fid", "fv"], "hour").na.fill(-1), "id", "fid", "fv")
    f = [tuple(r) for r in facts.collect()]
    expected = []
    for r in probes.collect():
        hits = [x for x in f if x[0] == r.k and x[1] <= r.ts]
        best = max(hits, key=lambda x: (x[1], x[2])) if hits else None
        expected.append((r.id, best[2], best[3]) if best else (r.id, -1, -1))
    assert got == sorted(expected)


def test_sampled_slices_spread_one_key_one_day_one_letter(spark):
    from pyspark.sql import Window

    df = spark.range(3000).select(
        "id", F.lit(1).alias("k"), F.timestamp_seconds(F.lit(1_700_006_400) + F.col("id") * 7919 % 3000 / 10).alias("ts"), (F.col("id") % 101).alias("v")
    )
    order = [F.col("ts"), F.col("id")]
    sliced = numbering.sampled_slices(df, ["k"], order, 100)
    sizes = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
    assert len(sizes) >= 25 and max(sizes) < 400
    w = Window.partitionBy("k").orderBy("ts", "id")
    expected = rows(df.select("id", F.row_number().over(w).cast("bigint").alias("position")))
    assert rows(numbering.number_rows(df, ["k"], order, slice_rows=100), "id", "position") == expected

    facts = df.where("v % 4 = 0").select("k", "ts", F.col("id").alias("fid"))
    probes = df.where("v % 4 > 0").select("id", "k", "ts")
    got = rows(history.as_of_join(probes, facts, ["k"], "ts", "fid", ["fid"], slice_rows=100), "id", "fid")
    best = probes.join(facts.withColumnRenamed("ts", "t"), "k").where("t <= ts").groupBy("id").agg(F.max_by("fid", "t").alias("fid"))
    assert got == rows(probes.select("id").join(best, "id", "left"), "id", "fid")

    words = spark.range(3000).select(F.lit("f").alias("field"), F.format_string("a%05d", (F.col("id") * 7) % 3000).alias("value"), F.lit(None).cast("double").alias("number"))
    placed = rows(facets.ordered_facets(words, 100), "value", "position")
    assert placed == [(f"a{i:05d}", i + 1) for i in range(3000)]


def test_as_of_join_without_key_or_time(spark):
    at = dt.datetime(2024, 1, 2)
    probes = spark.createDataFrame([(1, 7, at), (2, 7, None), (3, None, at)], "id int, k int, ts timestamp")
    facts = spark.createDataFrame([(7, None, 1), (None, at, 2), (7, at, 3)], "k int, ts timestamp, fid int")
    for unit in (None, "day"):
        got = history.as_of_join(probes, facts, ["k"], "ts", "fid", ["fid"], unit)
        assert rows(got.na.fill(-1, ["fid"]), "id", "fid") == [(1, 3), (2, -1), (3, -1)]
    assert history.as_of_join(probes.limit(0), facts, ["k"], "ts", "fid", ["fid"]).count() == 0
    assert rows(history.as_of_join(probes, facts.limit(0), ["k"], "ts", "fid", ["fid"]), "id") == [(1,), (2,), (3,)]


def test_facet_pages_follow_content(spark):
    def ordered(n, *more):
        names = [f"v{i:06d}" for i in range(n)] + list(more)
        df = spark.createDataFrame([("f", v, None) for v in names], "field string, value string, number double")
        return facets.ordered_facets(df, 5000)

    before = ordered(30_000)
    pages = {r.page: list(r["values"]) for r in facets.content_pages(before, 1000).collect()}
    assert len(pages) > 10 and sorted(v for p in pages.values() for v in p) == [f"v{i:06d}" for i in range(30_000)]
    for new in ("a", "v000500x", "v014000x"):
        after = ordered(30_000, new)
        judged = facets.facet_changes(facets.content_pages(after, 1000), facets.content_pages(before, 1000))
        assert 1 <= judged.where("updated").count() <= 2
    field = facets.facet_fields(before, 1000).first()
    assert [pages[p][0] for p in field.pages] == sorted(v[0] for v in pages.values()) and field.n_values == 30_000
    assert field.hash != facets.facet_fields(after, 1000).first().hash
    sizes = [[len(r["values"]) for r in facets.content_pages(ordered(n), 1_000_000).collect()] for n in (9_999, 10_001)]
    assert sizes == [[9_999], [10_001]]


def test_change_percent(spark):
    df = spark.createDataFrame([(1, 1, 100), (1, 2, 150), (1, 3, 0), (1, 4, 10)], "p int, d int, v int")
    assert rows(history.change_percent(df, "p", "d", "v").na.fill(-9), "d", "change_bp") == [(1, -9), (2, 5000), (3, -10000), (4, -9)]


def test_history(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 9)), (3, None)], "id int, t timestamp")
    assert rows(history.retained(df, "t", dt.datetime(2024, 1, 5)), "id") == [(2,), (3,)]
    assert rows(history.purge_counts(df, "t", dt.datetime(2024, 1, 5))) == [(1, 2)]
    assert history.emptied(df).count() == 0 and history.emptied(df).schema == df.schema
    left, counts = history.drop_column(df, "t")
    assert left.columns == ["id"] and rows(counts) == [(3, 2)]
    state = spark.createDataFrame([("failed",), ("completed",)], "sync_status string")
    assert rows(history.reset_state(state)) == [("completed",), ("ready",)]
    assert history.clear_hashes(state, "sync_status").where("sync_status is null").count() == 2
    assert rows(history.restore(df, ["id"], "t", dt.datetime(2024, 1, 2), [F.col("id")]), "id") == [(1,)]


# ---------------------------------------------------------------- facets and search

def test_facets(spark):
    df = spark.createDataFrame(
        [("B", 10.0, ["x", None], "VII·dff"), ("a", 9.0, ["y"], "VII"), ("b", None, None, None), ("é", 2.5, [], "")],
        "t string, n double, arr array<string>, lab string",
    )
    values = facets.facet_values(df, {"t": "scalar", "n": "number", "arr": "array", "lab": "labels"})
    docs = {r["field"]: list(r["values"]) for r in facets.facet_documents(facets.ordered_facets(values)).collect()}
    assert docs == {"t": ["a", "b", "B", "é"], "n": ["2.5", "9", "10"], "arr": ["x", "y"], "lab": ["dff", "VII"]}
    paged = facets.facet_documents(facets.ordered_facets(values), page_size=3)
    assert sorted((r["field"], r["page"], len(r["values"])) for r in paged.collect() if r["field"] == "t") == [("t", 0, 3), ("t", 1, 1)]
    stored = facets.facet_documents(facets.ordered_facets(values))
    judged = facets.facet_changes(stored, stored.withColumn("hash", F.when(F.col("field") == "t", "old").otherwise(F.col("hash"))))
    assert {r["field"] for r in judged.where("updated").collect()} == {"t"}


def test_ordered_sets(spark):
    groups = spark.createDataFrame(
        [("Core 2", dt.datetime(2020, 1, 1)), ("Core 1", dt.datetime(2019, 1, 1)), ("Deck X", dt.datetime(2018, 1, 1)), ("No date", None)],
        "name string, published_on timestamp",
    )
    values = spark.createDataFrame([("Deck X",), ("Core 1",), ("Core 2",), ("No date",), ("Unknown",)], "value string")
    out = [r[0] for r in facets.ordered_sets(values, groups, "value", "name", "published_on").collect()]
    assert out == ["Core 1", "Core 2", "Deck X"]
    placed = facets.set_positions(values, groups).orderBy("position").collect()
    assert [(r.value, r.position) for r in placed] == [("Core 1", 1), ("Core 2", 2), ("Deck X", 3)]


def test_search(spark):
    cards = spark.createDataFrame(
        [(1, "Cloud", ["1-001C"], False), (2, None, ["Re-004C"], True), (3, None, ["1-002C"], False), (4, "Tifa", None, False)],
        "id int, clean_name string, card_numbers array<string>, is_non_card boolean",
    )
    listed = search.with_terms(cards)
    assert rows(listed, "id") == [(1,), (2,)]
    index = search.inverted_index(listed, "id")
    assert rows(search.search_index(index, " CLO ", "id")) == [(1,)]
    assert rows(search.search(listed, "re-004c", "id", exact=True), "id") == [(2,)]
    fresh = search.refresh_terms(cards, "id", listed.select("id", "search_hash", F.when(F.col("id") > 1, F.col("search_terms")).alias("search_terms")))
    assert rows(fresh, "id", "change_kind") == [(1, "unstamped"), (2, "unchanged")]
    assert rows(search.term_counts(index).where("term = '1-'")) == [("1-", 1)]


# ---------------------------------------------------------------- keys, runs, quality, select

def test_keys(spark):
    a = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    assert rows(keys.key_difference(a, b, "k"), "k", "side") == [(1, "left"), (3, "right")]
    assert rows(keys.orphans(a, b, "k")) == [(1,)]
    assert rows(keys.child_counts(b, a, "k", "k")) == [(2, 2), (3, 0)]
    assert rows(keys.group_totals(b, "k", x=a, y=b)) == [(2, 2, 1), (3, 0, 1)]
    users = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k int, mail string")
    wanted = spark.createDataFrame([("y",), ("z",), ("q",)], "mail string")
    assert rows(keys.insert_absent(b.where("k = 3"), users, wanted, "mail", "k"), "k") == [(2,)]


def test_runs(spark):
    t = dt.datetime
    r = spark.createDataFrame(
        [("a", 1, "completed", t(2024, 1, 1), 10, 100, 1), ("b", 2, "failed", t(2024, 1, 2), 4000, 10, 1), ("c", 2, "completed", t(2024, 1, 3), 21, 100, 6)],
        "run_id string, version bigint, sync_status string, sync_start timestamp, sync_duration bigint, items_processed bigint, n_errors bigint",
    )
    assert runs.current_run(r).first().run_id == "c"
    assert runs.next_version(r).first()[0] == 3 and runs.next_version(r.where("false")).first()[0] == 1
    assert rows(runs.run_health(r)) == [(3, 2, 16, 2)]
    assert rows(runs.alerts(r), "run_id", "duration_alert", "error_band") == [("a", False, "OK"), ("b", True, "CRITICAL"), ("c", False, "WARNING")]
    e = spark.createDataFrame([("a", ["x", "y"])], "run_id string, errors array<string>")
    with_errors = r.withColumn("sync_errors", F.array(F.lit("x")))
    assert sorted((x.run_id, tuple(x.sync_errors)) for x in runs.add_errors(with_errors, e).collect())[0] == ("a", ("x", "y"))
    steps = spark.createDataFrame([("a", "s1", 1), ("a", "s2", 2), ("b", "s1", 3)], "run_id string, step string, n int")
    assert rows(runs.run_summary(steps, ["s1", "s2"]).select("run_id", "s1.n", F.coalesce("s2.n", F.lit(0)))) == [("a", 1, 2), ("b", 3, 0)]
    classified = spark.createDataFrame([("new",), ("unchanged",), ("changed",)], "change_kind string")
    assert rows(runs.run_counters(classified, classified.limit(2))) == [(5, 2, 2)]


def test_quality(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, None)], "product_id int, name string, last_updated timestamp")
    assert rows(quality.validation_report(df, quality.card_rules())) == [(2, 0, 0, 1, 2)]
    assert rows(quality.validation_errors(df, quality.card_rules(), "product_id")) == [(1, "last_updated"), (2, "last_updated"), (2, "name")]
    urls_ = spark.createDataFrame(
        [("https://x/1/2_200w.jpg", "https://x/1/2_400w.jpg", False), ("https://y/no.jpg", "https://y/no.jpg", True)],
        "low_res_url string, high_res_url string, is_placeholder boolean",
    )
    assert rows(quality.validation_report(urls_, quality.image_rules("https://x/"))) == [(2, 1, 1, 1)]
    counters = spark.createDataFrame([(3, 0)], "items_updated bigint, n_errors bigint")
    assert rows(quality.run_checks(counters), "has_updates", "has_errors") == [(True, False)]


def test_repairs(spark):
    df = spark.createDataFrame([(1, ["1-001C"], "Re-001C/1-001C"), (2, ["Re-002C"], "Re-002C"), (3, None, "1-003C")], "id int, card_numbers array<string>, full_card_number string")
    assert [(r.id, list(r.card_numbers)) for r in repair.code_repairs(df, "id").collect()] == [(1, ["1-001C", "Re-001C"])]


def test_field_rules(spark):
    left = spark.createDataFrame([(1, "a", ["x", "y"], None), (2, " ", ["x"], 1)], "id int, s string, arr array<string>, n int")
    right = spark.createDataFrame([(1, None, ["Y ", "X"], 5), (2, "b", ["z"], 6)], "id int, s string, arr array<string>, n int")

    def merged(**rules):
        out = enrich.merge_by_rules(left, right, "id", rules).orderBy("id").collect()
        return [(r.s, r.arr, r.n, r.changed_fields) for r in out]

    assert merged(s="overwrite", arr="overwrite", n="overwrite") == [(None, ["x", "y"], 5, ["s", "n"]), ("b", ["z"], 6, ["s", "arr", "n"])]
    assert merged(s="prefer_source", arr="keep", n="fill_empty") == [("a", ["x", "y"], 5, ["n"]), ("b", ["x"], 1, ["s"])]
    assert merged(s="fill_empty") == [("a", ["x", "y"], None, []), ("b", ["x"], 1, ["s"])]


def test_pushdown_and_pruning(spark):
    df = select.with_prefix(spark.read.parquet("/root/testdata/sf0.001/part.parquet"), "p_brand", "Brand#1").select("p_partkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(p_brand,Brand#1)" in plan and "p_retailprice" not in plan
    hot = select.limit_per_group(hot_events(spark), "k", [F.col("id")], 2)
    assert "WindowGroupLimit" in hot._jdf.queryExecution().executedPlan().toString()
