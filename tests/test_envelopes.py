"""Envelopes read by many tasks, against a JSON parser."""

import json
import random

import pytest
from pyspark.sql import functions as F

from shelfmark.schemas import PRICE_RESULT, SOURCE_CARD
from shelfmark.sources import envelopes, feeds


@pytest.fixture
def small_splits(spark):
    """Splits of a few hundred bytes, so that they run through elements."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "700")
    spark.conf.set(names[1], "1")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def record(rng, i):
    name = "".join(rng.choice('ab{}[]"\\,: é漢\n') for _ in range(rng.randint(0, 30)))
    return {"productId": i, "lowPrice": i / 4, "marketPrice": None, "subTypeName": name, "other": {"deep": [{"x": "}"}, {}]}}


def rows_of(feed):
    return {(r.source_file.rsplit("/", 1)[1], r.position): (r.r.productId, r.r.subTypeName) for r in feed.where("r IS NOT NULL").collect()}


def test_as_a_parser(spark, tmp_path, small_splits):
    rng = random.Random(3)
    want = {}
    for k, style in enumerate([{}, {"indent": 2}, {"ensure_ascii": False}, {"separators": (",", ":")}]):
        records = [record(rng, 1000 * k + i) for i in range(60)]
        envelope = {"meta": {"a": {"b": 1}}, "note": 'a "{" in a string', "errors": [{"productId": -1}], "results": records, "after": [{"productId": -2}], "end": True}
        (tmp_path / f"f{k}.json").write_text(json.dumps(envelope, **style) + ("\n" if k % 2 else ""), encoding="utf-8")
        want |= {(f"f{k}.json", i): (r["productId"], r["subTypeName"]) for i, r in enumerate(records)}
    feed = feeds.read_feed(spark, str(tmp_path), PRICE_RESULT, layout=feeds.SPLIT)
    assert rows_of(feed) == want
    assert feed.count() == len(want) and feed.where("corrupt IS NOT NULL").count() == 0
    assert rows_of(feeds.read_feed(spark, str(tmp_path), PRICE_RESULT)) == want
    assert envelopes.fragments(spark, str(tmp_path)).select("source_file", "block").distinct().count() > 40


def test_broken_and_empty_envelopes(spark, tmp_path, small_splits):
    texts = {
        "cut": '{"results": [{"productId": 1}, {"productId": 2}]', "open": '{"results": [{"productId": 1, "subTypeName": "x}]}',
        "none": '{"other": [{"productId": 1}]}', "empty": '{"results": []}', "blank": '{"results":[{}]} \n ',
        "bad": '{"results": [{"productId": 1}, {"productId": nonsense}, {"productId": 3}]}',
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    found = {}
    for r in feeds.read_feed(spark, str(tmp_path), PRICE_RESULT, layout=feeds.SPLIT).collect():
        found.setdefault(r.source_file.rsplit("/", 1)[1], []).append((r.position, r.r and r.r.productId, r.corrupt is not None))
    assert {k: sorted(v, key=str) for k, v in found.items()} == {
        "cut": [(None, None, True)], "open": [(None, None, True)], "none": [(None, None, False)], "empty": [(None, None, False)],
        "blank": [(0, None, False)], "bad": [(0, 1, False), (1, None, True), (2, 3, False)],
    }


def test_second_source_needs_its_cards(spark, tmp_path):
    (tmp_path / "a").write_text('{"cards": [{"id": "1", "code": "1-001H"}]}')
    assert [r.code for r in feeds.source_cards(spark, str(tmp_path), feeds.SPLIT).collect()] == ["1-001H"]
    (tmp_path / "b").write_text('{"something": 1}')
    with pytest.raises(Exception, match="no readable cards array"):
        feeds.source_cards(spark, str(tmp_path), feeds.SPLIT).collect()
    assert SOURCE_CARD.names and F


def test_running_sums_are_worked_out_once(spark, tmp_path):
    """They are staged: a feed that is read several times does not repeat them, and they carry no text."""
    (tmp_path / "a").write_text('{"results": [{"productId": 1, "subTypeName": "a}{"}, {"productId": 2}]}')
    feed = feeds.read_feed(spark, str(tmp_path), PRICE_RESULT, layout=feeds.SPLIT)
    assert "Window" not in feed._jdf.queryExecution().optimizedPlan().toString()
    assert "text" not in envelopes.numbered(envelopes.fragments(spark, str(tmp_path))).columns
    assert sorted(r.position for r in feed.collect()) == [0, 1]
