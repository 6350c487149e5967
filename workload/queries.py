"""Registered queries: each runs one operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfmark import session
from shelfmark.functions import (
    arrays, attributes, codes, elements, fingerprints, labels, names, prices, terms, text, texts, urls,
)
from shelfmark.operators import (
    changes, enrich, facets, history, keys, match, merge, pivot, quality, repair, runs, search, select,
)
from shelfmark.plans import catalogue as plan
from shelfmark.sources import envelopes, feeds, images, tables
from shelfmark.streaming import ingest

from . import derive
from .derive import POLICY, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _big(name: str):
    return F.col(name).cast("bigint").alias(name)


def _at(day: str):
    """A point in time without a zone, like the time columns of the tables: the filter is pushed down."""
    return F.lit(day).cast("timestamp_ntz")


def _joined(col, sep: str = "|"):
    return F.array_join(col, sep)


# ---------------------------------------------------------------- scans, filters, order


@query
def column_scan(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")


@query
def point_lookup(spark, sf):
    return select.by_key(table(spark, sf, "orders"), "o_orderkey", 77).select("o_orderkey", "o_custkey", "o_orderstatus")


@query
def row_count(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def equality_filter(spark, sf):
    df = select.by_key(table(spark, sf, "orders"), "o_orderstatus", "F")
    return df.select("o_orderkey", "o_orderpriority")


@query
def older_rows(spark, sf):
    return select.older_than(table(spark, sf, "orders"), "o_orderdate", _at("1996-06-01")).select("o_orderkey")


@query
def prefix_filter(spark, sf):
    return select.with_prefix(table(spark, sf, "part"), "p_brand", "Brand#1").select("p_partkey", "p_brand")


@query
def substring_filter(spark, sf):
    return select.containing(table(spark, sf, "part"), "p_name", "RED").select("p_partkey", "p_name")


@query
def present_filter(spark, sf):
    return select.present(derive.catalogue(spark, sf), "number_text", "card_type").select("product_id", "number_text")


@query
def window_filter(spark, sf):
    df = select.in_window(
        table(spark, sf, "events"), "ts", _at("2024-01-02"), _at("2024-01-20"), event_type="error"
    )
    return df.select("event_id", "user_id")


@query
def page_after(spark, sf):
    return select.page_after(table(spark, sf, "customer"), "c_custkey", 70, 25).select("c_custkey", "c_name")


@query
def top_groups(spark, sf):
    return select.top(table(spark, sf, "orders"), 10, F.col("o_orderkey").desc()).select("o_orderkey", "o_custkey")


@query
def limit_per_group(spark, sf):
    df = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    return select.limit_per_group(df, "o_custkey", [F.col("o_orderkey")], 3)


@query
def newest_first(spark, sf):
    df = select.newest_first(table(spark, sf, "events"), "ts", "event_id", 20, event_type="error")
    return df.select("event_id", "user_id")


@query
def index_order(spark, sf):
    df = table(spark, sf, "part").select("p_name", "p_size", "p_partkey")
    return select.index_order(df, "p_name", "p_size")


# ---------------------------------------------------------------- column rules


@query
def attribute_lookup(spark, sf):
    attrs = F.array(
        F.struct(
            F.lit("k").alias("name"), F.lit("k").alias("display_name"), F.get_json_object("props", "$.k").alias("value")
        )
    )
    value = attributes.attribute(attrs, "k")
    return table(spark, sf, "events").select(
        "event_id", value.alias("k_text"), text.parse_number(value).cast("bigint").alias("k_number")
    )


@query
def number_parse(spark, sf):
    df = derive.catalogue(spark, sf)
    return df.select(
        "product_id",
        text.parse_number(F.col("cost_text")).cast("bigint").alias("cost"),
        text.parse_integer(F.col("power_text")).alias("power"),
    )


@query
def cents_normalize(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        _big("l_linenumber"),
        text.cents(F.col("l_extendedprice")).alias("price_cents"),
        text.cents(F.col("l_discount")).alias("discount_cents"),
        text.cents(-F.col("l_tax")).alias("negative_cents"),
    )


@query
def code_normalize(spark, sf):
    df = derive.products(spark, sf).select("product_id", codes.row_codes(F.col("extended_data")).alias("c"))
    return df.select(
        "product_id",
        _joined(F.col("c")).alias("codes"),
        codes.primary_code(F.col("c")).alias("primary_code"),
        codes.full_code(F.col("c")).alias("full_code"),
        codes.is_promo(F.col("c")).alias("is_promo"),
    )


@query
def code_compare(spark, sf):
    part = table(spark, sf, "part").select(
        F.lit("part").alias("origin"), F.col("p_partkey").alias("id"), F.col("p_brand").alias("v")
    )
    customer = table(spark, sf, "customer").select(F.lit("customer"), "c_custkey", "c_name")
    catalogue = derive.catalogue(spark, sf).select(F.lit("catalogue"), "product_id", "number_text")
    df = part.unionAll(customer).unionAll(catalogue)
    return df.select("origin", "id", codes.comparison_form(F.col("v")).alias("form"), codes.loose_code(F.col("v")).alias("loose"))


@query
def label_normalize(spark, sf):
    part = table(spark, sf, "part").select(
        F.lit("part").alias("origin"), F.col("p_partkey").alias("id"), F.col("p_type").alias("v")
    )
    customer = table(spark, sf, "customer").select(F.lit("customer"), "c_custkey", "c_mktsegment")
    region = table(spark, sf, "region").select(F.lit("region"), F.col("r_regionkey").cast("bigint"), "r_name")
    df = part.unionAll(customer).unionAll(region)
    return df.select(
        "origin", "id",
        labels.normalise_label(F.col("v")).alias("wide"), labels.normalise_label(F.col("v"), "narrow").alias("narrow"),
    )


@query
def list_normalize(spark, sf):
    df = derive.catalogue(spark, sf).select("product_id", labels.categories(F.col("category")).alias("c"))
    return df.select(
        "product_id", labels.join_labels(F.col("c")).alias("category"), F.size("c").cast("bigint").alias("n_categories")
    )


@query
def category_merge(spark, sf):
    df = derive.source_cards(spark, sf)
    return df.select("row_id", _joined(labels.merged_categories(F.col("category_1"), F.col("category_2"))).alias("categories"))


@query
def search_names(spark, sf):
    return derive.catalogue(spark, sf).select("product_id", names.search_name(F.col("raw_name")).alias("clean_name"))


@query
def display_names(spark, sf):
    df = derive.catalogue(spark, sf)
    promo_codes = F.when(F.col("product_id") % 9 == 1, F.array(F.lit("PR-001")))
    return df.select("product_id", names.display_name(F.col("raw_name"), promo_codes).alias("name"))


@query
def name_repair(spark, sf):
    return repair.name_repairs(derive.catalogue(spark, sf), "product_id", "raw_name").select("product_id", "raw_name")


@query
def text_rules(spark, sf):
    ruled = texts.rules_text(F.col("text"))
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(ruled).alias("ruled_md5"), F.length(ruled).cast("bigint").alias("ruled_length")
    )


@query
def text_translate(spark, sf):
    df = derive.catalogue(spark, sf)
    return df.select("product_id", texts.translated_text(F.col("description")).alias("description"))


@query
def text_precedence(spark, sf):
    own = derive.catalogue(spark, sf).select("product_id", "description")
    other = derive.source_cards(spark, sf).select("row_id", "text")
    df = own.join(other, F.col("product_id") == F.col("row_id"))
    return df.select(
        "product_id",
        texts.preferred_text(F.col("description"), F.col("text")).alias("description"),
        texts.shrink_level(texts.translated_text(F.col("text")), F.col("text")).alias("level"),
    )


@query
def dictionary_translate(spark, sf):
    statuses = {"O": "Open", "F": "Filled"}
    df = table(spark, sf, "orders")
    translated = elements.translate_all(F.array("o_orderstatus", F.lit("F")), statuses)
    return df.select(
        "o_orderkey",
        elements.translate_value(F.col("o_orderstatus"), statuses).alias("status"),
        _joined(translated).alias("statuses"),
    )


@query
def rarity_labels(spark, sf):
    df = derive.catalogue(spark, sf)
    return df.select("product_id", elements.rarity_label(F.col("rarity"), F.col("product_id") % 9 == 1).alias("rarity"))


@query
def element_rules(spark, sf):
    a = F.col("extended_data")
    kind, number, element = (attributes.attribute(a, n) for n in ("CardType", "Number", "Element"))
    return derive.products(spark, sf).select(
        "product_id",
        _joined(elements.row_elements(kind, number, element)).alias("elements"),
        elements.row_type(kind, number).alias("card_type"),
        elements.is_non_card(kind, a).alias("is_non_card"),
    )


@query
def source_element_rules(spark, sf):
    df = derive.source_cards(spark, sf)
    return df.select(
        "row_id",
        _joined(elements.source_elements(F.col("type"), F.col("code"), F.col("element"))).alias("elements"),
        elements.source_type(F.col("type"), F.col("code")).alias("card_type"),
        elements.source_job(F.col("type"), F.col("job")).alias("job"),
    )


@query
def url_variants(spark, sf):
    pages = table(spark, sf, "pages").select(F.lit("page").alias("origin"), F.col("page_id").alias("id"), "url")
    images = derive.catalogue(spark, sf).select(F.lit("image"), "product_id", F.col("image_url"))
    df = pages.unionAll(images).withColumn("v", urls.url_variants(F.col("url"), POLICY))
    df = df.withColumn("r", urls.image_record(F.col("url"), POLICY))
    return df.select(
        "origin", "id",
        urls.is_valid_image_url(F.col("url"), POLICY).alias("valid"),
        F.col("v.full").alias("full_url"), F.col("v.high").alias("high_url"), F.col("v.low").alias("low_url"),
        F.col("r.full_res_url").alias("full_res_url"), F.col("r.low_res_url").alias("low_res_url"),
        F.col("r.metadata.error_message").alias("reason"),
    )


@query
def image_paths(spark, sf):
    return derive.catalogue(spark, sf).select(
        "product_id",
        *[urls.image_path(F.col("group_id"), F.col("product_id"), r, POLICY).alias(f"{r}_path") for r in urls.RESOLUTIONS],
    )


@query
def composite_key_roundtrip(spark, sf):
    pairs = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey").distinct()
    code = F.concat(F.col("l_partkey").cast("string"), F.lit("/"), F.col("l_suppkey").cast("string"))
    sets = F.when(F.col("l_partkey") % 3 > 0, F.array(F.concat(F.lit("Set #"), (F.col("l_suppkey") % 7).cast("string"))))
    keyed = pairs.withColumn("doc_id", codes.composite_key(code, sets))
    return keyed.select("l_partkey", "l_suppkey", "doc_id", codes.code_of_key(F.col("doc_id")).alias("code"))


@query
def code_repair(spark, sf):
    df = derive.products(spark, sf).select("product_id", codes.row_codes(F.col("extended_data")).alias("c"))
    stored = df.select("product_id", codes.full_code(F.col("c")).alias("full_card_number"),
                       F.filter("c", lambda x: ~x.startswith("Re-")).alias("card_numbers"))
    fixed = repair.code_repairs(stored, "product_id")
    return fixed.select("product_id", _joined(F.col("card_numbers")).alias("card_numbers"))


@query
def code_validity(spark, sf):
    df = derive.catalogue(spark, sf)
    return df.select(
        "product_id",
        codes.normalise_code(F.col("number_text")).alias("code"),
        codes.is_valid_code(F.col("number_text")).alias("is_valid"),
        codes.is_valid_source_code(F.col("number_text")).alias("is_valid_source"),
        codes.code_stem(F.col("number_text")).alias("stem"),
    )


@query
def special_names(spark, sf):
    return derive.catalogue(spark, sf).select("product_id", names.has_special_remark(F.col("raw_name")).alias("is_special"))


@query
def array_rules(spark, sf):
    df = table(spark, sf, "part").select(
        "p_partkey", F.split("p_name", " ").alias("a"), F.array(F.upper("p_type"), F.lit("ring"), F.lit("red")).alias("b")
    )
    a, b = F.col("a"), F.col("b")
    return df.select(
        "p_partkey",
        _joined(arrays.ordered_union(a, b)).alias("ordered"),
        _joined(arrays.sorted_union(a, b)).alias("sorted"),
        arrays.overlaps(a, b).alias("overlap"),
        arrays.same_members(a, F.array(F.element_at(a, 2), F.upper(F.element_at(a, 1)))).alias("same"),
        _joined(arrays.append_unique(a, F.lit("bolt"))).alias("appended"),
    )


@query
def first_rows(spark, sf):
    return select.sample_first(table(spark, sf, "supplier"), "s_suppkey", 10).select("s_suppkey", "s_name")


# ---------------------------------------------------------------- prices


def _price_rows(spark, sf) -> DataFrame:
    flag = F.col("l_returnflag")
    return table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("product_id"),
        F.when(F.col("l_linenumber") % 2 == 0, F.col("l_discount")).alias("direct_low"),
        F.col("l_extendedprice").alias("high"),
        F.col("l_quantity").alias("low"),
        F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice") - F.col("l_quantity")).alias("market"),
        F.col("l_tax").alias("mid"),
        F.when(flag == "N", "Normal").when(flag == "R", "Foil").otherwise("Promo").alias("sub_type_name"),
        "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity",
    )


PRICE_ORDER = ["l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity"]


def _pivoted(spark, sf) -> DataFrame:
    rows = pivot.pivot_variants(_price_rows(spark, sf), order=[F.col(c) for c in PRICE_ORDER])
    return pivot.prices_in_cents(rows)


@query
def variant_pivot(spark, sf):
    flat = [
        F.col(f"{v}.{f}").alias(f"{v}_{f}") for v in ("normal", "foil") for f in prices.PRICE_FIELDS
    ]
    valid = prices.has_variant(F.col("normal"), F.col("foil"))
    return _pivoted(spark, sf).select("product_id", *flat, valid.alias("is_valid"))


@query
def price_hash(spark, sf):
    return pivot.valid_prices(_pivoted(spark, sf)).select("product_id", fingerprints.price_fingerprint().alias("content_hash"))


@query
def price_change_pct(spark, sf):
    monthly = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_partkey").alias("product_id"), F.date_trunc("month", "l_shipdate").alias("month"))
        .agg(
            F.floor(
                F.sum(text.cents(F.col("l_extendedprice"))) / F.sum(F.col("l_quantity").cast("bigint"))
            ).cast("bigint").alias("market")
        )
    )
    out = history.change_percent(monthly, "product_id", "month", "market")
    return out.select("product_id", F.date_format("month", "yyyy-MM").alias("month"), "market", "previous", "change_bp")


# ---------------------------------------------------------------- change detection and merging


def _order_content(df: DataFrame):
    return fingerprints.fingerprint(
        [
            F.col("o_custkey"),
            F.col("o_orderstatus"),
            text.cents(F.col("o_totalprice")).alias("total_cents"),
            F.col("o_orderpriority"),
        ]
    )


def _orders_hashed(spark, sf) -> DataFrame:
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return df.withColumn("content_hash", _order_content(df))


def _orders_stored(spark, sf) -> DataFrame:
    """An earlier state: every 5th order unknown, every 7th different, every 11th without a version."""
    k = F.col("o_orderkey")
    old = _orders_hashed(spark, sf).where(k % 5 != 0)
    old = old.withColumn("content_hash", F.when(k % 7 == 0, F.md5("content_hash")).otherwise(F.col("content_hash")))
    old = old.withColumn("o_orderpriority", F.when(k % 7 == 0, F.lit("OLD")).otherwise(F.col("o_orderpriority")))
    return old.withColumn("data_version", F.when(k % 11 != 0, F.lit(3).cast("bigint")))


@query
def content_hash(spark, sf):
    nation = table(spark, sf, "nation").select(
        F.lit("nation").alias("origin"), F.col("n_nationkey").cast("bigint").alias("id"),
        fingerprints.fingerprint([F.col("n_nationkey").alias("groupId"), F.col("n_name").alias("modifiedOn")]).alias("content_hash"),
    )
    return nation.unionAll(_orders_hashed(spark, sf).select(F.lit("orders"), "o_orderkey", "content_hash"))


@query
def record_hash(spark, sf):
    df = table(spark, sf, "customer").select("c_name", "c_custkey", "c_mktsegment", "c_nationkey")
    return df.select("c_custkey", fingerprints.record_fingerprint(df).alias("content_hash"))


@query
def source_hash(spark, sf):
    df = derive.source_cards(spark, sf)
    hashed = fingerprints.source_fingerprint("type")
    matched = fingerprints.match_fingerprint(F.array(F.lit("Re-004C"), F.lit("1-001C")))
    return df.select("row_id", hashed.alias("content_hash"), matched.alias("match_hash"))


@query
def change_classify(spark, sf):
    out = changes.classify(_orders_hashed(spark, sf), _orders_stored(spark, sf), "o_orderkey", version_col="data_version")
    return out.select("o_orderkey", "change_kind")


@query
def force_classify(spark, sf):
    """A forced run: what is unchanged counts as forced."""
    out = changes.classify(
        _orders_hashed(spark, sf), _orders_stored(spark, sf), "o_orderkey", version_col="data_version", force=True
    )
    return out.select("o_orderkey", "change_kind")


@query
def write_stamp(spark, sf):
    """Rows to write carry version and time of the run."""
    judged = changes.classify(_orders_hashed(spark, sf), _orders_stored(spark, sf), "o_orderkey", version_col="data_version")
    out = merge.stamp(changes.to_write(judged), 4, datetime(2024, 5, 1, 12, 30, tzinfo=timezone.utc))
    return out.select("o_orderkey", "data_version", F.date_format("last_updated", "yyyy-MM-dd HH:mm").alias("written_at"))


@query
def run_counters(spark, sf):
    out = changes.classify(_orders_hashed(spark, sf), _orders_stored(spark, sf), "o_orderkey", version_col="data_version")
    return runs.run_counters(out, by="o_orderstatus")


@query
def reconcile(spark, sf):
    """The flagship: which rows changed since the last run, and what is the merged table."""
    # every 13th order is not in the feed any more and stays as stored
    feed = _orders_hashed(spark, sf).where(F.col("o_orderkey") % 13 != 0)
    merged = changes.reconcile(_orders_stored(spark, sf), feed, "o_orderkey", version=F.lit(4).cast("bigint"))
    return merged.select(
        "o_orderkey", "o_custkey", "o_orderstatus", text.cents(F.col("o_totalprice")).alias("total_cents"),
        "o_orderpriority", "content_hash", "data_version", "change_kind",
    )


@query
def reject_rows(spark, sf):
    df = derive.catalogue(spark, sf).select("product_id", "card_type", "number_text")
    rules = {"type": F.col("card_type").isNotNull(), "number": F.col("number_text").isNotNull()}
    good, bad = changes.split_rejects(df, rules)
    return good.select("product_id", F.lit("").alias("reasons")).unionAll(
        bad.select("product_id", _joined(F.col("reject_reasons")))
    )


def _customers(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey",
        "c_name",
        F.struct(
            F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").cast("bigint").alias("nation")
        ).alias("place"),
        text.cents(F.col("c_acctbal")).alias("balance"),
    )


def _customer_updates(spark, sf) -> DataFrame:
    """Every third customer again: a null balance, a changed segment, no nation; some new keys."""
    k = F.col("c_custkey")
    df = table(spark, sf, "customer").where(k % 3 == 0)
    n = F.when(k % 6 == 0, k).otherwise(-k - 1)
    return df.select(
        n.alias("c_custkey"),
        F.when(k % 9 != 0, F.lower("c_name")).alias("c_name"),
        F.struct(F.lower("c_mktsegment").alias("segment")).alias("place"),
        F.lit(None).cast("bigint").alias("balance"),
        F.when(k % 12 == 0, F.array(F.lit("c_name"))).otherwise(
            F.array(F.lit("c_name"), F.lit("place"), F.lit("place.segment"), F.lit("balance"))
        ).alias(merge.PRESENT),
    )


def _flat_customers(df: DataFrame) -> DataFrame:
    return df.select("c_custkey", "c_name", F.col("place.segment").alias("segment"), F.col("place.nation").alias("nation"), "balance")


@query
def upsert_merge(spark, sf):
    return _flat_customers(merge.merge_upsert(_customers(spark, sf), _customer_updates(spark, sf), "c_custkey"))


@query
def update_existing(spark, sf):
    return _flat_customers(merge.update_existing(_customers(spark, sf), _customer_updates(spark, sf), "c_custkey"))


@query
def replace_rows(spark, sf):
    rows = _customer_updates(spark, sf).select("c_custkey", "c_name", F.col("place.segment").alias("segment"))
    base = _flat_customers(_customers(spark, sf)).select("c_custkey", "c_name", "segment")
    return merge.replace_rows(base, rows, "c_custkey")


@query
def fill_missing(spark, sf):
    base = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 4 == 0, F.col("c_custkey")).alias("n_orders")
    )
    counts = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"))
    return merge.fill_missing(base, counts, "c_custkey", "n_orders", 0)


# ---------------------------------------------------------------- history


def _yearly(spark, sf) -> DataFrame:
    df = table(spark, sf, "orders")
    return df.select(
        F.col("o_custkey").alias("product_id"),
        (F.year("o_orderdate") * 10_000_000_000 + F.col("o_orderkey")).alias("data_version"),
        "o_orderkey", "o_orderstatus",
    )


@query
def delta_log(spark, sf):
    latest = history.latest_delta(history.delta_log(_yearly(spark, sf), "product_id"), "product_id")
    return latest.select(
        "product_id", "data_version", F.col("changes.o_orderkey").alias("o_orderkey"),
        F.col("changes.o_orderstatus").alias("o_orderstatus"),
    )


@query
def version_since(spark, sf):
    return history.version_since(_yearly(spark, sf), 1997 * 10_000_000_000 + 9_999_999_999).select("product_id", "data_version")


@query
def daily_snapshot(spark, sf):
    df = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", text.cents(F.col("value")).alias("cents"))
    out = history.daily_snapshot(df, ["user_id"], "ts", [F.col("ts"), F.col("event_id")])
    return out.select("user_id", F.date_format("snapshot_date", "yyyy-MM-dd").alias("day"), "event_id", "event_type", "cents")


@query
def retention_purge(spark, sf):
    return history.retained(table(spark, sf, "events"), "ts", _at("2024-01-15")).select("event_id", "event_type")


@query
def retention_counts(spark, sf):
    return history.purge_counts(table(spark, sf, "events"), "ts", _at("2024-01-15"), "event_type")


@query
def dropped_column(spark, sf):
    return history.drop_column(derive.catalogue(spark, sf), "element")[1]


@query
def state_reset(spark, sf):
    df = table(spark, sf, "events").select("event_id", "event_type")
    return history.reset_state(df, "event_type", "error", "ready")


@query
def latest_at_or_before(spark, sf):
    df = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type")
    out = history.latest_at(df, ["user_id"], "ts", _at("2024-01-10"), [F.col("event_id")])
    return out.select("user_id", "event_id", "event_type")


@query
def group_restore(spark, sf):
    """State of one kind of event at a point in time."""
    df = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type")
    out = history.restore(df, ["user_id"], "ts", _at("2024-01-10"), [F.col("event_id")], "event_type", "click")
    return out.select("user_id", "event_id")


@query
def as_of_join(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", text.cents(F.col("value")).alias("cents"))
    clicks = e.where(F.col("event_type") == "click").select("user_id", "event_id", "ts")
    errors = e.where(F.col("event_type") == "error").select("user_id", "ts", F.col("event_id").alias("error_id"), "cents")
    out = history.as_of_join(clicks, errors, ["user_id"], "ts", "error_id", ["error_id", "cents"])
    return out.select("event_id", "user_id", "error_id", "cents")


@query
def rolling_mean(spark, sf):
    df = table(spark, sf, "events").select("user_id", "event_id", "ts", text.cents(F.col("value")).alias("cents"))
    out = history.rolling_mean(df, ["user_id"], [F.col("ts"), F.col("event_id")], None, "cents")
    return out.select("event_id", "rolling_sum", "rolling_n")


# ---------------------------------------------------------------- matching


def _match_sides(spark, sf) -> tuple[DataFrame, DataFrame]:
    kept = ("set_name", "number_text", "card_type")
    rows = derive.products(spark, sf, *kept)
    left = rows.select("product_id", codes.row_codes(F.col("extended_data")).alias("c"), *kept).select(
        "product_id",
        codes.match_keys(
            F.col("c"), codes.full_code(F.col("c")), F.col("number_text"), codes.primary_code(F.col("c")),
            F.coalesce(F.col("card_type") == "Sealed Product", F.lit(False)),
        ).alias("keys"),
        F.when(F.col("set_name").isNotNull(), F.array("set_name"))
        .when(F.col("product_id") % 2 == 0, F.array().cast("array<string>")).alias("sets"),
        "number_text", "c",
    )
    right = derive.source_cards(spark, sf).select(
        "row_id", "doc_id", codes.source_match_keys(F.col("code")).alias("keys"), F.col("set").alias("sets"), "code"
    )
    return left, right


@query
def first_match_join(spark, sf):
    left, right = _match_sides(spark, sf)
    return match.first_match(left, right, "product_id", "keys", "sets", "row_id", "keys", "sets")


@query
def tiered_match(spark, sf):
    left, right = _match_sides(spark, sf)
    l = left.select("product_id", F.coalesce("c", F.array().cast("array<string>")).alias("exact"), F.col("keys").alias("loose"))
    r = right.select("row_id", F.col("code").alias("exact_code"), "keys")
    return match.tiered_match(l, r, "product_id", "exact", "loose", "row_id", "exact_code", "keys").select(
        "product_id", "row_id", F.col("tier").cast("bigint").alias("tier")
    )


@query
def scored_match(spark, sf):
    part = derive.spread(table(spark, sf, "part"))
    props = {"power": "p_size", "cost": "p_type", "job": "p_name", "rarity": "p_brand"}
    left = part.select(
        "p_partkey", F.array((F.col("p_partkey") % 97).cast("string")).alias("stems"),
        *[F.nullif(F.col(c).cast("string"), F.lit("SMALL")).alias(p) for p, c in props.items()],
    )
    right = part.select(
        F.col("p_partkey").alias("s_partkey"), (F.col("p_partkey") % 97).cast("string").alias("stem"),
        *[F.col(c).cast("string").alias(p) for p, c in props.items()],
    )
    out = match.scored_match(left, right, "p_partkey", "stems", "s_partkey", "stem", list(props))
    return out.select("p_partkey", "n_matches", "s_partkey")


@query
def key_set_difference(spark, sf):
    l = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    r = table(spark, sf, "orders").select((F.col("o_custkey") * 2).alias("k"))
    return keys.key_difference(l, r, "k")


@query
def orphan_check(spark, sf):
    """Parts that no line refers to by twice its number."""
    parents = table(spark, sf, "lineitem").select((F.col("l_partkey") * 2).alias("twice"))
    return keys.orphans(table(spark, sf, "part").select("p_partkey", "p_name"), parents, "p_partkey", "twice")


@query
def child_counts(spark, sf):
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    c = table(spark, sf, "customer").select((F.col("c_nationkey") * 2).alias("twice"))
    out = keys.child_counts(n, c, "n_nationkey", "twice", "n_customers")
    return out.select(_big("n_nationkey"), "n_name", "n_customers")


@query
def group_totals(spark, sf):
    n = table(spark, sf, "nation").select(_big("n_nationkey"))
    c = table(spark, sf, "customer").select(F.col("c_nationkey").cast("bigint").alias("n_nationkey"))
    s = table(spark, sf, "supplier").select(F.col("s_nationkey").cast("bigint").alias("n_nationkey"))
    return keys.group_totals(n, "n_nationkey", n_customers=c, n_suppliers=s)


@query
def backfill_count(spark, sf):
    base = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.lit(99).cast("bigint")).alias("n_orders")
    )
    orders = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"))
    return merge.fill_missing(base, orders, "c_custkey", "n_orders", 0)


@query
def insert_absent(spark, sf):
    users = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    wanted = table(spark, sf, "customer").where(F.col("c_acctbal") > 5000).select("c_name")
    target = table(spark, sf, "orders").where(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("c_custkey"))
    return keys.insert_absent(target, users, wanted, "c_name", "c_custkey").select("c_custkey", "c_name")


@query
def attach_parent(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", (F.col("c_nationkey") + 3).cast("bigint").alias("group_id"))
    out = keys.attach_parent_name(c, derive.groups(spark, sf), "group_id", "name")
    return out.select("c_custkey", _joined(F.col("set")).alias("set"))


# ---------------------------------------------------------------- enrichment


@query
def field_priority_merge(spark, sf):
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    left = c.select(
        "c_custkey", F.when(k % 4 > 0, F.col("c_name")).alias("name"), F.when(k % 5 == 0, F.lit("  ")).otherwise(F.col("c_mktsegment")).alias("segment"),
        F.array(F.lit("b"), F.col("c_mktsegment")).alias("tags"), F.when(k % 3 > 0, F.col("c_nationkey").cast("bigint")).alias("nation"),
    )
    right = c.where(k % 2 == 0).select(
        "c_custkey", F.when(k % 8 > 0, F.upper("c_name")).alias("name"), F.lower("c_mktsegment").alias("segment"),
        F.when(k % 6 == 0, F.array(F.lit("new"))).otherwise(F.array(F.concat(F.lit(" "), "c_mktsegment"), F.lit("b"))).alias("tags"),
        (F.col("c_nationkey") + 100).cast("bigint").alias("nation"),
    )
    rules = {"name": enrich.OVERWRITE, "segment": enrich.PREFER_SOURCE, "tags": enrich.OVERWRITE, "nation": enrich.FILL_EMPTY}
    out = enrich.merge_by_rules(left, right, "c_custkey", rules)
    return out.select("c_custkey", "name", "segment", _joined(F.col("tags")).alias("tags"), "nation",
                      _joined(F.col("changed_fields")).alias("changed_fields"))


@query
def field_compare(spark, sf):
    own = derive.catalogue(spark, sf).select("product_id", "card_type", "job", "rarity")
    other = derive.source_cards(spark, sf).select("row_id", F.col("type").alias("s_type"), F.col("job").alias("s_job"), F.col("rarity").alias("s_rarity"))
    pairs = own.join(other, F.col("product_id") == F.col("row_id"))
    fields = {f: (F.col(f), F.col(s)) for f, s in (("card_type", "s_type"), ("job", "s_job"), ("rarity", "s_rarity"))}
    return enrich.compare_fields(pairs, "product_id", fields)


def _clean_cards(spark, sf) -> DataFrame:
    return plan.cleaned_cards(derive.products(spark, sf), derive.groups(spark, sf), POLICY)


@query
def card_cleaning(spark, sf):
    """Whole marketplace row to cleaned card."""
    return _clean_cards(spark, sf).select(
        "product_id", "name", "clean_name", "primary_card_number", "full_card_number", "card_type", "category",
        F.col("cost").cast("bigint").alias("cost"), "description", _joined(F.col("elements")).alias("elements"),
        "job", "rarity", "is_non_card", _joined(F.col("set")).alias("set"), "low_res_url", "content_hash",
    )


@query
def card_enrichment(spark, sf):
    """Clean, match and merge: the fields of every card that the second source changes."""
    cards = _clean_cards(spark, sf)
    source = derive.source_cards(spark, sf)
    matches = plan.matched_cards(cards, source)
    out = enrich.card_updates(cards, matches, source, "product_id", "doc_id", POLICY)
    return out.select(
        "product_id", "doc_id", "name", "card_type", "job", "rarity", "full_card_number", "primary_card_number",
        "category", F.col("cost").cast("bigint").alias("cost"), F.col("power").cast("bigint").alias("power"),
        "description", _joined(F.col("elements")).alias("elements"), _joined(F.col("set")).alias("set"),
    )


@query
def source_repairs(spark, sf):
    """Explicit pairs under the fill-only rules: figures, wrongly and rightly marked non-cards, images of the source."""
    none = F.lit(None).cast("string")
    cards = _clean_cards(spark, sf).withColumns({c: none for c in ("full_res_url", "high_res_url", "low_res_url")})
    row = F.col("row_id").cast("string")
    found = F.struct(F.array(F.concat(F.lit("thumb/"), row)).alias("thumbs"), F.array(F.concat(F.lit("full/"), row)).alias("full"))
    source = derive.source_cards(spark, sf).withColumn("images", F.when(F.col("row_id") % 3 > 0, found).otherwise(F.col("images")))
    pairs = source.select(F.col("row_id").alias("product_id"), "doc_id")
    out = enrich.card_updates(cards, pairs, source.drop("row_id"), "product_id", "doc_id", POLICY, enrich.FILL_FIGURES)
    return out.select(
        "product_id", F.col("cost").cast("bigint").alias("cost"), F.col("power").cast("bigint").alias("power"), "is_non_card",
        "card_type", "full_res_url", "high_res_url", "low_res_url",
    )


# ---------------------------------------------------------------- facets


FACETS = {"p_type": facets.SCALAR, "p_brand": facets.SCALAR, "p_size": facets.NUMBER, "words": facets.ARRAY, "label": facets.LABELS}


def _facet_rows(spark, sf) -> DataFrame:
    return table(spark, sf, "part").select(
        "p_type", "p_brand", "p_size", F.split("p_name", " ").alias("words"),
        F.concat(F.col("p_type"), F.lit(" · "), F.col("p_brand")).alias("label"),
    )


@query
def facet_values(spark, sf):
    return facets.facet_values(_facet_rows(spark, sf), FACETS).select("field", "value")


@query
def ordered_facets(spark, sf):
    out = facets.ordered_facets(facets.facet_values(_facet_rows(spark, sf), FACETS))
    return out.select("field", "value", "position")


@query
def facet_hash(spark, sf):
    ordered = facets.ordered_facets(facets.facet_values(_facet_rows(spark, sf), FACETS))
    docs = facets.content_pages(ordered)
    return docs.select("field", F.col("page").cast("bigint").alias("page"), _joined(F.col("values")).alias("values"), "hash")


@query
def facet_fields(spark, sf):
    ordered = facets.ordered_facets(facets.facet_values(_facet_rows(spark, sf), FACETS))
    return facets.facet_fields(ordered).select("field", "n_values", "hash")


@query
def facet_changes(spark, sf):
    """Documents against those of an earlier state that lacked the larger sizes."""
    rows = _facet_rows(spark, sf)
    now = facets.content_pages(facets.ordered_facets(facets.facet_values(rows, FACETS)))
    before = facets.content_pages(facets.ordered_facets(facets.facet_values(rows.where("p_size < 40"), FACETS)))
    return facets.facet_changes(now, before).select("field", "updated")


@query
def distinct_values(spark, sf):
    return facets.distinct_values(table(spark, sf, "orders"), "o_orderpriority")


@query
def ordered_sets(spark, sf):
    g = derive.groups(spark, sf)
    values = facets.distinct_values(g, "name").withColumnRenamed("value", "set_name")
    used = table(spark, sf, "customer").join(
        g.select(F.col("group_id").cast("int").alias("c_nationkey"), F.col("name").alias("set_name")), "c_nationkey"
    ).select("set_name")
    out = facets.ordered_sets(used.join(values, "set_name", "left_semi"), g, "set_name", "name", "published_on")
    return out.select("set_name", "is_supplemental")


# ---------------------------------------------------------------- search


def _searchable(spark, sf) -> DataFrame:
    a = F.col("extended_data")
    return derive.products(spark, sf).select(
        "product_id", names.search_name(F.col("name")).alias("clean_name"), codes.row_codes(a).alias("card_numbers"),
        elements.is_non_card(attributes.attribute(a, "CardType"), a).alias("is_non_card"),
    )


@query
def prefix_terms(spark, sf):
    c = table(spark, sf, "customer").select(F.lit("customer").alias("origin"), F.col("c_custkey").alias("id"), F.col("c_name").alias("v"))
    p = table(spark, sf, "part").select(F.lit("part"), "p_partkey", "p_name")
    return c.unionAll(p).select("origin", "id", _joined(terms.name_terms(F.col("v"))).alias("terms"))


@query
def code_terms(spark, sf):
    df = _searchable(spark, sf)
    return df.select("product_id", _joined(F.array_sort(terms.code_terms(F.col("card_numbers")))).alias("terms"))


@query
def index_terms(spark, sf):
    df = search.with_terms(_searchable(spark, sf))
    return df.select("product_id", F.size("search_terms").cast("bigint").alias("n_terms"), "search_hash")


@query
def index_refresh(spark, sf):
    cards = _searchable(spark, sf)
    k = F.col("product_id")
    stored = search.with_terms(cards).where(k % 5 > 0).select(
        "product_id",
        F.when(k % 7 > 0, F.col("search_hash")).otherwise(F.lit("old")).alias("search_hash"),
        F.when(k % 11 > 0, F.col("search_terms")).alias("search_terms"),
    )
    return search.refresh_terms(cards, "product_id", stored).select("product_id", "change_kind")


@query
def index_in_place(spark, sf):
    """The form a run uses: cards that hold their own terms and fingerprint."""
    k = F.col("product_id")
    known = terms.search_terms(F.col("clean_name"), F.col("card_numbers"))
    cards = _searchable(spark, sf).withColumn("search_terms", known)
    stored = cards.withColumn(
        "search_hash", F.when(k % 7 == 0, F.lit("old")).when(k % 5 > 0, fingerprints.terms_fingerprint(F.col("search_terms")))
    ).withColumn("search_terms", F.when(k % 11 > 0, F.col("search_terms")))
    return search.refresh_in_place(stored, "product_id").select("product_id", "change_kind", "search_hash")


@query
def index_rebuild(spark, sf):
    """Postings kept in buckets: those of cards with new terms are due, and derived anew from the list of due ones."""
    folder = session.shared_folder(spark, "index-rebuild")
    cards, index = f"{folder}/cards", f"{folder}/index"
    rows = search.with_terms(_searchable(spark, sf)).select("product_id", "search_terms")
    rows = rows.withColumn(tables.BUCKET, tables.bucket_of("product_id", 8))
    changed = F.col("product_id") % 100 == 0
    before = rows.withColumn("search_terms", F.when(changed, F.array(F.lit("old"))).otherwise(F.col("search_terms")))

    def derive(some):
        return search.inverted_index(some, "product_id", keep=[tables.BUCKET])

    everything = list(range(8))
    tables.overwrite_partitions(before, cards, [tables.BUCKET])
    tables.rebuild_buckets(spark, index, cards, everything, derive, "term")
    tables.add_due(spark, index, tables.touched_buckets(rows.where(changed), "product_id", 8))
    tables.overwrite_partitions(rows, cards, [tables.BUCKET])
    tables.rebuild_due(spark, index, cards, derive, "term")
    return search.term_counts(spark.read.parquet(index))


@query
def term_index(spark, sf):
    index = search.inverted_index(search.with_terms(_searchable(spark, sf)), "product_id")
    return search.term_counts(index)


@query
def term_search(spark, sf):
    index = search.inverted_index(search.with_terms(_searchable(spark, sf)), "product_id")
    return search.search_index(index, " Red ", "product_id", 50)


@query
def code_search(spark, sf):
    df = search.with_terms(_searchable(spark, sf))
    return search.search(df, "C-004", "product_id", exact=True).select("product_id")


# ---------------------------------------------------------------- runs, quality, logs




def _logs(spark, sf) -> DataFrame:
    kind = F.col("event_type")
    level = F.when(kind == "error", "ERROR").when(kind == "view", "WARNING").otherwise("INFO")
    return table(spark, sf, "events").select(
        "event_id", "ts", "user_id", level.alias("level"), text.cents(F.col("value")).alias("cents"),
        F.concat(F.lit("code "), (F.col("user_id") % 5).cast("string")).alias("message"),
        F.concat(F.lit("hour "), F.date_format("ts", "HH")).alias("context"),
    )


@query
def error_rate(spark, sf):
    return quality.error_rate(_logs(spark, sf), "ts", _at("2024-01-05"), F.col("level") == "ERROR").select("n_errors", "n_logs", "band")


@query
def error_patterns(spark, sf):
    return quality.error_patterns(_logs(spark, sf), "ts", "event_id", F.col("level") == "ERROR", "message")


@query
def error_aggregate(spark, sf):
    out = quality.error_aggregate(_logs(spark, sf), "ts", _at("2024-01-05"), F.col("level") == "ERROR", "message", "context")
    return out.select("message", "n", F.date_format("last_occurrence", "yyyy-MM-dd HH:mm:ss").alias("last_occurrence"),
                      "n_contexts")


@query
def error_contexts(spark, sf):
    out = quality.error_contexts(_logs(spark, sf), "ts", _at("2024-01-05"), F.col("level") == "ERROR", "message", "context")
    return out.select("message", "context", "n", F.date_format("last_occurrence", "yyyy-MM-dd HH:mm:ss").alias("last_occurrence"))


@query
def log_summary(spark, sf):
    out = quality.log_summary(_logs(spark, sf), "ts", _at("2024-01-03"), _at("2024-01-25"), "level", "cents")
    return out.select("n_errors", "n_warnings", "total_duration", "n_durations")


@query
def top_errors(spark, sf):
    return quality.top_errors(_logs(spark, sf), "ts", _at("2024-01-03"), _at("2024-01-25"), F.col("level") == "ERROR", "message", 3)


ORDER_RULES = {
    "price": lambda: F.col("o_totalprice") > 50_000,
    "status": lambda: F.col("o_orderstatus").isin("O", "F"),
    "priority": lambda: F.col("o_orderpriority").startswith("1-") | F.col("o_orderpriority").startswith("2-"),
}


@query
def validation_report(spark, sf):
    rules = {n: r() for n, r in ORDER_RULES.items()}
    return quality.validation_report(table(spark, sf, "orders"), rules, "o_orderpriority")


@query
def validation_errors(spark, sf):
    rules = {n: r() for n, r in ORDER_RULES.items()}
    return quality.validation_errors(table(spark, sf, "orders"), rules, "o_orderkey")


@query
def match_counters(spark, sf):
    left, right = _match_sides(spark, sf)
    matched = match.first_match(left, right, "product_id", "keys", "sets", "row_id", "keys", "sets")
    return runs.match_counters(left, matched, F.col("product_id") != F.col("row_id"))


def _run_rows(spark, sf) -> DataFrame:
    """A run per user and day out of the events: states, durations, errors."""
    e = table(spark, sf, "events")
    return e.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.min("ts").alias("sync_start"), F.max("ts").alias("sync_end"), F.count(F.lit(1)).alias("items_processed"),
        F.count_if(F.col("event_type") == "error").alias("n_errors"),
    ).select(
        F.concat(F.col("user_id").cast("string"), F.lit("/"), F.date_format("day", "yyyy-MM-dd")).alias("run_id"),
        (F.col("user_id") * 1000 + F.dayofyear("day")).cast("bigint").alias("version"),
        F.when(F.col("n_errors") == 0, runs.COMPLETED).otherwise(runs.FAILED).alias("sync_status"),
        "sync_start", "sync_end", runs.duration_seconds(F.col("sync_start"), F.col("sync_end")).alias("sync_duration"),
        "items_processed", "n_errors",
    )


@query
def error_append(spark, sf):
    """Error texts added to run records, each text once."""
    rows = _run_rows(spark, sf).withColumn("sync_errors", F.when(F.col("n_errors") > 0, F.array(F.lit("first"))))
    late = rows.where(F.col("items_processed") % 2 == 0).select(
        "run_id", F.when(F.col("n_errors") > 1, F.array(F.lit("first"), F.lit("late"))).otherwise(F.array(F.lit("late"))).alias("errors")
    )
    return runs.add_errors(rows, late).select("run_id", _joined(F.col("sync_errors")).alias("errors"))


@query
def run_validation(spark, sf):
    rows = _run_rows(spark, sf).select(
        "sync_status", F.when(F.col("n_errors") < 3, F.col("sync_end")).alias("sync_end"), F.col("items_processed").alias("card_count"),
        F.when(F.col("n_errors") > 0, F.array(F.lit("x"))).alias("sync_errors"),
    )
    return quality.validation_report(rows, quality.run_rules(), "sync_status")


@query
def price_validation(spark, sf):
    rows = _pivoted(spark, sf).withColumn("last_updated", F.when(F.col("product_id") % 3 > 0, F.lit("2024-05-01")))
    rows = rows.withColumn("normal", F.when(F.col("product_id") % 5 > 0, F.col("normal")).otherwise(
        F.col("normal").withField("mid", F.lit(None).cast("bigint"))))
    return quality.validation_report(rows, quality.price_rules())


@query
def image_validation(spark, sf):
    record = urls.image_record(F.col("image_url"), POLICY)
    rows = derive.catalogue(spark, sf).select("group_id", record.alias("r")).select("group_id", "r.*", "r.metadata.is_placeholder")
    return quality.validation_report(rows, quality.image_rules("https://img."), "group_id")


@query
def run_health(spark, sf):
    return runs.run_health(_run_rows(spark, sf))


@query
def next_version(spark, sf):
    return runs.next_version(_run_rows(spark, sf))


@query
def run_alerts(spark, sf):
    return runs.alerts(_run_rows(spark, sf), max_seconds=3600).select("run_id", "sync_duration", "duration_alert", "error_band")


@query
def current_run(spark, sf):
    return runs.current_run(_run_rows(spark, sf)).select("run_id", "sync_status", "version")


@query
def run_summary(spark, sf):
    steps = table(spark, sf, "lineitem").groupBy(
        F.col("l_suppkey").alias("run_id"), F.col("l_returnflag").alias("step")
    ).agg(F.count(F.lit(1)).alias("processed"), F.count_if(F.col("l_linestatus") == "F").alias("updated"))
    out = runs.run_summary(steps, ["A", "N", "R"])
    return out.select("run_id", *[F.col(f"{s}.{c}").alias(f"{s.lower()}_{c}") for s in ("A", "N", "R") for c in ("processed", "updated")])


@query
def size_summary(spark, sf):
    return quality.size_summary(table(spark, sf, "documents"), "n_chars", "source")


@query
def within_size(spark, sf):
    return quality.within_size(table(spark, sf, "documents"), "n_chars").select("doc_id", "n_chars")


@query
def null_stripping(spark, sf):
    df = derive.catalogue(spark, sf).select("product_id", "card_type", F.struct("job", "element").alias("detail"), "rarity")
    return df.select("product_id", fingerprints.compact_json(df, ["card_type", "detail", "rarity"]).alias("record"))


# ---------------------------------------------------------------- whole runs, feeds and streams


@query
def catalogue_run(spark, sf):
    """Feeds landed as JSON lines, the whole run over them, the card table it leaves."""
    folder = session.shared_folder(spark, "catalogue-run")
    derive.land_feeds(spark, sf, folder)
    layout = plan.Layout(
        f"{folder}/groups", f"{folder}/products", f"{folder}/prices", f"{folder}/source", f"{folder}/tables",
        feed_layout=feeds.LINES, n_buckets=8,
    )
    run = plan.Run(spark, layout, POLICY)
    for step in plan.run_steps(run):
        if not step.success:
            raise RuntimeError(f"{step.step}: {step.error}")
    return run.load("cards").select(
        "product_id", "name", "clean_name", "card_type", "job", "rarity", "full_card_number", "category",
        F.col("cost").cast("bigint").alias("cost"), F.col("power").cast("bigint").alias("power"), "description",
        _joined(F.col("elements")).alias("elements"), _joined(F.col("set")).alias("set"),
        F.size("search_terms").cast("bigint").alias("n_terms"),
    )


def _landed(spark, sf, purpose: str) -> plan.Layout:
    folder = session.shared_folder(spark, purpose)
    derive.land_feeds(spark, sf, folder)
    return plan.Layout(
        f"{folder}/groups", f"{folder}/products", f"{folder}/prices", f"{folder}/source", f"{folder}/tables",
        feed_layout=feeds.LINES, n_buckets=8,
    )


def _done(results: list[plan.StepResult]) -> list[plan.StepResult]:
    for step in results:
        if not step.success:
            raise RuntimeError(f"{step.step}: {step.error}")
    return results


@query
def planned_run(spark, sf):
    """What a run would do, without writing: counts of its first two steps."""
    run = plan.Run(spark, _landed(spark, sf, "planned"), POLICY, plan_only=True)
    results = _done(plan.run_steps(run, [plan.sync_groups, plan.sync_cards]))
    return spark.createDataFrame([(r.step, r.processed, r.updated) for r in results], "step string, processed bigint, updated bigint")


@query
def card_images(spark, sf):
    """The child table of images that the card step leaves."""
    run = plan.Run(spark, _landed(spark, sf, "images"), POLICY)
    _done(plan.run_steps(run, [plan.sync_groups, plan.sync_cards]))
    return run.load("card_images").select("product_id", "is_placeholder", "original_url", "error_message", "data_version")


@query
def single_group_run(spark, sf):
    """Products landed by group; a run for one group reads its folder only."""
    folder = session.shared_folder(spark, "single-group")
    derive.land_feeds(spark, sf, folder)
    products = spark.read.json(f"{folder}/products")
    products.withColumn("group_id", F.col("groupId")).write.partitionBy("group_id").json(f"{folder}/by_group")
    layout = plan.Layout(f"{folder}/groups", f"{folder}/by_group", "", "", f"{folder}/tables", feeds.LINES, 8, by_group=True)
    run = plan.Run(spark, layout, POLICY, group_id=7)
    _done(plan.run_steps(run, [plan.sync_groups, plan.sync_cards]))
    return run.load("cards").select("product_id", "group_id", "clean_name", _joined(F.col("set")).alias("set"))


@query
def run_record(spark, sf):
    """The record that a run leaves."""
    run = plan.Run(spark, _landed(spark, sf, "record"), POLICY)
    _done(plan.run_steps(run, [plan.sync_groups, plan.sync_cards]))
    return run.load("runs").select("version", "card_count", "group_count", "sync_status", "search_indexed",
                                   F.size("sync_errors").cast("bigint").alias("n_errors"))


@query
def manual_overrides(spark, sf):
    """Values set by hand after the sources were merged."""
    run = plan.Run(spark, _landed(spark, sf, "overrides"), POLICY)
    by_hand = derive.catalogue(spark, sf).where(F.col("product_id") % 10 == 0).select("product_id", F.lit("by hand").alias("job"))

    def enriched(r: plan.Run) -> plan.StepResult:
        return plan.enrich_cards(r, by_hand)

    _done(plan.run_steps(run, [plan.sync_groups, plan.sync_cards, plan.sync_source, enriched]))
    return run.load("cards").select("product_id", F.coalesce(F.col("job") == "by hand", F.lit(False)).alias("overridden"))


@query
def feed_rejects(spark, sf):
    """Groups land among broken lines: the groups are stored, every broken line is kept with its file."""
    folder = session.shared_folder(spark, "feed-rejects")
    good = derive.groups(spark, sf).select(F.to_json(F.struct(F.col("group_id").alias("groupId"), "name")).alias("value"))
    bad = table(spark, sf, "customer").select(F.concat(F.lit("{broken "), "c_name").alias("value"))
    good.unionAll(bad).write.text(f"{folder}/groups")
    layout = plan.Layout(f"{folder}/groups", "", "", "", f"{folder}/tables", feeds.LINES, 8)
    run = plan.Run(spark, layout, POLICY)
    (step,) = _done(plan.run_steps(run, [plan.sync_groups]))
    rejects = spark.read.parquet(layout.table("groups_rejects")).select(
        F.lit("rejected").alias("kind"), F.get_json_object("record", "$.corrupt").alias("text"), F.lit(step.n_errors).cast("bigint").alias("n")
    )
    return rejects.unionAll(run.load("groups").select(F.lit("stored"), "name", F.lit(step.processed).cast("bigint")))


@query
def stream_rejects(spark, sf):
    """Rows a stream does not accept go to its rejects table."""
    folder = session.shared_folder(spark, "stream-rejects")
    rows = ingest.table_stream(spark, f"{sf}/events.parquet").select("event_id", "user_id", "ts", "event_type")
    q = ingest.upsert_stream(
        rows, f"{folder}/target", f"{folder}/checkpoint", "user_id", ["ts", "event_id"],
        lambda df: fingerprints.fingerprint([F.col("event_id")]), n_buckets=8, rejects=f"{folder}/rejects",
        accept=F.col("event_type") != "error",
    )
    q.awaitTermination()
    rejects = spark.read.parquet(f"{folder}/rejects").select(
        F.lit("rejected").alias("kind"), F.get_json_object("record", "$.event_id").cast("bigint").alias("event_id")
    )
    return rejects.unionAll(spark.read.parquet(f"{folder}/target").select(F.lit("stored"), "event_id"))


# Places of a feed that one task holds at a time to tell them apart.
PLACES_PER_TASK = 100_000


def _feed_totals(read: DataFrame, n_tasks: int) -> DataFrame:
    """Price rows of a feed per product and variant, and how many places they came from.

    Nearly every row is a place of its own, and rows pack so well that partitions sized by their bytes hold millions of
    them: they are dealt by place to ``n_tasks`` before anything is grouped.
    """
    kept = read.select("product_id", "sub_type_name", "source_file", "position", "market", text.cents(F.col("high")).alias("cents"))
    dealt = kept.repartition(n_tasks, "product_id", "sub_type_name", "source_file", "position")
    return dealt.groupBy("product_id", "sub_type_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("cents").alias("high_cents"),
        F.count("market").alias("n_market"), F.countDistinct("source_file", "position").alias("n_places"),
    )


@query
def price_feed(spark, sf):
    """Price rows landed as JSON lines, read back with the feed schema and pivoted."""
    folder = session.shared_folder(spark, "price-feed")
    rows = _price_rows(spark, sf).select(
        F.col("product_id").alias("productId"), F.col("low").alias("lowPrice"), F.col("mid").alias("midPrice"),
        F.col("high").alias("highPrice"), F.col("market").alias("marketPrice"),
        F.col("direct_low").alias("directLowPrice"), F.col("sub_type_name").alias("subTypeName"),
    )
    rows.write.json(folder)
    read = feeds.prices(spark, folder, layout=feeds.LINES)
    return _feed_totals(read, derive.tasks_for(table(spark, sf, "lineitem"), PLACES_PER_TASK))


@query
def stream_upsert(spark, sf):
    """Events streamed into a table of the latest event per user and day; equals the batch snapshot."""
    folder = session.shared_folder(spark, "stream")
    rows = ingest.table_stream(spark, f"{sf}/events.parquet").select(
        F.concat(F.col("user_id").cast("string"), F.lit("/"), F.date_format("ts", "yyyy-MM-dd")).alias("snapshot_key"),
        "user_id", "event_id", "ts", "event_type",
    )
    q = ingest.upsert_stream(
        rows, f"{folder}/target", f"{folder}/checkpoint", "snapshot_key", ["ts", "event_id"],
        lambda df: fingerprints.fingerprint([F.col("event_id"), F.col("event_type")]), n_buckets=8,
    )
    q.awaitTermination()
    return spark.read.parquet(f"{folder}/target").select("snapshot_key", "user_id", "event_id", "event_type")


def _price_records(spark, sf):
    return _price_rows(spark, sf).select(
        F.floor(F.col("product_id") / 256).alias("envelope"),
        F.struct(
            F.col("product_id").alias("productId"), F.col("low").alias("lowPrice"), F.col("mid").alias("midPrice"),
            F.col("high").alias("highPrice"), F.col("market").alias("marketPrice"),
            F.col("direct_low").alias("directLowPrice"), F.col("sub_type_name").alias("subTypeName"),
        ).alias("record"),
    )


# Price rows in the envelopes that one task makes and lands.
ROWS_PER_TASK = 200_000


def _price_bodies(spark, sf, batch: int = 0, n_batches: int = 1):
    """The records of each envelope, of all or a batch of them; envelopes are dealt to tasks by their rows, as packed rows are few bytes."""
    n = -(-derive.tasks_for(table(spark, sf, "lineitem"), ROWS_PER_TASK) // n_batches)
    records = _price_records(spark, sf).select("envelope", F.to_json("record").alias("record"))
    if n_batches > 1:
        records = records.where(F.pmod(F.xxhash64("envelope"), F.lit(n_batches)) == batch)
    dealt = records.repartition(n, "envelope") if n > 1 else records
    return dealt.groupBy("envelope").agg(F.array_join(F.collect_list("record"), ",").alias("body"))


# Files that one task lands; a file costs about as much time whatever its size.
FILES_PER_TASK = 500
# Folders of so many files that are listed at a time: the driver holds the list.
FOLDERS_PER_LIST = 200


def _land_files(rows: DataFrame, name: str, n_tasks: int, folder: str) -> None:
    """A folder and file per value of a column, rows of one value in one task; every task puts its own files in place.

    With one task the rows stay as they are dealt.
    """
    dealt = rows.repartition(n_tasks, name) if n_tasks > 1 else rows
    writer = dealt.write.partitionBy(name).option("lineSep", "\n")
    # else the driver moves all files by itself when the last task is done; the folder is new and read after that
    writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(folder)


# Price rows whose envelopes are on disk at a time, as text many times as large as the table.
ROWS_PER_BATCH = 20_000_000


def _by_batches(spark, sf, purpose: str, whole, result: Callable[[str, int], DataFrame]) -> DataFrame:
    """Every envelope is landed as ``whole`` and read by ``result``; a batch of them goes from disk before the next comes.

    An envelope is in one batch, so ``result`` of a folder and the number of batches has to keep to single envelopes.
    """
    n = derive.tasks_for(table(spark, sf, "lineitem"), ROWS_PER_BATCH)
    kept = session.shared_folder(spark, f"{purpose}-results")
    for batch in range(n):
        folder = session.shared_folder(spark, purpose)
        with session.shuffles_go(spark), envelopes.passing(spark):
            bodies = _price_bodies(spark, sf, batch, n)
            _land_files(bodies.select("envelope", whole.alias("text")), "envelope", 1, folder)
            found = result(folder, n)
            found.write.mode("append").parquet(kept)
        tables.remove(spark, folder)
    return spark.read.schema(found.schema).parquet(kept)


@query
def envelope_feed(spark, sf):
    """Price rows landed as envelopes of up to 256 products, read at element borders and pivoted."""
    whole = F.concat(F.lit('{"success":true,"errors":[{"at":"}{"}],"results":['), "body", F.lit('],"total":{"n":1}}'))
    n_tasks = derive.tasks_for(table(spark, sf, "lineitem"), PLACES_PER_TASK)

    def totals(folder: str, n_batches: int) -> DataFrame:
        return _feed_totals(feeds.prices(spark, folder, layout=feeds.SPLIT), -(-n_tasks // n_batches))

    return _by_batches(spark, sf, "envelope-feed", whole, totals)


@query
def envelope_checks(spark, sf):
    """Envelopes of which some lack the array, end early or hold an element that can't be read: what is left of each."""
    kind = F.col("envelope") % 4
    whole = F.when(kind == 1, F.concat(F.lit('{"other":['), "body", F.lit("]}"))).when(
        kind == 2, F.concat(F.lit('{"results":['), "body", F.lit("]"))
    ).when(kind == 3, F.concat(F.lit('{"results":[{"productId":oops},'), "body", F.lit("]}"))).otherwise(
        F.concat(F.lit('{"results":['), "body", F.lit("]}"))
    )

    def left(folder: str, _: int) -> DataFrame:
        read = feeds.read_feed(spark, folder, feeds.PRICE_RESULT, layout=feeds.SPLIT)
        name = F.regexp_extract("source_file", r"envelope=(\d+)", 1).cast("bigint").alias("envelope")
        return read.groupBy(name).agg(
            F.count("r").alias("n_records"), F.count("corrupt").alias("n_unreadable"),
            F.coalesce(F.max("position") + 1, F.lit(0)).cast("bigint").alias("n_elements"),
        )

    return _by_batches(spark, sf, "envelope-checks", whole, left)


@query
def image_objects(spark, sf):
    """Pages landed as files that begin like JPEG, like PNG, or like neither, read back and told apart by their bytes."""
    folder = session.shared_folder(spark, "image-objects")
    head = F.when(F.col("page_id") % 3 == 0, F.unhex(F.lit("FFD8FFE0"))).when(F.col("page_id") % 3 == 1, F.unhex(F.lit("89504E47")))
    content = F.concat(F.coalesce(head, F.unhex(F.lit(""))), F.encode(F.coalesce("html", F.lit("")), "utf-8"))
    pages = table(spark, sf, "pages").select("page_id", content.alias("content"))
    n = derive.tasks_for(pages, FILES_PER_TASK)
    if path := images.own_path(spark, folder):
        folders = images.land_objects(pages, "page_id", "content", n, path)
        lists = [folders[i : i + FOLDERS_PER_LIST] for i in range(0, n, FOLDERS_PER_LIST)]
    else:  # text files hold any bytes; a line separator ends each
        _land_files(pages.select("page_id", F.col("content").cast("string").alias("text")), "page_id", n, folder)
        lists = [[folder]]
    page = F.regexp_extract("path", r"page_id=(\d+)", 1).cast("bigint").alias("page_id")

    def read(some: list[str]) -> DataFrame:
        # Spark counts 4 MB for opening a file, so a partition has 32 small ones
        found = images.checked_images(images.image_files(spark, some, "*.txt")).coalesce(len(some) if path else n)
        return found.select(page, (F.col("length") - 1).alias("n_bytes"), "kind")

    if len(lists) == 1:
        return read(lists[0])
    kept = session.shared_folder(spark, "image-kinds")
    for some in lists:
        read(some).write.mode("append").parquet(kept)
    return spark.read.schema(read(lists[0][:1]).schema).parquet(kept)


@query
def emptied_table(spark, sf):
    """A table emptied with its schema kept, and taken in anew from the rows of one status."""
    orders = table(spark, sf, "orders").select(_big("o_orderkey"), "o_orderstatus", "o_orderpriority")
    folder = session.shared_folder(spark, "emptied")
    history.emptied(orders).write.parquet(folder)
    orders.where("o_orderstatus = 'P'").write.mode("append").parquet(folder)
    return spark.read.parquet(folder)


@query
def stream_quarantine(spark, sf):
    """Envelopes streamed into a table, some of them cut short: those are set aside, and all others are taken in."""
    folder = session.shared_folder(spark, "quarantine")
    bodies = _price_bodies(spark, sf)
    end = F.when(F.col("envelope") % 3 == 2, F.lit("")).otherwise(F.lit("]}"))
    whole = F.concat(F.lit('{"results":['), "body", end)
    _land_files(bodies.select("envelope", whole.alias("text")), "envelope", 1, f"{folder}/in")
    rows = ingest.feed_stream(spark, f"{folder}/in/*", feeds.PRICE_RESULT)
    key = F.concat_ws("/", F.col("product_id"), F.coalesce("sub_type_name", F.lit("")))
    q = ingest.upsert_stream(
        rows, f"{folder}/target", f"{folder}/checkpoint", "price_key", ["source_file", "position"],
        lambda df: fingerprints.fingerprint([F.col("product_id"), F.col("sub_type_name")]), n_buckets=8,
        shape=lambda feed: feeds.shape_prices(feed).withColumn("price_key", key),
    )
    q.awaitTermination()
    aside = spark.read.parquet(f"{folder}/target-rejects")
    name = F.regexp_extract("record", r"envelope=(\d+)", 1).cast("bigint")
    taken = spark.read.parquet(f"{folder}/target").select(F.lit("taken").alias("outcome"), F.col("product_id").alias("id"), "sub_type_name")
    return taken.unionByName(aside.select(F.lit("set aside").alias("outcome"), name.alias("id"), F.lit(None).cast("string").alias("sub_type_name")).distinct())
