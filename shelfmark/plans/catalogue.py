"""The full run and its parts: feeds in, tables out."""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from .. import schemas
from ..functions import codes, elements, fingerprints, labels, names, texts, urls
from ..functions.attributes import attribute
from ..functions.prices import history_form
from ..functions.text import parse_integer, parse_number
from ..operators import changes, enrich, facets, history, keys, match, merge, pivot, runs, search
from ..sources import feeds, tables

FACET_FIELDS = {
    "card_type": facets.SCALAR,
    "category": facets.LABELS,
    "cost": facets.NUMBER,
    "elements": facets.ARRAY,
    "power": facets.NUMBER,
    "rarity": facets.SCALAR,
    "set": facets.ARRAY,
}


# Tables kept in hash buckets of their key; a run rewrites the buckets it touches.
BUCKETED = {"groups", "cards", "card_images", "source_cards", "prices"}

# Published versions that retention leaves, so that a reader of the last one but one is not cut off.
KEPT_VERSIONS = 2

# Columns of the card table that the index step fills.
INDEX_COLUMNS = {"search_terms": "array<string>", "search_hash": "string"}

# Attributes of a product row and the columns they are read into.
ATTRIBUTES = {
    "Number": "number",
    "CardType": "raw_type",
    "Category": "raw_category",
    "Cost": "raw_cost",
    "Power": "raw_power",
    "Description": "raw_text",
    "Element": "raw_element",
    "Job": "job",
    "Rarity": "rarity",
}


@dataclass(frozen=True)
class Layout:
    """Where feeds land and where tables live."""

    groups_feed: str
    products_feed: str
    prices_feed: str
    source_feed: str
    tables: str
    feed_layout: str = feeds.ENVELOPE
    n_buckets: int = 64  # so many that a bucket is a few gigabytes
    by_group: bool = False  # products and prices land in a folder for each group, ``group_id=...``

    def feed(self, path: str, group_id: int | None) -> str:
        """Where to read a feed from: one group's folder if there is one, else all of it."""
        return f"{path.rstrip('/')}/group_id={group_id}" if self.by_group and group_id is not None else path

    def table(self, name: str) -> str:
        return f"{self.tables.rstrip('/')}/{name}"


@dataclass
class StepResult:
    step: str
    success: bool = True
    processed: int = 0
    updated: int = 0
    n_errors: int = 0
    error: str | None = None


@dataclass
class Run:
    """Options and the single-writer version of one run."""

    spark: SparkSession
    layout: Layout
    images: urls.ImagePolicy
    force: bool = False
    group_id: int | None = None
    plan_only: bool = False
    started: datetime = field(default_factory=lambda: datetime.now(timezone.utc))
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    version: int = 1

    def load(self, name: str) -> DataFrame | None:
        if name in BUCKETED:
            return tables.read_buckets(self.spark, self.layout.table(name))
        return tables.current(self.spark, self.layout.table(name))

    def log(self, name: str) -> str:
        return self.layout.table(f"{name}_deltas")

    def merge(self, name: str, updates: DataFrame, key: str, how, empty: DataFrame | None = None) -> None:
        """Merge written rows into a bucketed table."""
        tables.merge_buckets(
            self.spark, self.layout.table(name), updates, key, self.layout.n_buckets,
            lambda base, rows: how(base, rows, key), empty,
        )


# ---------------------------------------------------------------- row shapes


def hashed_products(products: DataFrame) -> DataFrame:
    """Marketplace rows with what their fingerprint is made of, and the raw fields that cleaning needs later."""
    attrs = F.col("extended_data")
    # every attribute is looked up once; the rules below read plain columns
    base = products.select(
        "product_id",
        "group_id",
        "modified_on",
        F.col("name").alias("raw_name"),
        F.col("clean_name").alias("raw_clean_name"),
        "image_url",
        codes.row_codes(attrs).alias("card_numbers"),
        attrs,
        *[attribute(attrs, name).alias(column) for name, column in ATTRIBUTES.items()],
    )
    cards = base.select(
        "*",
        codes.full_code(F.col("card_numbers")).alias("full_card_number"),
        elements.row_type(F.col("raw_type"), F.col("number")).alias("card_type"),
        parse_number(F.col("raw_cost")).alias("cost"),
        elements.row_elements(F.col("raw_type"), F.col("number"), F.col("raw_element")).alias("elements"),
        parse_number(F.col("raw_power")).alias("power"),
    )
    return cards.withColumn("content_hash", fingerprints.card_fingerprint())


def cleaned_rows(hashed: DataFrame, groups: DataFrame, images: urls.ImagePolicy) -> DataFrame:
    """Names, texts, labels and addresses of hashed rows: one projection and the group look-up."""
    attrs = F.col("extended_data")
    staged = hashed.select(
        "*",
        labels.categories(F.col("raw_category")).alias("categories"),
        urls.image_record(F.col("image_url"), images).alias("image"),
    )
    cards = staged.select(
        "product_id",
        names.display_name(F.col("raw_name"), F.col("card_numbers")).alias("name"),
        names.search_name(F.col("raw_name")).alias("clean_name"),
        F.col("image.full_res_url").alias("full_res_url"),
        F.col("image.high_res_url").alias("high_res_url"),
        F.col("image.low_res_url").alias("low_res_url"),
        F.col("image.metadata").alias("image_metadata"),
        "group_id",
        elements.is_non_card(F.col("raw_type"), attrs).alias("is_non_card"),
        "card_numbers",
        codes.primary_code(F.col("card_numbers")).alias("primary_card_number"),
        "full_card_number",
        "card_type",
        labels.join_labels(F.col("categories")).alias("category"),
        "categories",
        "cost",
        texts.rules_text(F.col("raw_text")).alias("description"),
        "elements",
        "job",
        "number",
        "power",
        "rarity",
        "content_hash",
    )
    return keys.attach_parent_name(cards, groups, "group_id", "name")


def cleaned_cards(products: DataFrame, groups: DataFrame, images: urls.ImagePolicy) -> DataFrame:
    """Marketplace rows to cleaned cards with their fingerprint."""
    return cleaned_rows(hashed_products(products), groups, images)


def stored_source(rows: DataFrame) -> DataFrame:
    """Second-source rows as stored, with key and fingerprint."""
    hashed = rows.withColumn("content_hash", fingerprints.source_fingerprint())
    return hashed.select(
        codes.composite_key(F.col("code"), F.col("set")).alias("doc_id"),
        F.coalesce(parse_integer(F.col("id")), F.lit(0)).alias("id"),
        F.replace(F.col("code"), F.lit(";"), F.lit("/")).alias("code"),
        F.coalesce(F.col("name_en"), F.lit("")).alias("name"),
        F.coalesce(F.col("type_en"), F.lit("")).alias("type"),
        elements.source_job(F.col("type_en"), F.col("job_en")).alias("job"),
        F.coalesce(texts.translated_text(F.col("text_en")), F.lit("")).alias("text"),
        "element",
        F.coalesce(F.col("rarity"), F.lit("")).alias("rarity"),
        parse_integer(F.col("cost")).alias("cost"),
        parse_integer(F.col("power")).alias("power"),
        F.coalesce(F.col("category_1"), F.lit("")).alias("category_1"),
        F.nullif(F.col("category_2"), F.lit("")).alias("category_2"),
        "multicard",
        "ex_burst",
        F.coalesce(F.col("set"), F.array().cast("array<string>")).alias("set"),
        "images",
        "content_hash",
        "source_file",
        "position",
    )


def current_prices(raw: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Price rows to valid price records in cents with their fingerprint."""
    valid = pivot.valid_prices(pivot.prices_in_cents(pivot.pivot_variants(raw, order=feeds.feed_order())))
    hashed = valid.withColumn("content_hash", fingerprints.price_fingerprint())
    if products is None:
        return hashed.withColumn("group_id", F.lit(None).cast("bigint"))
    return hashed.join(products.select("product_id", "group_id"), "product_id", "left")


# ---------------------------------------------------------------- steps


def _metrics(seen: Observation) -> dict[str, int]:
    """Observed counts; a plan that Spark found to be empty has none."""
    try:
        return defaultdict(int, seen.get)
    except Py4JJavaError:
        return defaultdict(int)


def _reconciled(
    run: Run,
    name: str,
    incoming: DataFrame,
    key: str,
    later: dict[str, str] | None = None,
    child: tuple[str, str] | None = None,
    unreadable: DataFrame | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> StepResult:
    """Reject, classify, log the changed rows and merge them into the buckets they touch.

    Classification reads key, fingerprint and version of the stored table, nothing else.  The change
    log of the run is written first; what is merged is read back from it, so a lost executor costs
    one task and not the feed.  ``later`` names columns that other steps fill; ``child`` is a struct column
    that goes to a table of its own, with one row per key.  ``finish`` cleans the rows that are to be written, and
    no others: an unchanged row costs its fingerprint.  ``unreadable`` feed documents are
    rejects as well, with the name of their file.
    """
    result = StepResult(name)
    good, bad = changes.split_rejects(incoming, {f"{key} missing": F.col(key).isNotNull()})
    stored = run.load(name)
    if stored is None:
        stored = merge.stamp(good.where(F.lit(False)), run.version, run.started)
    judged = changes.classify(good, stored, key, version_col="data_version", force=run.force)
    counts = [
        F.count(F.lit(1)).alias("processed"),
        F.count_if(F.col("change_kind") != "unchanged").alias("updated"),
    ]
    if run.plan_only:
        planned = judged.agg(*counts).first()
        result.processed, result.updated = planned.processed, planned.updated
        return result
    seen, rejects = Observation(), Observation()
    changed = changes.to_write(judged.observe(seen, *counts)).drop("change_kind")
    if finish is not None:
        changed = finish(changed)
    stamped = merge.stamp(changed, run.version, run.started)
    tables.append(history.delta_log(stamped, key).withColumn("run_id", F.lit(run.run_id)), run.log(name), ["run_id"])
    result.processed, result.updated = (_metrics(seen)[n] for n in ("processed", "updated"))
    empty = stamped.where(F.lit(False))
    for column, kind in (later or {}).items():
        empty = empty.withColumn(column, F.lit(None).cast(kind))
    rows = logged_changes(run, name, stamped, key)
    if child is not None:
        column, table = child
        details = rows.select(key, f"{column}.*", "data_version", "last_updated")
        run.merge(table, details, key, merge.merge_upsert)
        rows, empty = rows.drop(column), empty.drop(column)
    run.merge(name, rows, key, merge.merge_upsert, empty)
    records = bad.select(F.to_json(F.struct("*")).alias("record"))
    if unreadable is not None:
        records = records.unionByName(unreadable.select(F.to_json(F.struct("source_file", "corrupt")).alias("record")))
    watched = records.select("record", F.lit(run.started).cast("timestamp").alias("last_updated"), F.lit(run.run_id).alias("run_id"))
    tables.append(watched.observe(rejects, F.count(F.lit(1)).alias("n")), run.layout.table(f"{name}_rejects"), ["run_id"])
    result.n_errors = _metrics(rejects)["n"]
    return result


def logged_changes(run: Run, name: str, like: DataFrame, key: str) -> DataFrame:
    """Rows this run has changed, as logged."""
    schema = history.delta_log(like, key).withColumn("run_id", F.lit("")).schema
    log = run.spark.read.schema(schema).parquet(run.log(name))
    return log.where(F.col("run_id") == run.run_id).select(key, "data_version", "changes.*")


def _merge_staged(run: Run, step: str, name: str, updates: DataFrame, key: str, derived: str | None = None) -> None:
    """Update existing rows of a stored table from a plan that reads that very table.

    The updates are written down before the table is touched, and the copy goes when they are in.  The touched buckets
    of the table ``derived`` from it are noted as due before that.
    """
    path = f"{run.layout.table('staged')}/{step}-{run.run_id}"
    updates.write.mode("overwrite").parquet(path)
    staged = run.spark.read.parquet(path)
    if derived is not None:
        tables.add_due(run.spark, run.layout.table(derived), tables.touched_buckets(staged, key, run.layout.n_buckets))
    run.merge(name, staged, key, merge.update_existing)
    tables.remove(run.spark, path)


def sync_groups(run: Run) -> StepResult:
    feed = feeds.read_feed(run.spark, run.layout.groups_feed, schemas.GROUP_RESULT, layout=run.layout.feed_layout)
    rows = feeds.shape_groups(feeds.readable(feed))
    unique = changes.latest_per_key(rows, ["group_id"], feeds.feed_order()).drop("source_file", "position")
    hashed = unique.withColumn("content_hash", fingerprints.group_fingerprint())
    return _reconciled(run, "groups", hashed, "group_id", unreadable=feeds.unreadable(feed))


def sync_cards(run: Run) -> StepResult:
    path = run.layout.feed(run.layout.products_feed, run.group_id)
    feed = feeds.read_feed(run.spark, path, schemas.PRODUCT_RESULT, layout=run.layout.feed_layout)
    rows = feeds.shape_products(feeds.readable(feed))
    if run.group_id is not None:
        rows = rows.where(F.col("group_id") == run.group_id)
    unique = changes.latest_per_key(rows, ["product_id"], feeds.feed_order())
    groups = run.load("groups")
    if groups is None:
        groups = feeds.groups(run.spark, run.layout.groups_feed, run.layout.feed_layout)
    return _reconciled(
        run, "cards", hashed_products(unique), "product_id", INDEX_COLUMNS, ("image_metadata", "card_images"),
        feeds.unreadable(feed), lambda rows: cleaned_rows(rows, groups, run.images),
    )


def sync_source(run: Run) -> StepResult:
    feed = feeds.read_feed(run.spark, run.layout.source_feed, schemas.SOURCE_CARD, "cards", run.layout.feed_layout)
    rows = stored_source(feeds.shape_source(feed, run.layout.feed_layout))
    unique = changes.latest_per_key(rows, ["doc_id"], feeds.feed_order()).drop("source_file", "position")
    bad = feeds.unreadable(feed) if run.layout.feed_layout == feeds.LINES else None  # else the step has failed
    return _reconciled(run, "source_cards", unique, "doc_id", unreadable=bad)


def matched_cards(cards: DataFrame, source: DataFrame) -> DataFrame:
    left = cards.select(
        "product_id",
        "set",
        codes.match_keys(
            F.col("card_numbers"), F.col("full_card_number"), F.col("number"), F.col("primary_card_number"),
            F.coalesce(F.col("is_non_card"), F.lit(False)),
        ).alias("keys"),
    )
    right = source.select(
        "doc_id", codes.source_match_keys(codes.code_of_key(F.col("doc_id"))).alias("keys"), F.col("set")
    )
    return match.first_match(left, right, "product_id", "keys", "set", "doc_id", "keys", "set")


def enrich_cards(run: Run, overrides: DataFrame | None = None) -> StepResult:
    result = StepResult("enrich")
    cards, source = run.load("cards"), run.load("source_cards")
    updates = enrich.card_updates(cards, matched_cards(cards, source), source, "product_id", "doc_id", run.images)
    if run.plan_only:
        result.updated = updates.count()
        return result
    seen = Observation()
    stamped = merge.stamp(updates.drop("doc_id", "changed_fields"), run.version, run.started)
    counted = stamped.observe(seen, F.count(F.lit(1)).alias("updated"))
    _merge_staged(run, "enrich", "cards", counted, "product_id")
    result.updated = _metrics(seen)["updated"]
    if overrides is not None:
        _merge_staged(run, "overrides", "cards", overrides, "product_id")
    return result


def refresh_index(run: Run) -> StepResult:
    """Terms and fingerprints on the cards, then the postings of the buckets this changes.

    A run that dies between the two leaves its buckets on the list of due ones, and the next run derives their postings
    although it finds no changed fingerprint.
    """
    result = StepResult("search_index")
    cards = run.load("cards")
    fresh = search.refresh_in_place(cards, "product_id", run.force)
    counts = [
        F.count(F.lit(1)).alias("processed"),
        F.count_if(F.col("change_kind") != "unchanged").alias("updated"),
    ]
    if run.plan_only:
        planned = fresh.agg(*counts).first()
        result.processed, result.updated = planned.processed, planned.updated
        return result
    seen = Observation()
    changed = changes.to_write(fresh.observe(seen, *counts)).drop("change_kind")
    _merge_staged(run, "search_index", "cards", changed, "product_id", "search_index")
    result.processed, result.updated = (_metrics(seen)[n] for n in ("processed", "updated"))
    tables.rebuild_due(
        run.spark, run.layout.table("search_index"), run.layout.table("cards"),
        lambda cards: search.inverted_index(cards, "product_id", keep=[tables.BUCKET]), sort="term",
    )
    return result


def refresh_facets(run: Run) -> StepResult:
    result = StepResult("facets")
    cards, groups = run.load("cards"), run.load("groups")
    values = facets.facet_values(cards, FACET_FIELDS)
    plain = facets.ordered_facets(values.where(F.col("field") != "set"))
    documents = facets.content_pages(plain.select("field", "value", "position"))
    sets = facets.set_positions(values.where(F.col("field") == "set"), groups)
    documents = documents.unionByName(facets.content_pages(sets))
    stored = run.load("facets")
    if stored is None:
        stored = documents.where(F.lit(False))
    judged = facets.facet_changes(documents, stored, run.force)
    seen = Observation()
    judged = judged.observe(
        seen, F.count(F.lit(1)).alias("processed"), F.count_if(F.col("updated")).alias("updated")
    )
    if run.plan_only:
        result.updated = judged.where("updated").count()
        return result
    left = judged.where(F.col("hash").isNotNull())  # a removed document counts as updated and goes
    tables.publish(left.drop("updated").withColumn("last_updated", F.lit(run.started).cast("timestamp")),
                   run.layout.table("facets"))
    result.processed, result.updated = (_metrics(seen)[n] for n in ("processed", "updated"))
    return result


def sync_prices(run: Run) -> StepResult:
    """Current prices, and the snapshot of the day: every product's price, changed by this run or not."""
    path = run.layout.feed(run.layout.prices_feed, run.group_id)
    feed = feeds.read_feed(run.spark, path, schemas.PRICE_RESULT, layout=run.layout.feed_layout)
    raw = feeds.shape_prices(feeds.readable(feed))
    incoming = current_prices(raw, run.load("cards"))
    if run.group_id is not None:
        incoming = incoming.where(F.col("group_id") == run.group_id)
    result = _reconciled(run, "prices", incoming, "product_id", unreadable=feeds.unreadable(feed))
    if run.plan_only:
        return result
    day = F.lit(run.started.date())
    current = run.load("prices")
    if current is None:
        return result
    snapshot = current.select(
        "product_id", "group_id", history_form(F.col("normal")).alias("normal"), history_form(F.col("foil")).alias("foil"),
        F.col("last_updated").alias("written_at"), day.alias("snapshot_date"),
    )
    tables.overwrite_partitions(snapshot, run.layout.table("price_history"), ["snapshot_date"])
    return result


def purge(run: Run, cutoff: datetime, names: tuple[str, ...] = ("runs",)) -> dict[str, int]:
    """Retention by age; returns how many rows each table loses.

    Append logs (``..._deltas``, ``..._rejects``) lose the partitions of old runs; published tables lose old rows, and
    their older versions but the last ``KEPT_VERSIONS``.  A name that is no table raises ``ValueError``.
    """
    deleted = {}
    for name in names:
        path = run.layout.table(name)
        if name.endswith(("_deltas", "_rejects")) and tables.exists(run.spark, path):
            log = run.spark.read.parquet(path)
            time = "changes.last_updated" if name.endswith("_deltas") else "last_updated"
            ages = log.groupBy("run_id").agg(F.max(time).alias("t"), F.count(F.lit(1)).alias("n"))
            old = ages.where(F.col("t") < F.lit(cutoff)).collect()  # one row for each run
            for row in old:
                tables.remove(run.spark, f"{path}/run_id={row.run_id}")
            deleted[name] = sum(row.n for row in old)
            continue
        df = None if name in BUCKETED else run.load(name)
        if df is None:
            raise ValueError(f"no log and no published table: {name}")
        counts = Observation()
        time = "sync_start" if name == "runs" else "last_updated"
        seen = df.observe(counts, F.count_if(F.col(time) < F.lit(cutoff)).alias("n"))
        tables.publish(history.retained(seen, time, cutoff), run.layout.table(name))
        deleted[name] = _metrics(counts)["n"]
        for version in tables.versions(run.spark, path)[:-KEPT_VERSIONS]:
            tables.remove(run.spark, tables.version_path(path, version))
    return deleted


# ---------------------------------------------------------------- runs

CATALOGUE_STEPS: list[Callable[[Run], StepResult]] = [
    sync_groups, sync_cards, sync_source, enrich_cards, refresh_index, refresh_facets,
]
SCHEDULED_STEPS: list[Callable[[Run], StepResult]] = [sync_groups, sync_cards, sync_source, enrich_cards]


def run_steps(run: Run, steps: list[Callable[[Run], StepResult]] = CATALOGUE_STEPS) -> list[StepResult]:
    """Run steps in order, stop at the first that fails, and keep the run record.

    Every run has a number of its own, also after a failed one, so a reader that asks for later versions misses nothing.
    A record says "in-progress" from the start; a run that is killed leaves it so.
    """
    history_table = run.load("runs")
    if history_table is not None:
        run.version = runs.next_version(history_table).first()["version"]
    if not run.plan_only:
        for name in BUCKETED:  # a writer may have died while it replaced buckets
            tables.recover(run.spark, run.layout.table(name), [tables.BUCKET])
        _publish_record(run, runs.RUNNING, 0, 0, set(), None, [])
    results: list[StepResult] = []
    for step in steps:
        try:
            results.append(step(run))
        except Exception as error:  # noqa: BLE001 - any failure of a step ends the run and is recorded
            results.append(StepResult(step.__name__, success=False, error=str(error)))
            break
    if not run.plan_only:
        _record(run, results)
    return results


def _record(run: Run, results: list[StepResult]) -> None:
    good = all(r.success for r in results)
    ended = datetime.now(timezone.utc)
    done = {r.step for r in results if r.success}
    cards, groups = run.load("cards"), run.load("groups")
    _publish_record(
        run, runs.COMPLETED if good else runs.FAILED, cards.count() if cards is not None else 0,
        groups.count() if groups is not None else 0, done, ended, [r.error for r in results if r.error],
    )


def _publish_record(
    run: Run, status: str, n_cards: int, n_groups: int, done: set[str], ended: datetime | None, errors: list[str]
) -> None:
    """The run's record in place of an earlier one of the same run."""
    seconds = None if ended is None else int((ended - run.started).total_seconds() + 0.5)
    row = (
        run.run_id, run.version, n_cards, n_groups, "search_index" in done, "facets" in done, status, run.started, ended,
        seconds, errors,
    )
    record = run.spark.createDataFrame([row], schemas.RUN)
    history_table = run.load("runs")
    if history_table is not None:
        record = history_table.where(F.col("run_id") != run.run_id).unionByName(record)
    tables.publish(record, run.layout.table("runs"))
