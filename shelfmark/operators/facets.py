"""Facets: the distinct values of chosen fields, ordered, with a fingerprint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.fingerprints import values_fingerprint
from ..functions.labels import MIDDOT, label_list
from .numbering import SLICE_ROWS, last_before, number_rows

# The words that mark a supplemental set.
SUPPLEMENTAL = "Deck|Collection|Promo"

SCALAR, NUMBER, ARRAY, LABELS = "scalar", "number", "array", "labels"


def distinct_values(df: DataFrame, column: str, kind: str = SCALAR) -> DataFrame:
    """Distinct non-null values of one column as ``value``."""
    return facet_values(df, {column: kind}).select("value")


def facet_values(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """``field, value, number`` without duplicates, all fields in one pass over the table.

    ``fields`` maps a column to its kind: ``scalar``, ``number``, ``array`` or ``labels`` (delimited
    text, every part normalised).  ``number`` is the typed twin of a numeric value.
    """
    empty = F.array().cast("array<struct<value:string,number:double>>")

    def entry(value: Column, number: Column | None = None) -> Column:
        twin = F.lit(None).cast("double") if number is None else number
        return F.struct(value.cast("string").alias("value"), twin.alias("number"))

    entries = []
    for name, kind in fields.items():
        col = F.col(name)
        if kind == ARRAY:
            values = F.transform(F.array_compact(col), lambda x: entry(x))
        elif kind == LABELS:
            values = F.transform(label_list(col, MIDDOT, "narrow"), lambda x: entry(x))
        elif kind == NUMBER:
            values = F.when(col.isNotNull(), F.array(entry(_number_text(col), col.cast("double"))))
        else:
            values = F.when(col.isNotNull(), F.array(entry(col)))
        entries.append(F.struct(F.lit(name).alias("field"), F.coalesce(values, empty).alias("values")))
    return (
        df.select(F.explode(F.array(*entries)).alias("_f"))
        .select(F.col("_f.field").alias("field"), F.explode("_f.values").alias("_v"))
        .select("field", F.col("_v.value").alias("value"), F.col("_v.number").alias("number"))
        .distinct()
    )


def _number_text(col: Column) -> Column:
    return F.regexp_replace(col.cast("string"), r"\.0$", "")


def ordered_facets(values: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Facet values with their position: numbers numerically, text in Unicode collation order.

    Numbering goes by sampled slices, so a field is not sorted by one task, whatever its values share.
    """
    text = F.collate(F.col("value"), "UNICODE")
    order = [F.col("number").asc_nulls_last(), text.asc(), F.col("value").asc()]
    return number_rows(values, ["field"], order, name="position", slice_rows=slice_rows)


def facet_documents(ordered: DataFrame, page_size: int = 10_000) -> DataFrame:
    """``field, page, values, hash``: one document per field and page of values.

    Ordinary facets have one page.  A wide field gets further pages, none of them beyond the size of
    a row, and loses no value.
    """
    return _documents(ordered, F.floor((F.col("position") - 1) / page_size))


def content_pages(ordered: DataFrame, page_size: int = 10_000) -> DataFrame:
    """``field, page, values, hash`` as :func:`facet_documents`, in pages that follow the values.

    A page ends with a value whose own hash is a multiple of ``page_size``, so pages have that many
    values on average, and a new value touches its page alone (two if it ends one).  ``page`` is 0
    for the first page and else the hash of the value that ends the page before: it stays when
    pages elsewhere come and go.  No value is lost.
    """
    own = F.xxhash64(F.col("value"))
    ends = F.when(F.pmod(own, F.lit(page_size)) == 0, own)
    placed = last_before(ordered, ["field"], "position", ends, "_page")
    return _documents(placed, F.coalesce("_page", F.lit(0)).cast("bigint"))


def _documents(placed: DataFrame, page: Column) -> DataFrame:
    packed = placed.groupBy("field", page.alias("page")).agg(
        F.array_sort(F.collect_list(F.struct("position", "value"))).alias("_v")
    )
    values = F.transform("_v", lambda x: x["value"])
    return packed.select("field", "page", values.alias("values"), values_fingerprint(values).alias("hash"))


def facet_fields(ordered: DataFrame, page_size: int = 10_000) -> DataFrame:
    """``field, pages, n_values, hash``: the content pages of a field in order, and its hash made from theirs."""
    first = ordered.groupBy("field", "value").agg(F.min("position").alias("_first"))
    documents = content_pages(ordered, page_size)
    starts = documents.select("field", "page", "hash", F.size("values").alias("_n"), F.col("values")[0].alias("value"))
    pages = F.array_sort(F.collect_list(F.struct("_first", "page", "hash")))
    out = starts.join(first, ["field", "value"]).groupBy("field").agg(pages.alias("_p"), F.sum("_n").alias("n_values"))
    return out.select(
        "field", F.transform("_p", lambda p: p["page"]).alias("pages"), "n_values",
        values_fingerprint(F.transform("_p", lambda p: p["hash"])).alias("hash"),
    )


def is_supplemental(name: Column) -> Column:
    return name.rlike(SUPPLEMENTAL)


def ordered_sets(values: DataFrame, groups: DataFrame, value: str, name: str, published: str) -> DataFrame:
    """Set names in two blocks, core sets first, each by publishing time and name.

    Names without a published group are dropped.  Of several groups with one name the latest counts.
    """
    known = (
        groups.where((F.col(name) != "") & F.col(published).isNotNull())
        .groupBy(F.col(name).alias(value))
        .agg(F.max(published).alias("published_on"))
    )
    joined = values.select(value).distinct().join(known, value)
    block = is_supplemental(F.col(value)).alias("is_supplemental")
    return joined.select(value, block, "published_on").orderBy("is_supplemental", "published_on", value)


def facet_changes(documents: DataFrame, stored: DataFrame, force: bool = False) -> DataFrame:
    """The documents and those stored ones that are no more (without values), with ``updated`` per document."""
    old = stored.select("field", "page", F.col("hash").alias("_old"))
    joined = documents.join(old, ["field", "page"], "full_outer")
    changed = ~F.col("hash").eqNullSafe(F.col("_old")) | F.lit(force)
    return joined.withColumn("updated", changed).drop("_old")


def set_positions(values: DataFrame, groups: DataFrame) -> DataFrame:
    """Facet rows of the set field with their two-block position; there are as many as groups."""
    ranked = ordered_sets(values, groups, "value", "name", "published_on")
    return number_rows(
        ranked.withColumn("field", F.lit("set")),
        ["field"],
        [F.col("is_supplemental"), F.col("published_on"), F.col("value")],
    ).select("field", "value", "position")
