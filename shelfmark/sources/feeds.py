"""Landed feed files to typed rows.

A feed lands either as envelope documents (``{"results": [...]}``, one file per group) or as JSON
lines of the same records.  In the ``envelope`` layout a file is read by one task; ``split`` reads large
envelopes by many (``envelopes``).  ``position`` is the place of a record in its file, the only order a feed has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from . import envelopes
from ..functions.elements import source_elements
from ..schemas import GROUP_RESULT, PRICE_RESULT, PRODUCT_RESULT, SOURCE_CARD

CORRUPT = "_corrupt_record"
ENVELOPE, LINES, SPLIT = "envelope", "lines", "split"


def envelope_schema(record: StructType, field: str = "results") -> StructType:
    return StructType([StructField(field, ArrayType(record)), StructField(CORRUPT, StringType())])


def lines_schema(record: StructType) -> StructType:
    return StructType([*record.fields, StructField(CORRUPT, StringType())])


def read_feed(spark: SparkSession, path: str, record: StructType, field: str = "results", layout: str = ENVELOPE) -> DataFrame:
    """Records of a feed as ``r``, with ``position``, ``source_file`` and ``corrupt`` (unreadable text)."""
    if layout == SPLIT:
        return envelopes.read(spark, path, record, field)
    if layout == LINES:
        raw = spark.read.schema(lines_schema(record)).json(path)
    else:
        raw = spark.read.schema(envelope_schema(record, field)).option("multiLine", "true").json(path)
    return unwrap(raw, record, field, layout)


def unwrap(raw: DataFrame, record: StructType, field: str = "results", layout: str = ENVELOPE) -> DataFrame:
    """Records of a batch or a stream of feed documents; an unreadable document gives one row."""
    origin = F.col("_metadata.file_path").alias("source_file")
    if layout == LINES:
        # a block never holds more rows than bytes, so this grows along the whole file
        row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        place = (F.col("_metadata.file_block_start") + row).alias("position")
        whole = F.when(F.col(CORRUPT).isNull(), F.struct(*record.names)).alias("r")
        # Spark refuses to read the corrupt text alone, so it is tied to a field of the record
        text = F.when(F.col(CORRUPT).isNotNull() | F.col(record.names[0]).isNull(), F.col(CORRUPT)).alias("corrupt")
        return raw.select(whole, place, origin, text)
    return raw.select(F.posexplode_outer(field).alias("position", "r"), origin, F.col(CORRUPT).alias("corrupt"))


def readable(feed: DataFrame) -> DataFrame:
    return feed.where(F.col("r").isNotNull())


def unreadable(feed: DataFrame) -> DataFrame:
    return feed.where(F.col("corrupt").isNotNull()).select("source_file", "corrupt")


def feed_order() -> list[Column]:
    """The order of a feed: its files by name, records by place."""
    return [F.col("source_file"), F.col("position")]


def groups(spark: SparkSession, path: str, layout: str = ENVELOPE) -> DataFrame:
    return shape_groups(readable(read_feed(spark, path, GROUP_RESULT, layout=layout)))


def shape_groups(feed: DataFrame) -> DataFrame:
    return feed.select(
        F.col("r.groupId").alias("group_id"),
        F.col("r.name").alias("name"),
        F.col("r.abbreviation").alias("abbreviation"),
        F.col("r.publishedOn").try_cast("timestamp").alias("published_on"),
        F.col("r.modifiedOn").alias("modified_on"),
        "source_file",
        "position",
    )


def products(spark: SparkSession, path: str, group_id: int | None = None, layout: str = ENVELOPE) -> DataFrame:
    rows = shape_products(readable(read_feed(spark, path, PRODUCT_RESULT, layout=layout)))
    return rows if group_id is None else rows.where(F.col("group_id") == group_id)


def shape_products(feed: DataFrame) -> DataFrame:
    attrs = F.transform(
        F.coalesce(F.col("r.extendedData"), F.array()),
        lambda a: F.struct(a["name"].alias("name"), a["displayName"].alias("display_name"), a["value"].alias("value")),
    )
    return feed.select(
        F.col("r.productId").alias("product_id"),
        F.col("r.name").alias("name"),
        F.col("r.cleanName").alias("clean_name"),
        F.col("r.imageUrl").alias("image_url"),
        F.col("r.categoryId").alias("category_id"),
        F.col("r.groupId").alias("group_id"),
        F.col("r.url").alias("url"),
        F.col("r.modifiedOn").alias("modified_on"),
        F.col("r.imageCount").alias("image_count"),
        attrs.alias("extended_data"),
        "source_file",
        "position",
    )


def prices(spark: SparkSession, path: str, layout: str = ENVELOPE) -> DataFrame:
    return shape_prices(readable(read_feed(spark, path, PRICE_RESULT, layout=layout)))


def shape_prices(feed: DataFrame) -> DataFrame:
    return feed.select(
        F.col("r.productId").alias("product_id"),
        F.col("r.directLowPrice").alias("direct_low"),
        F.col("r.highPrice").alias("high"),
        F.col("r.lowPrice").alias("low"),
        F.col("r.marketPrice").alias("market"),
        F.col("r.midPrice").alias("mid"),
        F.col("r.subTypeName").alias("sub_type_name"),
        "source_file",
        "position",
    )


def source_cards(spark: SparkSession, path: str, layout: str = ENVELOPE) -> DataFrame:
    return shape_source(read_feed(spark, path, SOURCE_CARD, "cards", layout), layout)


def shape_source(feed: DataFrame, layout: str = ENVELOPE) -> DataFrame:
    """Second-source rows with the element rules applied.

    An envelope without ``cards`` fails the job, for then the whole source is missing; of lines, single bad ones are left out.
    """
    if layout == LINES:
        checked = readable(feed)
    else:
        checked = feed.withColumn("r", F.when(F.col("r").isNull(), _missing_cards()).otherwise(F.col("r")))
    fixed = source_elements(F.col("type_en"), F.col("code"), F.col("element"))
    return checked.select("r.*", "source_file", "position").withColumn("element", fixed)


def _missing_cards() -> Column:
    message = F.concat(F.lit("no readable cards array in "), F.col("source_file"))
    return F.raise_error(message).cast(SOURCE_CARD)

