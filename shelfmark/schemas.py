"""Schemas of the landed feeds and of the stored tables (no inference anywhere)."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Built from objects: a DDL text can only be read once a session runs.
TEXT, WHOLE, SMALL, NUMBER, TRUTH, TIME = (
    StringType(), LongType(), IntegerType(), DoubleType(), BooleanType(), TimestampType(),
)
TEXTS = ArrayType(TEXT)


def record(**fields: DataType) -> StructType:
    return StructType([StructField(name, data_type) for name, data_type in fields.items()])


GROUP_RESULT = record(groupId=WHOLE, name=TEXT, abbreviation=TEXT, publishedOn=TEXT, modifiedOn=TEXT)
PRODUCT_RESULT = record(
    productId=WHOLE, name=TEXT, cleanName=TEXT, imageUrl=TEXT, categoryId=WHOLE, groupId=WHOLE,
    url=TEXT, modifiedOn=TEXT, imageCount=SMALL,
    extendedData=ArrayType(record(name=TEXT, displayName=TEXT, value=TEXT)),
)
PRICE_RESULT = record(
    productId=WHOLE, lowPrice=NUMBER, midPrice=NUMBER, highPrice=NUMBER, marketPrice=NUMBER,
    directLowPrice=NUMBER, subTypeName=TEXT,
)
SOURCE_CARD = record(
    id=TEXT, code=TEXT, name_en=TEXT, type_en=TEXT, job_en=TEXT, text_en=TEXT,
    element=TEXTS, rarity=TEXT, cost=TEXT, power=TEXT, category_1=TEXT, category_2=TEXT,
    multicard=TEXT, ex_burst=TEXT, set=TEXTS, images=record(thumbs=TEXTS, full=TEXTS),
)
RUN = record(
    run_id=TEXT, version=WHOLE, card_count=WHOLE, group_count=WHOLE, search_indexed=TRUTH,
    filters_updated=TRUTH, sync_status=TEXT, sync_start=TIME, sync_end=TIME, sync_duration=WHOLE,
    sync_errors=TEXTS,
)


def nullable(data_type: DataType) -> DataType:
    """The type with nulls allowed at every depth; casting to a stricter one is refused."""
    if isinstance(data_type, ArrayType):
        return ArrayType(nullable(data_type.elementType), True)
    if isinstance(data_type, MapType):
        return MapType(data_type.keyType, nullable(data_type.valueType), True)
    if isinstance(data_type, StructType):
        return StructType([StructField(f.name, nullable(f.dataType), True) for f in data_type.fields])
    return data_type
