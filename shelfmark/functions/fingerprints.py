"""Content fingerprints: MD5 of one canonical JSON text per row.

Null fields are written out, fields keep their given order, doubles that are whole numbers are
written without a fraction.  Money must be in cents before it is fingerprinted.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from .arrays import non_empty, no_strings, sorted_union
from .codes import source_codes
from .elements import is_source_crystal, CRYSTAL
from .text import parse_integer

_KEEP_NULLS = {"ignoreNullFields": "false"}


def canonical_json(fields: Iterable[Column], whole_numbers: Iterable[str] = ()) -> Column:
    """JSON text of the fields in the given order; ``whole_numbers`` lose a zero fraction."""
    text = F.to_json(F.struct(*fields), _KEEP_NULLS)
    names = "|".join(whole_numbers)
    if names:
        text = F.regexp_replace(text, rf'([{{,]"(?:{names})":-?\d+)\.0(?=[,}}])', "$1")
    return text


def fingerprint(fields: Iterable[Column], whole_numbers: Iterable[str] = ()) -> Column:
    return F.md5(canonical_json(fields, whole_numbers))


def record_fingerprint(df: DataFrame, exclude: Iterable[str] = ()) -> Column:
    """Fingerprint of a whole record, fields in name order."""
    skip = set(exclude)
    return fingerprint([F.col(c) for c in sorted(df.columns) if c not in skip])


def card_fingerprint() -> Column:
    """Fingerprint of a cleaned card row; text and group are not part of it."""
    return fingerprint(
        [
            F.col("raw_name").alias("name"),
            F.col("raw_clean_name").alias("cleanName"),
            F.col("modified_on").alias("modifiedOn"),
            F.col("card_type").alias("cardType"),
            F.col("number"),
            F.col("rarity"),
            F.col("cost"),
            F.col("power"),
            F.col("elements"),
            F.array(F.lit("Unknown")).alias("set"),
            F.col("raw_category").alias("category"),
            F.col("card_numbers").alias("cardNumbers"),
            F.col("full_card_number").alias("fullCardNumber"),
        ],
        whole_numbers=("cost", "power"),
    )


def group_fingerprint() -> Column:
    return fingerprint([F.col("group_id").alias("groupId"), F.col("modified_on").alias("modifiedOn")])


def price_fingerprint(include: Iterable[str] = ()) -> Column:
    """Both price variants; the fetch time only when named in ``include``."""
    return fingerprint([F.col("normal"), F.col("foil"), *[F.col(c) for c in include]])


def _source_fields(code: Column, element: Column, codes: Column, extra: list[Column]) -> list[Column]:
    return [
        F.coalesce(code, F.lit("")).alias("code"),
        element.alias("element"),
        F.coalesce(F.col("rarity"), F.lit("")).alias("rarity"),
        parse_integer(F.col("cost").cast("string")).alias("cost"),
        parse_integer(F.col("power").cast("string")).alias("power"),
        F.coalesce(F.col("category_1"), F.lit("")).alias("category_1"),
        F.nullif(F.col("category_2"), F.lit("")).alias("category_2"),
        *extra,
        F.col("multicard"),
        F.col("ex_burst"),
        F.array_sort(non_empty(F.coalesce(F.col("set"), no_strings()))).alias("set"),
        codes.alias("cardNumbers"),
    ]


def source_fingerprint(kind: str = "type_en") -> Column:
    """Fingerprint of a second-source row whose elements are already translated."""
    code = F.col("code")
    element = F.when(is_source_crystal(F.col(kind), code), F.array(F.lit(CRYSTAL))).otherwise(
        F.array_sort(non_empty(F.coalesce(F.col("element"), no_strings())))
    )
    return fingerprint(_source_fields(code, element, source_codes(code), []))


def match_fingerprint(left_codes: Column, kind: str = "type") -> Column:
    """As ``source_fingerprint``, with categories and the reprint codes of the matched row."""
    code = F.col("code")
    element = F.when(is_source_crystal(F.col(kind), code), F.array(F.lit(CRYSTAL))).otherwise(
        F.array_sort(non_empty(F.coalesce(F.col("element"), no_strings())))
    )
    reprints = F.filter(F.coalesce(left_codes, no_strings()), lambda c: c.startswith("Re-"))
    labels = F.when(
        F.coalesce(F.col("category_2"), F.lit("")) != "", F.array("category_1", "category_2")
    ).otherwise(F.array("category_1"))
    return fingerprint(
        _source_fields(
            code, element, sorted_union(source_codes(code), reprints), [labels.alias("categories")]
        )
    )


def terms_fingerprint(terms: Column) -> Column:
    return F.md5(F.to_json(F.array_sort(terms)))


def values_fingerprint(values: Column) -> Column:
    return F.md5(F.to_json(values))


def _without_nulls(col: Column, data_type) -> Column:
    """Nested records that have no value left become null themselves."""
    if not isinstance(data_type, StructType):
        return col
    fields = {f.name: _without_nulls(col[f.name], f.dataType) for f in data_type.fields}
    any_left = F.lit(False)
    for c in fields.values():
        any_left = any_left | c.isNotNull()
    return F.when(any_left, F.struct(*[c.alias(n) for n, c in fields.items()]))


def compact_json(df: DataFrame, columns: Iterable[str]) -> Column:
    """JSON text of some columns without null fields and empty records, at every depth."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return F.to_json(F.struct(*[_without_nulls(F.col(c), types[c]).alias(c) for c in columns]))
