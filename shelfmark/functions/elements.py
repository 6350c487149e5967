"""Elements, types and rarities: dictionaries and the rules that derive them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .arrays import no_strings, split_clean
from .attributes import has_any_attribute
from .labels import map_literal
from .text import capitalise

# Element symbols of the second source.
ELEMENTS = {
    "火": "Fire",
    "氷": "Ice",
    "風": "Wind",
    "土": "Earth",
    "雷": "Lightning",
    "水": "Water",
    "光": "Light",
    "闇": "Dark",
}

# Rarity codes of the second source.
RARITIES = {"C": "Common", "R": "Rare", "H": "Hero", "L": "Legend", "S": "Starter"}

CRYSTAL = "Crystal"


def translate_value(col: Column, dictionary: dict[str, str]) -> Column:
    """Dictionary lookup; an unknown value passes through."""
    return F.coalesce(map_literal(dictionary)[col], col)


def translate_all(arr: Column, dictionary: dict[str, str]) -> Column:
    return F.transform(arr, lambda x: translate_value(x, dictionary))


def rarity_label(code: Column, promo: Column) -> Column:
    return F.when(promo, F.lit("Promo")).otherwise(translate_value(code, RARITIES))


def _crystal_number(number: Column) -> Column:
    return F.coalesce(F.upper(number).startswith("C-"), F.lit(False))


def row_elements(kind: Column, number: Column, element: Column) -> Column:
    """Elements of a marketplace row; crystals, by type or code, have just that element."""
    crystal = F.coalesce(F.lower(kind) == "crystal", F.lit(False))
    listed = F.transform(split_clean(element, "[;,]"), capitalise)
    return F.when(crystal | _crystal_number(number), F.array(F.lit(CRYSTAL))).otherwise(
        F.coalesce(listed, no_strings())
    )


def row_type(kind: Column, number: Column) -> Column:
    """Type attribute, or crystal when the code says so."""
    return F.when(_crystal_number(number), F.lit(CRYSTAL)).otherwise(kind)


def is_non_card(kind: Column, attrs: Column) -> Column:
    """A row with a type other than sealed product, or with any code, power or job, is a card."""
    typed = F.coalesce(F.lower(kind) != "sealed product", F.lit(False))
    return ~(typed | has_any_attribute(attrs, ["Number", "Power", "Job"]))


def is_source_crystal(kind: Column, code: Column) -> Column:
    """Second-source rule: exact type or code prefix."""
    return F.coalesce(kind == CRYSTAL, F.lit(False)) | F.coalesce(code.startswith("C-"), F.lit(False))


def source_elements(kind: Column, code: Column, element: Column) -> Column:
    return F.when(is_source_crystal(kind, code), F.array(F.lit(CRYSTAL))).otherwise(
        translate_all(F.coalesce(element, no_strings()), ELEMENTS)
    )


def source_type(kind: Column, code: Column) -> Column:
    return F.when(is_source_crystal(kind, code), F.lit(CRYSTAL)).otherwise(kind)


def source_job(kind: Column, job: Column) -> Column:
    """Summons have no job."""
    return F.when(kind == "Summon", F.lit("")).otherwise(F.coalesce(job, F.lit("")))
