"""Field-by-field merging of a matched second source into the catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StringType

from ..functions.arrays import computed_once, first_where, no_strings, ordered_union, same_members, split_clean
from ..functions.codes import REPRINT, is_promo, is_valid_source_code
from ..functions.elements import rarity_label, source_elements, source_type
from ..functions.labels import join_labels, merged_categories
from ..functions.names import has_special_remark
from ..functions.text import is_blank
from ..functions.texts import preferred_text
from ..functions.urls import ImagePolicy
from ..schemas import nullable

OVERWRITE, FILL_EMPTY, PREFER_SOURCE, KEEP = "overwrite", "fill_empty", "prefer_source", "keep"

# Which source wins for each plain field.
CARD_RULES = {
    "card_type": OVERWRITE,
    "job": OVERWRITE,
    "rarity": OVERWRITE,
    "set": OVERWRITE,
    "elements": OVERWRITE,
    "cost": OVERWRITE,
    "power": OVERWRITE,
}

# The documented variant, in which the source only fills missing figures.
FILL_FIGURES = {**CARD_RULES, "cost": FILL_EMPTY, "power": FILL_EMPTY}


def is_empty(col: Column, data_type) -> Column:
    """Null, an empty array or a blank text."""
    if isinstance(data_type, ArrayType):
        return F.coalesce(F.size(col) == 0, F.lit(True))
    if isinstance(data_type, StringType):
        return is_blank(col)
    return col.isNull()


def merged_value(rule: str, current: Column, source: Column, data_type) -> Column:
    """Value of one field under a rule; equal arrays keep the stored order and spelling."""
    source = source.cast(data_type)
    if rule == KEEP:
        return current
    if rule == FILL_EMPTY:
        return F.when(is_empty(current, data_type), source).otherwise(current)
    if rule == PREFER_SOURCE:
        return F.when(is_empty(source, data_type), current).otherwise(source)
    if isinstance(data_type, ArrayType):
        return F.when(same_members(current, source), current).otherwise(source)
    return source


def merge_by_rules(left: DataFrame, right: DataFrame, key: str, rules: dict[str, str]) -> DataFrame:
    """Left join on a unique key; one ``select`` computes every ruled field of the matched rows.

    Adds ``changed_fields``: the ruled fields whose value is really different now.
    """
    source = right.select(
        F.col(key).alias("_key"), F.lit(True).alias("_hit"), *[F.col(f).alias(f"_s_{f}") for f in rules]
    )
    joined = left.join(source, left[key] == source["_key"], "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    types = {f.name: nullable(f.dataType) for f in left.schema.fields}
    new = {
        f: F.when(hit, merged_value(rule, left[f], F.col(f"_s_{f}"), types[f])).otherwise(left[f])
        for f, rule in rules.items()
    }
    changed = F.array_compact(
        F.array(*[F.when(~value.eqNullSafe(left[f]), F.lit(f)) for f, value in new.items()])
    )
    return joined.select(
        *[(new[c] if c in new else left[c]).alias(c) for c in left.columns], changed.alias("changed_fields")
    )


def card_updates(
    cards: DataFrame,
    matches: DataFrame,
    source: DataFrame,
    card_id: str,
    source_id: str,
    policy: ImagePolicy,
    rules: dict[str, str] | None = None,
) -> DataFrame:
    """Matched cards with every field merged, and ``changed_fields``; rows without a change are left out.

    ``matches`` has one row per matched card.  The card table is joined to it by its own key, the
    source by its own, both of them unique.
    """
    rules = rules or CARD_RULES
    types = {f.name: nullable(f.dataType) for f in cards.schema.fields}
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in source.columns])
    paired = cards.join(matches.select(card_id, F.col(source_id).alias("_sid")), card_id)
    joined = paired.join(s, F.col("_sid") == F.col(f"s_{source_id}"))

    non_card = F.coalesce(F.col("is_non_card"), F.lit(False))
    typed = F.coalesce(F.col("s_type") != "", F.lit(False))
    only_codes = non_card & ~typed
    promo = is_promo(F.col("card_numbers"))
    labels = merged_categories(F.col("s_category_1"), F.col("s_category_2"))
    valid = F.filter(split_clean(F.col("s_code"), "/"), is_valid_source_code)
    has_codes = ~non_card & (F.size("_valid") > 0)
    reprints = F.filter(F.coalesce(F.col("card_numbers"), no_strings()), lambda c: c.startswith(REPRINT))
    merged_codes = ordered_union(F.col("_valid"), reprints)
    lead = F.coalesce(first_where(F.col("_valid"), lambda c: ~c.startswith(REPRINT)), F.get("_valid", 0))

    # computed once, used by several fields
    joined = joined.withColumn("_valid", valid).withColumn("_labels", labels)

    given = {
        "card_type": source_type(F.col("s_type"), F.col("s_code")),
        "job": F.when(F.col("s_type") == "Summon", F.lit("")).otherwise(F.col("s_job")),
        "rarity": rarity_label(F.col("s_rarity"), promo),
        "set": F.coalesce(F.col("s_set"), no_strings()),
        "elements": source_elements(F.col("s_type"), F.col("s_code"), F.col("s_element")),
        "cost": F.col("s_cost"),
        "power": F.col("s_power"),
    }
    new = {}
    for field, rule in rules.items():
        forced = field in ("card_type", "elements")  # a row wrongly taken for a non-card is put right
        value = merged_value(rule, F.col(field), given[field], types[field])
        if forced:
            value = F.when(non_card & typed, given[field].cast(types[field])).otherwise(value)
        new[field] = F.when(only_codes, F.col(field)).otherwise(value)
    for figure in ("cost", "power"):
        new[figure] = F.coalesce(new[figure], F.when(F.col(figure).isNull(), given[figure].cast(types[figure])))
    has_labels = ~only_codes & (F.size("_labels") > 0)
    images = ~non_card & (F.size("s_images.full") > 0) & (F.size("s_images.thumbs") > 0)
    full_image = F.when(images, F.get("s_images.full", 0))
    thumb_image = F.when(images, F.get("s_images.thumbs", 0))
    placeholder = F.lit(policy.placeholder_url)
    new |= {
        "is_non_card": F.col("is_non_card") & ~typed,
        "name": F.when(only_codes | promo | has_special_remark(F.col("name")), F.col("name")).otherwise(F.col("s_name")),
        "categories": F.when(has_labels, F.col("_labels")).otherwise(F.col("categories")),
        "category": F.when(has_labels, join_labels(F.col("_labels"))).otherwise(F.col("category")),
        "card_numbers": F.when(has_codes, merged_codes),
        "full_card_number": F.when(has_codes, F.array_join(merged_codes, "/")),
        "primary_card_number": F.when(has_codes, lead),
        "number": F.when(has_codes, lead),
        "description": F.when(only_codes, F.col("description")).otherwise(
            preferred_text(F.col("description"), F.col("s_text"))
        ),
        "full_res_url": F.coalesce(F.col("full_res_url"), full_image, placeholder),
        "high_res_url": F.coalesce(F.col("high_res_url"), full_image, placeholder),
        "low_res_url": F.coalesce(F.col("low_res_url"), thumb_image, placeholder),
    }
    fields = [f for f in cards.columns if f in new]
    computed = joined.select(
        card_id, F.col("_sid").alias(source_id), *[new[f].cast(types[f]).alias(f) for f in fields],
        *[F.col(f).alias(f"_old_{f}") for f in fields],
    )
    changed = F.array_compact(
        F.array(*[F.when(~F.col(f).eqNullSafe(F.col(f"_old_{f}")), F.lit(f)) for f in fields])
    )
    return (
        computed_once(computed, changed, "changed_fields")
        .where(F.size("changed_fields") > 0)
        .select(card_id, source_id, *fields, "changed_fields")
    )


def compare_fields(pairs: DataFrame, key: str, fields: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Side-by-side report of a joined pair: ``key, field, left_value, right_value, equal``."""
    rows = [
        F.struct(
            F.lit(name).alias("field"),
            left.cast("string").alias("left_value"),
            right.cast("string").alias("right_value"),
            left.cast("string").eqNullSafe(right.cast("string")).alias("equal"),
        )
        for name, (left, right) in fields.items()
    ]
    return pairs.select(key, F.explode(F.array(*rows)).alias("_c")).select(key, "_c.*")
