"""Category labels: spelling rules, list forms, merging of two columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .arrays import move_to_front, no_strings, split_clean
from .text import let, title_case

MIDDOT = "·"
PRIORITY_LABEL = "DFF"

# Labels with a prescribed spelling, by their upper-case form.
FIXED_SPELLINGS = {
    "THEATRHYTHM": "Theatrhythm",
    "MOBIUS": "Mobius",
    "PICTLOGICA": "Pictlogica",
    "TYPE-0": "Type-0",
    "WORLD OF FINAL FANTASY": "WOFF",
    "LORD OF VERMILION": "LOV",
}

# Labels that stay in capitals, besides everything that begins with "FF".
ACRONYMS = ["DFF", "WOFF", "MQ", "LOV", "SOPFFO"]

# Roman numerals, the wide form up to 4999 and the narrow form up to 39.
ROMAN = {
    "wide": r"(?i)^M{0,4}(CM|CD|D?C{0,3})(XC|XL|L?X{0,3})(IX|IV|V?I{0,3})\z",
    "narrow": r"(?i)^(X{0,3})(IX|IV|V?I{0,3})\z",
}


def map_literal(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def normalise_label(col: Column, roman: str = "wide") -> Column:
    """Prescribed spelling, else Roman numeral in capitals, else shouted words in title case."""
    upper = F.upper(col)
    keep = col.isin(ACRONYMS) | col.startswith("FF")
    return (
        F.when(upper.isin(list(FIXED_SPELLINGS)), map_literal(FIXED_SPELLINGS)[upper])
        .when(col.rlike(ROMAN[roman]), upper)
        .when((col == upper) & (F.length(col) > 1) & ~keep, title_case(col))
        .otherwise(col)
    )


def label_list(col: Column, separators: str = "[;·]", roman: str = "wide") -> Column:
    """Split a delimited label text; parts are normalised, duplicates stay."""
    decoded = F.replace(col, F.lit("&middot;"), F.lit(MIDDOT))
    parts = F.transform(split_clean(decoded, separators), lambda c: normalise_label(c, roman))
    return F.coalesce(parts, no_strings())


def categories(col: Column) -> Column:
    """Labels of a marketplace row, the priority label first."""
    return let(label_list(col), lambda cats: move_to_front(cats, PRIORITY_LABEL))


def join_labels(arr: Column) -> Column:
    """Joined text form; null for an empty list."""
    return F.when(F.size(arr) > 0, F.array_join(arr, MIDDOT))


def merged_categories(first: Column, second: Column) -> Column:
    """Labels of two columns: those containing the priority label first, then the rest, deduplicated."""
    both = F.concat(label_list(first, MIDDOT, "narrow"), label_list(second, MIDDOT, "narrow"))
    return let(
        both,
        lambda cats: F.array_distinct(
            F.concat(F.filter(cats, lambda c: c.contains(PRIORITY_LABEL)), cats)
        ),
    )
