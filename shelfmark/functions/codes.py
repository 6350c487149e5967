"""Product codes: normal form, validation, lists of codes, comparison form, composite keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .arrays import first_where, split_clean
from .attributes import attribute_values
from .text import SPACE_CHARS, extract, let, strip

# The accepted code formats and the marks of reprints and promotional codes.
VALID_CODE = r"^(?:PR-\d{3}|\d{1,2}-\d{3}[A-Z]|[ABC]-\d{3}|Re-\d{3}[A-Z])\z"
VALID_SOURCE_CODE = r"^(?:PR-\d{3}|[1-9]\d?-\d{3}[A-Z]|[ABC]-\d{3}|Re-\d{3}[A-Z])\z"
PROMO_CODE = r"^(?:PR?|A)-\d{3}"
PROMO_REMAINDER = r"PR-\d+/(.+)"
REPRINT = "Re-"


def is_valid_code(col: Column) -> Column:
    return col.rlike(VALID_CODE)


def is_valid_source_code(col: Column) -> Column:
    """As ``is_valid_code``, but a numeric prefix may not begin with zero."""
    return col.rlike(VALID_SOURCE_CODE)


def comparison_form(col: Column) -> Column:
    """Separators and blanks removed, upper case: two spellings of one code become equal."""
    return F.upper(F.translate(col, "-.,;/" + SPACE_CHARS, ""))


def _compact(col: Column) -> Column:
    return F.upper(F.translate(col, "-.,;" + SPACE_CHARS, ""))


def _padded(prefix: str, clean: Column, pattern: str) -> Column:
    # lpad of null is null, and so is the concatenation: no match gives no code
    return F.concat(F.lit(prefix), F.lpad(extract(clean, pattern), 3, "0"))


def _from_compact(clean: Column) -> Column:
    reprint = r"^RE0*(\d{1,3})([A-Z])\z"
    numbered = r"^(\d?[1-9]|[1-9]0)(\d{3})([A-Z])\z"
    first = F.substring(clean, 1, 1)
    return (
        F.when(first == "P", _padded("PR-", clean, r"^PR?0*(\d{1,3})"))
        .when(
            first.isin("A", "B", "C"),
            F.concat(first, F.lit("-"), _padded("", clean, r"^[ABC]0*(\d{1,3})")),
        )
        .when(first == "R", F.concat(_padded(REPRINT, clean, reprint), F.regexp_extract(clean, reprint, 2)))
        .when(clean.rlike(numbered), F.regexp_replace(clean, numbered, "$1-$2$3"))
    )


def normalise_code(col: Column) -> Column:
    """Normal form of one code text, or null when it fits no known format."""
    return _from_compact(_compact(col))


def normalise_codes(arr: Column) -> Column:
    """Normal forms of an array of code texts, unusable ones dropped, order kept."""
    return F.array_compact(F.transform(F.transform(arr, _compact), _from_compact))


def loose_code(col: Column) -> Column:
    """Forgiving normal form: the closing letter is optional and an unknown format passes through."""
    clean = comparison_form(col)
    numbered = r"^(\d{1,2})(\d{3})([A-Z]?)\z"
    return F.coalesce(
        _padded("PR-", clean, r"^PR0*(\d{1,3})"),
        F.concat(F.lit("A-"), extract(clean, r"^A(\d{3})")),
        F.when(clean.rlike(numbered), F.regexp_replace(clean, numbered, "$1-$2$3")),
        clean,
    )


def code_stem(col: Column) -> Column:
    """A code without its closing letter."""
    return F.regexp_replace(col, r"[A-Z]\z", "")


def row_codes(attrs: Column, name: str = "Number") -> Column:
    """All codes of a row: every such attribute, split on ``, ; /``; null when none is usable."""
    texts = F.flatten(F.transform(attribute_values(attrs, name), lambda v: F.split(v, "[,;/]", -1)))
    return let(F.array_distinct(normalise_codes(texts)), lambda c: F.when(F.size(c) > 0, c))


def primary_code(codes: Column) -> Column:
    """First code that is no reprint, else the last, else the first that is valid."""

    def valid(c: Column) -> Column:
        return F.when(is_valid_code(c), c)

    return F.coalesce(
        valid(first_where(codes, lambda c: ~c.startswith(REPRINT))),
        valid(F.element_at(codes, -1)),
        first_where(codes, is_valid_code),
    )


def full_code(codes: Column) -> Column:
    return F.array_join(codes, "/")


def is_promo(codes: Column) -> Column:
    """Any code in a promotional format; a null list is not promotional."""
    return F.coalesce(F.exists(codes, lambda c: c.rlike(PROMO_CODE)), F.lit(False))


def source_codes(code: Column) -> Column:
    """Codes of a combined source code text, sorted."""
    return F.array_sort(split_clean(code, "/"))


def repaired_codes(codes: Column, full: Column) -> Column:
    """Append the reprint code found in the full code when the list lacks it."""
    reprint = extract(full, r"(Re-\d{3}[A-Z])")
    base = F.coalesce(codes, F.array().cast("array<string>"))
    return F.when(reprint.isNull() | F.array_contains(base, reprint), codes).otherwise(
        F.array_append(base, reprint)
    )


def composite_key(code: Column, sets: Column) -> Column:
    """``code;code_FirstSet``: the code with slashes made safe and the first set's letters and digits."""
    first_set = F.coalesce(F.nullif(F.get(sets, 0), F.lit("")), F.lit("Unknown"))
    return F.concat(
        F.replace(code, F.lit("/"), F.lit(";")),
        F.lit("_"),
        F.regexp_replace(first_set, "[^a-zA-Z0-9]", ""),
    )


def code_of_key(key: Column) -> Column:
    return F.replace(F.substring_index(key, "_", 1), F.lit(";"), F.lit("/"))


def match_keys(codes: Column, full: Column, number: Column, primary: Column, is_non_card: Column) -> Column:
    """Comparison forms under which a row may be found.

    The whole full code always counts.  A promotional code counts only through what follows
    ``PR-n/``.  Rows that are no cards have no keys.
    """
    every = F.array_compact(
        F.concat(F.coalesce(codes, F.array().cast("array<string>")), F.array(full, number, primary))
    )
    usable = F.transform(
        every, lambda c: F.when(c.rlike(PROMO_CODE), extract(c, PROMO_REMAINDER)).otherwise(c)
    )
    keys = F.transform(F.array_compact(F.array_append(usable, full)), comparison_form)
    return F.when(~is_non_card, F.array_distinct(F.filter(keys, lambda k: k != "")))


def source_match_keys(code: Column) -> Column:
    """Comparison forms of a combined source code."""
    keys = F.transform(F.split(code, "/", -1), lambda c: comparison_form(strip(c)))
    return F.array_distinct(F.filter(keys, lambda k: k != ""))
