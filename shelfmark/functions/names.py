"""Product names: search form, display form, repair of stored names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .arrays import no_strings
from .text import SPACE, WORD_END, WORD_START, extract, let, replace_first_each, squeeze, strip

_DASH = "[-–—]"
_BEFORE_PAREN = rf"(?={SPACE}*\(|\z)"

# What is stripped from a name to get its search form, in this order, first match only.
SEARCH_STRIPS = [
    rf"{SPACE}*{_DASH}{SPACE}*PR-?\d+/[^(\s]+",
    rf"{SPACE}*{_DASH}{SPACE}*PR-?\d+",
    rf"{SPACE}*{_DASH}{SPACE}*\d{{1,2}}-\d{{3}}[A-Z]",
    rf"{SPACE}*{_DASH}{SPACE}*[A-C]-\d{{3}}",
    rf"{SPACE}*{_DASH}{SPACE}*PR{WORD_END}",
]

# What is stripped from a name to get its display form, in this order, first match only.
DISPLAY_STRIPS = [
    rf"{SPACE}*\(PR-?\d+\)",
    rf"{SPACE}*\(\d{{1,2}}-\d{{3}}[A-Z]\)",
    rf"{SPACE}*\([A-C]-\d{{3}}\)",
    rf"(?:{SPACE}*{_DASH}{SPACE}*PR)?-?\d+/[^(\s]+{_BEFORE_PAREN}",
    rf"{SPACE}*{_DASH}{SPACE}*PR-?\d+{_BEFORE_PAREN}",
    rf"{SPACE}*{_DASH}{SPACE}*\d{{1,2}}-\d{{3}}[A-Z]{_BEFORE_PAREN}",
    rf"{SPACE}*{_DASH}{SPACE}*[A-C]-\d{{3}}{_BEFORE_PAREN}",
    rf"{SPACE}*{_DASH}{SPACE}*PR{WORD_END}",
    rf"{SPACE}*{_DASH}{SPACE}*\d+[^(\s]*{_BEFORE_PAREN}",
]

# Parenthesised remarks that stay in a display name.
KEPT_REMARKS = [
    "Full Art",
    "Promo",
    "Road to World Championship",
    "Champion",
    "Anniversary",
    "Prerelease Promo",
    "Alternate Art Promo",
    "Full Art Reprint",
    "Buy A Box Promo",
    "Class Zero Cadet",
]

# Month names.
MONTHS = [
    "January",
    "February",
    "March",
    "April",
    "May",
    "June",
    "July",
    "August",
    "September",
    "October",
    "November",
    "December",
]

# Remarks that mark a name as special.
SPECIAL_REMARKS = r"(?i)Full Art|Promo|Road|Champion|Anniversary"

_DROPPED_REMARK = (
    r"^(?:Common|Rare|PR-?\d+|PR|PR-.*|\d{1,2}|\d{1,2}-\d{3}[A-Z]|[A-C]|[A-C]-\d{3})\z"
)
_ANY_MONTH = "(?:" + "|".join(MONTHS) + ")"
_KEPT_REMARK = "|".join(KEPT_REMARKS) + rf"|^{_ANY_MONTH}{SPACE}+\d{{4}}\z"
_YEAR = rf"{WORD_START}\d{{4}}{WORD_END}"
_DANGLING = r"\([A-C1-9](?!\))"
_DANGLING_TAIL = rf"{SPACE}*\([A-C1-9][^)]*\z"
_NESTED_REMARK = rf"^\d+{SPACE}+\((.+)\z"


def search_name(name: Column) -> Column:
    """Name without codes and remarks; an ``EX`` or ``LB`` mark lost that way is put back."""

    def without_remarks(bare: Column) -> Column:
        mark = F.when(bare.rlike("EX|LB"), extract(bare, rf"{WORD_START}(EX|LB){WORD_END}"))
        clean = F.when(bare.contains("("), strip(F.regexp_replace(bare, rf"{SPACE}*\([^)]+\)", ""))).otherwise(bare)
        return let(
            F.struct(clean.alias("clean"), mark.alias("mark")),
            lambda x: F.when(x["clean"].contains(x["mark"]), x["clean"]).otherwise(F.concat_ws(" ", x["clean"], x["mark"])),
        )

    return let(strip(replace_first_each(name, SEARCH_STRIPS, _DASH)), without_remarks)


def _cut_dangling(col: Column) -> Column:
    return F.when(col.rlike(_DANGLING), strip(F.regexp_replace(col, _DANGLING_TAIL, ""))).otherwise(col)


def _kept_remark(remark: Column) -> Column:
    inner = F.when(
        ~remark.rlike(_DROPPED_REMARK) & (remark != ""),
        F.when(remark.rlike(_NESTED_REMARK), F.regexp_extract(remark, _NESTED_REMARK, 1)).when(
            remark.rlike(_KEPT_REMARK) | (remark.rlike(_YEAR) & ~remark.rlike(r"^\d+\z")), remark
        ),
    )
    return F.concat(F.lit("("), inner, F.lit(")"))


def display_name(name: Column, codes: Column) -> Column:
    """Name without codes, with the remarks worth showing; a bare promotional name gains ``(Promo)``."""
    promo = F.coalesce(F.exists(codes, lambda c: c.startswith("PR-")), F.lit(False)) | name.rlike(
        r"PR-?\d+"
    )

    def assemble(bare: Column) -> Column:
        base = F.regexp_replace(bare, rf"(?s){SPACE}*\((?-s:.*?)\).*\z", "")
        found = F.regexp_extract_all(bare, F.lit(r"\((.*?)\)"), F.lit(1))
        remarks = F.when(bare.contains("("), F.array_compact(F.transform(found, _kept_remark))).otherwise(no_strings())
        return let(
            remarks,
            lambda kept: F.concat_ws(" ", base, kept, F.when(promo & (F.size(kept) == 0), F.lit("(Promo)"))),
        )

    bare = replace_first_each(name, DISPLAY_STRIPS[:3], r"\((?:PR|\d|[A-C]-)")
    bare = let(bare, lambda n: strip(replace_first_each(n, DISPLAY_STRIPS[3:], "[-–—/]")))
    return squeeze(let(let(bare, _cut_dangling), assemble))


def has_special_remark(name: Column) -> Column:
    """The name has a parenthesis and one of the special remarks anywhere."""
    return name.rlike(r"\(.*?\)") & name.rlike(SPECIAL_REMARKS)


def repaired_name(name: Column) -> Column:
    """Repair stored names with an unfinished parenthesis; everything else is returned unchanged.

    ``X (19 (Full Art)`` becomes ``X (Full Art)``; ``X (1`` becomes ``X``.  Names that carry a kept
    remark, a month remark or a month with a year are left alone unless they have the nested form.
    """
    nested = rf"^(.*?){SPACE}*\(\d+{SPACE}+\((.*?)\)\z"
    kept = "|".join(rf"\({k}\)" for k in KEPT_REMARKS) + rf"|\({_ANY_MONTH}"
    month_year = name.rlike(_ANY_MONTH) & name.rlike(_YEAR)
    return (
        F.when(name.rlike(nested) & ~month_year, F.regexp_replace(name, nested, "$1 ($2)"))
        .when(name.rlike(_DANGLING) & ~name.rlike(kept) & ~month_year, _cut_dangling(name))
        .otherwise(name)
    )
