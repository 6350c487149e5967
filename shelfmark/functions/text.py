"""Text and number helpers, each a ``Column -> Column`` rule on built-in functions.

The feeds were written for an engine whose ``replace`` hits the first match only, whose white space
is Unicode and whose number parsing accepts a leading prefix.  These helpers give exactly that.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters a feed counts as white space.
SPACE_CHARS = (
    " \t\n\r\x0b\x0c\u00a0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000\ufeff"
)
SPACE = r"[ \t\n\r\x0B\f\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]"

# ASCII word bounds, independent of the JVM's own definition of ``\b``.
WORD_START = r"(?<![A-Za-z0-9_])(?=[A-Za-z0-9_])"
WORD_END = r"(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])"


def strip(col: Column) -> Column:
    """Remove leading and trailing Unicode white space (no regular expression)."""
    return F.btrim(col, F.lit(SPACE_CHARS))


def squeeze(col: Column) -> Column:
    """Collapse every run of white space to one blank, then strip."""
    return strip(F.regexp_replace(col, SPACE + "+", " "))


def blank_to_null(col: Column) -> Column:
    """Empty text counts as absent; text of blanks does not."""
    return F.nullif(col, F.lit(""))


def is_blank(col: Column) -> Column:
    """True for null, empty or white-space-only text."""
    return F.coalesce(strip(col) == "", F.lit(True))


def replace_first(col: Column, pattern: str, replacement: str = "") -> Column:
    """Replace only the leftmost match (Spark's ``regexp_replace`` replaces all of them).

    The expression matches from the first hit to the end of the text, so there is one hit, found
    at the speed of a plain search; what follows it is put back.
    """
    return F.regexp_replace(col, rf"{pattern}(?<rest>(?s:.*))\z", replacement + "${rest}")


def replace_first_each(col: Column, patterns: list[str], only_with: str | None = None) -> Column:
    """Drop the leftmost match of each pattern, one pattern after the other.

    ``only_with`` is a character class every match contains: texts without it are passed through.
    """
    out = col
    for pattern in patterns:
        out = replace_first(out, pattern)
    return out if only_with is None else F.when(col.rlike(only_with), out).otherwise(col)


def extract(col: Column, pattern: str, group: int = 1) -> Column:
    """``regexp_extract`` that yields null instead of empty text when nothing matches."""
    return blank_to_null(F.regexp_extract(col, pattern, group))


def capitalise(col: Column) -> Column:
    """First character upper, rest lower; inner blanks do not start a new word."""
    return F.concat(F.upper(F.substring(col, 1, 1)), F.lower(F.substring(col, 2, 2147483647)))


def title_case(col: Column) -> Column:
    """Every word capitalised, words separated by one blank."""
    return F.initcap(F.regexp_replace(F.lower(col), SPACE + "+", " "))


_NUMBER = r"^([+-]?(?:Infinity|(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?))"


def parse_number(col: Column) -> Column:
    """Lenient double: a leading numeric prefix is enough; empty or non-numeric text is null."""
    return extract(strip(col), _NUMBER).try_cast("double")


def parse_integer(col: Column) -> Column:
    """Lenient integer: a leading integer prefix is enough; zero and non-numeric text are null."""
    return F.nullif(extract(strip(col), r"^([+-]?\d+)").try_cast("bigint"), F.lit(0))


def cents(col: Column) -> Column:
    """Money to whole cents; halves go up, also below zero."""
    return F.floor(col.cast("double") * 100 + 0.5).cast("bigint")


def let(value: Column, body) -> Column:
    """Bind ``value`` once and use it many times inside ``body``.

    Only for array pipelines, which are higher-order functions anyway: the bound variable keeps the
    expression tree linear in size where plain substitution would double it at every use.
    """
    return F.get(F.transform(F.array(value), body), 0)
