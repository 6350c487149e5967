"""Search terms: prefixes of names and of codes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .arrays import no_strings
from .text import SPACE_CHARS, let, strip


def _prefixes(text: Column, start: int | Column = 1) -> Column:
    """Prefixes of lengths ``start .. length``; empty when the text is shorter."""
    first = F.lit(start) if isinstance(start, int) else start
    return F.when(
        F.length(text) >= first,
        F.transform(F.sequence(first, F.length(text)), lambda n: F.substring(text, F.lit(1), n)),
    ).otherwise(no_strings())


def name_terms(text: Column) -> Column:
    """All prefixes of the lower-cased, stripped text, the whole text included."""
    given = F.when(F.coalesce(text, F.lit("")) != "", strip(F.lower(text)))
    # a text of blanks keeps its single empty term
    return let(
        given,
        lambda t: F.when(t.isNull(), no_strings()).when(t == "", F.array(F.lit(""))).otherwise(_prefixes(t)),
    )


def _one_code(code: Column) -> Column:
    head = F.substring_index(code, "-", 1)
    tail = F.get(F.split(code, "-", -1), 1)
    hyphened = F.concat(
        F.array(F.substring(code, 1, 1)),
        F.when(
            head != "",
            F.concat(
                F.array(head),
                _prefixes(F.concat(head, F.lit("-"), tail), F.length(head) + 1),
                F.when(head == "re", F.array(code)).otherwise(no_strings()),
            ),
        ).otherwise(no_strings()),
    )
    plain = F.array(F.substring(code, 1, 1), code)
    return F.when(code == "", F.array(F.lit(""))).when(code.contains("-"), hyphened).otherwise(plain)


def code_terms(codes: Column) -> Column:
    """First character, part before the hyphen with and without it, growing part after it.

    Only the first two hyphen parts count, except that a reprint code is also a term as a whole.
    """
    given = F.filter(F.coalesce(codes, no_strings()), lambda c: c.isNotNull() & (c != ""))
    clean = F.transform(given, lambda c: F.translate(F.lower(c), SPACE_CHARS, ""))
    return F.array_distinct(F.flatten(F.transform(clean, _one_code)))


def search_terms(name: Column, codes: Column) -> Column:
    """Distinct name and code terms, sorted."""
    return F.array_sort(F.array_distinct(F.concat(name_terms(name), code_terms(codes))))
