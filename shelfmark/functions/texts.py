"""Rules text: wording rules, markup translation, precedence of two sources."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .elements import ELEMENTS
from .text import SPACE, SPACE_CHARS, WORD_END, WORD_START, blank_to_null, is_blank, let, strip

# The cost word and the ability mark.
COST_WORD = "Dull"
ABILITY_MARK = "EX BURST"

# Markup of the second source.
MARKUP = {"[[br]]": "\n", "[[i]]": "<em>", "[[/]]": "</em>"}


def rules_text(col: Column, keep_cost_words: bool = False) -> Column:
    """Marketplace rules text: ability mark in capitals, cost word freed of tags and repetitions.

    Only a text with exactly one colon is split.  Left of it the bare cost word goes (unless it is
    all there is, or ``keep_cost_words``) and the bracketed one stays; right of it a doubled cost word
    becomes one and brackets go.
    """
    # plain searches first: long texts without the words are not put through the expressions
    def mark(text: Column) -> Column:
        marked = F.regexp_replace(text, rf"(?i){WORD_START}ex burst{WORD_END}", ABILITY_MARK)
        return F.when(F.lower(text).contains("ex burst"), marked).otherwise(text)

    def untag(text: Column) -> Column:
        plain = F.regexp_replace(text, rf"<[^>]+>{COST_WORD}</[^>]+>", COST_WORD)
        return F.when(text.contains(f"{COST_WORD}</"), plain).otherwise(text)

    def by_side(text: Column) -> Column:
        one_colon = F.length(F.replace(text, F.lit(":"), F.lit(""))) == F.length(text) - 1
        left = F.rtrim(F.substring_index(text, ":", 1), F.lit(SPACE_CHARS))
        right = F.ltrim(F.substring_index(text, ":", -1), F.lit(SPACE_CHARS))
        if not keep_cost_words:
            kept = ~left.contains(COST_WORD) | (strip(left) == COST_WORD)
            left = F.when(kept, left).otherwise(F.regexp_replace(left, bare_cost, ""))
        doubled = F.regexp_replace(right, rf"{WORD_START}{COST_WORD}{SPACE}+{COST_WORD}{WORD_END}", COST_WORD)
        right = F.when(right.contains(COST_WORD), doubled).otherwise(right)
        right = F.replace(right, F.lit(f"[{COST_WORD}]"), F.lit(COST_WORD))
        return F.when(one_colon, F.concat(left, F.lit(": "), right)).otherwise(text)

    bare_cost = (
        rf"(?<![A-Za-z0-9_\[]){COST_WORD}{WORD_END}|{WORD_START}{COST_WORD}(?![A-Za-z0-9_\]])"
    )
    return let(let(let(blank_to_null(col), mark), untag), by_side)


def translated_text(col: Column) -> Column:
    """Second-source rules text: markup and symbols translated, then the wording rules."""
    text = blank_to_null(col)
    for mark, replacement in MARKUP.items():
        text = F.replace(text, F.lit(mark), F.lit(replacement))
    for symbol, label in ELEMENTS.items():
        text = F.replace(text, F.lit(f"《{symbol}》"), F.lit(f"{{{label[0]}}}"))
    text = F.regexp_replace(text, "《(\\d+)》", "{$1}")
    return rules_text(text)


def length_ratio(processed: Column, original: Column) -> Column:
    """Share of the original length that survived; null for an empty original."""
    return F.length(processed) / F.nullif(F.length(original), F.lit(0))


def shrink_level(processed: Column, original: Column) -> Column:
    """``raw`` below half, ``warn`` below four fifths, else ``ok``."""
    kept = F.coalesce(F.length(processed), F.lit(0))
    size = F.length(original)
    return (
        F.when(kept * 2 < size, F.lit("raw"))
        .when(kept < F.floor(size * F.lit(0.8)), F.lit("warn"))
        .otherwise(F.lit("ok"))
    )


def preferred_text(own: Column, source: Column) -> Column:
    """Processed source text; the raw one if processing lost more than half; else own; else null."""

    def choose(processed: Column) -> Column:
        usable = ~is_blank(processed) & (F.length(processed) * 2 >= F.length(source))
        return (
            F.when(~is_blank(source), F.when(usable, processed).otherwise(source))
            .otherwise(blank_to_null(own))
        )

    return let(translated_text(source), choose)
