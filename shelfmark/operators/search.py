"""Search index: term lists on rows, and the inverted table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.arrays import fan_out
from ..functions.fingerprints import terms_fingerprint
from ..functions.terms import search_terms
from ..functions.text import strip
from .changes import change_kind, classify


def is_searchable(name: str = "clean_name", codes: str = "card_numbers", non_card: str = "is_non_card") -> Column:
    """Rows with a code list; a card also needs a name."""
    named = F.coalesce(F.col(name), F.lit("")) != ""
    return F.col(codes).isNotNull() & (F.coalesce(F.col(non_card), F.lit(False)) | named)


def with_terms(df: DataFrame, name: str = "clean_name", codes: str = "card_numbers") -> DataFrame:
    """Eligible rows with their sorted terms and the fingerprint of the terms."""
    eligible = df.where(is_searchable(name, codes))
    listed = eligible.withColumn("search_terms", search_terms(F.col(name), F.col(codes)))
    return listed.withColumn("search_hash", terms_fingerprint(F.col("search_terms")))


def refresh_terms(cards: DataFrame, key: str, stored: DataFrame, force: bool = False) -> DataFrame:
    """Term lists with ``change_kind``; rows whose stored list is missing count as unstamped.

    ``stored`` has the key, ``search_hash`` and ``search_terms`` of the last refresh.
    """
    fresh = with_terms(cards).select(key, "search_terms", "search_hash")
    return classify(fresh, stored, key, "search_hash", derived_col="search_terms", force=force)


def refresh_in_place(cards: DataFrame, key: str, force: bool = False, name: str = "clean_name", codes: str = "card_numbers") -> DataFrame:
    """``refresh_terms`` for a table that holds its own terms and fingerprint: columns of one row, no join."""
    terms = search_terms(F.col(name), F.col(codes))
    fresh = cards.where(is_searchable(name, codes)).withColumn("_terms", terms)
    fresh = fresh.withColumn("_hash", terms_fingerprint(F.col("_terms")))
    kind = change_kind(F.lit(True), F.col("_hash"), F.col("search_hash"), derived=F.col("search_terms"), force=force)
    return fresh.select(
        key, F.col("_terms").alias("search_terms"), F.col("_hash").alias("search_hash"), kind.alias("change_kind")
    )


def inverted_index(df: DataFrame, key: str, terms: str = "search_terms", keep: list[str] | None = None) -> DataFrame:
    """``initial, term, key``: one row per posting.

    Postings stay with their row: no shuffle, and a term that many rows share is spread over all of them
    instead of being gathered in one list.  The full run keeps them in the hash buckets of the rows,
    sorted by term, and rebuilds only the buckets of changed rows.
    """
    postings = fan_out(df, F.col(terms), "term", key, *(keep or []))
    return postings.select(F.substring("term", 1, 1).alias("initial"), "term", key, *(keep or []))


def term_counts(index: DataFrame) -> DataFrame:
    return index.groupBy("term").agg(F.count(F.lit(1)).alias("n_rows"))


def search_index(index: DataFrame, query: str, key: str, n: int | None = None) -> DataFrame:
    """Keys under one term of the inverted table: pushed equalities, then top-n."""
    term = query.strip().lower()
    hits = index.where((F.col("initial") == term[:1]) & (F.col("term") == term)).select(key)
    return hits if n is None else hits.orderBy(key).limit(n)


def search(df: DataFrame, query: str, key: str, n: int | None = None, exact: bool = False,
           codes: str = "card_numbers", terms: str = "search_terms") -> DataFrame:
    """Rows whose term list has the query; with ``exact`` only rows with that very code."""
    term = query.strip().lower()
    hits = df.where(F.array_contains(terms, term))
    if exact:
        hits = hits.where(F.exists(codes, lambda c: F.lower(strip(c)) == term))
    return hits if n is None else hits.orderBy(key).limit(n)
