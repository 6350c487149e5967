"""Matching rows of two sources by codes.

All operators reduce the right side to one row per look-up key before the join, so the join never
multiplies rows: the left side fans out to its own keys and nothing else, whatever share of either
source one code holds.  Codes that hold more than ``HOT_SHARE`` of the probes are named by a sketch of bounded size
first; only they are spread over ``SALTS`` tasks, and only their index rows are repeated.  As the join is then on more
than the index is grouped by, both sides have an exchange right below it, and the adaptive skew join splits what is still
too large.  The closing aggregate reduces before its shuffle.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.arrays import fan_out, normalise_set_name

ANY, NO_SET, SET = "any", "no_set", "set"
SALTS = 8
HOT_SHARE = 1 / 256


def hot_codes(probes: DataFrame, code: str, share: float = HOT_SHARE) -> list[str]:
    """The codes with more than ``share`` of all probes, and perhaps some that nearly have it.

    A frequent-items sketch: its size, and that of the list, depend on ``share`` alone; it never misses one.
    """
    found = probes.agg(F.count(code).alias("n"), F.expr(f"approx_top_k({code}, {int(1 / share)}, {int(16 / share)})").alias("top")).first()
    return sorted(x["item"] for x in found.top if x["count"] > found.n * share) if found.n else []


def _look_up(probes: DataFrame, index: DataFrame, left_id: str, keys: list[str]) -> DataFrame:
    """Join on unique index keys, hot ones spread over ``SALTS`` tasks.

    Hot is what the join sends to one task: the whole key.  The index is sorted, not broadcast: it holds rows of a fan-out,
    whose size Spark guesses from the files below it.
    """
    at = F.col(keys[0]) if len(keys) == 1 else F.xxhash64(*keys)
    hot = hot_codes(probes.select(at.alias("_key")), "_key")
    is_hot = at.isin(hot) if hot else F.lit(False)
    own = F.pmod(F.xxhash64(left_id), F.lit(SALTS)).cast("int")
    salted = probes.withColumn("_salt", F.when(is_hot, own).otherwise(0))
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    repeated = index.withColumn("_salt", F.explode(salts)) if hot else index.withColumn("_salt", F.lit(0))
    return salted.join(repeated.hint("merge"), [*keys, "_salt"]).drop("_salt")


def _place(scope: str, name: Column | None = None) -> Column:
    """Where a right row can be found besides its code: anywhere, without a set, or under a set name."""
    return F.named_struct(F.lit("scope"), F.lit(scope), F.lit("name"), F.lit("") if name is None else name)


def _set_places(sets: str, otherwise: str) -> Column:
    names = F.array_distinct(F.transform(F.array_compact(sets), normalise_set_name))
    return F.when(F.col(sets).isNull(), F.array(_place(otherwise))).otherwise(
        F.transform(names, lambda s: _place(SET, s))
    )


def first_match(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    left_keys: str,
    left_sets: str,
    right_id: str,
    right_keys: str,
    right_sets: str,
) -> DataFrame:
    """First right row in id order that shares a key and a set with the left row.

    The set test passes when either set column is null; an empty set column overlaps nothing.
    Result: ``left_id, right_id`` of matched rows.
    """
    places = F.concat(F.array(_place(ANY)), _set_places(right_sets, otherwise=NO_SET))
    found_at = right.select(right_id, F.col(right_keys).alias("_keys"), places.alias("_places"))
    index = (
        fan_out(found_at, F.col("_keys"), "code", right_id, "_places")
        .select(right_id, "code", F.inline_outer("_places"))
        .groupBy("code", "scope", "name")
        .agg(F.min(right_id).alias(right_id))
    )
    asked = F.when(F.col(left_sets).isNull(), F.array(_place(ANY))).otherwise(
        F.concat(F.array(_place(NO_SET)), _set_places(left_sets, otherwise=NO_SET))
    )
    asking = left.select(left_id, F.col(left_keys).alias("_keys"), asked.alias("_asked"))
    probes = fan_out(asking, F.col("_keys"), "code", left_id, "_asked").select(
        left_id, "code", F.inline_outer("_asked")
    )
    return (
        _look_up(probes, index, left_id, ["code", "scope", "name"]).groupBy(left_id).agg(F.min(right_id).alias(right_id))
    )


def tiered_match(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    exact: str,
    loose: str,
    right_id: str,
    right_exact: str,
    right_loose: str,
) -> DataFrame:
    """Exact key first (in the left row's own key order), then any loose key (in right id order).

    ``exact`` and ``loose`` are arrays of the left row; ``right_exact`` is one key and ``right_loose``
    an array of the right row.  Result: ``left_id, right_id, tier``.
    """
    exact_index = right.groupBy(F.col(right_exact).alias("_key")).agg(F.min(right_id).alias(right_id))
    asked = left.select(left_id, F.posexplode_outer(exact).alias("_pos", "_key")).where(F.col("_key").isNotNull())
    tier1 = _look_up(asked, exact_index, left_id, ["_key"]).select(left_id, F.lit(1).alias("tier"), F.col("_pos"), right_id)
    loose_index = (
        fan_out(right, F.col(right_loose), "_key", right_id).groupBy("_key").agg(F.min(right_id).alias(right_id))
    )
    tier2 = _look_up(fan_out(left, F.col(loose), "_key", left_id), loose_index, left_id, ["_key"])
    tier2 = tier2.select(left_id, F.lit(2).alias("tier"), F.lit(0).alias("_pos"), right_id)
    best = tier1.unionByName(tier2).groupBy(left_id).agg(F.min(F.struct("tier", "_pos", right_id)).alias("_best"))
    return best.select(left_id, F.col(f"_best.{right_id}").alias(right_id), F.col("_best.tier").alias("tier"))


def _agreement_key(properties: tuple[str, ...], prefix: str = "") -> tuple[Column, Column]:
    """(all given, joint value) of some properties."""
    given = F.lit(True)
    for p in properties:
        given = given & F.col(prefix + p).isNotNull()
    return given, F.array(*[F.col(prefix + p).cast("string") for p in properties])


def _stem_probes(
    df: DataFrame, row_id: str, stems: Column, properties: list[str], sizes: range, keep: list[str] | None = None
) -> DataFrame:
    """One row per (row, stem, subset of at least two given properties) with the joint value."""
    subsets = []
    for size in sizes:
        for subset in combinations(properties, size):
            given, joint = _agreement_key(subset)
            entry = F.named_struct(
                F.lit("subset"), F.lit("+".join(subset)), F.lit("size"), F.lit(size), F.lit("joint"), joint
            )
            subsets.append(F.when(given, entry))
    kept = [row_id, *(keep or [])]
    ready = df.select(*kept, stems.alias("_stems"), F.array_compact(F.array(*subsets)).alias("_subsets"))
    fanned = fan_out(ready, F.col("_stems"), "stem", *kept, "_subsets")
    return fanned.select(*kept, "stem", F.inline_outer("_subsets")).where(F.col("subset").isNotNull())


def scored_match(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    left_stems: str,
    right_id: str,
    right_stem: str,
    properties: list[str],
) -> DataFrame:
    """Number and first of the right rows with an equal code stem and at least two equal properties.

    A property missing on either side never counts.  Rows are counted through every pair, triple and
    the quadruple of properties and the overlaps are taken out again (inclusion and exclusion for
    "at least two"), so no pair of rows is ever formed.  Result: ``left_id, n_matches, right_id``.
    """
    if len(properties) != 4:
        raise ValueError("the score is defined over four properties")
    sizes = range(2, 5)
    # equal right rows are folded into one before they fan out to their subsets
    profiles = right.groupBy(right_stem, *properties).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(right_id).alias(right_id)
    )
    index = (
        _stem_probes(profiles, right_id, F.array(right_stem), properties, sizes, keep=["_rows"])
        .groupBy("stem", "subset", "joint")
        .agg(F.sum("_rows").alias("_n"), F.min(right_id).alias(right_id))
    )
    probes = _stem_probes(left, left_id, F.array_distinct(left_stems), properties, sizes)
    weight = F.when(F.col("size") == 2, 1).when(F.col("size") == 3, -2).otherwise(3)
    return (
        _look_up(probes, index, left_id, ["stem", "subset", "joint"])
        .groupBy(left_id)
        .agg(F.sum(F.col("_n") * weight).alias("n_matches"), F.min(right_id).alias(right_id))
    )
