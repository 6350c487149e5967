"""Mixing sources to target weights: hierarchical budgets and seeded epochs, in DataFrame functions only.

A budget of tokens goes down a tree, by default domain, language, source.  At each node it is dealt to the children
in proportion to their weights; a child that cannot use its share (its tokens times ``max_epochs``) is filled up, and
what it leaves goes to its siblings.  A parent never gets more than its children can use together, so a shortage is
settled among siblings before it reaches the level above.  All of it is whole-number arithmetic: shares are rounded
down and the tokens left over go one each to the first open children, so no token of the budget is lost.

A leaf reads its documents in seeded epochs: epoch ``e`` orders them by a digest of seed, epoch and id.  Its budget
is ``q`` whole epochs and a prefix of the next.  A document counts as read when its first token lies in the prefix.

Nothing is ordered over a whole leaf.  Tokens are summed by leaf and the leading digits of the digest, two digits at a
time; only the bucket in which the prefix ends is looked at further, and the last one ordered by distinct digest.  The outcome is one row per leaf (whole epochs and the
digest at which the prefix ends), and a document is decided by comparing its own digest with it.

Defined results: a null level is a value of its own.  A leaf of weight 0, or without tokens, gets no budget and its
documents 0 copies.  Documents without tokens are read where the order meets them.  Repeated rows have the same
digest and are read together.  Columns of the input called like the new ones are replaced.  An empty table gives an empty result.  Negative weights or budgets raise ``ValueError``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stages import other_fields, quoted, stage

LEVELS = ("domain", "lang", "source")
BUCKET_DIGITS = (2, 4)  # 256 buckets in a leaf, and 256 in the one where the prefix ends
_WIDE = "decimal(38,0)"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _weight(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    given = weights.get(level, {})
    if any(w < 0 for w in given.values()):
        raise ValueError("weights must not be negative")
    column = F.lit(int(given.get("*", 1)))
    named = [(k, w) for k, w in given.items() if k != "*"]
    if named:
        table = F.create_map(*[F.lit(x) for k, w in named for x in (k, int(w))])
        column = F.coalesce(F.try_element_at(table, F.col(level).cast("string")), column)
    return column.cast("long")


def _deal(nodes: DataFrame, parents: Sequence[str], node: str) -> DataFrame:
    """``budget`` of the parent dealt to its children by ``weight`` within ``cap``; adds ``share``."""
    within = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    cap = F.when(F.col("weight") > 0, F.col("cap")).otherwise(0).cast(_WIDE)
    nodes = nodes.withColumn("cap", cap).withColumn(
        "_ratio", F.when(F.col("weight") > 0, F.col("cap").cast("double") / F.col("weight").cast("double"))
    )
    order = within.orderBy(F.col("_ratio").asc_nulls_first(), F.col(node).asc_nulls_first())
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    nodes = nodes.withColumns({
        "_before": (F.sum("cap").over(upto) - F.col("cap")).cast(_WIDE),
        "_from": F.sum("weight").over(onward).cast("decimal(18,0)"),
        "_place": F.row_number().over(order),
    })
    full = F.col("cap") * F.col("_from") <= (F.col("budget") - F.col("_before")) * F.col("weight").cast("decimal(18,0)")
    nodes = nodes.withColumn("_full", F.coalesce(full, F.lit(False)))
    open_ = ~F.col("_full")
    nodes = nodes.withColumns({
        "_left": (F.col("budget") - F.min(F.when(open_, F.col("_before"))).over(within)).cast(_WIDE),
        "_open_weight": F.max(F.when(open_, F.col("_from"))).over(within),
        "_first_open": F.min(F.when(open_, F.col("_place"))).over(within),
    })
    part = F.expr("CAST(CAST(weight AS DECIMAL(18,0)) * CAST(_left AS DECIMAL(20,0)) DIV _open_weight AS DECIMAL(38,0))")
    nodes = nodes.withColumn("_part", F.when(F.col("_full"), F.col("cap")).otherwise(F.coalesce(part, F.lit(0))).cast(_WIDE))
    spare = F.col("_left") - F.sum(F.when(open_, F.col("_part"))).over(within)
    extra = F.when(open_ & (F.col("_place") - F.col("_first_open") < spare), 1).otherwise(0)
    return nodes.withColumn("share", (F.col("_part") + extra).cast(_WIDE)).drop(
        "_ratio", "_before", "_from", "_place", "_full", "_left", "_open_weight", "_first_open", "_part"
    )


def budgets(
    leaves: DataFrame,
    levels: Sequence[str],
    weights: Mapping[str, Mapping[str, int]],
    budget_share: tuple[int, int],
    max_epochs: int,
) -> DataFrame:
    """For each leaf (levels, ``supply``): ``budget``, from ``budget_share`` (a fraction) of all tokens."""
    up, down = budget_share
    if up < 0 or down <= 0 or max_epochs < 0:
        raise ValueError("budget and epochs must not be negative")
    caps = leaves.withColumn("cap", (F.col("supply") * max_epochs).cast(_WIDE))
    for depth, level in enumerate(levels):
        parents = list(levels[:depth])
        # weightless children can take nothing, so their supply is no reason to give their parent a budget
        usable = caps
        for lower in levels[depth:]:
            usable = usable.withColumn("cap", F.when(_weight(lower, weights) > 0, F.col("cap")).otherwise(0).cast(_WIDE))
        if depth == 0:
            nodes = usable.groupBy(level).agg(F.sum("cap").cast(_WIDE).alias("cap"), F.sum("supply").alias("_supply"))
            total = (F.sum("_supply").over(Window.partitionBy(F.lit(0))) * up).cast("decimal(20,0)")
            nodes = nodes.withColumn("_total", total)
            nodes = nodes.withColumn("budget", F.expr(f"CAST(_total DIV {int(down)} AS DECIMAL(38,0))")).drop("_supply", "_total")
        else:
            nodes = usable.groupBy(*parents, level).agg(F.sum("cap").cast(_WIDE).alias("cap"))
            nodes = _join(nodes, dealt, parents)
        dealt = _deal(nodes.withColumn("weight", _weight(level, weights)), parents, level)
        dealt = dealt.select(*parents, level, F.col("share").alias("budget"))
    return dealt


def _join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """On equal keys, null equal to null; the keys of the left side stay."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(renamed[f"_r_{k}"])
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def _key(seed: int, epoch: Column, id_col: str) -> Column:
    parts = [F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))]
    return F.sha2(F.concat_ws(":", *parts), 256)


def plan(
    docs: DataFrame,
    weights: Mapping[str, Mapping[str, int]],
    levels: Sequence[str] = LEVELS,
    tokens_col: str = "n_tokens",
    id_col: str = "doc_id",
    budget_share: tuple[int, int] = (3, 4),
    max_epochs: int = 4,
    seed: int = 17,
) -> DataFrame:
    """One row per leaf: levels, supply, budget, whole_epochs, prefix_tokens, last_key (null: no prefix)."""
    levels = list(levels)
    narrow = stage(docs.select(F.col(id_col).alias("_id"), *levels, F.col(tokens_col).alias("_tokens")), "mix-tokens")
    leaves = stage(narrow.groupBy(*levels).agg(F.sum("_tokens").alias("supply")), "mix-leaves")
    given = _join(leaves, budgets(leaves, levels, weights, budget_share, max_epochs), levels)
    supply = F.when(F.col("supply") > 0, F.col("supply"))
    given = stage(
        given.select(
            *levels, "supply", F.col("budget").cast("long").alias("budget"),
            F.coalesce(F.expr("CAST(budget AS BIGINT) DIV nullif(supply, 0)"), F.lit(0)).alias("whole_epochs"),
            F.coalesce(F.col("budget").cast("long") % supply, F.lit(0)).cast("long").alias("prefix_tokens"),
        ),
        "mix-budgets",
    )
    partial = given.where("prefix_tokens > 0").select(*levels, "whole_epochs", "prefix_tokens")
    keyed = _join(narrow, partial, levels).withColumn("_key", _key(seed, F.col("whole_epochs"), "_id"))
    keyed = keyed.withColumn("_base", F.lit(0).cast("long"))
    for digits in BUCKET_DIGITS:
        sums = keyed.groupBy(*levels, F.substring("_key", 1, digits).alias("_bucket")).agg(
            F.sum("_tokens").alias("_tokens"), F.max("prefix_tokens").alias("prefix_tokens"), F.max("_base").alias("_base")
        )
        upto = Window.partitionBy(*levels).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = sums.withColumn("_upto", F.col("_base") + F.sum("_tokens").over(upto))
        sums = sums.withColumn("_base", F.col("_upto") - F.col("_tokens"))
        ending = sums.where("_base < prefix_tokens AND prefix_tokens <= _upto").select(*levels, "_bucket", "_base")
        keyed = keyed.drop("_base").withColumn("_bucket", F.substring("_key", 1, digits))
        keyed = _join(keyed, stage(ending, "mix-ends"), [*levels, "_bucket"]).drop("_bucket")
    last = keyed.groupBy(*levels, "_key").agg(
        F.sum("_tokens").alias("_tokens"), F.max("prefix_tokens").alias("prefix_tokens"), F.max("_base").alias("_base")
    )
    upto = Window.partitionBy(*levels).orderBy("_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = last.withColumn("_first", F.col("_base") + F.sum("_tokens").over(upto) - F.col("_tokens"))
    last = last.where("_first < prefix_tokens").groupBy(*levels).agg(F.max("_key").alias("last_key"))
    return stage(_join(given, last, levels, "left"), "mix-plan")


def mix(
    docs: DataFrame,
    weights: Mapping[str, Mapping[str, int]],
    levels: Sequence[str] = LEVELS,
    tokens_col: str = "n_tokens",
    id_col: str = "doc_id",
    budget_share: tuple[int, int] = (3, 4),
    max_epochs: int = 4,
    seed: int = 17,
) -> DataFrame:
    """The rows of ``docs`` with ``copies`` (how often the mixture reads the document) and ``leaf_budget``."""
    leaf = plan(docs, weights, levels, tokens_col, id_col, budget_share, max_epochs, seed)
    leaf = leaf.select(*levels, "whole_epochs", "last_key", F.col("budget").alias("leaf_budget"))
    kept = [quoted(f.name) for f in other_fields(docs, "whole_epochs", "last_key", "leaf_budget", "copies")]
    read = _join(docs.select(*kept), leaf, levels)
    prefix = F.coalesce((_key(seed, F.col("whole_epochs"), id_col) <= F.col("last_key")).cast("long"), F.lit(0))
    # an empty leaf has no epochs to read
    return read.withColumn("copies", F.col("whole_epochs") + prefix).drop("whole_epochs", "last_key")
