"""Exact top-k by inner product in three phases with a uniform threshold.

A vector's score is the sum of its partial scores over ``LISTS`` slices of the dimensions.

1. Each cell (a block of queries against a shard of vectors) takes the best ``k`` of each list and hands on the best
   ``k`` of their whole scores.
2. The ``k``-th best score handed on for a query is a safe cutoff: the true ``k``-th is no lower.  It goes to all cells.
   A vector that reaches the cutoff has a partial score of at least its ``LISTS``-th part in some list, so the entries
   of each list from there on are sufficient.
3. Their whole scores are resolved; of those that reach the cutoff each cell hands on the best ``k``.

Queries and vectors go to cells by hash of their ids: queries once for each shard, vectors once for each block, so a
cell has a bounded size and no task sees all of either.  Nothing passes through the driver but two counts.

Components become whole numbers, floor(scale * x).  Products are summed in doubles while that is exact, else in Python's
whole numbers; scores outside 64 bits are held at the limits.

Defined results: vectors that are null or empty or hold a null or non-finite component, and rows without an id, take no
part.  Vectors of different lengths are not compared.  Rows that repeat a vector's id are candidates each; a query id
is asked once, with the smallest of its vectors, and no row with the query's id is its own candidate.  Ties go to the
smaller id.  Without queries or candidates the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stages import stage

LISTS = 4
SHARD = 4096  # vectors in a cell
BLOCK = 1024  # queries in a cell
AT_ONCE = 128  # queries whose partial scores are held at a time
EXACT = 2.0**53


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """id, asked, dim, v (whole numbers in doubles) of the rows that take part."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("_v"), F.col("_asked").alias("asked"))
    rows = rows.where("id IS NOT NULL AND size(_v) > 0")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_ids, out_asked, out = [], [], []
            for key, asked, vector in zip(*(batch.column(c).to_pylist() for c in ("id", "asked")), batch.column("_v"), strict=True):
                x = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null becomes nan
                with np.errstate(over="ignore"):
                    x = np.floor(x * scale)
                if np.isfinite(x).all():
                    out_ids.append(key)
                    out_asked.append(asked)
                    out.append(x)
            yield pa.RecordBatch.from_pydict({
                "id": pa.array(out_ids, pa.int64()), "asked": pa.array(out_asked, pa.bool_()),
                "dim": pa.array([len(x) for x in out], pa.int32()),
                "v": pa.array(out, pa.list_(pa.float64())),
            })

    return rows.mapInArrow(run, "id bigint, asked boolean, dim int, v array<double>")


def _products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """q @ v.T, exact."""
    if not q.size or not v.size or np.abs(q).max() * np.abs(v).max() * q.shape[1] < EXACT:
        return q @ v.T
    whole = [[int(x) for x in row] for row in v]
    out = np.empty((len(q), len(v)), object)
    for i, row in enumerate(q):
        ours = [int(x) for x in row]
        out[i] = [sum(a * b for a, b in zip(ours, theirs, strict=True)) for theirs in whole]
    return out


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, earlier places first among equals."""
    if len(scores) > 4 * k and scores.dtype != object:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
        return some[np.argsort(-scores[some], kind="stable")[:k]]
    order = sorted(range(len(scores)), key=lambda i: (-scores[i], i)) if scores.dtype == object else np.argsort(-scores, kind="stable")
    return np.asarray(order[:k], np.int64)


def _long(score) -> int:
    return max(-(1 << 63), min((1 << 63) - 1, int(score)))


def _search(k: int, lists: int, with_cutoff: bool):
    def cell(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        out_q, out_v, out_s = [], [], []
        if queries.num_rows and vectors.num_rows:
            dim = queries.column("dim")[0].as_py()

            def matrix(table):
                return table.column("v").combine_chunks().values.to_numpy(zero_copy_only=False).reshape(-1, dim)

            ids = vectors.column("id").to_numpy()
            order = np.argsort(ids, kind="stable")  # ties go to the smaller id
            ids, v = ids[order], matrix(vectors)[order]
            q, q_ids = matrix(queries), queries.column("id").to_numpy()
            cutoffs = queries.column("cutoff").to_pylist() if with_cutoff else [None] * len(q)
            slices = [s for s in np.array_split(np.arange(dim), min(lists, dim)) if len(s)]
            for low in range(0, len(q), AT_ONCE):
                some = q[low : low + AT_ONCE]
                partial = [_products(some[:, s], v[:, s]) for s in slices]
                for i in range(len(some)):
                    query = int(q_ids[low + i])
                    rows = [p[i] for p in partial]
                    cutoff = cutoffs[low + i]
                    if not with_cutoff:
                        wanted = np.unique(np.concatenate([_best(r, k + 1) for r in rows]))
                    elif cutoff is None:
                        wanted = np.arange(len(ids))
                    else:
                        part = -(-cutoff // len(slices)) if cutoff > -(1 << 63) else cutoff
                        reach = np.zeros(len(ids), bool)
                        for r in rows:
                            reach |= (r >= part).astype(bool)
                        wanted = np.flatnonzero(reach)
                    wanted = wanted[ids[wanted] != query]
                    score = sum(r[wanted] for r in rows)
                    if with_cutoff and cutoff is not None:
                        there = np.array([_long(s) >= cutoff for s in score], bool) if score.dtype == object else score >= cutoff
                        wanted, score = wanted[there], score[there]
                    top = _best(score, k)
                    out_q += [query] * len(top)
                    out_v += ids[wanted[top]].tolist()
                    out_s += [_long(s) for s in score[top].tolist()]
        return pa.table({"query_id": pa.array(out_q, pa.int64()), "vec_id": pa.array(out_v, pa.int64()), "score": pa.array(out_s, pa.int64())})

    return cell


def top_k(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding",
    k: int = 10, scale: int = 1024, lists: int = LISTS, shard: int = SHARD, block: int = BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score for each query row of ``vectors`` against all other rows."""
    marked = vectors.withColumn("_asked", F.coalesce(is_query, F.lit(False)))
    rows = stage(whole_vectors(marked, id_col, vector_col, scale), "vectors")
    asked = rows.where("asked").groupBy("id", "dim").agg(F.min("v").alias("v"))
    asked = asked.groupBy("id").agg(F.min(F.struct("v", "dim")).alias("_q")).select("id", "_q.dim", "_q.v")
    asked = stage(asked, "queries")
    n_shards, n_blocks = (max(1, -(-df.count() // size)) for df, size in ((rows, shard), (asked, block)))
    cell = ["dim", "block", "shard"]
    shard_of = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(n_shards)).cast("int").alias("shard")
    block_of = F.pmod(F.xxhash64("id", F.lit(2)), F.lit(n_blocks)).cast("int").alias("block")
    held = rows.select("id", "dim", "v", shard_of, F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"))

    def each_shard(queries: DataFrame) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard")
        return queries.select("*", block_of).select("*", every)

    def searched(queries: DataFrame, with_cutoff: bool) -> DataFrame:
        both = each_shard(queries).groupBy(*cell).cogroup(held.groupBy(*cell))
        return both.applyInArrow(_search(k, lists, with_cutoff), "query_id bigint, vec_id bigint, score bigint")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    local = searched(asked, False).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    cutoffs = local.groupBy("query_id").agg(F.min("score").alias("cutoff"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k)
    cutoffs = stage(cutoffs.select(F.col("query_id").alias("id"), "cutoff"), "cutoffs")
    found = searched(asked.join(cutoffs, "id", "left"), True)
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")

