"""Near-duplicates by SimHash: fingerprints, links within a radius found in sharded BK-trees, connected components.

Fingerprints are made where the text is read; from then on only ids and 64-bit numbers move.  Equal fingerprints become
one node (the smallest id) before anything else, so a group of exact copies is one row.

Shards: 64 bits are cut into ``radius + 1`` blocks.  Two fingerprints within the radius agree in one block at least, so
the fingerprints with an equal block form a shard and every link lies within some shard.  A shard's fingerprints are
put into a BK-tree (children keyed by their distance to the parent), all of them are looked up in it, and only edges
within the radius of the distance at hand are followed.  Trees of many shards are built and searched together, one
level at a time.  A shard is shuffled to the task that builds its tree: trees together hold every fingerprint, which
has no size bound, so they aren't broadcast.

A shard that is larger than ``shard_limit`` is cut into parts, and each pair of parts is searched in a task's tree of
its own, so no task gets a hot shard whole.  Which shards are hot is known from counts; as the limit is at least a
4,096th of all nodes, there are at most ``blocks * 4096`` of them.

A task hands on a spanning forest of the links it has found, never all pairs.  Components are then found by letting
each node point to the smallest id it can see (large star, small star), written as a table after every round, which
removes the one before, until each node points to one that points nowhere.

Defined results: null and wordless texts have fingerprint zero and are linked like any other.  Texts of fewer words
than a shingle are one shingle.  Rows that repeat an id are each returned, with their own fingerprint; an id's rows
are one node, so what they link to is one component.  Null ids are returned with a component of their own fingerprint's
smallest id, null if there is none.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .bytewise import lower_ascii, pieces, text_bytes, word_spans
from .stages import shuffle_partitions, shuffles_go, stage, tidy, tidy_group, unstage

WORDS = 4
RADIUS = 4
SEED = 42
HOT_SHARE = 4096
SEARCHED = 1 << 16  # look-ups that walk through the trees at a time


def _fingerprint(hashes: list[int]) -> int:
    bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
    ones = np.add.reduce(bits, axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > len(hashes)).view(">u8")[0])


def text_fingerprints(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> np.ndarray:
    """The fingerprint of every text, as signed 64-bit numbers."""
    data = lower_ascii(data)
    starts, ends, first = word_spans(data, offsets)
    # words one blank apart, so a shingle is a slice
    lengths = ends - starts
    begin = np.cumsum(lengths + 1) - (lengths + 1)
    spaced = np.full(int((lengths + 1).sum()), 0x20, np.uint8)
    inside = np.repeat(starts - begin, lengths)
    to = np.repeat(begin - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
    spaced[to] = data[to + inside]
    text = memoryview(spaced.tobytes())
    last = begin + lengths
    out = np.zeros(len(offsets) - 1, np.uint64)
    begin, last, h = begin.tolist(), last.tolist(), xxhash.xxh64_intdigest
    for k, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
        if b - a >= words:
            hashes = [h(text[s:e], SEED) for s, e in zip(begin[a : b - words + 1], last[a + words - 1 : b], strict=True)]
        elif b > a:
            hashes = [h(text[begin[a] : last[b - 1]], SEED)]
        else:
            continue
        out[k] = _fingerprint(hashes)
    return out.view(np.int64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """id, fp (signed 64 bits) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "_text"):
                found = text_fingerprints(*text_bytes(piece.column("_text")), words)
                yield pa.RecordBatch.from_arrays([piece.column("id"), pa.array(found)], names=["id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(tidy(run), StructType([StructField("id", LongType()), StructField("fp", LongType())]))


class Forest:
    """BK-trees, one for each group of items, in arrays.  Items of a group must be distinct."""

    def __init__(self, values: np.ndarray, groups: np.ndarray):
        n = len(values)
        self.values = values
        order = np.argsort(groups, kind="stable")
        sorted_groups = groups[order]
        head = np.flatnonzero(np.r_[True, sorted_groups[1:] != sorted_groups[:-1]]) if n else np.zeros(0, np.int64)
        sizes = np.diff(np.r_[head, n])
        self.root_of = np.empty(n, np.int64)  # of each item's group
        self.root_of[order] = np.repeat(order[head], sizes)
        parents, edges = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        item = np.flatnonzero(self.root_of != np.arange(n))
        at = self.root_of[item]
        while len(item):
            edge = np.bitwise_count(values[item] ^ values[at]).astype(np.int64)
            slot = at * 65 + edge
            # the first item to ask for a slot becomes that child; the others go down to it
            _, one, which = np.unique(slot, return_index=True, return_inverse=True)
            child = item[one]
            parents[child], edges[child] = at[one], edge[one]
            down = np.ones(len(item), bool)
            down[one] = False
            at = child[which][down]
            item = item[down]
        # children of a node side by side, by edge
        slot = parents * 65 + edges
        self.children = np.argsort(slot, kind="stable")[int((parents < 0).sum()) :]
        self.slots = slot[self.children]

    def within(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of items of one group at most ``radius`` apart, in blocks."""
        for low in range(0, len(self.values), SEARCHED):
            asked = np.arange(low, min(low + SEARCHED, len(self.values)))
            node = self.root_of[asked]
            while len(asked):
                apart = np.bitwise_count(self.values[asked] ^ self.values[node]).astype(np.int64)
                hit = (apart <= radius) & (asked > node)
                if hit.any():
                    yield asked[hit], node[hit]
                begin = np.searchsorted(self.slots, node * 65 + np.maximum(apart - radius, 0))
                end = np.searchsorted(self.slots, node * 65 + np.minimum(apart + radius, 64), "right")
                more = end - begin
                asked = np.repeat(asked, more)
                step = np.arange(int(more.sum())) - np.repeat(np.cumsum(more) - more, more)
                node = self.children[np.repeat(begin, more) + step]


def spanning(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """For each item that is linked: the smallest item it is linked to through others.  One edge an item at most."""
    low = np.arange(n)
    for a, b in pairs:
        while True:
            x, y = low[a], low[b]
            differ = x != y
            if not differ.any():
                break
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
            while True:  # every item points at the end of its path
                jump = low[low]
                if (jump == low).all():
                    break
                low = jump
    moved = np.flatnonzero(low != np.arange(n))
    return moved, low[moved]


def _link_batch(radius: int):
    def run(table: pa.Table) -> pa.Table:
        """All shards of one task: rows (part, shard key, id, fp)."""
        values = table.column("fp").to_numpy().view(np.uint64)
        ids = table.column("id").to_numpy()
        _, groups = np.unique(np.stack([table.column(c).to_numpy() for c in ("block", "value", "part")]), axis=1, return_inverse=True)
        order = np.lexsort((ids, groups.reshape(-1)))
        ids, values, groups = ids[order], values[order], groups.reshape(-1)[order]
        a, b = spanning(len(ids), Forest(values, groups).within(radius))
        return pa.table({"a": ids[a], "b": ids[b]})

    return run


def _blocks(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of ``radius + 1`` blocks of 64 bits."""
    edges = np.linspace(0, 64, radius + 2).astype(int)
    return [(int(a), int(b - a)) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def links(nodes: DataFrame, radius: int = RADIUS, shard_limit: int = 1024) -> DataFrame:
    """a, b: a forest of links that connects all nodes (id, fp; fps distinct) within ``radius`` of one another."""
    spark = nodes.sparkSession
    with shuffles_go(spark):
        n = nodes.count()
    limit = max(shard_limit, n // HOT_SHARE)
    keyed = nodes.select(
        "id", "fp",
        F.posexplode(F.array(*[
            F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1)) for shift, width in _blocks(radius)
        ])).alias("block", "value"),
    )
    with shuffles_go(spark):
        hot = keyed.groupBy("block", "value").count().where(F.col("count") > limit).collect()  # few: see above
    keyed = keyed.withColumn("shard", F.col("block") * F.lit(1 << 32) + F.col("value"))
    if hot:
        # a hot shard's parts by id; part p meets part q in the tree (p, q)
        parts = F.create_map(*[
            F.lit(x) for r in hot for x in ((r.block << 32) + r.value, -(-r["count"] // limit))
        ])
        keyed = keyed.withColumn("_parts", F.coalesce(F.try_element_at(parts, F.col("shard")), F.lit(1)))
        keyed = keyed.withColumn("_own", F.pmod(F.xxhash64("id"), F.col("_parts")))
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))
        keyed = keyed.withColumn("_other", other)
        low, high = F.least("_own", "_other"), F.greatest("_own", "_other")
        keyed = keyed.withColumn("part", low * F.col("_parts") + high)
    else:
        keyed = keyed.withColumn("part", F.lit(0).cast("long"))
    buckets = max(4 * shuffle_partitions(spark), -(-n * (radius + 1) // 200_000))
    bucket = F.pmod(F.xxhash64("shard", "part"), F.lit(buckets))
    return (
        keyed.select("id", "fp", F.col("block").cast("long"), "value", "part", bucket.alias("bucket"))
        .groupBy("bucket")
        .applyInArrow(tidy_group(_link_batch(radius)), "a bigint, b bigint")
    )


def _settled(edges: DataFrame) -> bool:
    """Whether every node points to one other at most, which itself points nowhere."""
    with shuffles_go(edges.sparkSession):
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("points"), F.lit(0).alias("met"))
        ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("points"), F.lit(1).alias("met")))
        ends = ends.groupBy("node").agg(F.sum("points").alias("points"), F.max("met").alias("met"))
        return ends.where("points > 1 OR points = 1 AND met = 1").limit(1).count() == 0


def stars(edges: DataFrame) -> DataFrame:
    """a, b, a staged table: every node but the smallest of its component, and that one."""
    edges = stage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    while not _settled(edges):
        # large star: a node's greater neighbours point to the least of all its neighbours
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.where("a <> b").distinct(), "large")
        # small star: a node and its smaller neighbours point to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        small = small.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        after = stage(small, "edges")
        unstage(edges, large)
        edges = after
    return edges


def members(found: DataFrame) -> DataFrame:
    """node, component: of all nodes of ``stars``."""
    roots = found.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return found.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def components(edges: DataFrame) -> DataFrame:
    """node, component: for every node of an edge the smallest node it is connected with."""
    return members(stars(edges))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, radius: int = RADIUS
) -> DataFrame:
    """id_col, fp, component_id for every row of ``docs``."""
    rows = stage(fingerprints(docs, id_col, text_col, words), "fingerprints")
    known = rows.where("id IS NOT NULL")
    nodes = stage(known.groupBy("fp").agg(F.min("id").alias("id")), "nodes")
    # the rows of a repeated id are one document
    repeated = known.groupBy("id").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low <> high").select("id")
    own = known.join(repeated, "id").distinct().join(nodes.withColumnRenamed("id", "first"), "fp")
    own = own.select(F.col("id").alias("a"), F.col("first").alias("b"))
    found = components(links(nodes, radius).unionByName(own))
    of_fp = nodes.join(found, nodes["id"] == found["node"], "left")
    of_fp = stage(of_fp.select("fp", F.coalesce("component", "id").alias("component_id")), "components")
    return rows.join(of_fp, "fp", "left").select(F.col("id").alias(id_col), "fp", "component_id")


def keep(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """One document of each component, that with the smallest id, with all columns; rows without an id stay."""
    found = near_duplicates(docs, id_col, text_col, words, radius)
    gone = stage(found.where(F.col("component_id") != F.col(id_col)).select(F.col(id_col).alias("_gone")).distinct(), "gone")
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
