"""Near copies by exact 5-word Jaccard similarity, of candidates from SimHash and from bands of min-wise hashes.

A SimHash of 64 bits within a radius that trees can search reaches few pairs of similarity 0.8: their median distance is
far beyond it.  So each document has ``BANDS`` further fingerprints, each of the least shingle hashes under ``BAND_ROWS``
functions; two documents of similarity s share at least one with probability 1 - (1 - s^5)^20, at 0.8 that is 0.9996.
Candidates are confirmed by their sets of distinct shingles, made once for each document that is a candidate: only pairs
that share ``LEAST_SIMILAR`` of them are links.

Any two documents of a group with one band fingerprint are compared, unless they are known to be in one component.  That
goes by rounds.  First every document meets one member of each of its groups of a few bands, drawn anew for each group:
a few pairs a document, after which a group of copies is one component, or nearly so.  Next, the documents of groups still open
are told how many of their shingles some other of them has.  The rest bounds the similarity of any pair from above, so most
pairs that only share a template, and documents of which too little is shared, are left out unseen.  Then, in a round some members, drawn by a hash of the id, are hubs and meet all members of other components.
Then links contract components, and members that have been hubs have met everyone, so they are done.  Of the groups that
still hold two components, a round takes ``MORE`` times as many hubs as the one before, until all members have been hubs
or no group is open.  A group's members are counted again when some were left out.
So the pairs of a group of copies are in proportion to its size, and no pair is left out.  What remains in proportion to the square of a group are pairs that share a fingerprint and still are no links.

Defined results: texts of fewer words than a shingle are one shingle; null and wordless texts are alike.  Rows that
repeat an id are one document, linked to what any of them is linked to; rows without an id stay.  Columns of any name pass
through.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import simhash
from .bytewise import lower_ascii, mix, pieces, ranges, slice_hashes, text_bytes, window_hashes, word_spans
from .stages import shuffles_go, stage, tidy, unstage

WORDS = 5
LEAST_SIMILAR = 0.8
BANDS, BAND_ROWS = 20, 5
HUBS, MORE = 1, 8  # expected hubs of a group in the first round, and how many times more in the next
PRUNINGS = 2  # each may leave further documents without a partner
FIRST_BANDS = ((0, 4), (4, 8))  # bands of the rounds before, each with one hub a group
_BASE = 0xD6E8FEB86659FD93
_FUNCTIONS = mix(np.arange(1, BANDS * BAND_ROWS + 1, dtype=np.uint64)) | np.uint64(1)


def shingles(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts (each has one at least), and where each text's begin (n + 1)."""
    data, offsets = text_bytes(texts)
    data = lower_ascii(data)
    starts, ends, first = word_spans(data, offsets)
    items = slice_hashes(data, starts, ends)
    n = np.diff(first)
    begin = np.r_[0, np.cumsum(np.maximum(n - words + 1, 1))]
    out = np.zeros(int(begin[-1]), np.uint64)
    for width in range(1, words + 1):  # a shorter text is one shingle of all its words
        some = np.flatnonzero(n >= words if width == words else n == width)
        if len(some):
            count = n[some] - width + 1
            out[ranges(begin[some], count)] = window_hashes(items, width, _BASE + 2 * width)[ranges(first[some], count)]
    return out, begin


def band_fingerprints(texts: pa.Array, words: int = WORDS) -> np.ndarray:
    """(texts, BANDS) fingerprints."""
    hashes, begin = shingles(texts, words)
    out = np.zeros((len(texts), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(texts), band + 1, np.uint64)
        for factor in _FUNCTIONS[band * BAND_ROWS : (band + 1) * BAND_ROWS]:
            x = hashes * factor
            x ^= x >> np.uint64(32)
            x *= factor
            key = mix(key + np.minimum.reduceat(x, begin[:-1]))
        out[:, band] = key
    return out.view(np.int64)


def shared(left: np.ndarray, right: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets."""
    both = np.sort(np.concatenate([left, right]), kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return common / (len(both) - common)


def _distinct(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    return owner[new], hashes[new]


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    return rows.where("id IS NOT NULL")


def band_members(texts: DataFrame, words: int = WORDS) -> DataFrame:
    """band, key, id, draw (0 to 1, by the id), n: the members of each group of n > 1 documents with one band fingerprint.

    A staged table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in (p for batch in batches for p in pieces(batch, "_text")):
            found = band_fingerprints(piece.column("_text"), words)
            keys = pa.ListArray.from_arrays(np.arange(0, found.size + 1, BANDS, dtype=np.int32), found.reshape(-1))
            yield pa.RecordBatch.from_arrays([piece.column("id"), keys], names=["id", "keys"])

    rows = stage(texts.mapInArrow(tidy(run), "id bigint, keys array<bigint>").distinct(), "bands")
    members = rows.select("id", F.posexplode("keys").alias("band", "key"))
    groups = stage(members.groupBy("key").agg(F.count("id").alias("n")).where("n > 1"), "groups")
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    found = stage(members.join(groups, "key").select("band", "key", "id", draw.alias("draw"), "n"), "members")
    unstage(rows, groups)
    return found


def shingle_sets(texts: DataFrame, words: int = WORDS) -> DataFrame:
    """id, set: the sorted distinct hashes of each text's shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in (p for batch in batches for p in pieces(batch, "_text")):
            hashes, begin = shingles(piece.column("_text"), words)
            owner, hashes = _distinct(np.repeat(np.arange(piece.num_rows), np.diff(begin)), hashes)
            ends = np.searchsorted(owner, np.arange(piece.num_rows + 1)) * 8
            sets = pa.Array.from_buffers(pa.binary(), piece.num_rows, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(hashes)])
            yield pa.RecordBatch.from_arrays([piece.column("id"), sets], names=["id", "set"])

    return texts.mapInArrow(tidy(run), "id bigint, set binary")


def confirmed(pairs: DataFrame, sets: DataFrame, least: float = LEAST_SIMILAR) -> DataFrame:
    """The pairs of ids (a, b) whose sets have ``least`` in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("_left"), batch.column("_right")
            alike = [
                shared(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) >= least
                for x, y in zip(left, right, strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(alike, pa.bool_()))

    sides = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("_left")), "a")
    sides = sides.join(sets.select(F.col("id").alias("b"), F.col("set").alias("_right")), "b")
    # a set is 8 bytes a shingle; sizes that differ by more can't be alike
    n, m = F.octet_length("_left"), F.octet_length("_right")
    sides = sides.where(F.least(n, m) >= least * F.greatest(n, m))
    return sides.select("a", "b", "_left", "_right").mapInArrow(tidy(run), "a bigint, b bigint")


def _open(members: DataFrame, found: DataFrame, again: bool = False) -> DataFrame:
    """Members with their component, of groups that hold two components or more; n is counted ``again``."""
    known = found.select(F.col("a").alias("id"), F.col("b").alias("component"))
    members = members.join(known, "id", "left").withColumn("component", F.coalesce("component", "id"))
    ends = members.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("id").alias("n"))
    ends = ends.where("low <> high")
    return stage(members.drop("n").join(ends.select("key", "n"), "key") if again else members.join(ends.select("key"), "key"), "open")


def _meet(members: DataFrame, hubs: DataFrame, possible: Column | None = None) -> DataFrame:
    """a, b: pairs (a > b) of members and hubs (key, hub, other) of other components."""
    condition = (members["key"] == hubs["at"]) & (F.col("component") != F.col("other"))
    met = members.join(hubs, condition if possible is None else condition & possible)
    return met.select(F.greatest("id", "hub").alias("a"), F.least("id", "hub").alias("b")).distinct()


def first_pairs(members: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs of every member of a group with one of them, a staged table; ``found``: ``simhash.stars``."""
    members = _open(members, found)
    drawn = F.min(F.struct(F.xxhash64("id", "key").alias("by"), F.col("id").alias("hub"), F.col("component").alias("other")))
    hubs = members.groupBy("key").agg(drawn.alias("drawn"))
    pairs = stage(_meet(members, hubs.select(F.col("key").alias("at"), "drawn.hub", "drawn.other")), "pairs")
    unstage(members)
    return pairs


def round_pairs(members: DataFrame, found: DataFrame, before: float, upto: float, least: float) -> DataFrame | None:
    """Pairs between the hubs of this round and all members that haven't been hubs in a round before, a staged table.

    None if no group is open, so that none will be in a later round.
    Shingles that only one document has are in the union of any pair, never in what it shares: some pairs can't reach ``least``.
    """
    members = _open(members.where(F.col("draw") * F.col("n") >= before), found)
    if members.isEmpty():
        unstage(members)
        return None
    hubs = members.where(F.col("draw") * F.col("n") < upto).select(
        F.col("key").alias("at"), F.col("id").alias("hub"), F.col("component").alias("other"),
        F.col("size").alias("hub_size"), F.col("common").alias("hub_common"),
    )
    both = F.least("common", "hub_common")
    known = F.col("common").isNotNull() & F.col("hub_common").isNotNull()
    met = _meet(members, hubs, ~known | (both >= (F.col("size") + F.col("hub_size") - both) * least))
    pairs = stage(met, "pairs")
    unstage(members)
    return pairs


def common_shingles(sets: DataFrame) -> DataFrame:
    """id, size, common: how many shingles a document has, and how many of them some other of ``sets`` has, too.

    Only documents of one row are told.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = batch.column("id").to_numpy(), batch.column("set")
            data, offsets = text_bytes(found)
            hashes, counts = np.frombuffer(data.tobytes(), np.int64), np.diff(offsets) // 8
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, counts)), pa.array(hashes)], names=["id", "hash"])

    spread = sets.select("id", "set").mapInArrow(tidy(run), "id bigint, hash bigint")
    owned = spread.groupBy("hash").agg(F.min("id").alias("id"), F.max("id").alias("last")).where("id = last")
    owned = owned.groupBy("id").agg(F.count("hash").alias("own"))
    sizes = sets.groupBy("id").agg(F.count("set").alias("rows"), F.min(F.octet_length("set") / 8).alias("size"))
    sizes = sizes.join(owned, "id", "left").where("rows = 1")
    return sizes.select("id", "size", (F.col("size") - F.coalesce("own", F.lit(0))).alias("common"))


def simhash_candidates(docs: DataFrame, id_col: str, text_col: str, words: int, radius: int) -> DataFrame:
    """a, b: pairs (a > b) with equal fingerprints (with the smallest id) or within ``radius`` of each other, a staged table."""
    rows = stage(simhash.fingerprints(docs, id_col, text_col, words).where("id IS NOT NULL"), "fingerprints")
    nodes = stage(rows.groupBy("fp").agg(F.min("id").alias("id")), "nodes")
    equal = rows.join(nodes.withColumnRenamed("id", "first"), "fp").select(F.col("id").alias("a"), F.col("first").alias("b"))
    alike = equal.unionByName(simhash.links(nodes, radius)).where("a <> b")
    alike = stage(alike.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "alike")
    unstage(rows, nodes)
    return alike


def candidates(texts: DataFrame, words: int = WORDS) -> DataFrame:
    """a, b: the pairs (a > b) of the first round among texts (id, _text)."""
    none = texts.sparkSession.createDataFrame([], "a bigint, b bigint")
    return first_pairs(band_members(texts, words).where(F.col("band") < FIRST_BANDS[0][1]), none)


def keep(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    words: int = WORDS, least: float = LEAST_SIMILAR, radius: int = simhash.RADIUS,
) -> DataFrame:
    """One document of each component of near copies, that with the smallest id, with all columns; rows without an id stay."""
    texts = _texts(docs, id_col, text_col)
    members = band_members(texts, words)
    alike = simhash_candidates(docs, id_col, text_col, words, radius)
    met = members.select("id").unionByName(alike.select(F.explode(F.array("a", "b")).alias("id"))).distinct()
    sets = shingle_sets(texts.join(met, "id", "left_semi"), words)
    several = stage(texts.groupBy("id").count().where("count > 1").select("id"), "several")
    if not several.isEmpty():
        sets = sets.join(several, "id", "left_anti").unionByName(sets.join(several, "id").distinct())
    sets = stage(sets, "sets")
    links = stage(confirmed(alike, sets, least), "links")
    found = simhash.stars(links)
    unstage(several, alike, links)

    def contract(pairs: DataFrame) -> None:
        nonlocal found
        if not pairs.isEmpty():
            links = stage(confirmed(pairs, sets, least), "links")
            # what is found already stands for the links before
            after = simhash.stars(found.unionByName(links))
            unstage(found, links)
            found = after
        unstage(pairs)

    for low, high in FIRST_BANDS:
        contract(first_pairs(members.where(F.col("band").between(low, high - 1)), found))
    for _ in range(PRUNINGS):  # of the groups that are still open
        opened = _open(members, found, again=True)
        left = opened.drop("component", "size", "common")
        # the sets of the others are not wanted any more
        fewer = stage(sets.join(left.select("id").distinct(), "id", "left_semi"), "sets")
        common = stage(common_shingles(fewer), "common")
        possible = left.join(common, "id", "left").where(F.coalesce(F.col("common") >= F.col("size") * least, F.lit(True)))
        possible = stage(possible, "members")
        unstage(members, sets, opened, common)
        members, sets = possible, fewer
    with shuffles_go(docs.sparkSession):
        most = members.agg(F.max("n")).first()[0] or 0
    before, upto = 0, HUBS
    while before < most:
        pairs = round_pairs(members, found, before, upto, least)
        if pairs is None:
            break
        contract(pairs)
        before, upto = upto, upto * MORE
    unstage(members, sets)
    gone = found.select(F.col("a").alias("_gone"))
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
