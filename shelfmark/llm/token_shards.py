"""Token ids in shards, with a minimal perfect hash index from document keys to places in a shard.

A shard is one record of a Parquet table, written by Spark's own committer:

========== ======================================================================================================
part, seq  number of the task that wrote it, and of the shard within the task
first_*    first key and tie of the shard, for its place among all
n_rows     documents in it; ``n_ids``: ids in it
keys       their keys in order, 64-bit little-endian; ``null_keys`` of them, at the front, have none
offsets    first id of each document, and the end: n_rows + 1 numbers of 64 bits
seeds      displacement of each bucket of the hash, 32 bits signed
slots      for each slot (fingerprint of the key, first document, documents), 32 bits each
payload    the ids of all documents, 32 bits little-endian, nothing between them
========== ======================================================================================================

Shards hold documents in ascending order of key.  A look-up hashes the key to a bucket, the bucket's displacement to a
slot, and compares the slot's fingerprint: a constant number of steps, whatever the shard holds.

Texts are encoded by the tokenizers library in segments, each distinct segment once for a piece of text and while a
worker's cache holds it.  Segments end at white characters, which normaliser and pattern drop and never reach over, and
between ASCII letters and other ASCII characters (see ``segments``).

Defined results: a null text counts as empty; a document has at least its end id.  Documents without a key come first
and are not in the index.  Documents that share a key stand side by side, by a hash of the text, and are found
together.  An empty table gives no shard and an empty result.  Other columns of the input do not matter.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytewise import is_white, lower_ascii, mix, pieces, ranges, slice_hashes, text_bytes, word_spans
from .stages import shuffle_partitions

SHARD_IDS = 1 << 20  # a shard is closed when it holds so many ids; 4 MB
PIECE = 1 << 20
CACHED_SEGMENTS = 250_000
TOGETHER = 512  # segments encoded in one call
BUCKET = 4  # keys for each displacement
TRIES = 64  # displacements tried at a time
_STEP = np.uint64(0xA24BAED4963EE407)

SHARD_SCHEMA = (
    "part int, seq int, first_key bigint, first_tie bigint, last_key bigint, n_rows bigint, n_ids bigint, null_keys bigint, "
    "keys binary, offsets binary, seeds binary, slots binary, payload binary"
)


# -- the index

def _hash(keys: np.ndarray) -> np.ndarray:
    return mix(keys.view(np.uint64) + _STEP)


def _slots(hashes: np.ndarray, seeds, n: int) -> np.ndarray:
    return (mix(hashes ^ (np.asarray(seeds, np.uint64) + np.uint64(1)) * _STEP) % np.uint64(n)).astype(np.int64)


def build_index(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(seeds, slot of each key) for distinct 64-bit keys; the slots are 0 .. len(keys) - 1."""
    n = len(keys)
    hashes = _hash(keys)
    n_buckets = max(1, -(-n // BUCKET))
    bucket = (hashes >> np.uint64(20)) % np.uint64(n_buckets)
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket.astype(np.int64), minlength=n_buckets)
    ends = np.cumsum(sizes)
    seeds = np.zeros(n_buckets, np.int32)
    place = np.zeros(n, np.int64)
    taken = np.zeros(n, bool)
    by_size = np.argsort(-sizes, kind="stable")
    many = by_size[sizes[by_size] > 1]
    for b in many.tolist():
        mine = order[ends[b] - sizes[b] : ends[b]]
        low = 0
        while True:
            tries = np.arange(low, low + TRIES, dtype=np.uint64)
            where = _slots(hashes[mine][None, :], tries[:, None], n)
            fits = ~taken[where].any(axis=1)
            if len(mine) > 1:
                ordered = np.sort(where, axis=1)
                fits &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
            if fits.any():
                k = int(np.argmax(fits))
                seeds[b], place[mine] = low + k, where[k]
                taken[where[k]] = True
                break
            low += TRIES
    # a bucket of one key names its slot itself
    single = by_size[sizes[by_size] == 1]
    free = np.flatnonzero(~taken)[: len(single)]
    place[order[ends[single] - 1]] = free
    seeds[single] = -free - 1
    return seeds, place


def find(keys: np.ndarray, seeds: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first document, documents) of each key; 0 documents for a key that is not there."""
    n = len(slots)
    if n == 0 or len(keys) == 0:
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    hashes = _hash(keys)
    seed = seeds[((hashes >> np.uint64(20)) % np.uint64(len(seeds))).astype(np.int64)].astype(np.int64)
    slot = np.where(seed < 0, -seed - 1, _slots(hashes, np.maximum(seed, 0), n))
    there = slots[slot, 0] == (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return np.where(there, slots[slot, 1], 0).astype(np.int64), np.where(there, slots[slot, 2], 0).astype(np.int64)


# -- encoding

# ASCII letters, other ASCII, apostrophes, and bytes of other characters
_KIND = np.full(256, 3, np.uint8)
_KIND[:128] = 1
_KIND[97:123] = 0
_KIND[0x27] = 2


def _letters() -> str:
    """Characters that stay one run of letters through normalisation and lower-casing."""
    def stays(c: str) -> bool:
        return all(unicodedata.category(x)[0] == "L" for x in unicodedata.normalize("NFC", c.lower()))

    return "".join(c for c in map(chr, range(0x80, 0x2000)) if unicodedata.category(c)[0] == "L" and stays(c))


# One pre-token each: a run of letters, or a run of ASCII signs without digits and apostrophes.
_ONE = re.compile(f"[a-z{_letters()}]+|[!-&(-/:-@\\[-`{{-~]+")


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, starts and ends of segments, and where each text's segments begin.

    A word is cut where an ASCII letter meets another ASCII character, for there the tokenizer's pattern always ends a
    piece; not after an apostrophe, which may belong to what follows.  A word that may hold a special token stays whole.
    """
    starts, ends, _ = word_spans(data, offsets)
    low = lower_ascii(data)
    kind = _KIND[low]
    cut = np.zeros(len(data) + 1, bool)
    cut[1:-1] = ((kind[:-1] == 0) & ((kind[1:] == 1) | (kind[1:] == 2))) | ((kind[:-1] == 1) & (kind[1:] == 0))
    special = np.flatnonzero((data[:-1] == 0x3C) & (data[1:] == 0x7C)) if len(data) else []
    for word in np.unique(np.searchsorted(starts, special, "right") - 1).tolist() if len(special) else []:
        a, b = starts[word], ends[word]
        low[a:b] = data[a:b]
        cut[a + 1 : b] = False
    inside = ~is_white(data)
    inner = np.zeros(len(data), bool)
    inner[1:] = cut[1:-1] & inside[1:] & inside[:-1]
    inner[starts] = False
    begins, stops = inner.copy(), np.zeros(len(data) + 1, bool)
    begins[starts] = True
    stops[:-1] = inner
    stops[ends] = True
    all_starts = np.flatnonzero(begins)
    return low, all_starts, np.flatnonzero(stops), np.searchsorted(all_starts, offsets)


class Words:
    """Encodes texts segment by segment, each distinct segment once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a pre-token
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def _encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has."""
        found = [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate([np.zeros(0, np.uint32), *found]), np.array([len(x) for x in found], np.int64)

    def _encoded_together(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts of one pre-token each, many in a call: their ids end where a pre-token ends."""
        ids, _ = self._encoded([" ".join(texts[i : i + TOGETHER]) for i in range(0, len(texts), TOGETHER)])
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(texts) or (len(ids) and ends[-1] != len(ids)):
            return self._encoded(texts)
        return ids, np.diff(np.r_[0, ends])

    def of(self, slices: list[bytes]) -> np.ndarray:
        """The place of each slice's ids in ``begin`` and ``size``."""
        if len(self.index) > CACHED_SEGMENTS:
            self.forget()
        missing = [s for s in slices if s not in self.index]
        alone, together = [], []
        for s in missing:
            (together if _ONE.fullmatch(s.decode()) else alone).append(s)
        for group, encode in ((together, self._encoded_together), (alone, self._encoded)):
            if group:
                ids, sizes = encode([s.decode() for s in group])
                n = len(self.index)
                self.index.update(zip(group, range(n, n + len(group)), strict=True))
                self.begin = np.r_[self.begin, len(self.flat) + np.cumsum(sizes) - sizes]
                self.size = np.r_[self.size, sizes]
                self.flat = np.r_[self.flat, ids]
        return np.fromiter(map(self.index.__getitem__, slices), np.int64, len(slices))

    def encode(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each closed by ``end_id``, and how many each text has."""
        n = len(offsets) - 1
        low, starts, ends, first = segments(data, offsets)
        if not len(starts):
            return np.full(n, end_id, np.uint32), np.ones(n, np.int64)
        _, one, which = np.unique(slice_hashes(low, starts, ends), return_index=True, return_inverse=True)
        text = low.tobytes()
        known = self.of([text[a:b] for a, b in zip(starts[one].tolist(), ends[one].tolist(), strict=True)])
        begin, size = self.begin[known][which], self.size[known][which]
        ids = self.flat[ranges(begin, size)]
        per_text = np.diff(np.r_[0, np.cumsum(size)][first])
        # the end id after each text's ids
        return np.insert(ids, np.cumsum(per_text), end_id), per_text + 1


_loaded: dict[str, Words] = {}


def words_of(path: str) -> Words:
    if path not in _loaded:
        _loaded[path] = Words(path)
    return _loaded[path]


# -- writing

def _shard(part: int, seq: int, keys: list, ties: list, sizes: np.ndarray, payload: bytes) -> pa.RecordBatch:
    null_keys = sum(k is None for k in keys)
    known = np.array(keys[null_keys:], np.int64)
    distinct, first, count = np.unique(known, return_index=True, return_counts=True)
    seeds, place = build_index(distinct) if len(distinct) else (np.zeros(0, np.int32), np.zeros(0, np.int64))
    slots = np.zeros((len(distinct), 3), np.uint32)
    if len(distinct):
        slots[place, 0] = (_hash(distinct) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        slots[place, 1] = first + null_keys
        slots[place, 2] = count
    offsets = np.r_[0, np.cumsum(sizes)].astype("<i8")
    row = {
        "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
        "first_key": pa.array([keys[0]], pa.int64()), "first_tie": pa.array([ties[0]], pa.int64()),
        "last_key": pa.array([keys[-1]], pa.int64()), "n_rows": pa.array([len(keys)], pa.int64()),
        "n_ids": pa.array([int(offsets[-1])], pa.int64()), "null_keys": pa.array([null_keys], pa.int64()),
    }
    blobs = {"keys": known.astype("<i8").tobytes(), "offsets": offsets.tobytes(), "seeds": seeds.astype("<i4").tobytes(),
             "slots": slots.astype("<u4").tobytes(), "payload": payload}
    row |= {k: pa.array([v], pa.binary()) for k, v in blobs.items()}
    return pa.RecordBatch.from_pydict(row)


def shards(
    docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    n_parts: int | None = None, shard_ids: int = SHARD_IDS,
) -> DataFrame:
    """The shards of all documents, as rows to be written."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("key"), text.alias("_text"))
    order = [F.col("key").asc_nulls_first(), F.xxhash64("_text")]
    n = n_parts or shuffle_partitions(docs.sparkSession)
    rows = rows.repartitionByRange(n, *order).withColumn("tie", F.xxhash64("_text")).sortWithinPartitions(F.col("key").asc_nulls_first(), "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, seq = words_of(path), TaskContext.get().partitionId(), 0
        keys, ties, sizes, payload, held = [], [], [], [], 0
        for batch in batches:
            for piece in pieces(batch, "_text", PIECE):
                ids, counts = words.encode(*text_bytes(piece.column("_text")), end_id)
                keys += piece.column("key").to_pylist()
                ties += piece.column("tie").to_pylist()
                sizes.append(counts)
                payload.append(ids.astype("<u4").tobytes())
                held += len(ids)
                if held >= shard_ids:
                    yield _shard(part, seq, keys, ties, np.concatenate(sizes), b"".join(payload))
                    seq += 1
                    keys, ties, sizes, payload, held = [], [], [], [], 0
        if keys:
            yield _shard(part, seq, keys, ties, np.concatenate(sizes), b"".join(payload))

    return rows.mapInArrow(run, SHARD_SCHEMA)


# -- reading

def _arrays(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return (np.frombuffer(row["keys"], "<i8"), np.frombuffer(row["offsets"], "<i8"), np.frombuffer(row["seeds"], "<i4"),
            np.frombuffer(row["slots"], "<u4").reshape(-1, 3))


def directory(written: DataFrame) -> DataFrame:
    """part, seq, base (ids before the shard), first_key, last_key: one row for each shard."""
    place = Window.orderBy(F.col("first_key").asc_nulls_first(), "first_tie", "part", "seq")
    before = F.sum("n_ids").over(place.rowsBetween(Window.unboundedPreceding, -1))
    small = written.select("part", "seq", "first_key", "first_tie", "last_key", "n_ids")
    return small.select("part", "seq", F.coalesce(before, F.lit(0)).alias("base"), "first_key", "last_key")


def read(written: DataFrame, digest: Callable[[bytes], int] = zlib.crc32) -> DataFrame:
    """key, part, seq, at (first id in the shard), n_ids, digest of the document's ids; found through the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, offsets, seeds, slots = _arrays(row)
                distinct, again = np.unique(keys, return_counts=True)
                first, count = find(distinct, seeds, slots)
                if not (count == again).all():
                    raise ValueError(f"the index of shard {row['part']}/{row['seq']} lacks a key")
                rows = np.r_[np.arange(row["null_keys"]), ranges(first, count)]
                key = [None] * row["null_keys"] + np.repeat(distinct, count).tolist()
                begin, end = offsets[rows], offsets[rows + 1]
                payload = memoryview(row["payload"])
                sums = [digest(payload[4 * a : 4 * b]) for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
                n = len(rows)
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array(key, pa.int64()), "part": pa.array(np.full(n, row["part"], np.int32)),
                    "seq": pa.array(np.full(n, row["seq"], np.int32)), "at": pa.array(begin.astype(np.int64)),
                    "n_ids": pa.array((end - begin).astype(np.int64)), "digest": pa.array(sums, pa.int64()),
                })

    columns = ["part", "seq", "null_keys", "keys", "offsets", "seeds", "slots", "payload"]
    return written.select(columns).mapInArrow(run, "key bigint, part int, seq int, at bigint, n_ids bigint, digest bigint")


def lookup(written: DataFrame, keys: DataFrame, key_col: str = "key") -> DataFrame:
    """key, ids: the ids of each document with a wanted key.  Keys go to the shards whose range holds them.

    The list of shards reaches the driver: a few numbers for each ``SHARD_IDS`` ids.
    """
    known = directory(written).where("last_key IS NOT NULL").orderBy("base").collect()
    last = np.array([r.last_key for r in known], np.int64)
    first = np.array([np.iinfo(np.int64).min if r.first_key is None else r.first_key for r in known], np.int64)
    names = [(r.part, r.seq) for r in known]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = np.array(batch.column("key").to_pylist(), np.int64)
            low, high = np.searchsorted(last, wanted), np.searchsorted(first, wanted, "right")
            n = np.maximum(high - low, 0)
            to = [names[i] for i in ranges(low, n).tolist()]
            yield pa.RecordBatch.from_pydict({
                "key": pa.array(np.repeat(wanted, n)), "part": pa.array([p for p, _ in to], pa.int32()),
                "seq": pa.array([s for _, s in to], pa.int32()),
            })

    def answer(wanted: pa.Table, held: pa.Table) -> pa.Table:
        keys, out = [], []
        for row in held.to_pylist() if wanted.num_rows else []:
            _, offsets, seeds, slots = _arrays(row)
            ids = np.frombuffer(row["payload"], "<u4")
            asked = wanted.column("key").to_numpy()
            for key, a, n in zip(asked.tolist(), *(x.tolist() for x in find(asked, seeds, slots)), strict=True):
                for doc in range(a, a + n):
                    keys.append(key)
                    out.append(ids[offsets[doc] : offsets[doc + 1]].astype(np.int32))
        return pa.table({"key": pa.array(keys, pa.int64()), "ids": pa.array(out, pa.list_(pa.int32()))})

    asked = keys.select(F.col(key_col).cast("long").alias("key")).where("key IS NOT NULL").distinct()
    routed = asked.mapInArrow(route, "key bigint, part int, seq int")
    return (
        routed.groupBy("part", "seq")
        .cogroup(written.groupBy("part", "seq"))
        .applyInArrow(answer, "key bigint, ids array<int>")
    )
