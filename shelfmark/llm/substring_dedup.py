"""Removal of repeated passages, found by fixed-block anchors.

A window of ``width`` words that also starts in a document with a smaller id is removed from all but the smallest.

1. Anchors.  Every document is cut into non-overlapping blocks of ``(width + 1) // 2`` words, so each of its windows
   holds a whole block.  Blocks are the index; every rolling run of as many words of every document probes it.  A hash
   is an anchor if it stands as a block somewhere and in another document besides.
2. Extension.  Only windows around anchors can be repeats.  They are looked up whole, by a 96-bit hash of their words,
   for the smallest id they start in.  Overlapping repeated windows run together to maximal repeats, which are removed.

Both look-ups go from chunks of documents to buckets of hashes and back (``chunked``): one row for each chunk and
bucket, distinct hashes only, so a passage in a third of all documents costs no more than one in two, and no pair of
documents is ever formed.  Anchors are compared by 30 bits within a bucket, which can only add windows to look up.

Defined results: null texts have no words.  A document shorter than a window keeps all.  Rows that repeat an id are one
document: they lose nothing to one another.  Rows without an id count as after every id, and lose nothing to one
another.  Texts of any length are read whole.  Other columns of the input do not matter.  An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewise import mix, pieces, ranges, window_hashes, word_spans
from .chunked import (
    bucket_of, buckets_of, by_chunk, pack, pack_sorted, stable, starts_of, text_pieces, unpack, unpack_sorted, word_hashes,
)
from .stages import stage, tidy, tidy_group

WIDTH = 13
NO_ID = np.int64(2**63 - 1)
_ANCHOR_BASE, _WINDOW_BASE, _CHECK_BASE = 0xD6E8FEB86659FD93, 0xCA9B0A4F1D3C8E75, 0xB5026F5AA96619E9
_LOW30 = np.uint64((1 << 30) - 1)


def _places(first: np.ndarray, width: int) -> np.ndarray:
    """Where windows of ``width`` words begin that lie in one text."""
    sizes = np.maximum(np.diff(first) - width + 1, 0)
    return ranges(first[:-1], sizes)


def _anchor_keys(words: np.ndarray, first: np.ndarray, block: int, n_buckets: int):
    """For each rolling run of ``block`` words: its place, and bucket << 30 | 30 bits of its hash."""
    places = _places(first, block)
    hashes = window_hashes(words, block, _ANCHOR_BASE)[places] if len(places) else np.zeros(0, np.uint64)
    return places, bucket_of(hashes, n_buckets).astype(np.uint64) << np.uint64(30) | (hashes & _LOW30)


def _text_of(places: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.searchsorted(first, places, "right") - 1


def _by_bucket(chunk: int, keys: np.ndarray, shift: int, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One row for each bucket of sorted distinct keys."""
    bucket = (keys >> np.uint64(shift)).astype(np.int64)
    begin = starts_of(bucket)
    end = np.r_[begin[1:], len(keys)]
    spans = list(zip(begin.tolist(), end.tolist(), strict=True))
    rows = {"chunk": pa.array([chunk] * len(spans), pa.int64()), "bucket": pa.array(bucket[begin], pa.int64())}
    for name, (x, how) in columns.items():
        rows[name] = pa.array([how(x[a:b]) for a, b in spans], pa.binary())
    return pa.RecordBatch.from_pydict(rows)


def _probes(block: int, n_buckets: int):
    """Pass 1: distinct hashes of a chunk, with two flags: stands as a block; stands in several rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for piece in (p for batch in batches for p in pieces(batch, "text")):
            chunks = piece.column("chunk").to_numpy()
            for chunk in np.unique(chunks).tolist():
                texts = piece.column("text").take(pa.array(np.flatnonzero(chunks == chunk)))
                words, first = word_hashes(texts)
                places, keys = _anchor_keys(words, first, block, n_buckets)
                text = _text_of(places, first)
                of_grid = (places - first[text]) % block == 0
                order = np.argsort(keys)
                keys, text, of_grid = keys[order], text[order], of_grid[order]
                begin = starts_of(keys)
                flags = np.zeros(len(begin), np.uint64)
                if len(begin):
                    flags = np.logical_or.reduceat(of_grid, begin).astype(np.uint64) << np.uint64(1)
                    flags |= (np.maximum.reduceat(text, begin) != np.minimum.reduceat(text, begin)).astype(np.uint64)
                held.setdefault(chunk, []).append(keys[begin] << np.uint64(2) | flags)
        for chunk in list(held):
            both = np.sort(np.concatenate(held.pop(chunk)))
            keys, flags = both >> np.uint64(2), both & np.uint64(3)
            begin = starts_of(keys)
            if not len(begin):
                continue
            merged = np.bitwise_or.reduceat(flags, begin)
            merged |= (np.diff(np.r_[begin, len(keys)]) > 1).astype(np.uint64)  # in several pieces
            packed = ((keys[begin] & _LOW30) << np.uint64(2) | merged).astype(np.uint32)
            yield _by_bucket(chunk, keys[begin], 30, {"sent": (packed, pack_sorted)})

    return run


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    """Hashes with flags, as several tasks have sent them for one chunk, as if one had."""
    if len(parts) == 1:
        return parts[0]
    both = np.sort(np.concatenate(parts))
    begin = starts_of(both >> np.uint32(2))
    several = (np.diff(np.r_[begin, len(both)]) > 1).astype(np.uint32)
    return (both[begin] & ~np.uint32(3)) | np.bitwise_or.reduceat(both & np.uint32(3), begin) | several


def _anchors(table: pa.Table) -> pa.Table:
    """A bucket's answer to each chunk: which of its hashes are anchors, a bit each."""
    rows = table.column("sent").to_pylist()
    chunks = by_chunk(table)
    sent = [_joined([unpack_sorted(rows[i], np.uint32) for i in of_chunk]) for _, of_chunk in chunks]
    sizes = np.array([len(x) for x in sent])
    both = np.concatenate(sent)
    order = np.argsort(both >> np.uint32(2), kind="stable")
    both = both[order]
    begin = starts_of(both >> np.uint32(2))
    counts = np.diff(np.r_[begin, len(both)])
    flags = np.bitwise_or.reduceat(both & np.uint32(3), begin)
    anchor = ((flags & 2) > 0) & ((counts > 1) | ((flags & 1) > 0))
    back = np.empty(len(both), bool)
    back[order] = np.repeat(anchor, counts)
    ends = np.cumsum(sizes)
    bits = [np.packbits(back[e - s : e]).tobytes() for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
    return pa.table({
        "chunk": pa.array([c for c, _ in chunks], pa.int64()),
        "bucket": table.column("bucket").combine_chunks()[: len(chunks)], "bits": pa.array(bits, pa.binary()),
    })


def _flags(replies: list[dict], bucket: np.ndarray) -> np.ndarray:
    """The answers to a chunk's sorted distinct keys of the given buckets, as it sent them."""
    begin = starts_of(bucket)
    sizes = dict(zip(bucket[begin].tolist(), np.diff(np.r_[begin, len(bucket)]).tolist(), strict=True))
    answers = {r["bucket"]: r["bits"] for r in replies}
    if set(answers) != set(sizes):
        raise ValueError("a chunk does not hold the documents it held before")
    parts = [np.unpackbits(np.frombuffer(answers[b], np.uint8))[:n] for b, n in sizes.items()]
    if any(len(p) != n for p, n in zip(parts, sizes.values(), strict=True)):
        raise ValueError("a chunk does not hold the documents it held before")
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


class Windows:
    """The windows of a chunk that hold an anchor, and their distinct keys."""

    def __init__(self, docs: pa.Table, replies: list[dict], width: int, n_buckets: int):
        block = (width + 1) // 2
        self.texts = docs.column("text").combine_chunks()
        ids = docs.column("id").combine_chunks()
        self.ids = np.where(np.asarray(ids.is_null()), NO_ID, ids.fill_null(0).to_numpy(zero_copy_only=False)).astype(np.int64)
        words, first = word_hashes(self.texts)
        self.n_words = np.diff(first)
        self.first = first
        places, keys = _anchor_keys(words, first, block, n_buckets)
        distinct, which = np.unique(keys, return_inverse=True)
        anchor = np.zeros(len(words) + 1, np.int64)
        anchor[places] = _flags(replies, (distinct >> np.uint64(30)).astype(np.int64))[which]
        total = np.r_[0, np.cumsum(anchor)]
        windows = _places(first, width)
        holds = total[windows + width - block + 1] > total[windows]
        self.windows = windows[holds]
        self.text = _text_of(self.windows, first)
        if len(self.windows):
            hashes = window_hashes(words, width, _WINDOW_BASE)[self.windows]
            check = window_hashes(words, width, _CHECK_BASE)[self.windows] >> np.uint64(32)
        else:
            hashes = check = np.zeros(0, np.uint64)
        bucket = bucket_of(mix(hashes), n_buckets)
        # distinct windows by bucket, then hash; two words that agree in 64 bits but not in 32 more are told apart
        self.order = np.lexsort((check, hashes, bucket))
        b, h, c = bucket[self.order], hashes[self.order], check[self.order].astype(np.uint32)
        new = np.ones(len(h), bool)
        new[1:] = (b[1:] != b[:-1]) | (h[1:] != h[:-1]) | (c[1:] != c[:-1])
        self.begin = np.flatnonzero(new)
        self.bucket, self.hashes, self.check = b[new], h[new], c[new]
        own = self.ids[self.text[self.order]]
        self.least = np.minimum.reduceat(own, self.begin) if len(own) else own


def _split(replies: pa.Table, kind: int) -> list[dict]:
    return [r for r in replies.to_pylist() if r["kind"] == kind]


def _ask(width: int, n_buckets: int):
    """Pass 2: distinct windows around anchors, with the smallest id of the chunk they start in."""

    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        schema = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), *[(c, pa.binary()) for c in ("hashes", "checks", "least")]])
        if not docs.num_rows:
            return schema.empty_table()
        w = Windows(docs, replies.to_pylist(), width, n_buckets)
        begin = starts_of(w.bucket)
        spans = list(zip(begin.tolist(), [*begin[1:].tolist(), len(w.bucket)], strict=True))
        return pa.table({
            "chunk": pa.array([docs.column("chunk")[0].as_py()] * len(spans), pa.int64()),
            "bucket": pa.array(w.bucket[begin], pa.int64()),
            "hashes": pa.array([pack_sorted(w.hashes[a:b]) for a, b in spans], pa.binary()),
            "checks": pa.array([pack(w.check[a:b]) for a, b in spans], pa.binary()),
            "least": pa.array([pack(w.least[a:b]) for a, b in spans], pa.binary()),
        }, schema)

    return run


def _answer(table: pa.Table) -> pa.Table:
    """A bucket's answer to each chunk: whether a window starts in a document before the chunk's first with it."""
    hashes = [unpack_sorted(x, np.uint64) for x in table.column("hashes").to_pylist()]
    sizes = np.array([len(x) for x in hashes])
    h = np.concatenate(hashes)
    c = np.concatenate([unpack(x, np.uint32) for x in table.column("checks").to_pylist()])
    least = np.concatenate([unpack(x, np.int64) for x in table.column("least").to_pylist()])
    order = np.lexsort((c, h))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (c[order][1:] != c[order][:-1])
    begin = np.flatnonzero(new)
    smallest = np.repeat(np.minimum.reduceat(least[order], begin), np.diff(np.r_[begin, len(h)]))
    back = np.empty(len(h), bool)
    back[order] = smallest < least[order]
    ends = np.cumsum(sizes)
    bits = [np.packbits(back[e - s : e]).tobytes() for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
    return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "bits": pa.array(bits, pa.binary())})


def _spaced(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The slices with a blank after each, and where each begins (and the end)."""
    lengths = ends - starts
    begin = np.r_[0, np.cumsum(lengths + 1)]
    out = np.full(int(begin[-1]), 0x20, np.uint8)
    out[ranges(begin[:-1], lengths)] = data[ranges(starts, lengths)]
    return out.tobytes(), begin


def _remove(width: int, n_buckets: int):
    """Pass 3: each document without its repeats."""
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        schema = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                            ("kept_text", pa.string()), ("removed", pa.list_(span))])
        if not docs.num_rows:
            return schema.empty_table()
        w = Windows(docs, _split(replies, 1), width, n_buckets)
        before = _flags(_split(replies, 2), w.bucket)
        which = np.repeat(np.arange(len(w.begin)), np.diff(np.r_[w.begin, len(w.order)]))
        own = w.ids[w.text[w.order]]
        gone = before[which] | (own > w.least[which]) if len(own) else np.zeros(0, bool)
        places = w.windows[w.order][gone]
        n = int(w.first[-1])
        cover = np.zeros(n + 1, np.int64)
        np.add.at(cover, places, 1)
        np.add.at(cover, places + width, -1)
        covered = np.cumsum(cover)[:n] > 0
        first, kept_texts, n_kept = w.first, [], []
        for row, data, offsets in text_pieces(w.texts):
            starts, ends, f = word_spans(data, offsets)
            kept = np.flatnonzero(~covered[first[row] : first[row] + len(starts)])
            text, begin = _spaced(data, starts[kept], ends[kept])
            at = np.searchsorted(kept, f)
            a, b = begin[at[:-1]], begin[at[1:]]
            b = np.maximum(b - 1, a)  # without the last blank
            kept_texts += [text[x:y].decode() for x, y in zip(a.tolist(), b.tolist(), strict=True)]
            n_kept.append(np.diff(at))
        # maximal repeats: runs of covered words within a text
        edge = np.zeros(n + 1, bool)
        edge[first[first < n]] = True
        head = covered & (edge[:n] | ~np.r_[False, covered[:-1]])
        tail = covered & (edge[1:] | ~np.r_[covered[1:], False])
        tail[n - 1 : n] = covered[n - 1 : n]
        run_start, run_end = np.flatnonzero(head), np.flatnonzero(tail) + 1
        owner = _text_of(run_start, first)
        spans = pa.StructArray.from_arrays(
            [pa.array(run_start - first[owner]), pa.array(run_end - first[owner])], names=["start", "end"]
        )
        list_ends = np.searchsorted(run_start, first).astype(np.int32)
        return pa.table({
            "id": docs.column("id").combine_chunks(), "n_words": pa.array(w.n_words.astype(np.int64)),
            "n_removed": pa.array((w.n_words - np.concatenate(n_kept)).astype(np.int64)),
            "kept_text": pa.array(kept_texts, pa.string()),
            "removed": pa.ListArray.from_arrays(pa.array(list_ends), spans),
        }, schema)

    return run


def dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, from_files: bool = False
) -> DataFrame:
    """id_col, n_words, n_removed, kept_text (words one blank apart), removed (spans of words): a row for each document.

    ``from_files``: ``docs`` is a plain scan of files that do not change meanwhile; otherwise it is written first.
    """
    rows = stable(docs, id_col, text_col, from_files)
    n = buckets_of(rows)
    sent = rows.select("chunk", "text").mapInArrow(tidy(_probes((width + 1) // 2, n)), "chunk bigint, bucket bigint, sent binary")
    answer = "chunk bigint, bucket bigint, bits binary"
    anchors = stage(sent.groupBy("bucket").applyInArrow(tidy_group(_anchors), answer), "anchors")
    asked = rows.groupBy("chunk").cogroup(anchors.groupBy("chunk")).applyInArrow(
        tidy_group(_ask(width, n)), "chunk bigint, bucket bigint, hashes binary, checks binary, least binary"
    )
    earlier = stage(asked.groupBy("bucket").applyInArrow(tidy_group(_answer), answer), "earlier")
    replies = anchors.withColumn("kind", F.lit(1)).unionByName(earlier.withColumn("kind", F.lit(2)))
    found = rows.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        tidy_group(_remove(width, n)),
        "id bigint, n_words bigint, n_removed bigint, kept_text string, removed array<struct<start: bigint, end: bigint>>",
    )
    return found.withColumnRenamed("id", id_col)
