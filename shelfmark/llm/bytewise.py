"""Texts as arrays of bytes: bounded pieces of a batch, words, and hashes of slices, without a loop over characters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

PIECE = 2 << 20  # bytes of text handled at a time; bounds the memory of a task, not the work
LONG_SLICE = 256  # longer slices are hashed one by one

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64))


def pieces(batch: pa.RecordBatch, column: str | int, limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with at most ``limit`` bytes of text; a longer text is a piece of its own."""
    if batch.num_rows == 0:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(size, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = total[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(total, before + limit, "right")))
        yield batch.slice(at, upto - at)
        at = upto


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if texts.null_count:
        texts = pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    n, at = len(texts), texts.offset
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[at : at + n + 1].astype(np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def is_white(data: np.ndarray) -> np.ndarray:
    return _WHITE[data]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words between white characters, and for each text where its words begin (n + 1)."""
    word = ~_WHITE[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = word
    inner = offsets[offsets < len(data)]
    before[inner] = False  # a text begins
    starts = np.flatnonzero(word & ~before[:-1])
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = word
    after[offsets] = False  # a text ends
    ends = np.flatnonzero(word & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


class Powers:
    """Powers of the base and of its inverse, as far as the longest piece so far."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def reach(cls, n: int) -> None:
        if len(cls.up) < n:
            n = 1 << (n - 1).bit_length()
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(cls, name, np.multiply.accumulate(steps))


def slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each slice; equal bytes give equal hashes wherever they stand.

    Differences of one running polynomial sum, so a slice costs the same at any length.  Sums modulo a power of two
    can be led astray by long regular slices; those are hashed on their own.
    """
    Powers.reach(len(data) + 1)
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * Powers.up[: len(data)], out=running[1:])
    found = mix((running[ends] - running[starts]) * Powers.down[starts] + (ends - starts).astype(np.uint64))
    for i in np.flatnonzero(ends - starts > LONG_SLICE):
        found[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]], seed=7)
    return found


def window_hashes(items: np.ndarray, width: int, base: int) -> np.ndarray:
    """A hash of each run of ``width`` consecutive items (len - width + 1 of them)."""
    n = len(items) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    found = np.zeros(n, np.uint64)
    for k in range(width):
        found *= np.uint64(base)
        found += items[k : k + n]
    return mix(found)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each of several runs, one after the other."""
    total = int(counts.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    first = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return first + np.arange(total)
