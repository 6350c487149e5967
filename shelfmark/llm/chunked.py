"""Look-ups between chunks of documents and buckets of hashes, without moving a row for every hash.

A chunk is a set of whole documents.  A task that reads some of them sends each bucket *one* row: the distinct hashes of
that bucket, sorted and packed, with some numbers for each.  A bucket gathers the rows of all chunks, puts those of one
chunk together (``by_chunk``), works out something for each distinct hash, and answers each chunk with one row, aligned
with the sorted distinct hashes of the chunk.  However common a hash
is, it stands once in a chunk's row, so a hot key costs a bucket no more than the number of chunks.

A chunk must hold the same documents whenever it is read.  ``file_part`` follows the name and size of a row's file and
the hash of its id alone: splits move when executors come or go, chunks do not.  It suits a table read straight from
files; any other input is first written as a table (``stable``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytewise import pieces, slice_hashes, text_bytes, word_spans
from .stages import shuffle_partitions, stage

PER_FILE = 2  # chunks of a small file
CHUNK_BYTES = 1 << 22  # a greater file has a chunk for as many of its bytes: a task of the later passes holds one chunk, at some 25 times that


def file_part(id_col: str) -> Column:
    """The chunk of a row; rows of one id and file share one."""
    n = F.greatest(F.lit(PER_FILE), F.ceil(F.col("_metadata.file_size") / F.lit(CHUNK_BYTES)))
    return F.xxhash64(F.col("_metadata.file_path"), F.pmod(F.xxhash64(F.col(id_col)), n))


def stable(docs: DataFrame, id_col: str, text_col: str, from_files: bool) -> DataFrame:
    """chunk, id, text.  ``from_files``: ``docs`` is read straight from files that stay as they are."""
    own = F.col(id_col).cast("long")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    if not from_files:
        docs, own, text = stage(docs.select(own.alias("id"), text.alias("text")), "chunks"), F.col("id"), F.col("text")
    rows = docs.select("_metadata", own.alias("id"), text.alias("text"))
    return rows.select(file_part("id").alias("chunk"), "id", "text")


def by_chunk(table: pa.Table) -> list[tuple[int, list[int]]]:
    """The chunks of a bucket's rows, and which rows each has sent: several where splits cut the chunk's file."""
    rows: dict[int, list[int]] = {}
    for i, chunk in enumerate(table.column("chunk").to_pylist()):
        rows.setdefault(chunk, []).append(i)
    return list(rows.items())


def buckets_of(df: DataFrame) -> int:
    return 2 * shuffle_partitions(df.sparkSession)


def bucket_of(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes >> np.uint64(33)) % np.uint64(n)).astype(np.int64)


def _planes(x: np.ndarray) -> bytes:
    """The bytes of numbers, all first bytes first: high bytes of small numbers compress to nothing."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _from_planes(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).reshape(-1).view(dtype)


def pack_sorted(x: np.ndarray) -> bytes:
    """Ascending numbers as packed differences."""
    return _planes(np.diff(x, prepend=x.dtype.type(0))) if len(x) else b""


def unpack_sorted(data: bytes, dtype) -> np.ndarray:
    return np.cumsum(_from_planes(data, dtype), dtype=dtype) if data else np.zeros(0, dtype)


def pack(x: np.ndarray) -> bytes:
    return _planes(x) if len(x) else b""


def unpack(data: bytes, dtype) -> np.ndarray:
    return _from_planes(data, dtype) if data else np.zeros(0, dtype)


def text_pieces(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive texts, a bounded number of bytes at a time."""
    at = 0
    for piece in pieces(pa.RecordBatch.from_arrays([texts], names=["text"]), "text"):
        yield at, *text_bytes(piece.column("text"))
        at += piece.num_rows


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word of all texts, and where each text's words begin (n + 1)."""
    hashes, firsts, n = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)], 0
    for _, data, offsets in text_pieces(texts):
        starts, ends, first = word_spans(data, offsets)
        hashes.append(slice_hashes(data, starts, ends))
        firsts.append(first[1:] + n)
        n += len(starts)
    return np.concatenate(hashes), np.concatenate(firsts)


def starts_of(sorted_groups: np.ndarray) -> np.ndarray:
    """Where each group of a sorted array begins."""
    if not len(sorted_groups):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.r_[True, sorted_groups[1:] != sorted_groups[:-1]])
