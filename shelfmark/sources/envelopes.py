"""Large JSON envelopes read by many tasks.

A document ``{"results": [{...}, {...}]}`` is read as fragments that end at a closing brace, which Spark splits like any
text.  Whether a brace stands in a string, how deep it lies and which element it ends are running sums over the
fragments of a file.  Splits of a file that has several are summed up first, a row a split; with what lies before it
known, each split is then walked through once, in the order it is read, and its elements are parsed on the spot.  Only
an element that a border of splits runs through is put together from pieces.  The text is never shuffled or kept.

Rows come as from the other layouts: ``r``, ``position`` (from 0 within the array), ``source_file``, ``corrupt``.  An
element that can't be parsed is one corrupt row, the others stay.  A file whose braces or strings don't close is one
corrupt row with its first fragment.  A file without elements in the array gives one row with neither.  Elements that
aren't objects are left out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import shared_folder
from .tables import remove

CORRUPT = "_corrupt_record"
_STRING = r'"[^"]*"'
# what lies before the first brace that is in no string, and the rest
_HEAD = r'(?s)^((?:[^"{]++|"(?:[^"\\]++|\\.)*+")*+)(\{.*)$'
_ARRAY = r'(?s)"((?:[^"\\]|\\.)*)"\s*:\s*\[\s*$'

# rows of a walk: an element, a piece of one that does or does not end it, and what a split ends with
_ELEMENT, _LAST_PIECE, _PIECE, _SPLIT = range(4)
_WALK = "kind int, source_file string, block bigint, number bigint, text binary, depth bigint, in_string boolean"

_made: list[str] = []


def _count(text: Column, character: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What is staged for feeds read inside goes afterwards; their rows are used inside, too."""
    n = len(_made)
    try:
        yield
    finally:
        while len(_made) > n:
            remove(spark, _made.pop())


def _staged(df: DataFrame) -> DataFrame:
    """Written once below the shared folder: what follows reads it several times."""
    folder = shared_folder(df.sparkSession, "envelopes")
    _made.append(folder)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _opens_outside(bare: Column) -> Column:
    """Opening braces in no string, if the text begins outside; most fragments have theirs before the first quote."""
    every = _count(bare, "{")
    return F.when(_count(F.substring_index(bare, '"', 1), "{") == every, every).otherwise(
        _count(F.regexp_replace(bare, r'"[^"]*+"?+', ""), "{")
    )


def fragments(spark: SparkSession, path: str) -> DataFrame:
    """The fragments of all files, in the order they are read, with what is counted in each.

    ``text`` has the brace that ends it, also where the file ends without one.  ``quotes``, and ``opens_out`` and
    ``opens_in``: opening braces, if the fragment begins outside or in a string.
    """
    raw = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_block_length").alias("length"), F.col("_metadata.file_size").alias("file_size"), F.col("value").alias("text"),
    )
    bare = F.when(F.col("text").contains("\\"), F.regexp_replace("text", r"(?s)\\.", "")).otherwise(F.col("text"))
    raw = raw.withColumn("_bare", bare)
    raw = raw.select(
        "source_file", "block", "length", "file_size", F.concat("text", F.lit("}")).alias("text"),
        _count(F.col("_bare"), '"').alias("quotes"), _opens_outside(F.col("_bare")).alias("opens_out"), _count(F.col("_bare"), "{").alias("_every"),
    )
    return raw.withColumn("opens_in", F.col("_every") - F.col("opens_out")).drop("_every")  # what a quote tells apart changes sides


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The parts of a batch that are of one split, each with file and block."""
    files, blocks = batch.column("source_file"), batch.column("block").to_numpy()
    changes = np.flatnonzero(blocks[1:] != blocks[:-1]) + 1
    if batch.num_rows > 1:
        others = pa.compute.not_equal(files.slice(1), files.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
        changes = np.union1d(changes, np.flatnonzero(others) + 1)
    borders = [0, *changes.tolist(), batch.num_rows]
    for begin, end in zip(borders, borders[1:]):
        if end > begin:
            yield (files[begin].as_py(), int(blocks[begin])), batch.slice(begin, end - begin)


def _walked(rows: pa.RecordBatch, closed: bool, inside: int, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each fragment: does it end in a string, how deep, and is there a closing brace that counts."""
    quotes, out, within = (rows.column(c).to_numpy().astype(np.int64) for c in ("quotes", "opens_out", "opens_in"))
    after = inside + np.cumsum(quotes)
    ends_in = after % 2 == 1
    closes = ~ends_in if closed else np.zeros(len(quotes), bool)
    return ends_in, depth + np.cumsum(np.where((after - quotes) % 2 == 1, within, out) - closes), closes


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row a split: bytes, odd quotes, and for a begin outside or in a string the change of depth and the closing braces by depth after them."""
    done, key, n_bytes, odd, depths, braces = [], None, 0, 0, [0, 0], [Counter(), Counter()]

    def end() -> None:
        if key:
            found = [([*c], [*c.values()]) for c in braces]
            done.append((*key, n_bytes, odd, depths[0], *found[0], depths[1], *found[1]))

    for batch in batches:
        for at, rows in _runs(batch):
            if at != key:
                end()
                key, n_bytes, odd, depths, braces = at, 0, 0, [0, 0], [Counter(), Counter()]
            for begin in (0, 1):
                ends_in, depth, closes = _walked(rows, True, (odd + begin) % 2, depths[begin])
                braces[begin].update(dict(zip(*(x.tolist() for x in np.unique(depth[closes], return_counts=True)))))
                depths[begin] = int(depth[-1])
                if begin == 0:
                    odd_after = int(ends_in[-1])
            n_bytes, odd = n_bytes + int(rows.column("n_bytes").to_numpy().sum()), odd_after
    end()
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), _SUMS)], names=_SUM_NAMES)


_SUMS = [pa.string(), *[pa.int64()] * 4, *[pa.list_(pa.int64())] * 2, pa.int64(), *[pa.list_(pa.int64())] * 2]
_SUM_NAMES = ["source_file", "block", "n_bytes", "odd", "depth_out", "at_out", "n_out", "depth_in", "at_in", "n_in"]


def numbered(pieces: DataFrame) -> DataFrame:
    """The splits of files that have several, without their text: a row each, with what its fragments add up to."""
    several = pieces.where(F.col("length") < F.col("file_size"))
    several = several.select("source_file", "block", F.octet_length("text").alias("n_bytes"), "quotes", "opens_out", "opens_in")
    lists = "array<bigint>"
    return several.mapInArrow(_summed, ", ".join(f"{n} {lists if pa.types.is_list(t) else 'string' if pa.types.is_string(t) else 'bigint'}" for n, t in zip(_SUM_NAMES, _SUMS)))


def begins(splits: DataFrame) -> dict[tuple[str, int], tuple[int, int, int, int]]:
    """What lies before each split of ``numbered``: bytes, in a string or not, depth, elements.

    They reach the driver, which lists the same splits for every scan.
    """
    known, file, state = {}, None, None
    for s in sorted(splits.collect(), key=lambda s: (s.source_file, s.block)):
        if s.source_file != file:
            file, state = s.source_file, (0, 0, 0, 0)
        known[s.source_file, s.block] = state
        n_bytes, inside, depth, number = state
        change, at, counts = (s.depth_in, s.at_in, s.n_in) if inside else (s.depth_out, s.at_out, s.n_out)
        state = n_bytes + s.n_bytes, (inside + s.odd) % 2, depth + change, number + dict(zip(at, counts)).get(1 - depth, 0)
    return known


class _Walk:
    """A split on its way through: its state, the text since the last element, and the fragment that may be the file's last."""

    def __init__(self, key: tuple[str, int], rows: pa.RecordBatch, known: dict) -> None:
        self.file, self.block = key
        length, self.size = rows.column("length")[0].as_py(), rows.column("file_size")[0].as_py()
        self.goes_on = self.block + length < self.size
        # a split without a known begin must be a file of its own: splits of the two scans are the same
        state = known[key] if self.block or self.goes_on else (0, 0, 0, 0)
        self.n_bytes, self.inside, self.depth, self.number = state
        self.first = rows.column("text")[0].as_py()[:-1] if self.block == 0 else None
        self.begun, self.cut, self.held = [], self.block > 0, None

    def take(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if self.held:
            rows = pa.Table.from_batches([self.held, rows]).combine_chunks().to_batches()[0]
        self.held = rows.slice(rows.num_rows - 1)
        yield from self._go(rows.slice(0, rows.num_rows - 1), True)

    def end(self) -> Iterator[pa.RecordBatch]:
        last = len(self.held.column("text")[0].as_py())
        yield from self._go(self.held, self.n_bytes + last <= self.size)
        if self.goes_on and self.begun:
            yield self._rows(_PIECE, pa.array([b"".join(self.begun)], pa.binary()))
        yield self._rows(_SPLIT, pa.array([self.first], pa.binary()))

    def _go(self, rows: pa.RecordBatch, closed: bool) -> Iterator[pa.RecordBatch]:
        if not rows.num_rows:
            return
        ends_in, depth, closes = _walked(rows, closed, self.inside, self.depth)
        self.inside, self.depth = int(ends_in[-1]), int(depth[-1])
        text = rows.column("text")
        data = text.buffers()[2]
        at = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1]
        self.n_bytes += int(at[-1] - at[0])
        ends = at[1:][closes & (depth == 1)]
        begin, stop = int(at[0]), int(at[-1]) - (not closed)
        if len(ends) and (self.begun or self.cut):
            self.begun.append(data.slice(begin, int(ends[0]) - begin).to_pybytes())
            yield self._rows(_LAST_PIECE if self.cut else _ELEMENT, pa.array([b"".join(self.begun)], pa.binary()))
            self.begun, self.cut, begin, ends = [], False, int(ends[0]), ends[1:]
        if len(ends):  # elements lie one after the other, so their texts are where they were read
            offsets = pa.py_buffer(np.concatenate([[begin], ends]).astype(np.int32))
            yield self._rows(_ELEMENT, pa.Array.from_buffers(pa.binary(), len(ends), [None, offsets, data]))
            begin = int(ends[-1])
        if stop > begin:
            self.begun.append(data.slice(begin, stop - begin).to_pybytes())

    def _rows(self, kind: int, text: pa.Array) -> pa.RecordBatch:
        n, number = len(text), self.number
        if kind in (_ELEMENT, _LAST_PIECE):
            self.number += n
        of = [pa.array(np.full(n, kind, np.int32)), pa.repeat(self.file, n), pa.array(np.full(n, self.block)), pa.array(np.arange(number, number + n))]
        return pa.RecordBatch.from_arrays(
            [*of, text, pa.array(np.full(n, self.depth)), pa.array(np.full(n, self.inside == 1))],
            names=["kind", "source_file", "block", "number", "text", "depth", "in_string"],
        )


def _walk(known: dict) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = walk = None
        for batch in batches:
            for at, rows in _runs(batch):
                if at != key:
                    if walk:
                        yield from walk.end()
                    key, walk = at, _Walk(at, rows, known)
                yield from walk.take(rows)
        if walk:
            yield from walk.end()

    return run


def _parsed(found: DataFrame, record: StructType, *others: str) -> DataFrame:
    """Elements by their text: the member their head names, the record, or the text that can't be read."""
    raw = F.when(F.col("number") == 0, F.regexp_replace("raw", r"^[\s\x{FEFF}]*\{", "")).otherwise(F.col("raw"))
    found = found.withColumn("raw", raw)
    plain = F.col("raw").startswith(",{")  # as nearly all are
    found = found.withColumn("head", F.when(plain, F.lit(",")).otherwise(F.regexp_extract("raw", _HEAD, 1)))
    found = found.withColumn("body", F.when(plain, F.expr("substring(raw, 2)")).otherwise(F.regexp_extract("raw", _HEAD, 2)))
    # which member of the envelope an element lies in: said by the text before the first of its elements
    outside = F.regexp_replace(F.regexp_replace("head", r"(?s)\\.", ""), _STRING, "")
    said = F.when(F.col("head") == ",", None).when(F.col("head").rlike(_ARRAY), F.regexp_extract("head", _ARRAY, 1)).when(outside.rlike(r"[\]:]"), F.lit(""))
    with_text = StructType([*record.fields, StructField(CORRUPT, StringType())])
    found = found.withColumn("parsed", F.from_json("body", with_text, {"columnNameOfCorruptRecord": CORRUPT}))
    bad = F.col("parsed").isNull() | F.col(f"parsed.{CORRUPT}").isNotNull()
    return found.select(
        "source_file", "number", F.when(F.col("raw").isNotNull(), said).alias("said"),
        F.when(~bad, F.struct(*[F.col(f"parsed.{n}").alias(n) for n in record.names])).alias("r"), F.when(bad, F.col("body")).alias("corrupt"), *others,
    )


def read(spark: SparkSession, path: str, record: StructType, field: str = "results") -> DataFrame:
    """Records of envelopes as ``r``, with ``position``, ``source_file`` and ``corrupt``."""
    pieces = fragments(spark, path)
    walked = pieces.mapInArrow(_walk(begins(numbered(pieces))), _WALK)
    walked = walked.withColumn("text", F.col("text").cast("string")).withColumn("raw", F.when(F.col("kind") == _ELEMENT, F.col("text")))
    left = F.when(F.col("kind") != _ELEMENT, F.col("text")).alias("text")
    walked = _staged(_parsed(walked, record, "kind", "block", left, "depth", "in_string"))

    at_end = F.max_by(F.struct("depth", "in_string"), "block").alias("end")
    files = walked.where(F.col("kind") == _SPLIT).groupBy("source_file").agg(at_end, F.max("text").alias("text"))
    files = files.select("source_file", "text", ((F.col("end.depth") == 0) & ~F.col("end.in_string")).alias("whole"))
    broken = walked.where(F.col("kind").isin(_PIECE, _LAST_PIECE)).groupBy("source_file", "number").agg(
        F.max(F.col("kind") == _LAST_PIECE).alias("ends"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "text"))), lambda x: x["text"]), "").alias("raw"),
    )
    found = walked.where(F.col("kind") == _ELEMENT).select("source_file", "number", "said", "r", "corrupt")
    found = found.unionByName(_parsed(broken.where("ends"), record))
    members = found.where(F.col("said").isNotNull()).groupBy("source_file").agg(F.array_sort(F.collect_list(F.struct("number", "said"))).alias("members"))
    member = F.element_at(F.filter("members", lambda m: m["number"] <= F.col("number")), -1)
    inner = found.join(members.join(files.where("whole").select("source_file"), "source_file"), "source_file")
    inner = inner.withColumn("member", member).where(F.col("member.said") == field)
    rows = inner.select((F.col("number") - F.col("member.number")).alias("position"), "r", "source_file", "corrupt")

    without = files.join(rows.select("source_file").distinct(), "source_file", "left_anti")
    nothing = [F.lit(None).cast("bigint").alias("position"), F.lit(None).cast(record).alias("r"), "source_file"]
    rows = rows.unionByName(without.where(~F.col("whole")).select(*nothing, F.col("text").alias("corrupt")))
    return rows.unionByName(without.where("whole").select(*nothing, F.lit(None).cast("string").alias("corrupt")))
