"""Phrases whose words occur together more often than apart, mined from sorted streams of n-gram counts.

Count streams.  A task numbers the words of about ``RUN_WORDS`` words of text and writes one *run*: its words, and for
each order the distinct n-grams as word numbers with their counts, in prefix order (first word first), packed as
differences.  Runs are a table in the shared folder: the text is read once, and what follows can be repeated from there.

Which n-grams are frequent.  Each run sends its n-grams as sorted keys to ranges of keys, 32 bits within a range.  A range merges the
sorted streams of all runs, adds the counts of adjacent equal keys, and answers every run with the keys that reach
``least``.  Keys only rule n-grams out: equal keys of different n-grams can add counts, never take any away.  The runs
then give the n-grams that are left as words, a row for each run and part, and these counts are added exactly.  As a part of a phrase occurs at least
as often as the phrase, everything a candidate needs is among them.

Lockstep joins.  The counts are joined in prefix order with those of their first words (left counts, and the greatest
count of an extension to the right), and in suffix order with those of their last words (right counts, and extensions
to the left).  All are merge joins of sorted streams.  A cut before the last ``k`` words needs both, so the two streams
are merged once more by whole phrase.  A phrase inside any longer one is inside one that is longer by a single word and
at least as frequent, so one step of extension suffices.

Skew: a common n-gram stands once in a run, whatever its share, so a range gets at most a row for each run and key; the
number of ranges follows the number of counts.  Joins leave hot keys to the adaptive skew join.

Defined results: null texts are empty, a null language is ``und``.  Repeated rows count each time.  Texts of any length
are read whole; n-grams never cross a run's border, as runs hold whole texts.  An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bytewise import lower_ascii, mix, pieces, slice_hashes, text_bytes
from .chunked import starts_of
from .stages import shuffle_partitions, stage, tidy, tidy_group

RUN_WORDS = 1 << 19
RUNS_A_FILE = 4  # readers hold a row group whole, which is a file here
PER_RANGE = 1 << 19  # counts merged by one range at a time
RANGES_A_PART = 4  # what may be frequent is a fraction of all counts, so a part of it may be greater
MOST_WORDS = 3
LEAST = 10
SCALE = 1_000_000
ANSWER = "run string, keys binary"
SPELLED = "part bigint, names array<string>, codes binary, words binary, counts binary"

# What ends a piece, and the blanks between words.
_ENDS = np.zeros(256, bool)
_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09]] = True


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, text and piece (numbered through all texts) of every word."""
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    inner = ~(_ENDS[data] | _BLANK[data])
    starts = np.flatnonzero(inner & (edge[:-1] | ~np.r_[False, inner[:-1]]))
    ends = np.flatnonzero(inner & (edge[1:] | ~np.r_[inner[1:], False])) + 1
    piece = np.cumsum(_ENDS[data] | edge[:-1])[starts]
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1, piece


def pack(x: np.ndarray) -> bytes:
    """Numbers in as many bytes as the greatest needs: all first bytes, then all second ones, so high bytes compress well."""
    if not len(x):
        return b""
    x = np.ascontiguousarray(x, np.uint64)
    width = max(1, (int(x.max()).bit_length() + 7) // 8)
    return bytes([width]) + x.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpack(data: bytes, dtype) -> np.ndarray:
    if not data:
        return np.zeros(0, dtype)
    body = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    out = np.zeros((body.shape[1], 8), np.uint8)
    out[:, : data[0]] = body.T
    return out.reshape(-1).view(np.uint64).astype(dtype, copy=False)


def pack_sorted(x: np.ndarray) -> bytes:
    """Ascending numbers: the first one, then differences."""
    x = np.ascontiguousarray(x).astype(np.uint64, copy=False)
    return x[:1].tobytes() + pack(np.diff(x)) if len(x) else b""


def unpack_sorted(data: bytes, dtype) -> np.ndarray:
    if not data:
        return np.zeros(0, dtype)
    steps = np.r_[np.frombuffer(data, np.uint64, 1), unpack(data[8:], np.uint64)]
    return np.cumsum(steps, dtype=np.uint64).astype(dtype, copy=False)


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    begin = starts_of(keys)
    return keys[begin], np.diff(np.r_[begin, len(keys)])


class _Run:
    """Texts gathered until they make a run."""

    def __init__(self, most: int):
        self.most = most
        self.n = 0
        self.hashes, self.pieces, self.words, self.langs = [], [], [], []
        self.last_piece = 0

    def add(self, texts: pa.Array, langs: pa.Array) -> None:
        data, offsets = text_bytes(texts)
        data = lower_ascii(data)
        starts, ends, text, piece = words_of(data, offsets)
        lang = langs.dictionary_encode()
        code = lang.indices.to_numpy(zero_copy_only=False)
        hashes = _salted(slice_hashes(data, starts, ends), lang.dictionary, code[text])
        _, one = np.unique(hashes, return_index=True)
        raw = data.tobytes()
        self.words.append([raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[one].tolist(), ends[one].tolist(), strict=True)])
        self.langs.append(lang.dictionary.take(pa.array(code[text[one]])).to_pylist())
        self.hashes.append((hashes, hashes[one]))
        self.pieces.append(piece + self.last_piece)
        self.last_piece += int(piece[-1]) + 1 if len(piece) else 0
        self.n += len(starts)

    def row(self) -> dict:
        """Words in the order of their hashes, and for each order packed n-grams of word numbers with counts."""
        hashes = np.concatenate([h for h, _ in self.hashes])
        known, first = np.unique(np.concatenate([k for _, k in self.hashes]), return_index=True)
        words = [w for part in self.words for w in part]
        langs = [x for part in self.langs for x in part]
        number = np.searchsorted(known, hashes)
        piece = np.concatenate(self.pieces)
        grams, counts = [], []
        before = number  # of each place: the number of the shorter n-gram that begins there
        for order in range(1, self.most + 1):
            m = len(number) - order + 1
            if order == 1:
                keys = number.astype(np.int64)
            elif m > 0:
                inside = piece[:m] == piece[order - 1 :]
                keys = np.where(inside, before[:m] * np.int64(len(known)) + number[order - 1 :], -1)
            else:
                keys = np.zeros(0, np.int64)
            distinct, count = _counted(keys[keys >= 0])
            grams.append(distinct)
            counts.append(count)
            if order < self.most:
                before = np.searchsorted(distinct, keys)
        spelled = [words[i].encode() for i in first]
        names = sorted(set(langs))
        return {
            "run": uuid.uuid4().hex, "words": b"".join(spelled), "ends": pack_sorted(np.cumsum([len(w) for w in spelled], dtype=np.int64)),
            "codes": pack(np.array([names.index(langs[i]) for i in first], np.uint32)), "names": names,
            "grams": [pack_sorted(g) for g in grams], "counts": [pack(c) for c in counts], "sizes": [len(g) for g in grams],
        }


def _salted(hashes: np.ndarray, langs: pa.Array, code: np.ndarray) -> np.ndarray:
    """Hashes of words in their languages."""
    data, offsets = text_bytes(langs)
    salt = mix(slice_hashes(data, offsets[:-1], offsets[1:]) + np.uint64(1))  # not as a word's, lest they change places
    return mix(hashes ^ salt[code]) if len(hashes) else hashes


# words lie one after the other in one cell: cells of many thousand elements are costly to read back
RUN = "run string, words binary, ends binary, codes binary, names array<string>, grams array<binary>, counts array<binary>, sizes array<bigint>"
_RUN = pa.schema([
    ("run", pa.string()), ("words", pa.binary()), ("ends", pa.binary()), ("codes", pa.binary()), ("names", pa.list_(pa.string())),
    ("grams", pa.list_(pa.binary())), ("counts", pa.list_(pa.binary())), ("sizes", pa.list_(pa.int64())),
])


def count_runs(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most: int = MOST_WORDS) -> DataFrame:
    """Runs of counts of all n-grams of up to ``most`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Run(most)
        for piece in (p for batch in batches for p in pieces(batch, "text")):
            held.add(piece.column("text"), piece.column("lang"))
            if held.n >= RUN_WORDS:
                yield pa.RecordBatch.from_pylist([held.row()], _RUN)
                held = _Run(most)
        if held.n:
            yield pa.RecordBatch.from_pylist([held.row()], _RUN)

    rows = docs.select(
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
    )
    return rows.mapInArrow(tidy(run), RUN)


class _Stream:
    """A run read back: for each order the n-grams as columns of word numbers, their counts and keys."""

    def __init__(self, row: dict):
        offsets = np.r_[0, unpack_sorted(row["ends"], np.int64)]
        self.words = pa.Array.from_buffers(
            pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(row["words"])]
        )
        self.names, self.codes = pa.array(row["names"], pa.string()), unpack(row["codes"], np.uint32).astype(np.int64)
        data = np.frombuffer(row["words"], np.uint8)
        hashes = _salted(slice_hashes(data, offsets[:-1], offsets[1:]), self.names, self.codes)
        self.orders = []
        above = None
        for order, (grams, counts) in enumerate(zip(row["grams"], row["counts"], strict=True), 1):
            grams, counts = unpack_sorted(grams, np.int64), unpack(counts, np.uint32).astype(np.int64)
            if order == 1:
                columns, keys = [grams], hashes[grams]
            else:
                shorter, word = np.divmod(grams, len(hashes))
                columns = [c[shorter] for c in above[0]] + [word]
                keys = mix(above[1][shorter] * np.uint64(0x9E3779B97F4A7C15) + hashes[word])
            above = columns, keys
            self.orders.append((columns, counts, mix(keys + np.uint64(order))))


def ranged(keys: np.ndarray, n_ranges: int) -> np.ndarray:
    """The range of a key above 32 of its bits within the range: ascending with the key."""
    width = (1 << 64) // n_ranges + 1
    if n_ranges == 1:
        return keys >> np.uint64(32)
    part = keys // np.uint64(width)
    inside = (keys - part * np.uint64(width)) >> np.uint64(max(0, (width - 1).bit_length() - 32))
    return part << np.uint64(32) | inside


def _to_ranges(n_ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                orders = _Stream(row).orders
                keys = ranged(np.concatenate([k for _, _, k in orders]), n_ranges)
                order = np.argsort(keys)
                keys, counts = keys[order], np.concatenate([c for _, c, _ in orders])[order]
                part = (keys >> np.uint64(32)).astype(np.int64)
                begin = starts_of(part)
                spans = list(zip(begin.tolist(), [*begin[1:].tolist(), len(keys)], strict=True))
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(part[begin]), "run": pa.array([row["run"]] * len(spans), pa.string()),
                    "keys": pa.array([pack_sorted(keys[a:b]) for a, b in spans], pa.binary()),
                    "counts": pa.array([pack(counts[a:b]) for a, b in spans], pa.binary()),
                })

    return run


def _frequent_of(least: int):
    def run(table: pa.Table) -> pa.Table:
        """The sorted streams of all runs, merged: which keys reach ``least``, to each run that holds them."""
        streams = [unpack_sorted(x, np.uint64) for x in table.column("keys").to_pylist()]
        keys = np.concatenate(streams)
        counts = np.concatenate([unpack(x, np.uint32) for x in table.column("counts").to_pylist()]).astype(np.int64)
        order = np.argsort(keys, kind="stable")  # a merge, as the streams are sorted
        keys = keys[order]
        begin = starts_of(keys)
        frequent = keys[begin][np.add.reduceat(counts[order], begin) >= least]
        runs, answers = [], []
        for name, stream in zip(table.column("run").to_pylist(), streams, strict=True):
            kept = stream[_among(stream, frequent)]
            if len(kept):
                runs.append(name)
                answers.append(pack_sorted(kept))
        return pa.table({"run": pa.array(runs, pa.string()), "keys": pa.array(answers, pa.binary())})

    return run


def _among(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each key is among sorted ``known``."""
    if not len(known):
        return np.zeros(len(keys), bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


def _spelled(most: int, n_ranges: int, n_parts: int):
    def run(runs: pa.Table, answers: pa.Table) -> pa.Table:
        """The n-grams of a run that may be frequent, as words: a row for each part, like beside like and compressed."""
        if not runs.num_rows or not answers.num_rows:
            return _SPELLED.empty_table()
        known = np.sort(np.concatenate([unpack_sorted(x, np.uint64) for x in answers.column("keys").to_pylist()]))
        stream = _Stream(runs.to_pylist()[0])
        places, counts = [[] for _ in range(most + 1)], []
        for columns, f, keys in stream.orders:
            some = np.flatnonzero(_among(ranged(keys, n_ranges), known))
            # runs number their words differently: an n-gram's part follows its key
            places[0].append((mix(keys[some]) % np.uint64(n_parts)).astype(np.int64))
            for k in range(most):
                places[k + 1].append(columns[k][some] if k < len(columns) else np.full(len(some), -1))
            counts.append(f[some])
        part, *words = map(np.concatenate, places)
        order = np.lexsort((*words[::-1], part))
        part, words, counts = part[order], [w[order] for w in words], np.concatenate(counts)[order]
        begin = starts_of(part)
        spans = list(zip(begin.tolist(), [*begin[1:].tolist(), len(part)], strict=True))
        every = pa.concat_arrays([stream.words, pa.array([""], stream.words.type)])
        ended = pc.binary_join_element_wise(every, *(pa.scalar(x, stream.words.type) for x in ("", _END)))
        lines = [_lines(ended, w) for w in words]  # -1 is the last, which is empty
        codes = stream.codes[words[0]]
        return pa.table({
            "part": pa.array(part[begin], pa.int64()), "names": pa.array([stream.names.to_pylist()] * len(spans), pa.list_(pa.string())),
            "codes": pa.array([pack(codes[a:b]) for a, b in spans], pa.binary()),
            "words": pa.array([_squeezed([data[at[a] : at[b]] for data, at in lines]) for a, b in spans], pa.binary()),
            "counts": pa.array([pack(counts[a:b]) for a, b in spans], pa.binary()),
        }, _SPELLED)

    return run


_END = "\n"  # no word holds it, as it ends pieces
_SPELLED = pa.schema([
    ("part", pa.int64()), ("names", pa.list_(pa.string())), ("codes", pa.binary()), ("words", pa.binary()), ("counts", pa.binary()),
])


def _lines(ended: pa.Array, numbers: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The words of these numbers, one after the other, and where each begins (and the end)."""
    data, offsets = text_bytes(ended.take(pa.array(np.where(numbers < 0, len(ended) - 1, numbers))))
    return data.tobytes(), offsets


def _squeezed(columns: list[bytes]) -> bytes:
    raw = np.array([len(c) for c in columns], np.uint32).tobytes() + b"".join(columns)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unsqueezed(cell: bytes, most: int) -> list[bytes]:
    raw = pa.decompress(cell[8:], int.from_bytes(cell[:8], "little"), codec="zstd", asbytes=True)
    ends = 4 * most + np.r_[0, np.cumsum(np.frombuffer(raw, np.uint32, most), dtype=np.int64)]
    return [raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def _added(most: int, least: int):
    words = [f"w{k}" for k in range(1, most + 1)]
    schema = pa.schema([("lang", pa.string()), *[(w, pa.string()) for w in words], ("f", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        """What the runs have sent a part: n-grams are told apart by their words, their counts added."""
        names, codes, counts = (table.column(c).to_pylist() for c in ("names", "codes", "counts"))
        langs = [pa.array(n, pa.string()).take(pa.array(unpack(c, np.int64))) for n, c in zip(names, codes, strict=True)]
        cells = [_unsqueezed(c, most) for c in table.column("words").to_pylist()]
        spelled = [pa.array(b"".join(column).decode().split(_END)[:-1], pa.string()) for column in zip(*cells, strict=True)]
        f = pa.array(np.concatenate([unpack(c, np.int64) for c in counts]))
        sums = pa.table([pa.concat_arrays(langs), *spelled, f], names=["lang", *words, "f"])
        sums = sums.group_by(["lang", *words], use_threads=False).aggregate([("f", "sum")])
        sums = sums.filter(pc.greater_equal(sums.column("f_sum"), least))
        spelled = [pc.if_else(pc.equal(sums.column(w), ""), pa.scalar(None, pa.string()), sums.column(w)) for w in words]
        return pa.table([sums.column("lang"), *spelled, sums.column("f_sum")], schema=schema)

    return run


def frequent(runs: DataFrame, most: int = MOST_WORDS, least: int = LEAST) -> DataFrame:
    """lang, w1, w2, ... (null beyond the phrase), f: all n-grams that occur ``least`` times or more, counted exactly."""
    entries = runs.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    partitions = shuffle_partitions(runs.sparkSession)
    n_ranges = max(partitions, -(-entries // PER_RANGE))
    n_parts = max(partitions, -(-n_ranges // RANGES_A_PART))
    sent = runs.mapInArrow(tidy(_to_ranges(n_ranges)), "part bigint, run string, keys binary, counts binary")
    answers = stage(sent.groupBy("part").applyInArrow(tidy_group(_frequent_of(least)), ANSWER), "answers")
    spelled = runs.groupBy("run").cogroup(answers.groupBy("run")).applyInArrow(
        tidy_group(_spelled(most, n_ranges, n_parts)), SPELLED
    )
    words = ", ".join(f"w{k} string" for k in range(1, most + 1))
    return spelled.groupBy("part").applyInArrow(tidy_group(_added(most, least)), f"lang string, {words}, f bigint")


def _order(counts: DataFrame, words: int, most: int) -> DataFrame:
    """The n-grams of one order."""
    found = counts.where(F.col(f"w{words}").isNotNull())
    if words < most:
        found = found.where(F.col(f"w{words + 1}").isNull())
    return found.select("lang", *[f"w{k}" for k in range(1, words + 1)], "f")


def _wide(value: Column) -> Column:
    return value.cast("decimal(14,0)")


def score(a: Column, left: Column, right: Column, scale: int = SCALE) -> Column:
    """floor(scale * a * a / (left * right)); exact for counts of up to 14 digits, as long as the scale has 7."""
    return F.floor((_wide(a) * _wide(a) * F.lit(scale).cast("decimal(7,0)") - F.pmod(
        _wide(a) * _wide(a) * F.lit(scale).cast("decimal(7,0)"), _wide(left) * _wide(right)
    )) / (_wide(left) * _wide(right))).cast("long")


def candidates(counts: DataFrame, most: int = MOST_WORDS, share: tuple[int, int] = (1, 2)) -> DataFrame:
    """lang, phrase, a, l, r, score of every phrase of 2 to ``most`` words that no frequent extension swallows.

    ``share``: a phrase goes if an extension has at least this part of its count.
    """
    orders = {m: _order(counts, m, most) for m in range(1, most + 1)}
    found = None
    for m in range(2, most + 1):
        words = [f"w{k}" for k in range(1, m + 1)]
        own = orders[m].withColumnRenamed("f", "a")
        prefix, suffix = own, own.select("lang", *words)
        for k in range(1, m):  # in prefix order with the first k words, in suffix order with the last m - k
            left = orders[k].withColumnRenamed("f", f"l{k}")
            prefix = prefix.join(left.hint("merge"), ["lang", *words[:k]])
            tail = words[k:]
            right = orders[m - k].select("lang", *[F.col(f"w{j}").alias(w) for j, w in enumerate(tail, 1)], F.col("f").alias(f"r{k}"))
            suffix = suffix.join(right.hint("merge"), ["lang", *tail])
        if m < most:
            longer = orders[m + 1]
            on_right = longer.groupBy("lang", *words).agg(F.max("f").alias("x1"))
            on_left = longer.groupBy("lang", *[F.col(f"w{k + 1}").alias(f"w{k}") for k in range(1, m + 1)]).agg(F.max("f").alias("x2"))
            prefix = prefix.join(on_right.hint("merge"), ["lang", *words], "left")
            suffix = suffix.join(on_left.hint("merge"), ["lang", *words], "left")
        both = prefix.join(suffix.hint("merge"), ["lang", *words])
        if m < most:
            extended = F.greatest(F.coalesce("x1", F.lit(0)), F.coalesce("x2", F.lit(0)))
            both = both.where(extended * share[1] < F.col("a") * share[0])
        cuts = F.array(*[
            F.struct(score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
            for k in range(1, m)
        ])
        both = both.withColumn("cut", F.array_min(cuts))
        part = both.select("lang", F.concat_ws(" ", *words).alias("phrase"), "a", "cut.l", "cut.r", "cut.score")
        found = part if found is None else found.unionByName(part)
    return found


def mine(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
    most: int = MOST_WORDS, least: int = LEAST, share: tuple[int, int] = (1, 2), first: int = 2000,
) -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n, score: the ``first`` phrases of each language by score, count and phrase."""
    runs = stage(count_runs(docs, text_col, lang_col, most), "count-runs", maxRecordsPerFile=RUNS_A_FILE)
    counts = stage(frequent(runs, most, least), "counts")
    found = candidates(counts, most, share)
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(shuffle_partitions(docs.sparkSession)))
    # the first of a salt's share hold all that may be among the first of the language
    shares = Window.partitionBy("lang", "_salt").orderBy(*order)
    found = found.withColumn("_salt", salt).withColumn("_place", F.row_number().over(shares)).where(F.col("_place") <= first)
    by = Window.partitionBy("lang").orderBy(*order)
    ranked = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= first)
    totals = occurrences(runs)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def occurrences(runs: DataFrame) -> DataFrame:
    """lang, n: how many words each language has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes, counts = unpack(row["codes"], np.uint32), unpack(row["counts"], np.uint32)
                n = np.bincount(codes, weights=counts, minlength=len(row["names"])).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"lang": pa.array(row["names"], pa.string()), "n": pa.array(n)})

    return runs.select("codes", "names", F.col("counts")[0].alias("counts")).mapInArrow(run, "lang string, n bigint").groupBy("lang").agg(F.sum("n").alias("n"))
