"""Language identification by rank-order profiles of character n-grams.

Learning counts the 1- to 3-grams of all labelled texts by language and keeps each language's ``PROFILE`` most
frequent, in order.  A text is described the same way, and its distance to a language is the sum, over its n-grams, of
how far each stands from its place in the language's profile; an n-gram the profile lacks counts ``PROFILE`` places.
The nearest language is the prediction, ties to the smaller name.

Texts are lower-cased; a run of anything but letters counts as one blank, and a text begins and ends with one.  Three
code points fit into one 64-bit number, so n-grams are compared exactly.

What is broadcast are the profiles: ``PROFILE`` n-grams for each language, whatever the number of texts.

Defined results: null texts and texts without a letter are ``und`` with score 0, and so is every text if there is no
language to learn from.  Rows without a language, and null texts, teach nothing.  Very long texts are read whole,
repeated rows count each time.  Other columns pass through; those called like the new ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .bytewise import pieces, text_bytes
from .byte_bpe import LETTER, classes
from .chunked import starts_of
from .stages import numbered, other_fields, tidy

PROFILE = 400
PIECE = 1 << 20
HELD = 400_000  # distinct n-grams a task holds before it hands on what it has counted
WIDEST = 1 << 63  # numbers below can be sorted as one
UNKNOWN = "und"
LEAST_SCORE = 0.05


def _letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points with runs of others as one blank (0), their text, and whether each text has a letter."""
    n = len(offsets) - 1
    texts = data.tobytes()
    # lower-casing can change lengths, so texts are lowered one by one and laid out anew
    lowered = [texts[a:b].decode("utf-8").lower() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
    points = np.frombuffer(("\0" + "\0".join(lowered) + "\0").encode("utf-32-le"), np.uint32).astype(np.int64)
    sizes = np.array([len(t) for t in lowered], np.int64)
    owner = np.repeat(np.arange(n + 1), np.r_[sizes + 1, 1])
    letter = classes()[points] == LETTER
    points[~letter] = 0
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]  # of a run of others the first stays
    has = np.zeros(n, bool)
    has[owner[letter]] = True
    return points[keep], owner[keep], has


def _counted(points: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams of each of ``n`` texts with their counts, by text and n-gram: owner, code, count.

    Sorted are numbers of text and n-gram in one, in the alphabet of these texts alone, as small numbers sort faster.
    """
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    seen = np.zeros(int(points.max()) + 1, bool)
    seen[points] = True
    letters = np.r_[0, np.flatnonzero(seen) + 1]  # 0: no letter, 1: the blank
    size = len(letters)
    small = n * size**3 < 1 << 32
    kind = np.uint32 if small else np.int64
    place, one = np.cumsum(seen).astype(kind)[points], points != 0
    of_text = owner.astype(kind)
    two = place[:-1] * kind(size) + place[1:]
    real = one[:-1] | one[1:]
    # the blank between two texts closes the one and opens the other: a pair is the letter's text's
    owners = np.concatenate([of_text[one], np.where(one[:-1], of_text[:-1], of_text[1:])[real], of_text[1:-1][one[1:-1]]])
    codes = np.concatenate([place[one], two[real], (two[:-1] * kind(size) + place[2:])[one[1:-1]]])
    known, span = None, size**3
    if n * span >= WIDEST:
        known, codes = np.unique(codes, return_inverse=True)
        span = len(known)
    key = owners * kind(span) + codes.astype(kind)
    key.sort()
    first = starts_of(key)
    counts = np.diff(np.r_[first, len(key)])
    owner, code = np.divmod(key[first].astype(np.int64), max(span, 1))
    code = code if known is None else known[code].astype(np.int64)
    code, last = np.divmod(code, size)
    return owner, letters[code // size] << 42 | letters[code % size] << 21 | letters[last], counts


def _by_count(owner: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The order by text, falling count and n-gram of what is in the order of text and n-gram."""
    m, most = len(owner), int(count.max())
    if (int(owner.max()) + 1) * (most + 1) * m >= WIDEST:
        return np.lexsort((-count, owner))
    key = (owner * (most + 1) + (most - count)) * m + np.arange(m)
    key.sort()
    return key % m


def profiles(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", size: int = PROFILE) -> DataFrame:
    """lang, code, place: the most frequent n-grams of each language over all rows, place from 0."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(lang_col).cast("string").alias("_lang"), F.col(text_col).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def handed_on():
            for lang, (codes, counts) in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(codes)), pa.array(codes), pa.array(counts)], names=["lang", "code", "n"]
                )
            held.clear()

        for batch in batches:
            for piece in pieces(batch, "_text", PIECE):
                langs, which = np.unique(np.array(piece.column("_lang").to_pylist(), object).astype(str), return_inverse=True)
                data, offsets = text_bytes(piece.column("_text"))
                points, owners = _letters(data, offsets)[:2]
                owner, code, count = _counted(points, which[np.minimum(owners, len(which) - 1)], len(langs))
                for k, lang in enumerate(langs.tolist()):
                    mine = owner == k
                    old, old_n = held.get(lang, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
                    both, at = np.unique(np.r_[old, code[mine]], return_inverse=True)
                    held[lang] = both, np.bincount(at, np.r_[old_n, count[mine]], len(both)).astype(np.int64)
                if sum(len(c) for c, _ in held.values()) > HELD:
                    yield from handed_on()
        yield from handed_on()

    counts = rows.mapInArrow(tidy(run), "lang string, code bigint, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    return counts.withColumn("place", place - 1).where(F.col("place") < size).select("lang", "code", "place")


class Profiles:
    """The learned profiles, for tasks: which n-grams occur in any, and their place in each."""

    def __init__(self, rows, size: int):
        self.size = size
        self.langs = sorted({r.lang for r in rows})
        self.codes = np.unique(np.array([r.code for r in rows], np.int64))
        self.places = np.full((len(self.codes) + 1, len(self.langs)), -1, np.int32)
        for r in rows:
            self.places[np.searchsorted(self.codes, r.code), self.langs.index(r.lang)] = r.place

    def nearest(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest language of each text (-1: none) and the score."""
        n = len(offsets) - 1
        points, at, has = _letters(data, offsets)
        if not self.langs or not has.any():
            return np.full(n, -1), np.zeros(n)
        owner, code, count = _counted(points, np.minimum(at, n - 1), n)
        order = _by_count(owner, count)
        owner, code = owner[order], code[order]
        begins = np.searchsorted(owner, np.arange(n))
        place = np.arange(len(owner)) - begins[owner]
        top = place < self.size
        owner, code, place = owner[top], code[top], place[top]
        where = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        where = np.where(self.codes[where] == code, where, len(self.codes))
        theirs = self.places[where]
        apart = np.where(theirs < 0, self.size, np.minimum(np.abs(theirs - place[:, None]), self.size))
        total = np.zeros((n, len(self.langs)))
        for k in range(len(self.langs)):
            total[:, k] = np.bincount(owner, apart[:, k], n)
        used = np.bincount(owner, minlength=n)
        best = np.argmin(total, axis=1)
        score = 1 - total[np.arange(n), best] / np.maximum(used * self.size, 1)
        return np.where(has, best, -1), np.where(has, np.clip(score, 0, 1), 0.0)


def keep(docs: DataFrame, learned: DataFrame, text_col: str = "text", least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows in some known language, with their columns.

    Rejected are texts without a letter, and texts whose n-grams lie nearly as far from every profile as possible.
    """
    known = Profiles(learned.collect(), PROFILE)
    fields = docs.schema.fields
    rows, at = _with_text(docs, fields, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, at, PIECE):
                best, score = known.nearest(*text_bytes(piece.column(at)))
                stays = piece.filter(pa.array((best >= 0) & (score >= least_score)))
                yield pa.RecordBatch.from_arrays(stays.columns[: len(fields)], names=[f.name for f in fields])

    return rows.mapInArrow(tidy(run), StructType(fields))


def _with_text(docs: DataFrame, fields: list, text_col: str) -> tuple[DataFrame, int]:
    """The fields under plain names and the place of the text, which is not passed twice if it is among them."""
    for at, f in enumerate(fields):
        if f.name.lower() == text_col.lower() and isinstance(f.dataType, StringType):
            return docs.select(*numbered(fields)), at
    return docs.select(*numbered(fields), F.col(text_col).cast("string").alias("text")), len(fields)


def predict(docs: DataFrame, learned: DataFrame, text_col: str = "text", size: int = PROFILE) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (share of the greatest possible distance that is not there)."""
    known = Profiles(learned.collect(), size)  # as many rows as languages times the size of a profile
    added = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    kept = other_fields(docs, "lang_pred", "score")
    rows, at = _with_text(docs, kept, text_col)
    names = np.array([*known.langs, UNKNOWN], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, at, PIECE):
                best, score = known.nearest(*text_bytes(piece.column(at)))
                columns = piece.columns[: len(kept)] + [pa.array(names[best].tolist(), pa.string()), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in [*kept, *added]])

    return rows.mapInArrow(tidy(run), StructType([*kept, *added]))


def is_training(id_col: Column) -> Column:
    """Learn from rows whose crc32 of the id as text, modulo 5, is not 0; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % 5 != 0
