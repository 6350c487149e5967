"""Byte-level BPE encoding and decoding with a given rank file.

Where the pieces of a text begin is found without a pattern matcher.  Code points become classes; a class, with what
follows it, is a transition function between a few states.  Almost all of these functions are constant, so the state
after them is known at once.  Only an apostrophe that may open a contraction, and the letters after it, depend on the
state before.  Their functions are composed by an associative scan (doubling) over just those positions.

The slices between boundaries are made distinct by hash, each distinct slice is looked up in a cache, and the missing
ones are merged all together, one lowest-rank pair of each per round.  Ids come with the byte offset at which each
begins; decoding lays the bytes of each id at its offset.

Defined results: a null text counts as empty and gives no ids.  Texts of any length are encoded whole; repeated rows
are encoded each.  Other columns pass through; columns of the input called like the new ones are replaced.  An empty
table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from .bytewise import pieces, ranges, slice_hashes, text_bytes
from .stages import numbered, other_fields, tidy

PIECE = 1 << 20
CACHED_SLICES = 60_000  # of a worker; the cache is emptied when full
HEAP_FROM = 200  # bytes; longer slices are merged with a heap

# classes of code points
LETTER, NUMBER, SPACE, BLANK, QUOTE, OTHER = range(6)
# The pattern's own constants (fixed values): white space as the pattern language has it, and contractions.
WHITE_POINTS = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SHORT_ENDS = "stmd"
LONG_ENDS = ("re", "ve", "ll")

# states between two characters: within a run of letters, numbers, others or white space; after a blank that belongs to what
# follows; within a contraction with one or two characters to come; after a finished piece
IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_WHITE, PREFIXED, ONE_MORE, TWO_MORE, FRESH = range(8)


def _table(rules: dict[int, int], otherwise: int) -> np.ndarray:
    return np.array([rules.get(state, otherwise) for state in range(8)], np.uint8)


# the functions that are not constant: a letter, and the two kinds of contraction
AFTER_LETTER = _table({ONE_MORE: FRESH, TWO_MORE: ONE_MORE}, IN_LETTERS)
AFTER_SHORT = _table({IN_OTHERS: IN_OTHERS, PREFIXED: IN_OTHERS}, ONE_MORE)
AFTER_LONG = _table({IN_OTHERS: IN_OTHERS, PREFIXED: IN_OTHERS}, TWO_MORE)

_classes: np.ndarray | None = None


def classes() -> np.ndarray:
    """The class of every code point."""
    global _classes
    if _classes is None:
        kinds = {"L": LETTER, "N": NUMBER}
        table = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
        table[WHITE_POINTS] = SPACE
        table[0x20] = BLANK
        table[0x27] = QUOTE
        _classes = table
    return _classes


def boundaries(points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Whether a piece begins at each code point.  ``text_starts``: where texts begin, below len(points)."""
    n = len(points)
    if n == 0:
        return np.zeros(0, bool)
    kind = classes()[points]
    first = np.zeros(n + 1, bool)
    first[text_starts] = True
    first[n] = True
    white = (kind == SPACE) | (kind == BLANK)
    more_white = np.zeros(n, bool)  # white space or the end of the text follows
    more_white[:-1] = white[1:]
    more_white |= first[1:]
    prefix = (kind == BLANK) & ~more_white
    inner = white & more_white
    # the state after each character, where its function is constant
    state = np.full(n, IN_OTHERS, np.uint8)
    state[kind == LETTER] = IN_LETTERS
    state[kind == NUMBER] = IN_NUMBERS
    state[white] = FRESH
    state[inner] = IN_WHITE
    state[prefix] = PREFIXED
    quotes = np.flatnonzero(kind == QUOTE)
    if len(quotes):
        _contractions(points, kind, first, state, quotes)
    before = np.empty(n, np.uint8)
    before[0] = FRESH
    before[1:] = state[:-1]
    before[first[:-1]] = FRESH
    goes_on = (
        ((kind == LETTER) & ((before == IN_LETTERS) | (before == PREFIXED) | (before == ONE_MORE) | (before == TWO_MORE)))
        | ((kind == NUMBER) & ((before == IN_NUMBERS) | (before == PREFIXED)))
        | ((kind >= QUOTE) & ((before == IN_OTHERS) | (before == PREFIXED)))
        | (inner & (before == IN_WHITE))
    )
    return ~goes_on


def _contractions(points, kind, first, state, quotes) -> None:
    """Put the right states at apostrophes and the letters after them."""
    n = len(points)

    def at(offset):  # the letter so far on in the same text, else 0
        i = quotes + offset
        inside = i < n
        i = np.minimum(i, n - 1)
        for k in range(1, offset + 1):
            inside &= ~first[np.minimum(quotes + k, n)]
        return np.where(inside, points[i], 0)

    one, two = at(1), at(2)
    short = np.isin(one, [ord(c) for c in SHORT_ENDS])
    long_ = np.zeros(len(quotes), bool)
    for end in LONG_ENDS:
        long_ |= (one == ord(end[0])) & (two == ord(end[1]))
    opens = short | long_
    quotes, long_ = quotes[opens], long_[opens]
    if not len(quotes):
        return
    # active positions: the apostrophe, its letters, and the letter after them; further on functions are constant
    reach = np.where(long_, 4, 3)
    active = np.flatnonzero(np.bincount(ranges(quotes, reach), minlength=n))
    active = active[active < n]
    opener = np.zeros(n, np.uint8)
    opener[quotes] = np.where(long_, 2, 1)
    functions = np.repeat(state[active][:, None], 8, axis=1)
    functions[kind[active] == LETTER] = AFTER_LETTER
    functions[opener[active] == 1] = AFTER_SHORT
    functions[opener[active] == 2] = AFTER_LONG
    # runs of adjacent active positions within a text, entered with a state that is known
    head = np.ones(len(active), bool)
    head[1:] = np.diff(active) > 1
    head |= first[active]
    entry = np.where(first[active] | (active == 0), FRESH, state[np.maximum(active - 1, 0)])
    run = np.cumsum(head) - 1
    step = 1
    place = np.arange(len(active)) - np.flatnonzero(head)[run]
    longest = int(place.max()) + 1
    while step < longest:  # functions of 1, 2, 4, ... positions, composed
        late = np.flatnonzero(place >= step)
        functions[late] = functions[late[:, None], functions[late - step]]
        step *= 2
    entered = entry[np.flatnonzero(head)][run]
    state[active] = functions[np.arange(len(active)), entered]


class Ranks:
    """A rank file: the bytes of every id, and which two adjacent ids merge into which."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.ranks = ranks
        size = max(ranks.values()) + 1
        table = [b""] * size
        for token, rank in ranks.items():
            table[rank] = token
        self.lengths = np.array([len(t) for t in table], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(table), np.uint8)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        keys = np.array(sorted(pairs), np.int64)
        self.pairs = pairs
        self.keys = keys
        self.merged = np.array([pairs[int(k)] for k in keys], np.int64)
        self.none = np.int64(size)
        self.cache: dict[bytes, np.ndarray] = {}

    def merged_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id that each pair merges into, ``none`` where it doesn't."""
        if not len(self.keys):
            return np.full(len(left), self.none)
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.merged[at], self.none)

    def merge_all(self, slices: list[bytes]) -> list[np.ndarray]:
        """The ids of each slice: of all adjacent pairs the lowest rank, leftmost first, until none merges."""
        lengths = np.array([len(s) for s in slices], np.int64)
        ids = self.single[np.frombuffer(b"".join(slices), np.uint8)]
        owner = np.repeat(np.arange(len(slices)), lengths)
        done_ids, done_owner = [], []
        while len(ids):
            pair = np.full(len(ids), self.none)
            same = np.flatnonzero(owner[:-1] == owner[1:])
            pair[same] = self.merged_of(ids[same], ids[same + 1])
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            # rank first, then place: the leftmost of equal ranks
            best = np.minimum.reduceat(pair * len(ids) + np.arange(len(ids)), starts)
            rank, place = np.divmod(best, len(ids))
            merging = rank < self.none
            still = np.repeat(merging, np.diff(np.r_[starts, len(ids)]))
            done_ids.append(ids[~still])
            done_owner.append(owner[~still])
            ids[place[merging]] = rank[merging]
            still[place[merging] + 1] = False
            ids, owner = ids[still], owner[still]
        ids, owner = np.concatenate(done_ids), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return np.split(ids[order].astype(np.int32), np.cumsum(np.bincount(owner, minlength=len(slices)))[:-1])

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same for one long slice, with a heap of pairs."""
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            rank = self.pairs.get(ids[i] << 32 | ids[i + 1])
            if rank is not None:
                heap.append((rank, i, ids[i], ids[i + 1]))
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i] if ids[i] is not None else n
            if j >= n or ids[i] != left or ids[j] != right:
                continue
            ids[i], ids[j] = rank, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n:
                    rank = self.pairs.get(ids[a] << 32 | ids[b])
                    if rank is not None:
                        heapq.heappush(heap, (rank, a, ids[a], ids[b]))
        return np.array([x for x in ids if x is not None], np.int32)

    def of(self, slices: list[bytes]) -> list[np.ndarray]:
        """The ids of each slice, through the cache."""
        found = [self.cache.get(s) for s in slices]
        missing = [i for i, x in enumerate(found) if x is None]
        if missing:
            if len(self.cache) + len(missing) > CACHED_SLICES:
                self.cache.clear()
            plain = []
            for i in missing:
                whole = self.ranks.get(slices[i])
                if whole is not None:
                    found[i] = np.array([whole], np.int32)
                elif len(slices[i]) >= HEAP_FROM:
                    found[i] = self.merge_long(slices[i])
                else:
                    plain.append(i)
            if plain:
                for i, ids in zip(plain, self.merge_all([slices[i] for i in plain]), strict=True):
                    found[i] = ids
            if len(missing) <= CACHED_SLICES:
                self.cache.update((slices[i], found[i]) for i in missing)
        return found

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, the byte offset of each within its text, and how many each text has."""
        n = len(offsets) - 1
        if len(data) == 0:
            return np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(n, np.int64)
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        # bytes that begin a character tell where each code point stands
        place = np.flatnonzero((data & 0xC0) != 0x80)
        text_starts = np.searchsorted(place, offsets[:-1][np.diff(offsets) > 0])
        starts = place[boundaries(points, text_starts)]
        ends = np.r_[starts[1:], len(data)]
        _, one, which = np.unique(slice_hashes(data, starts, ends), return_index=True, return_inverse=True)
        text = data.tobytes()
        ids = self.of([text[a:b] for a, b in zip(starts[one].tolist(), ends[one].tolist(), strict=True)])
        counts = np.array([len(x) for x in ids], np.int64)
        flat = np.concatenate(ids)
        of_slice = counts[which]
        out = flat[ranges((np.cumsum(counts) - counts)[which], of_slice)]
        upto = np.r_[0, np.cumsum(of_slice)]
        per_text = upto[np.searchsorted(starts, offsets)]
        n_ids = np.diff(per_text)
        length = self.lengths[out]
        begin = np.cumsum(length) - length  # ids cover every byte of the piece
        return out, (begin - np.repeat(offsets[:-1], n_ids)).astype(np.int32), n_ids

    def decode(self, ids: np.ndarray, begins: np.ndarray) -> bytes:
        """The bytes of ids, each laid at its offset."""
        length = self.lengths[ids]
        if not len(ids):
            return b""
        out = np.zeros(int(begins[-1] + length[-1]), np.uint8)
        out[ranges(begins.astype(np.int64), length)] = self.bytes[ranges(self.starts[ids], length)]
        return out.tobytes()


_loaded: dict[str, Ranks] = {}


def ranks_of(path: str) -> Ranks:
    if path not in _loaded:
        _loaded[path] = Ranks(path)
    return _loaded[path]


def encode(docs: DataFrame, path: str, text_col: str = "text", with_decoded: bool = False) -> DataFrame:
    """``docs`` without the text, with ``ids`` and ``offsets`` (of each id's first byte in the text).

    ``with_decoded`` adds ``decoded``, the bytes that the ids give back, made in the same task.
    """
    added = [StructField("ids", ArrayType(IntegerType(), False)), StructField("offsets", ArrayType(IntegerType(), False))]
    added += [StructField("decoded", BinaryType())] * with_decoded
    kept = other_fields(docs, "ids", "offsets", "decoded", text_col)
    rows = docs.select(*numbered(kept), F.col(text_col).cast("string").alias("text"))
    at = len(kept)  # the text's place, whatever the other columns are called

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of(path)
        for batch in batches:
            for piece in pieces(batch, at, PIECE):
                data, offsets = text_bytes(piece.column(at))
                ids, begins, counts = ranks.encode(data, offsets)
                ends = np.r_[0, np.cumsum(counts)].astype(np.int32)
                columns = piece.columns[:at]
                columns += [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (ids, begins)]
                if with_decoded:
                    spans = zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)
                    columns.append(pa.array([ranks.decode(ids[a:b], begins[a:b]) for a, b in spans], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in [*kept, *added]])

    return rows.mapInArrow(tidy(run), StructType([*kept, *added]))


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``: the bytes of its ids; null ids give null."""
    kept = other_fields(encoded, "decoded")
    at = [f.name for f in kept].index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of(path)
        for batch in batches:
            out = []
            for row in batch.column(at):
                ids = None if not row.is_valid else np.array(row.values, np.int64)
                out.append(None if ids is None else ranks.decode(ids, np.cumsum(ranks.lengths[ids]) - ranks.lengths[ids]))
            columns = [*batch.columns, pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in kept] + ["decoded"])

    return encoded.select(*numbered(kept)).mapInArrow(tidy(run), StructType([*kept, StructField("decoded", BinaryType())]))

