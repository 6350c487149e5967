"""SentencePiece BPE: normalised, merged, every piece projected to the bytes of the original text, and decoded.

Normalisation.  A model may hold a compiled character map: a double-array trie of source strings, each with what it
becomes.  From every character that may begin one, all walks go down the trie together, a byte at a time, and the
longest match counts; of overlapping matches the left one does.  What is not matched stays.  For each byte of the
normalised text the byte of the original it comes from is kept, so a piece's first and last byte give its span.
White space becomes a mark, a mark is put before the text, and runs of blanks shrink if the model says so.  The mark is
held as a single blank byte, since no other blank is left then.

Merging.  If no piece of the model holds a mark behind another character, merges never cross the place before such a
mark.  Texts are cut there, slices are made distinct by hash, looked up in a cache, and the missing ones merged all
together: of each slice the best pair, leftmost first.  Characters the model lacks become bytes.

Decoding lays the bytes of the pieces one after the other, marks as blanks, without the blank put before the text.

Defined results: a null text counts as empty and gives no ids.  Texts of any length are encoded whole; repeated rows
are each encoded.  Other columns pass through; columns called like the new ones are replaced.  An empty table gives an
empty result.  Models without byte pieces, or with marks behind words, are refused.
"""

from __future__ import annotations

import codecs
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .bytewise import pieces, ranges, slice_hashes, text_bytes
from .stages import numbered, other_fields, tidy

PIECE = 1 << 20
CACHED_SLICES = 400_000  # of a worker; the cache is emptied when full
HEAP_FROM = 200  # symbols; longer slices are merged with a heap
MARK = "▁"  # stands for a blank in pieces
_MARK_BYTES = MARK.encode()

# kinds of pieces in a model file (fixed values)
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def _each_as_unknown(error):
    return "�" * (error.end - error.start), error.end


codecs.register_error("each-unknown", _each_as_unknown)


class CharacterMap:
    """The compiled character map: units of a double array, and the strings that matches become."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self.units = np.frombuffer(blob[4 : 4 + size], "<u4").astype(np.int64)
        self.texts = np.frombuffer(blob[4 + size :], np.uint8)
        self.ends = np.flatnonzero(self.texts == 0)
        first = self._step(np.zeros(256, np.int64), np.arange(256))[1]
        self.opens = first  # whether a byte can begin a match

    def _step(self, node: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The node that each byte leads to, and whether there is one."""
        unit = self.units[node]
        offset = (unit >> 10) << ((unit & (1 << 9)) >> 6)
        to = np.minimum(node ^ offset ^ byte, len(self.units) - 1)
        return to, (self.units[to] & ((1 << 31) | 0xFF)) == byte

    def matches(self, data: np.ndarray, limit: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, length, value) of the longest match from each of ``places``, none over ``limit``."""
        length, value = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
        walk, node, depth = np.arange(len(places)), np.zeros(len(places), np.int64), 0
        while len(walk):
            at = places[walk] + depth
            inside = at < limit[walk]
            walk, node, at = walk[inside], node[inside], at[inside]
            node, exists = self._step(node, data[at].astype(np.int64))
            walk, node = walk[exists], node[exists]
            depth += 1
            unit = self.units[node]
            ends = (unit >> 8) & 1 == 1
            # the value's unit lies at the node's offset
            leaf = node[ends] ^ ((unit[ends] >> 10) << ((unit[ends] & (1 << 9)) >> 6))
            length[walk[ends]], value[walk[ends]] = depth, self.units[leaf] & 0x7FFFFFFF
        some = length > 0
        return places[some], length[some], value[some]

    def becomes(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and length of what matches become."""
        return value, self.ends[np.searchsorted(self.ends, value)] - value


def _points(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)


def _longest_first(place: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Which matches count, read from the left: none that begins within another that counts."""
    if not len(place) or (place[1:] >= place[:-1] + length[:-1]).all():
        return np.ones(len(place), bool)
    keep, upto = np.zeros(len(place), bool), -1
    for i, (a, n) in enumerate(zip(place.tolist(), length.tolist(), strict=True)):
        if a >= upto:
            keep[i], upto = True, a + n
    return keep


class Normalised:
    """Normalised texts with marks as blanks: bytes, where texts begin (n + 1), and the source span of each byte."""

    def __init__(self, model: "Model", data: np.ndarray, offsets: np.ndarray):
        n = len(data)
        source = np.arange(n, dtype=np.int64)
        width = np.ones(n, np.int64)  # bytes of the original that a unit stands for
        text = data
        if model.map is not None and n:
            text, source, width = self._mapped(model.map, data, offsets)
        text, source, width = self._blanks(text, source, width)
        begin = np.searchsorted(source, offsets)
        if model.squeezes:
            first = np.zeros(len(text) + 1, bool)
            first[begin] = True
            blank = text == 0x20
            gone = blank & (first[:-1] | np.r_[False, blank[:-1]])
            text, source, width = text[~gone], source[~gone], width[~gone]
            begin = np.searchsorted(source, offsets)
            last = begin[1:][np.diff(begin) > 0] - 1
            last = last[text[last] == 0x20]
            text, source, width = (np.delete(x, last) for x in (text, source, width))
            begin = np.searchsorted(source, offsets)
        if model.prefixes:
            front = begin[:-1][np.diff(begin) > 0]
            text = np.insert(text, front, 0x20)
            lead = offsets[:-1][np.diff(begin) > 0]
            begin = begin + np.r_[0, np.cumsum(np.diff(begin) > 0)]
            source, width = np.insert(source, front, lead), np.insert(width, front, 0)
        self.text, self.begin = text, begin
        self.low, self.high = source, source + width

    @staticmethod
    def _mapped(rules: CharacterMap, data, offsets):
        places = np.flatnonzero(rules.opens[data] & ((data & 0xC0) != 0x80))
        limit = offsets[np.searchsorted(offsets, places, "right")]
        place, length, value = rules.matches(data, limit, places)
        keep = _longest_first(place, length)
        place, length, value = place[keep], length[keep], value[keep]
        start, size = rules.becomes(value)
        # every byte stays once, but a match's first byte gives way to what it becomes, and its others to nothing
        counts = np.ones(len(data), np.int64)
        counts[ranges(place, length)] = 0
        counts[place] = size
        source = np.repeat(np.arange(len(data)), counts)
        text = data[source]
        out = np.cumsum(counts) - counts
        text[ranges(out[place], size)] = rules.texts[ranges(start, size)]
        width = np.ones(len(data), np.int64)
        width[place] = length
        return text, source, width[source]

    @staticmethod
    def _blanks(text, source, width):
        """Marks of the text itself as blanks, too."""
        mark = np.flatnonzero((text[:-2] == _MARK_BYTES[0]) & (text[1:-1] == _MARK_BYTES[1]) & (text[2:] == _MARK_BYTES[2]))
        if len(mark):
            text, width = text.copy(), width.copy()
            text[mark] = 0x20
            width[mark] = np.maximum(source[mark + 2] + width[mark + 2] - source[mark], width[mark])
            text, source, width = (np.delete(x, np.r_[mark + 1, mark + 2]) for x in (text, source, width))
        return text, source, width


class Model:
    """A model file: pieces, merges, and how texts are normalised."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as files

        made = files.ModelProto()
        with open(path, "rb") as file:
            made.ParseFromString(file.read())
        rules = made.normalizer_spec
        if not made.trainer_spec.byte_fallback or made.trainer_spec.treat_whitespace_as_suffix or not rules.escape_whitespaces:
            raise ValueError("the model must fall back to bytes and mark blanks before words")
        self.map = CharacterMap(rules.precompiled_charsmap) if rules.precompiled_charsmap else None
        self.prefixes, self.squeezes = rules.add_dummy_prefix, rules.remove_extra_whitespaces
        if any(p.type in (USER_DEFINED, UNUSED) for p in made.pieces):
            raise ValueError("models with pieces of the user are not covered")
        names = [p.piece for p in made.pieces]
        self.n = len(names)
        spelled = {p.piece.replace(MARK, " "): i for i, p in enumerate(made.pieces) if p.type == NORMAL}
        self.cuts = not any(" " in s.lstrip(" ") for s in spelled)
        # symbols: pieces, and characters that occur in pieces without being one
        self.symbols = dict(spelled)
        for s in spelled:
            for c in s:
                self.symbols.setdefault(c, self.n + len(self.symbols))
        # the better the score, the lower the place; equal scores have equal places
        scores = sorted({made.pieces[i].score for i in spelled.values()}, reverse=True)
        place = {score: k for k, score in enumerate(scores)}
        merges = {}
        for s, i in spelled.items():
            for cut in range(1, len(s)):
                left, right = self.symbols.get(s[:cut]), self.symbols.get(s[cut:])
                if left is not None and right is not None:
                    merges[left << 32 | right] = (place[made.pieces[i].score], i)
        self.merges = merges
        self.keys = np.array(sorted(merges), np.int64)
        self.places = np.array([merges[k][0] for k in self.keys.tolist()], np.int64)
        self.merged = np.array([merges[k][1] for k in self.keys.tolist()], np.int64)
        self.none = np.int64(len(scores))
        self.bytes = np.zeros(256, np.int64)
        texts = [b""] * self.n
        for i, p in enumerate(made.pieces):
            if p.type == BYTE:
                self.bytes[int(p.piece[3:5], 16)] = i
                texts[i] = bytes([int(p.piece[3:5], 16)])
            elif p.type == UNKNOWN:
                texts[i] = made.trainer_spec.unk_surface.encode()
            elif p.type == NORMAL:
                texts[i] = p.piece.replace(MARK, " ").encode()
        self.is_word = np.array([p.type == NORMAL for p in made.pieces])
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.texts = np.frombuffer(b"".join(texts), np.uint8)
        # a symbol for each code point; characters of no piece have -1 less their code point
        self.symbol_of = -1 - np.arange(0x110000, dtype=np.int32)
        single = [c for c in self.symbols if len(c) == 1]
        self.symbol_of[[ord(c) for c in single]] = [self.symbols[c] for c in single]
        extra = {i: ord(c) for c, i in self.symbols.items() if i >= self.n}
        self.extra = np.zeros(max(extra, default=self.n) - self.n + 1, np.int64)
        self.extra[[i - self.n for i in extra]] = list(extra.values())
        self._forget()

    def _merge_all(self, ids: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and slices after all merges: of each slice the best adjacent pair first, leftmost of equals."""
        done_ids, done_owner = [ids[:0]], [owner[:0]]
        while len(ids):
            rank, to = np.full(len(ids), self.none), np.zeros(len(ids), np.int64)
            same = np.flatnonzero((owner[:-1] == owner[1:]) & (ids[:-1] >= 0) & (ids[1:] >= 0))
            wanted = ids[same] << 32 | ids[same + 1]
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            hit = self.keys[at] == wanted
            rank[same[hit]], to[same[hit]] = self.places[at[hit]], self.merged[at[hit]]
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.minimum.reduceat(rank * len(ids) + np.arange(len(ids)), starts)
            merging = best // len(ids) < self.none
            still = np.repeat(merging, np.diff(np.r_[starts, len(ids)]))
            done_ids.append(ids[~still])
            done_owner.append(owner[~still])
            first = best[merging] % len(ids)
            ids[first] = to[first]
            still[first + 1] = False
            ids, owner = ids[still], owner[still]
        ids, owner = np.concatenate(done_ids), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return ids[order], owner[order]

    def _merge_long(self, text: str) -> list[int]:
        """The same for one long slice, with a heap of pairs."""
        ids = self.symbol_of[_points(text.encode())].tolist()
        n = len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < n and ids[i] >= 0 and ids[j] >= 0:
                merge = self.merges.get(ids[i] << 32 | ids[j])
                if merge is not None:
                    heapq.heappush(heap, (merge[0], i, ids[i], ids[j], merge[1]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, left, right, to = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = to, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [x for x in ids if x is not None]

    def _as_ids(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id, bytes of normalised text it takes) of symbols, with their slices; a character the model lacks is its bytes,
        taken by the last."""
        lacks = (symbols < 0) | (symbols >= self.n)
        if not lacks.any():
            return np.stack([symbols, self.lengths[symbols]], axis=1), owner
        point = np.where(symbols < 0, -1 - symbols, self.extra[np.maximum(symbols - self.n, 0) * lacks])[lacks]
        blank = point == 0x20
        raw = np.frombuffer(np.where(blank, ord(MARK), point).astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
        size = np.diff(np.r_[np.flatnonzero((raw & 0xC0) != 0x80), len(raw)])
        counts = np.ones(len(symbols), np.int64)
        counts[lacks] = size
        out = np.zeros((int(counts.sum()), 2), np.int64)
        begin = np.cumsum(counts) - counts
        known = symbols[~lacks]
        out[begin[~lacks], 0], out[begin[~lacks], 1] = known, self.lengths[known]
        out[ranges(begin[lacks], size), 0] = self.bytes[raw]
        out[begin[lacks] + size - 1, 1] = np.where(blank, 1, size)
        return out, np.repeat(owner, counts)

    def of(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids (with bytes taken) of distinct slices with sorted hashes: the pool they lie in, where each begins, how many."""
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        new = np.flatnonzero(self.known[at] != hashes)
        if len(new):
            if len(self.known) + len(new) > CACHED_SLICES:
                self._forget()
                new = np.arange(len(hashes))
            self._learn(hashes[new], data, starts[new], ends[new])
            at = np.searchsorted(self.known, hashes)
        return self.pool, self.at[at], self.counts[at]

    def _forget(self) -> None:
        # a hash that no slice has: entries are compared for equality, and this one has no ids
        self.known = np.array([np.iinfo(np.uint64).max], np.uint64)
        self.at, self.counts = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.pool = np.zeros((0, 2), np.int32)

    def _learn(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        sizes = ends - starts
        short = np.flatnonzero(sizes < HEAP_FROM)
        raw = data[ranges(starts[short], sizes[short])]
        points = _points(raw.tobytes())
        of_byte = np.repeat(short, sizes[short])
        symbols, owner = self._merge_all(self.symbol_of[points].astype(np.int64), of_byte[(raw & 0xC0) != 0x80])
        for i in np.flatnonzero(sizes >= HEAP_FROM).tolist():
            merged = np.array(self._merge_long(data[starts[i] : ends[i]].tobytes().decode()), np.int64)
            symbols, owner = np.r_[symbols, merged], np.r_[owner, np.full(len(merged), i)]
        found, owner = self._as_ids(symbols, owner)
        order = np.argsort(owner, kind="stable")
        counts = np.bincount(owner, minlength=len(hashes))
        begin = np.cumsum(counts) - counts + len(self.pool)
        self.pool = np.concatenate([self.pool, found[order].astype(np.int32)])
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known, kind="stable")
        self.known = known[order]
        self.at, self.counts = (np.concatenate(x)[order] for x in ((self.at, begin), (self.counts, counts)))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, the begin and end of each in its own original text, and how many each text has."""
        made = Normalised(self, data, offsets)
        text, begin = made.text, made.begin
        if not len(text):
            none = np.zeros(0, np.int32)
            return none, none, none, np.zeros(len(offsets) - 1, np.int64)
        head = np.zeros(len(text), bool)
        head[begin[begin < len(text)]] = True
        if self.cuts:
            blank = text == 0x20
            head |= blank & ~np.r_[False, blank[:-1]]
        starts = np.flatnonzero(head)
        ends = np.r_[starts[1:], len(text)]
        distinct, one, which = np.unique(slice_hashes(text, starts, ends), return_index=True, return_inverse=True)
        pool, at, counts = self.of(distinct, text, starts[one], ends[one])
        out = pool[ranges(at[which], counts[which])]
        ids, taken = out[:, 0], out[:, 1].astype(np.int64)
        upto = np.cumsum(taken)
        n_ids = np.diff(np.r_[0, np.cumsum(counts[which])][np.searchsorted(starts, begin)])
        own = np.repeat(offsets[:-1], n_ids)
        first = made.low[np.minimum(upto - taken, len(text) - 1)]
        last = np.where(taken > 0, made.high[np.maximum(upto - 1, 0)], first)
        return ids, (first - own).astype(np.int32), (last - own).astype(np.int32), n_ids

    def decode_texts(self, ids: np.ndarray, upto: np.ndarray) -> list[str]:
        """The texts of encoded ids (none of them a control), which end at ``upto``."""
        length = self.lengths[ids]
        raw = self.texts[ranges(self.starts[ids], length)]
        begin = np.r_[0, np.cumsum(length)][upto]
        some = np.flatnonzero(np.diff(upto) > 0)
        head = ids[upto[some]]
        low = begin[:-1].copy()
        if self.prefixes or self.squeezes:
            low[some] += self.is_word[head] & (self.texts[self.starts[head]] == 0x20)
        text = raw.tobytes()
        return [text[a:b].decode("utf-8", "each-unknown") for a, b in zip(low.tolist(), begin[1:].tolist(), strict=True)]

    def decode(self, ids: np.ndarray) -> str:
        ids = np.asarray(ids, np.int64)
        length = self.lengths[ids]
        raw = self.texts[ranges(self.starts[ids], length)].tobytes()
        some = np.flatnonzero(length > 0)
        if len(some) and (self.prefixes or self.squeezes):
            head = ids[some[0]]
            if self.is_word[head]:
                one = self.texts[self.starts[head] : self.starts[head] + self.lengths[head]].tobytes()
                if one.startswith(b" "):
                    raw = raw[1:]
        return raw.decode("utf-8", "each-unknown")


_loaded: dict[str, Model] = {}


def model_of(path: str) -> Model:
    if path not in _loaded:
        _loaded[path] = Model(path)
    return _loaded[path]


def encode(docs: DataFrame, path: str, text_col: str = "text", with_decoded: bool = False) -> DataFrame:
    """``docs`` without the text, with ``ids``, and ``begins`` and ``ends`` of each id in bytes of the original text.

    ``with_decoded`` adds ``decoded``, the text that the ids give back, made in the same task.
    """
    added = [StructField(name, ArrayType(IntegerType(), False)) for name in ("ids", "begins", "ends")]
    added += [StructField("decoded", StringType())] * with_decoded
    kept = other_fields(docs, "ids", "begins", "ends", "decoded", text_col)
    rows = docs.select(*numbered(kept), F.col(text_col).cast("string").alias("text"))
    at = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(path)
        for piece in (p for batch in batches for p in pieces(batch, at, PIECE)):
            ids, begins, ends, counts = model.encode(*text_bytes(piece.column(at)))
            upto = np.r_[0, np.cumsum(counts)].astype(np.int32)
            columns = piece.columns[:at]
            columns += [pa.ListArray.from_arrays(upto, pa.array(x)) for x in (ids, begins, ends)]
            if with_decoded:
                columns.append(pa.array(model.decode_texts(ids, upto), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in [*kept, *added]])

    return rows.mapInArrow(tidy(run), StructType([*kept, *added]))


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``: the text of its ids; null ids give null."""
    kept = other_fields(encoded, "decoded")
    at = [f.name for f in kept].index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(path)
        for batch in batches:
            out = [model.decode(np.array(row.values, np.int64)) if row.is_valid else None for row in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[f.name for f in kept] + ["decoded"])

    return encoded.select(*numbered(kept)).mapInArrow(run, StructType([*kept, StructField("decoded", StringType())]))
