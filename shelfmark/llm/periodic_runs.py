"""Maximal periodic runs of words within a document, and the text with only the first period of each.

A run is a stretch of words with smallest period ``q`` and a length of at least ``max(least, 2 q)`` that neither
neighbour extends.  Words are appended one by one to a suffix automaton whose suffix links are a link-cut tree.  A
preferred path holds the substrings whose last occurrence ended at the same word.  Appending word ``i`` accesses its
node: the access walks the paths between it and the root, and recolours them to ``i``.  A path last seen at ``e`` whose
deepest node on the way has length ``L`` says that ``L`` words before ``e`` and before ``i`` agree.  If ``i - e <= L``
that is a square of primitive root ``i - e``, reaching back as far as its period does; the last ``i`` with the same
beginning and period ends the run.

Only stretches that may hold a run are appended.  In a run, words ``q`` apart agree over at least ``ceil(least / 2)``
words, so it is covered by windows of that many words that repeat in the document, no farther apart than half the
stretch they cover.  Windows that repeat only farther off are taken out, and what is left is covered anew, until
nothing changes.  That removes no run: all windows of a run stay by the same argument.

Work is a task's own: documents are read once, nothing is shuffled.  Memory grows with the longest periodic stretch of
one document, not with the input.

Defined results: null and wordless texts have no words and no runs.  Runs come by start, then period.  Repeated rows are
each returned, null ids too; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .bytewise import mix, pieces, ranges, slice_hashes, text_bytes, window_hashes, word_spans
from .stages import numbered, other_fields

LEAST = 12
_BASE = 0xC2B2AE3D27D4EB4F
RUN = StructType([StructField(name, LongType(), False) for name in ("start", "length", "period")])


def repetitions(words: list[int]) -> dict[tuple[int, int], int]:
    """{(start, period): end} of every maximal repetition of at least two periods."""
    found: dict[tuple[int, int], int] = {}
    # node 0 is none, node 1 the root
    steps: list[dict[int, int]] = [{}, {}]
    link, length = [0, 0], [0, 0]
    # splay trees of preferred paths: parent (or the node above the path), shallower and deeper child; the last end of a
    # path stands at its splay root
    up, low, high, last = [0, 0], [0, 0], [0, 0], [0, 0]

    def add(size: int, after: dict[int, int]) -> int:
        steps.append(after)
        length.append(size)
        link.append(0)
        for column in (up, low, high, last):
            column.append(0)
        return len(length) - 1

    def rotate(x: int) -> None:
        y = up[x]
        z = up[y]
        if low[y] == x:
            child = low[y] = high[x]
            high[x] = y
        else:
            child = high[y] = low[x]
            low[x] = y
        if child:
            up[child] = y
        if z:
            if low[z] == y:
                low[z] = x
            elif high[z] == y:
                high[z] = x
        up[x], up[y], last[x] = z, x, last[y]

    def splay(x: int) -> None:
        y = up[x]
        while y and (low[y] == x or high[y] == x):
            z = up[y]
            if z and (low[z] == y or high[z] == y):
                rotate(y if (low[z] == y) == (low[y] == x) else x)
            rotate(x)
            y = up[x]

    newest = 1
    for i, word in enumerate(words, 1):
        node = add(length[newest] + 1, {})
        p = newest
        while p and word not in steps[p]:
            steps[p][word] = node
            p = link[p]
        if not p:
            link[node] = 1
        else:
            q = steps[p][word]
            if length[q] == length[p] + 1:
                link[node] = q
            else:
                # a shorter twin of q takes its place below q's link, on the path of q, last seen with it
                twin = add(length[p] + 1, dict(steps[q]))
                link[twin] = link[q]
                while p and steps[p].get(word) == q:
                    steps[p][word] = twin
                    p = link[p]
                link[q] = link[node] = twin
                splay(q)
                child = low[twin] = low[q]
                if child:
                    up[child] = twin
                low[q], up[twin] = twin, q
        up[node] = link[node]
        newest = x = node
        below = 0
        while x:
            splay(x)
            end, deeper = last[x], high[x]
            if deeper:
                last[deeper] = end  # what lies below keeps its colour on a path of its own
            if end and i - end <= length[x]:
                found[2 * end - i - length[x] + (i - end), i - end] = i
            high[x] = below
            below, x = x, up[x]
        last[below] = i
    return found


def _near(items: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the windows that repeat in their text begin, and how far off the nearest equal one is."""
    hashes = window_hashes(items, width, _BASE)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    n = len(hashes)
    begin = np.flatnonzero(text[:n] == text[width - 1 : width - 1 + n])
    keys = mix(hashes[begin] + mix(text[begin].astype(np.uint64)))
    order = np.argsort(keys, kind="stable")
    gap = np.full(len(begin) + 1, np.iinfo(np.int64).max)
    same = keys[order[1:]] == keys[order[:-1]]
    gap[1:-1][same] = np.diff(begin[order])[same]
    near = np.empty(len(begin), np.int64)
    near[order] = np.minimum(gap[1:], gap[:-1])
    some = near < np.iinfo(np.int64).max
    return begin[some], near[some]


def stretches(items: np.ndarray, first: np.ndarray, least: int = LEAST) -> np.ndarray:
    """(start, end) of stretches of words, none over the end of a text, such that each run lies within one."""
    width = -(-least // 2)
    begin, near = _near(items, first, width)
    n = len(items)
    edge = np.zeros(n + 1, bool)
    edge[first] = True
    while len(begin):
        cover = np.zeros(n + 1, np.int64)
        cover[begin] += 1
        np.subtract.at(cover, begin + width, 1)
        covered = np.cumsum(cover)[:n] > 0
        head = covered & (edge[:n] | ~np.r_[False, covered[:-1]])
        number = np.cumsum(head) - 1
        start = np.flatnonzero(head)
        size = np.bincount(number[covered], minlength=len(start))
        stay = 2 * near <= size[number[begin]]
        if stay.all():
            return np.stack([start, start + size], axis=1)
        begin, near = begin[stay], near[stay]
    return np.zeros((0, 2), np.int64)


def text_runs(items: np.ndarray, first: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, starts counted within their text, and where each text's begin (n + 1)."""
    found = []
    for low, high in stretches(items, first, least).tolist():
        _, words = np.unique(items[low:high], return_inverse=True)
        found += [
            (low + start, end - start, period)
            for (start, period), end in repetitions(words.tolist()).items()
            if end - start >= max(least, 2 * period)
        ]
    runs = np.array(sorted((s, p, n) for s, n, p in found), np.int64).reshape(-1, 3)[:, [0, 2, 1]]
    upto = np.searchsorted(runs[:, 0], first)
    runs[:, 0] -= np.repeat(first[:-1], np.diff(upto))
    return runs, upto


def _collapsed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, runs: np.ndarray, upto: np.ndarray) -> list[str]:
    """Each text's words but for those in a run after its first period, one blank apart."""
    n = len(starts)
    cover = np.zeros(n + 1, np.int64)
    begin = runs[:, 0] + np.repeat(first[:-1], np.diff(upto))
    np.add.at(cover, begin + runs[:, 2], 1)
    np.subtract.at(cover, begin + runs[:, 1], 1)
    kept = np.flatnonzero(np.cumsum(cover)[:n] == 0)
    lengths = ends[kept] - starts[kept]
    at = np.r_[0, np.cumsum(lengths + 1)]
    out = np.full(int(at[-1]), 0x20, np.uint8)
    out[ranges(at[:-1], lengths)] = data[ranges(starts[kept], lengths)]
    text = out.tobytes()
    bounds = at[np.searchsorted(kept, first)]
    return [text[a : max(b - 1, a)].decode() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def find(docs: DataFrame, text_col: str = "text", least: int = LEAST) -> DataFrame:
    """``docs`` without the text, with ``n_words``, ``runs`` (start, length, period) and ``collapsed`` (the text without repeats).

    Columns of ``docs`` called like the new ones are replaced.
    """
    added = [
        StructField("n_words", LongType(), False), StructField("runs", ArrayType(RUN, False), False),
        StructField("collapsed", StringType(), False),
    ]
    kept = other_fields(docs, text_col, *[f.name for f in added])
    at = len(kept)
    run_type = pa.struct([pa.field(f.name, pa.int64(), False) for f in RUN])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in (p for batch in batches for p in pieces(batch, at)):
            data, offsets = text_bytes(piece.column(at))
            starts, ends, first = word_spans(data, offsets)
            runs, upto = text_runs(slice_hashes(data, starts, ends), first, least)
            structs = pa.StructArray.from_arrays([pa.array(runs[:, k]) for k in range(3)], fields=list(run_type))
            lists = pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), structs)
            columns = [*piece.columns[:at], pa.array(np.diff(first)), lists, pa.array(_collapsed(data, starts, ends, first, runs, upto), pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in [*kept, *added]])

    rows = docs.select(*numbered(kept), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, StructType([*kept, *added]))


def longest(runs: Column) -> Column:
    """The run of the greatest length, of equals that with the smallest start, then period; null if there is none."""
    least = F.array_min(F.transform(runs, lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("s"), r["period"].alias("p"))))
    return F.when(F.size(runs) > 0, F.struct(least["s"].alias("start"), (-least["n"]).alias("length"), least["p"].alias("period")))
