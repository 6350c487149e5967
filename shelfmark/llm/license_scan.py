"""Licence notices in documents: a trained paragraph classifier whose findings a template comparison confirms.

A paragraph is a line.  It is read in units of at most ``UNIT`` words, half of which overlap, so a template of up to half
a unit lies whole in some unit.  Notices are often wrapped, so runs of lines between lines without words are read in such
units too, across their line feeds.  A unit's features are its 1- to 3-grams of words (lower-cased, without punctuation),
hashed; multinomial logistic regression gives each family and an unknown class a score.

Training examples are variants of the templates (words left out, holders, surrounding words) for the families, and for
the unknown class a bounded sample of the corpus's own lines and units of several lines (``SAMPLE_DOCS``, ``SAMPLE_LINES``), scrambled templates and
fragments of them.  Every fifth example is held back to calibrate: one temperature makes the probabilities fit.

A unit counts as a notice of a family if all families together have ``LEAST_PROBABILITY`` or more, this one ``LEAST_SHARE`` of
that, and one of its templates has at least ``LEAST_SIMILAR`` of its word pairs in the unit.  The likeliest family goes
first, if it has ``LEAST_PROBABILITY`` alone, then the most similar one.  The words around a template that was found are
classified again as units of their own, so a unit with notices of several families reports each.

A finding names the paragraph and the word where its unit begins; for a unit of several lines, where the template begins.
Such a unit's finding is left out where the same words have given the family already.

Defined results: a null or empty text has no paragraph; blank lines are none.  Very long lines are read whole, unit by
unit.  Repeated rows are scanned each.  Other columns of the input do not matter.  An empty table gives an empty result
(the classifier then learns from scrambled templates alone).
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewise import pieces, ranges, slice_hashes, text_bytes, window_hashes, word_spans

UNIT = 50
FEATURES = 1 << 16
SAMPLE_DOCS, SAMPLE_LINES = 500, 3000
VARIANTS = 40
EPOCHS = 6
LEAST_PROBABILITY, LEAST_SIMILAR = 0.5, 0.7
LEAST_SHARE = 0.1
UNKNOWN = "unknown"

# Notices as licences and their users word them, by family; at most 25 words each.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Apache License Version 2.0, January 2004",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "bsd": [
        "Released under the BSD License.",
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GPL, version 3 or later.",
        "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "gpl-2.0": [
        "Licensed under the GNU General Public License, version 2.",
        "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License.",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ],
    "mpl-2.0": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc0": [
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "This work is dedicated to the public domain.",
    ],
    "all-rights-reserved": [
        "All rights reserved.",
        "No part of this publication may be reproduced without the prior written permission of the publisher.",
    ],
}
FAMILIES = [*TEMPLATES, UNKNOWN]

# Words end at anything in ASCII but letters and digits; a line feed is kept apart as the end of a line.
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[[b for b in range(128) if not chr(b).isalnum()]] = 0x20
_WORD = re.compile(r"[a-z0-9\u0080-\U0010ffff]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall("".join(c.lower() if c < "\x80" else c for c in text))


def _rows(grams: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([g & np.uint64(FEATURES - 1) for g in grams]).astype(np.int64)


def _grams(hashes: np.ndarray) -> list[np.ndarray]:
    return [window_hashes(hashes, n, 0xA0761D6478BD642F + 2 * n) for n in (1, 2, 3)]


def _features(words: list[str]) -> np.ndarray:
    data, offsets = text_bytes(pa.array([" ".join(words)]))
    starts, ends, _ = word_spans(data, offsets)
    return _rows(_grams(slice_hashes(data, starts, ends)))


_PAIRS = {f: [list(zip(w, w[1:], strict=False)) for w in map(words_of, t)] for f, t in TEMPLATES.items()}


def similarity(words: list[str], family: str) -> float:
    """Share of the word pairs of the family's best template that the words hold."""
    held = set(zip(words, words[1:], strict=False))
    return max(sum(p in held for p in pairs) / len(pairs) for pairs in _PAIRS[family])


def template_span(words: list[str], family: str) -> tuple[int, int]:
    """Where the family's best template stands: first word and end of the shortest of the fullest places."""
    pairs = max(_PAIRS[family], key=lambda pairs: (_held(words, pairs) / len(pairs), len(pairs)))
    wanted, room = set(pairs), len(pairs) + 2  # pairs within a template's length and a word or two left over
    at = [i for i, p in enumerate(zip(words, words[1:], strict=False)) if p in wanted]
    best = (0, 0, 0, 0)
    for k, first in enumerate(at):
        inside = [i for i in at[k : k + room] if i < first + room]
        distinct: set[tuple[str, str]] = set()
        for i in inside:
            distinct.add((words[i], words[i + 1]))
            best = max(best, (len(distinct), first - i, first, i + 2))
    return best[2], best[3]


def _held(words: list[str], pairs: list[tuple[str, str]]) -> int:
    held = set(zip(words, words[1:], strict=False))
    return sum(p in held for p in pairs)


def named_family(words: list[str], p: np.ndarray) -> tuple[int, float] | None:
    """The family (its number, and similarity) whose notice the words hold, given the probabilities of the classes."""
    known = p[:-1].sum()
    if known < LEAST_PROBABILITY:
        return None
    found = [(p[k] >= LEAST_PROBABILITY, similarity(words, FAMILIES[k]), p[k], k) for k in np.flatnonzero(p[:-1] >= LEAST_SHARE * known).tolist()]
    found = [x for x in found if x[1] >= LEAST_SIMILAR]
    return (max(found)[3], max(found)[1]) if found else None


def best_template(words: list[str]) -> float:
    return max(similarity(words, f) for f in TEMPLATES)


def examples(lines: list[str], seed: int = 11) -> list[tuple[list[str], int]]:
    """(words, class) to learn from; ``lines`` are paragraphs of the corpus."""
    rng = random.Random(seed)
    plain = [w[:UNIT] for w in (words_of(line) for line in lines) if w and best_template(w) < LEAST_SIMILAR / 2]
    found = [(w, len(FAMILIES) - 1) for w in plain]
    around = [w for w in plain if len(w) > 8] or [["this", "page", "is", "about", "other", "things", "and", "more", "of", "them"]]

    def context(n):
        words = rng.choice(around)
        at = rng.randrange(len(words))
        return words[at : at + n]

    for k, family in enumerate(TEMPLATES):
        for template in TEMPLATES[family]:
            words = words_of(template)
            for _ in range(VARIANTS):
                lost = [w for w in words if len(words) < 6 or rng.random() > 0.06]
                before = rng.choice([[], [], context(rng.randrange(20)), ["copyright", "c", str(rng.randrange(1990, 2030)), *context(2)]])
                found.append(([*before, *lost, *rng.choice([[], context(rng.randrange(20))])][:UNIT], k))
            for _ in range(VARIANTS // 2):  # near misses are unknown
                mixed = words[:]
                rng.shuffle(mixed)
                cut = words[: max(1, len(words) // 3)]
                found.append(([*context(10), *(mixed if rng.random() < 0.5 and len(words) > 5 else cut), *context(10)], len(FAMILIES) - 1))
    rng.shuffle(found)
    return found


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


class Classifier:
    """``weights`` (features, classes), ``bias`` and the calibrated ``temperature``."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, temperature: float):
        self.weights, self.bias, self.temperature = weights, bias, temperature

    @classmethod
    def learned(cls, samples: list[tuple[list[str], int]], epochs: int = EPOCHS) -> Classifier:
        n = len(FAMILIES)
        weights, squares, bias = np.zeros((FEATURES, n)), np.full((FEATURES, n), 1e-2), np.zeros(n)
        rows = [np.unique(_features(w)) for w, _ in samples]
        target = np.array([c for _, c in samples])
        held = np.arange(len(samples)) % 5 == 4
        taught = np.flatnonzero(~held)
        for _ in range(epochs):
            for low in range(0, len(taught), 32):
                some = taught[low : low + 32]
                sizes = np.array([len(rows[i]) for i in some])
                flat, owner = np.concatenate([rows[i] for i in some]), np.repeat(np.arange(len(some)), sizes)
                scores = np.zeros((len(some), n))
                np.add.at(scores, owner, weights[flat])
                p = np.exp(_log_softmax(scores + bias))
                p[np.arange(len(some)), target[some]] -= 1
                touched, at = np.unique(flat, return_inverse=True)
                grad = np.zeros((len(touched), n))
                np.add.at(grad, at, p[owner] / len(some))
                grad += 1e-4 * weights[touched]
                squares[touched] += grad * grad
                weights[touched] -= 0.3 * grad / np.sqrt(squares[touched])
                bias -= 0.05 * p.mean(axis=0)
        kept = np.flatnonzero(held)
        scores = np.stack([weights[rows[i]].sum(axis=0) + bias for i in kept]) if len(kept) else np.zeros((0, n))
        choices = np.geomspace(0.25, 8, 41)
        loss = [-_log_softmax(scores / t)[np.arange(len(kept)), target[kept]].mean() if len(kept) else abs(t - 1) for t in choices]
        return cls(weights.astype(np.float32), bias, float(choices[int(np.argmin(loss))]))

    def probabilities(self, hashes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Of each unit (words ``starts`` .. + ``sizes``), for every class."""
        scores = np.tile(self.bias, (len(starts), 1))
        for n, grams in enumerate(_grams(hashes)):
            inside = np.maximum(sizes - n, 0)
            some = np.flatnonzero(inside)
            if len(some):
                flat = (grams[ranges(starts[some], inside[some])] & np.uint64(FEATURES - 1)).astype(np.int64)
                scores[some] += np.add.reduceat(self.weights[flat], np.cumsum(inside[some]) - inside[some], axis=0)
        return np.exp(_log_softmax(scores / self.temperature))


def sample_lines(docs: DataFrame, text_col: str = "text", n_docs: int = SAMPLE_DOCS, n_lines: int = SAMPLE_LINES) -> list[str]:
    """A bounded sample of the corpus's lines and units of several lines: about ``n_docs`` different texts by hash, and of their lines ``n_lines``.

    A text is taken if its hash lies in the lowest ``n_docs``-th part of all; copies of a text are one.
    """
    text = F.col(text_col).cast("string")
    share = min(n_docs / max(docs.count(), 1), 1.0)
    least = min(int(share * 2**64), 2**64 - 1) - 2**63
    some = docs.select(text.alias("t")).where("t IS NOT NULL").withColumn("h", F.xxhash64("t", F.lit(1)))
    some = some.where(F.col("h") <= F.lit(least)).dropDuplicates(["h"])
    lines = some.select(F.explode(F.split("t", "\n")).alias("line")).where("line <> '' AND length(line) < 2000")
    # units of several lines, as they are scanned
    blocks = some.select(F.explode(F.split("t", r"\n(?:[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*\n)+")).alias("b")).where("contains(b, '\n')")
    blocks = blocks.select(F.filter(F.split("b", r"[\x00-\x20]+"), lambda w: w != "").alias("w")).where("size(w) > 0")
    at = F.explode(F.expr(f"sequence(1, size(w), {UNIT // 2})"))
    units = blocks.select("w", at.alias("i")).select(F.array_join(F.slice("w", F.col("i"), UNIT), " ").alias("line"))
    lines = lines.unionByName(units.where("length(line) < 2000"))
    lines = lines.distinct().withColumn("h", F.xxhash64("line", F.lit(2))).orderBy("h", "line").limit(n_lines)
    return [r.line for r in lines.collect()]


def learn(docs: DataFrame, text_col: str = "text") -> Classifier:
    return Classifier.learned(examples(sample_lines(docs, text_col)))


def _units(data: np.ndarray, offsets: np.ndarray):
    """Words of all texts, and units: text, paragraph, first word and words of each; paragraphs of each text."""
    plain = _PLAIN[data]
    starts, ends, first = word_spans(plain, offsets)
    n = len(offsets) - 1
    text = np.repeat(np.arange(n), np.diff(first))
    line = np.cumsum(data == 0x0A)[starts] if len(starts) else np.zeros(0, np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (line[1:] != line[:-1]) | (text[1:] != text[:-1])
    head = np.flatnonzero(new)
    size = np.diff(np.r_[head, len(starts)])
    n_paragraphs = np.bincount(text[head], minlength=n) if len(head) else np.zeros(n, np.int64)
    paragraph, at, size_ = _overlapping(head, size)
    owner, word, number = text[at], at - head[paragraph], paragraph
    # units of several lines: words of lines that follow each other, no line without words between
    head_of = np.repeat(np.arange(len(head)), size)
    apart = new.copy()
    apart[1:] &= (line[1:] - line[:-1] != 1) | (text[1:] != text[:-1])
    block = np.flatnonzero(apart)
    _, wide, wide_size = _overlapping(block, np.diff(np.r_[block, len(starts)]))
    several = head_of[wide] != head_of[wide + wide_size - 1]
    wide, wide_size = wide[several], wide_size[several]
    before = np.cumsum(n_paragraphs) - n_paragraphs
    at, size_ = np.r_[at, wide], np.r_[size_, wide_size]
    owner, number, word = np.r_[owner, text[wide]], np.r_[number, head_of[wide]], np.r_[word, wide - head[head_of[wide]]]
    return plain, starts, ends, owner, number - before[owner], word, at, size_, n_paragraphs


def _overlapping(head: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of runs of words: run, first word and words of each."""
    half = UNIT // 2
    count = np.maximum(-(-(size - half) // half), 1)
    run = np.repeat(np.arange(len(head)), count)
    at = head[run] + (np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)) * half
    return run, at, np.minimum(at + UNIT, head[run] + size[run]) - at


_FINDING = pa.struct([("paragraph", pa.int32()), ("word", pa.int32()), ("family", pa.string()),
                      ("probability", pa.float64()), ("similarity", pa.float64())])
_RESULT = "n_paragraphs bigint, findings array<struct<paragraph: int, word: int, family: string, probability: double, similarity: double>>"


def _found(model: Classifier, hashes, plain, starts, ends, units, n_texts: int) -> list[list[dict]]:
    """The findings of each text."""
    owner, paragraph, word, at, size = units
    # where each line of a text begins: the units of lines say it
    first = np.full(len(starts), -1, np.int64)
    heads = np.flatnonzero(word == 0)
    first[at[heads]] = paragraph[heads]
    line_head = np.maximum.accumulate(np.where(first >= 0, np.arange(len(starts)), 0))
    several = line_head[at] != line_head[at + size - 1] if len(at) else np.zeros(0, bool)
    found: list[list[dict]] = [[] for _ in range(n_texts)]
    seen: dict[tuple[int, str], list[tuple[int, int]]] = {}
    todo = [(owner[k], at[k], size[k], several[k]) for k in (~several, several)]
    while todo:
        text, begin, count, wide = todo.pop(0)
        p = model.probabilities(hashes, begin, count)
        likely = np.flatnonzero(p[:, :-1].sum(axis=1) >= LEAST_PROBABILITY)
        rest = []
        for u in likely.tolist():
            a, b = int(begin[u]), int(begin[u] + count[u])
            words = [plain[x:y].tobytes().decode("utf-8", "replace") for x, y in zip(starts[a:b], ends[a:b], strict=True)]
            named = named_family(words, p[u])
            if not named:
                continue
            family, alike = FAMILIES[named[0]], named[1]
            low, high = template_span(words, family)
            rest += [(text[u], x, y - x, wide[u]) for x, y in ((a, a + low), (a + high, b)) if y - x > 1]
            spans = seen.setdefault((int(text[u]), family), [])
            if wide[u] and any(x < a + high and a + low < y for x, y in spans):
                continue
            spans.append((a + low, a + high))
            where = a + low if wide[u] else a
            found[text[u]].append({"paragraph": int(first[line_head[where]]), "word": int(where - line_head[where]), "family": family,
                                   "probability": float(p[u, named[0]]), "similarity": alike})
        if rest:
            todo.insert(0, tuple(np.array(x) for x in zip(*rest, strict=True)))
    return found


def scan(docs: DataFrame, classifier: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_paragraphs, findings (paragraph and word where a unit begins, family, probability, similarity)."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)  # FEATURES times classes numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for piece in (p for batch in batches for p in pieces(batch, "_text")):
            plain, starts, ends, owner, paragraph, word, at, size, n_paragraphs = _units(*text_bytes(piece.column("_text")))
            found = _found(model, slice_hashes(plain, starts, ends), plain, starts, ends, (owner, paragraph, word, at, size), piece.num_rows)
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), pa.array(n_paragraphs.astype(np.int64)), pa.array(found, pa.list_(_FINDING))],
                names=["id", "n_paragraphs", "findings"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("_text"))
    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, {_RESULT}").withColumnRenamed("id", id_col)
