"""Log-probabilities of whole documents under a recurrent language model learned from the corpus.

Counting.  Words are counted over all training documents through ``chunked`` look-ups: each chunk sends its distinct
words with their counts, each bucket answers with the words' counts in all training documents.

Classes.  The ``HEAD`` most frequent words (ties by hash) fall into classes of ``WIDTH`` by frequency.  All other words
fall into ``TAIL`` classes by their last two bytes, known or not.  Within a tail class a word has its add-one share of
the class's training tokens, and all unknown words of the class share the remaining part, so that the probabilities of
known words and of one unknown word in each class sum to 1.

Learning.  Each task trains a copy of the network by truncated backpropagation over its training documents, once; the
copies are averaged by tokens.  There are two rounds: a tenth of the documents, and from that average the others.

Scoring.  A task reads a chunk's documents whole, with state carried from window to window.

Averaging explodes weights to rows and sums them with map-side combining; the driver gets one network, the list of
frequent words and the sizes of classes, all of fixed size.

Defined results: a null text counts as empty; an empty document is its end token.  A null id counts as empty text when
documents are divided.  Without training documents every word is unknown and the network keeps its first weights.
Repeated rows count and are scored each.  Other columns of the input do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytewise import lower_ascii, mix, pieces, slice_hashes, text_bytes, word_spans
from .chunked import bucket_of, by_chunk, pack, pack_sorted, stable, starts_of, unpack, unpack_sorted
from .recurrent import Network, Trainer
from .stages import shuffle_partitions, stage

HEAD, WIDTH, TAIL = 512, 32, 32
END = np.uint64(0x5DEECE66D)  # stands for the end of a document among hashes of words
TRAIN_TOKENS = 300_000  # tokens laid into lanes at a time
ROUNDS = (("_turn = 0", 1), ("_turn <> 0", 2))  # which training documents, and the number of the round


def is_training(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % 7 != 2


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and tail class of every token, ends included, and the number of tokens of each text."""
    data, offsets = text_bytes(texts)
    data = lower_ascii(data)
    starts, ends, first = word_spans(data, offsets)
    hashes = slice_hashes(data, starts, ends)
    last = data[ends - 1].astype(np.uint64)
    second = np.where(ends - starts > 1, data[np.maximum(ends - 2, 0)], 0).astype(np.uint64)
    shape = (mix(last << np.uint64(8) | second) % np.uint64(TAIL)).astype(np.uint8)
    at = first[1:]
    return np.insert(hashes, at, END), np.insert(shape, at, 0), np.diff(first) + 1


def _count(n_buckets: int):
    """Pass 1: for each chunk and bucket the distinct words, their training counts and classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for piece in (p for batch in batches for p in pieces(batch, "text")):
            chunks = piece.column("chunk").to_numpy()
            teaches = np.asarray(piece.column("training").to_numpy(zero_copy_only=False), bool)
            hashes, shape, sizes = _tokens(piece.column("text"))
            counted = np.repeat(teaches, sizes)
            chunk_of = np.repeat(chunks, sizes)
            for chunk in np.unique(chunks).tolist():
                mine = chunk_of == chunk if len(chunks) else slice(None)
                distinct, one, which = np.unique(hashes[mine], return_index=True, return_inverse=True)
                n = np.bincount(which, counted[mine], len(distinct)).astype(np.int64)
                held.setdefault(chunk, []).append((distinct, n, shape[mine][one]))
        for chunk in list(held):
            parts = held.pop(chunk)
            distinct, one, which = np.unique(np.concatenate([p[0] for p in parts]), return_index=True, return_inverse=True)
            n = np.bincount(which, np.concatenate([p[1] for p in parts]), len(distinct)).astype(np.int64)
            shape = np.concatenate([p[2] for p in parts])[one]
            bucket = bucket_of(distinct, n_buckets)
            order = np.argsort(bucket, kind="stable")
            begin = starts_of(bucket[order])
            for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(order)], strict=True):
                some = order[a:b]
                yield pa.RecordBatch.from_pydict({
                    "chunk": pa.array([chunk], pa.int64()), "bucket": pa.array([int(bucket[some[0]])], pa.int64()),
                    "words": pa.array([pack_sorted(distinct[some])], pa.binary()), "counts": pa.array([pack(n[some])], pa.binary()),
                    "shapes": pa.array([pack(shape[some])], pa.binary()),
                })

    return run


_REPLY = (
    "chunk bigint, bucket bigint, counts binary, words array<bigint>, totals array<bigint>, shapes array<int>, "
    "tokens array<bigint>, known array<bigint>"
)


def _total(table: pa.Table) -> pa.Table:
    """Answers to chunks (counts), and of the bucket: its most frequent words, and tokens and known words by class."""
    words = [unpack_sorted(x, np.uint64) for x in table.column("words").to_pylist()]
    chunks = by_chunk(table)
    own = [np.unique(np.concatenate([words[i] for i in rows])) if len(rows) > 1 else words[rows[0]] for _, rows in chunks]
    sizes = np.array([len(x) for x in own])
    both = np.concatenate(words)
    n = np.concatenate([unpack(x, np.int64) for x in table.column("counts").to_pylist()])
    shape = np.concatenate([unpack(x, np.uint8) for x in table.column("shapes").to_pylist()])
    distinct, one, which = np.unique(both, return_index=True, return_inverse=True)
    total = np.bincount(which, n, len(distinct)).astype(np.int64)
    ends = np.cumsum(sizes)
    back = total[np.searchsorted(distinct, np.concatenate(own))]
    answers = [pack(back[e - s : e]) for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
    top = np.lexsort((distinct.view(np.int64), -total))[:HEAD]
    top = top[total[top] > 0]
    by_shape = np.bincount(shape[one], total, TAIL).astype(np.int64)
    known = np.bincount(shape[one], total > 0, TAIL).astype(np.int64)
    n = len(answers)

    def last(values, kind):  # the bucket's own row
        return pa.array([None] * n + [values.tolist()], pa.list_(kind))

    return pa.table({
        "chunk": pa.array([*[c for c, _ in chunks], None], pa.int64()),
        "bucket": pa.array([*table.column("bucket").to_pylist()[:n], None], pa.int64()),
        "counts": pa.array([*answers, None], pa.binary()),
        "words": last(distinct[top].view(np.int64), pa.int64()), "totals": last(total[top], pa.int64()),
        "shapes": last(shape[one][top].astype(np.int32), pa.int32()),
        "tokens": last(by_shape, pa.int64()), "known": last(known, pa.int64()),
    })


@dataclass
class Vocabulary:
    """What all tasks know: frequent words in order, and sizes of the classes of the others."""

    head: np.ndarray  # hashes, sorted
    place: np.ndarray  # of each in the order of frequency
    head_counts: np.ndarray  # in the order of frequency
    tail_tokens: np.ndarray
    tail_words: np.ndarray
    tokens: int
    words: int

    @classmethod
    def of(cls, replies: DataFrame) -> Vocabulary:
        """From the answers of all buckets; ``HEAD`` words and ``TAIL`` classes reach the driver."""
        own = replies.where("chunk IS NULL")
        listed = own.select(F.inline(F.arrays_zip("words", "totals", "shapes"))).toDF("word", "n", "shape")
        top = listed.orderBy(F.desc("n"), "word").limit(HEAD).collect()
        by_class = own.select(F.posexplode(F.arrays_zip("tokens", "known")).alias("shape", "x"))
        sums = by_class.groupBy("shape").agg(F.sum("x.tokens").alias("n"), F.sum("x.known").alias("known")).collect()
        tokens, words = np.zeros(TAIL, np.int64), np.zeros(TAIL, np.int64)
        for r in sums:
            tokens[r.shape], words[r.shape] = r.n, r.known
        n, v = int(tokens.sum()), int(words.sum())
        for r in top:
            tokens[r.shape] -= r.n
            words[r.shape] -= 1
        head = np.array([r.word for r in top], np.int64).view(np.uint64)
        order = np.argsort(head)
        return cls(head[order], order, np.array([r.n for r in top], np.int64), tokens, words, n, v)

    @property
    def head_classes(self) -> int:
        return -(-len(self.head) // WIDTH)

    def network(self) -> Network:
        """Begins as the unigram model of classes and of their words."""
        prior = np.zeros((self.head_classes, WIDTH)) + 1e-3
        prior.reshape(-1)[: len(self.head)] += self.head_counts
        of_class = np.r_[prior.sum(axis=1), self.tail_tokens + self.tail_words + 1.0]
        return Network.new(len(self.head) + TAIL, of_class / of_class.sum(), prior / prior.sum(axis=1, keepdims=True))

    def places(self, hashes: np.ndarray, shape: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item, class, and word within the class (-1 in a tail class) of each token."""
        at = np.minimum(np.searchsorted(self.head, hashes), max(len(self.head) - 1, 0))
        frequent = self.head[at] == hashes if len(self.head) else np.zeros(len(hashes), bool)
        place = self.place[at] if len(self.head) else np.zeros(len(hashes), np.int64)
        item = np.where(frequent, place, len(self.head) + shape)
        return item, np.where(frequent, place // WIDTH, self.head_classes + shape), np.where(frequent, place % WIDTH, -1)

    def end_item(self) -> int:
        return int(self.places(np.array([END]), np.zeros(1, np.int64))[0][0])


def _train(vocabulary: Vocabulary, flat: np.ndarray, number: int):
    """One round: each task trains on its documents and hands on its weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(vocabulary.network().filled(flat))
        end, held, n = vocabulary.end_item(), [], 0

        def learn():
            trainer.learn(*(np.concatenate(x) for x in zip(*held, strict=True)), end)
            held.clear()

        for piece in (p for batch in batches for p in pieces(batch, "text")):
            hashes, shape, sizes = _tokens(piece.column("text"))
            held.append((sizes, *vocabulary.places(hashes, shape.astype(np.int64))))
            n += len(hashes)
            if n >= TRAIN_TOKENS:
                learn()
                n = 0
        if held:
            learn()
        if trainer.tokens:
            yield pa.RecordBatch.from_pydict({
                "tokens": pa.array([float(trainer.tokens)]),
                "weights": pa.array([trainer.network.flat().astype(np.float64)], pa.list_(pa.float64())),
            })

    del number
    return run


def train(rows: DataFrame, vocabulary: Vocabulary) -> Network:
    """The average of networks trained where the documents are; ``rows``: text, _turn of the training documents."""
    network = vocabulary.network()
    for which, number in ROUNDS:
        trained = rows.where(which).select("text").mapInArrow(_train(vocabulary, network.flat(), number), "tokens double, weights array<double>")
        each = trained.select("tokens", F.posexplode("weights").alias("i", "w"))
        average = each.groupBy("i").agg((F.sum(F.col("tokens") * F.col("w")) / F.sum("tokens")).alias("w")).collect()
        if average:
            flat = np.zeros(len(average))
            for r in average:  # one row for each weight
                flat[r.i] = r.w
            network = network.filled(flat)
    return network


def _score(vocabulary: Vocabulary, flat: np.ndarray, n_buckets: int):
    """Pass 2: the score of every document of a chunk, and its score under the counts alone."""

    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        schema = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                            ("base_score", pa.float64()), ("score", pa.float64())])
        if not docs.num_rows:
            return schema.empty_table()
        network, end = vocabulary.network().filled(flat), vocabulary.end_item()
        parts = [_tokens(p.column("text")) for b in docs.to_batches() for p in pieces(b, "text")]
        hashes, shape, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
        distinct, which = np.unique(hashes, return_inverse=True)
        order = np.argsort(bucket_of(distinct, n_buckets), kind="stable")
        answered = sorted(zip(replies.column("bucket").to_pylist(), replies.column("counts").to_pylist(), strict=True))
        counts = np.zeros(len(distinct), np.int64)
        found = np.concatenate([unpack(x, np.int64) for _, x in answered])
        if len(found) != len(distinct):
            raise ValueError("a chunk does not hold the documents it held before")
        counts[order] = found
        count = counts[which]
        text = np.repeat(np.arange(len(sizes)), sizes)
        n = len(sizes)
        base = np.bincount(text, np.log10((count + 1) / (vocabulary.tokens + vocabulary.words + 1)), n)
        shape = shape.astype(np.int64)
        items, classes, words = vocabulary.places(hashes, shape)
        log_p = network.score(sizes, items, classes, words, end).astype(np.float64)
        rest = words < 0
        size = (vocabulary.tail_tokens + vocabulary.tail_words + 1)[shape[rest]]
        log_p[rest] += np.log((count[rest] + 1) / size)
        return pa.table({
            "id": docs.column("id").combine_chunks(), "n_tokens": pa.array(sizes.astype(np.int64)),
            "n_known": pa.array(np.bincount(text, count > 0, n).astype(np.int64)), "base_score": pa.array(base),
            "score": pa.array(np.bincount(text, log_p, n) / np.log(10)),
        }, schema)

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", from_files: bool = False) -> DataFrame:
    """id_col, held_out, n_tokens, n_known, train_tokens, base_score, score: a row for each document."""
    rows = stable(docs, id_col, text_col, from_files).withColumn("training", is_training(F.col("id")))
    n = shuffle_partitions(docs.sparkSession)
    counted = rows.select("chunk", "text", "training").mapInArrow(
        _count(n), "chunk bigint, bucket bigint, words binary, counts binary, shapes binary"
    )
    replies = stage(counted.groupBy("bucket").applyInArrow(_total, _REPLY), "word-counts")
    vocabulary = Vocabulary.of(replies)
    turn = F.pmod(F.xxhash64("id"), F.lit(10)).alias("_turn")
    network = train(rows.where("training").select("text", turn), vocabulary)
    answers = replies.where("chunk IS NOT NULL").select("chunk", "bucket", "counts")
    found = rows.select("chunk", "id", "text").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        _score(vocabulary, network.flat(), n), "id bigint, n_tokens bigint, n_known bigint, base_score double, score double"
    )
    return found.select(
        F.col("id").alias(id_col), (~is_training(F.col("id"))).alias("held_out"), "n_tokens", "n_known",
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )
