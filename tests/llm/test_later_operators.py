"""The operators of the third round, each against a library or a brute-force version."""

import collections
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from shelfmark.llm import collocations, periodic_runs, queries, sentence_pieces  # noqa: E402
from shelfmark.llm.bytewise import text_bytes  # noqa: E402

from .test_operators import LOWER, ROWS, SCHEMA, WORD, counted, sha  # noqa: E402

PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def table(spark, folder, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


# --- sentence pieces ---


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_pieces_query(spark, library, tmp_path):
    found = queries.op11_sentence_pieces(spark, table(spark, tmp_path, ROWS)).collect()
    want = []
    for r in ROWS:
        ids = library.encode(r[1] or "")
        want.append((r[0], len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert counted(found) == counted(want)


def test_pieces_of_odd_texts(library):
    model = sentence_pieces.model_of(PIECES)
    rng = random.Random(4)
    letters = "abcdeft hin▁  \n\t.,éß漢😀̀\x00ﬁ①Ａ"
    texts = [None, "", " ", "   ", "▁", " ▁ x▁y ▁", "<0x41> <s> </s> <unk>", " " * 3000 + "abc", "x" * 3000, "漢" * 700]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(800)]
    ids, begins, ends, counts = model.encode(*text_bytes(pa.array(texts, pa.string())))
    at = 0
    for text, n in zip(texts, counts.tolist(), strict=True):
        want = library.encode(text or "", return_type="proto").pieces
        assert ids[at : at + n].tolist() == [p.id for p in want], text
        assert [*zip(begins[at : at + n].tolist(), ends[at : at + n].tolist(), strict=True)] == [(p.begin, p.end) for p in want], text
        assert model.decode(ids[at : at + n]) == library.decode([p.id for p in want]), text
        at += n


def test_any_ids_decode(library):
    model = sentence_pieces.model_of(PIECES)
    rng = random.Random(5)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(32000)]) for _ in range(rng.randint(0, 8))]
        assert model.decode(np.array(ids, np.int64)) == library.decode(ids), ids


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc", "nmt_nfkc_cf"])
@pytest.mark.parametrize("squeezes", [False, True])
def test_compiled_character_map(rule, squeezes):
    """The model at hand has no map; the rules the library ships are held against the library."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as files

    theirs = sentencepiece.SentencePieceNormalizer(
        rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=squeezes
    )
    made = files.ModelProto()
    made.ParseFromString(theirs.serialized_model_proto())

    class Rules:
        map = sentence_pieces.CharacterMap(made.normalizer_spec.precompiled_charsmap)
        prefixes = True

    Rules.squeezes = squeezes
    rng = random.Random(6)
    letters = [chr(c) for c in range(1, 0x3100) if chr(c).isprintable()] + list("ﬁ①ＡABC   ガﾞが\n\t")
    texts = ["", " ", "ﾊﾟ①ﬁ  Ⅷ ẹ́"]
    texts += ["".join(rng.choice(letters if rng.random() < 0.5 else "ab ﾊﾟＡ é") for _ in range(rng.randint(0, 30))) for _ in range(400)]
    ours = sentence_pieces.Normalised(Rules, *text_bytes(pa.array(texts)))
    for i, text in enumerate(texts):
        a, b = ours.begin[i], ours.begin[i + 1]
        assert ours.text[a:b].tobytes().decode().replace(" ", "▁") == theirs.normalize(text), text
        assert (np.diff(ours.low[a:b]) >= 0).all() and (ours.low[a:b] <= ours.high[a:b]).all()


def test_pieces_pass_other_columns(docs, empty):
    found = sentence_pieces.encode(docs, PIECES, with_decoded=True)
    assert found.columns == [c for c in docs.columns if c not in ("text", "ids")] + ["ids", "begins", "ends", "decoded"]
    again = sentence_pieces.decode(found.withColumnRenamed("decoded", "first"), PIECES)
    assert again.where(~F.col("decoded").eqNullSafe(F.col("first"))).count() == 0
    assert sentence_pieces.encode(empty, PIECES).count() == 0


# --- collocations ---


def brute_phrases(rows, least=10, first=2000, most=3):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for m in range(1, most + 1):
                f[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = set()
    for lang, c in f.items():
        candidates = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        gone = set()
        for p, a in candidates.items():
            for m in range(2, len(p)):
                gone |= {p[i : i + m] for i in range(len(p) - m + 1) if 100 * a >= 50 * c[p[i : i + m]]}
        kept = []
        for p, a in candidates.items():
            if p not in gone:
                s, k = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-s, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:first], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return out


def phrase_rows():
    rng = random.Random(8)
    words = [f"W{i}" for i in range(12)] + ["é", "de", "aa", "x"]
    rows = [(None, "aa"), (None, None), ("", "aa"), ("  \t ", None), (". , ;", "aa"), ("one", ""), ("de aa de aa", "de")]
    for i in range(300):
        text = "".join(rng.choice(words[: 4 + i % 12]) + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ",", " "]) for _ in range(rng.randint(0, 40)))
        rows.append((text, [None, "aa", "de", "und"][i % 4]))
    rows += [rows[40]] * 25 + [("tick tock " * 4000, "aa"), ("a a a a a a a a a a a a a a a", "aa")]
    return rows


@pytest.mark.parametrize("words", [60, 1 << 20])
def test_phrases(spark, monkeypatch, words):
    """Small runs and ranges, and everything in one."""
    monkeypatch.setattr(collocations, "RUN_WORDS", words)
    monkeypatch.setattr(collocations, "PER_RANGE", 100 if words == 60 else 1 << 21)
    rows = phrase_rows()
    made = spark.createDataFrame([(*r, 1, "s") for r in rows], "text string, lang string, score int, run string").repartition(3)
    assert {tuple(r) for r in collocations.mine(made).collect()} == brute_phrases(rows)
    assert {tuple(r) for r in collocations.mine(made, least=3, first=20).collect()} == brute_phrases(rows, 3, 20)


def test_longer_phrases(spark):
    rows = phrase_rows()
    made = spark.createDataFrame(rows, "text string, lang string")
    assert {tuple(r) for r in collocations.mine(made, most=4, least=5).collect()} == brute_phrases(rows, 5, most=4)
    assert {tuple(r) for r in collocations.mine(made, most=2, least=5).collect()} == brute_phrases(rows, 5, most=2)


def test_ranges_answer_each_run():
    """Counts of equal keys add up over runs, and only runs that hold a frequent key get an answer."""
    streams = {"a": {1: 6, 5: 2}, "b": {1: 4, 7: 9}, "c": {5: 7, 9: 1 << 31, 2**63: 10}}
    table = pa.table({
        "run": list(streams),
        "keys": [collocations.pack_sorted(np.array(list(s), np.uint64)) for s in streams.values()],
        "counts": [collocations.pack(np.array(list(s.values()), np.uint32)) for s in streams.values()],
    })
    found = collocations._frequent_of(10)(table).to_pylist()
    got = {r["run"]: collocations.unpack_sorted(r["keys"], np.uint64).tolist() for r in found}
    assert got == {"a": [1], "b": [1], "c": [9, 2**63]}


def test_exact_scores(spark):
    big = 98_765_432_109_876
    made = spark.createDataFrame([(big, big + 5, big + 7), (10, 10, 10), (3, 7, 9)], "a long, l long, r long")
    found = [r[0] for r in made.select(collocations.score(F.col("a"), F.col("l"), F.col("r"))).collect()]
    assert found == [1_000_000 * a * a // (x * y) for a, x, y in ((big, big + 5, big + 7), (10, 10, 10), (3, 7, 9))]


def test_phrases_of_an_empty_table(empty):
    assert collocations.mine(empty).count() == 0


def test_streams_are_merged(docs):
    """No hash join between count streams."""
    counts = collocations.stage(collocations.frequent(collocations.stage(collocations.count_runs(docs), "t")), "t")
    plan = collocations.candidates(counts)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "HashJoin" not in plan


# --- periodic runs ---


def brute_runs(words, least=12):
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            stretch = words[i : j + q]
            if j > i and len(stretch) >= max(least, 2 * q):
                if not any(stretch[p:] == stretch[:-p] for p in range(1, q)):
                    out.append((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def brute_repeats(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def run_rows():
    rng = random.Random(9)
    rows = [r for r in ROWS if len(r[1] or "") < 20_000]
    rest = rows[0][2:]
    for i in range(200):
        words = [f"w{rng.randrange(rng.choice([1, 2, 3, 40]))}" for _ in range(rng.randint(0, 90))]
        rows.append((5000 + i, rng.choice([" ", "\n", "\t  "]).join(words), *rest))
    return rows


def test_runs_query(spark, tmp_path):
    rows = run_rows()
    want = []
    for r in rows:
        words = brute_repeats(r[0], WORD.findall(r[1] or ""))
        runs = brute_runs(words)
        best = min(((-n, s, q) for s, n, q in runs), default=None)
        numbers = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want.append((r[0], len(runs), *numbers, sha(lines), sha(collapsed(words, runs))))
    found = queries.op13_periodic_runs(spark, table(spark, tmp_path, rows)).collect()
    assert counted(found) == counted(want)
    assert sum(w[1] for w in want) > 20


@pytest.mark.parametrize("least", [2, 3, 4, 7, 12])
def test_runs(least):
    rng = random.Random(least)
    for _ in range(400):
        n, kinds = rng.randint(0, 60), rng.choice([1, 2, 2, 3, 5])
        words = [rng.randrange(kinds) for _ in range(n)]
        if n and rng.random() < 0.5:
            a = rng.randrange(n)
            p = rng.randint(1, max(1, (n - a) // 3))
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        items = np.array([zlib.crc32(bytes([w])) for w in words], np.uint64)
        cut = rng.randint(0, n)
        runs, upto = periodic_runs.text_runs(items, np.array([0, cut, cut, n]), least)
        assert [tuple(r) for r in runs.tolist()] == brute_runs(words[:cut], least) + brute_runs(words[cut:], least)
        assert upto[1] == upto[2]


def test_long_runs():
    for words in ([1] * 30_000, [i % 3001 for i in range(30_000)]):
        runs, _ = periodic_runs.text_runs(np.array(words, np.uint64), np.array([0, len(words)]))
        assert runs.tolist() == [[0, len(words), len(set(words))]]


def test_words_that_cannot_repeat_are_left_out():
    """A passage that comes again only far off is not looked at closer."""
    passage, between = list(range(20)), list(range(100, 400))
    items = np.array(passage + between + passage, np.uint64)
    assert len(periodic_runs.stretches(items, np.array([0, len(items)]))) == 0


def test_runs_pass_other_columns(docs, empty):
    found = periodic_runs.find(docs)
    assert found.columns == [c for c in docs.columns if c != "text"] + ["n_words", "runs", "collapsed"]
    assert found.count() == docs.count()
    assert periodic_runs.find(empty).count() == 0


def test_registered():
    assert {"op11_sentence_pieces", "op12_collocations", "op13_periodic_runs"} <= set(queries.QUERIES)


# --- chunks of look-ups ---

@pytest.mark.parametrize("operator", ["dedup", "score"])
def test_chunks_do_not_follow_the_splits(spark, tmp_path, monkeypatch, operator):
    """Executors that come or go change how Spark cuts files; look-ups that go by chunks give the same result."""
    from shelfmark.llm import chunked, lm_scoring, substring_dedup

    rng = random.Random(5)
    passage = " ".join(f"p{k}" for k in range(30))
    rows = [(i, " ".join(f"w{rng.randrange(4000)}" for _ in range(60)) + (" " + passage if i % 5 == 0 else "")) for i in range(800)]
    path = f"{tmp_path}/docs"
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.option("parquet.block.size", 16_384).parquet(path)
    module = substring_dedup if operator == "dedup" else lm_scoring
    monkeypatch.setattr(chunked, "CHUNK_BYTES", 20_000)
    kept = {name: spark.conf.get(name) for name in ("spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum") if spark.conf.get(name, None)}
    parts, real = [40, 1, 7, 3], module.stage

    def moved(df, *args, **options):
        done = real(df, *args, **options)
        spark.conf.set("spark.sql.files.minPartitionNum", parts[0])
        parts.append(parts.pop(0))
        return done

    def result():
        docs = spark.read.parquet(path)
        found = substring_dedup.dedup(docs, from_files=True) if operator == "dedup" else lm_scoring.score(docs, from_files=True)
        columns = ["doc_id", "n_removed", "kept_text"] if operator == "dedup" else ["doc_id", "n_tokens", "n_known", "base_score"]
        return sorted(tuple(r) for r in found.select(*columns).collect())

    try:
        spark.conf.set("spark.sql.files.openCostInBytes", 1024)
        spark.conf.set("spark.sql.files.minPartitionNum", 2)
        wanted = result()
        docs = spark.read.parquet(path)
        assert docs.select(chunked.file_part("doc_id")).distinct().count() > chunked.PER_FILE
        spark.conf.set("spark.sql.files.minPartitionNum", 40)
        assert docs.rdd.getNumPartitions() > 2  # splits do move
        spark.conf.set("spark.sql.files.minPartitionNum", 2)
        monkeypatch.setattr(module, "stage", moved)
        assert result() == wanted and len(wanted) == 800
    finally:
        for name in ("spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"):
            spark.conf.unset(name)
        for name, value in kept.items():
            spark.conf.set(name, value)


def test_a_chunk_holds_few_bytes(spark):
    from shelfmark.llm import chunked

    rows = [(i, ("file:/x/part-0", 32_000_000)) for i in range(2000)]
    found = spark.createDataFrame(rows, "doc_id long, _metadata struct<file_path: string, file_size: long>")
    assert found.select(chunked.file_part("doc_id")).distinct().count() >= 8


def test_a_run_sends_a_part_one_row(docs):
    runs = collocations.count_runs(docs.coalesce(1)).toArrow()
    for i in range(runs.num_rows):
        run = runs.slice(i, 1)
        orders = collocations._Stream(run.to_pylist()[0]).orders
        keys = collocations.ranged(np.unique(np.concatenate([k for _, _, k in orders])), 4)
        answers = pa.table({"run": run.column("run"), "keys": pa.array([collocations.pack_sorted(keys)], pa.binary())})
        sent = collocations._spelled(3, 4, 2)(run, answers)
        assert sent.column("part").to_pylist() == [0, 1]
        added = [collocations._added(3, 1)(pa.concat_tables([sent.slice(k, 1)] * 2)) for k in (0, 1)]
        assert sum(sum(t.column("f").to_pylist()) for t in added) == 2 * sum(int(c.sum()) for _, c, _ in orders)
        assert sum(t.num_rows for t in added) == sum(len(c) for _, c, _ in orders)


def test_n_grams_of_texts_are_counted_as_one_number(monkeypatch):
    from shelfmark.llm import language_id

    texts = ["", "Ünï 日本語 テスト a b", "123", " x ", "ÀÉ" * 5, "日本 日本 😀 q", "İstanbul", "aaa aaa"]
    want = []
    for k, text in enumerate(texts):
        letters = "".join(c if c.isalpha() else " " for c in text.lower())
        letters = f" {' '.join(re.sub(r'[^\w]+', ' ', letters).split())} "
        grams = collections.Counter(letters[i : i + n] for n in (1, 2, 3) for i in range(len(letters) - n + 1))
        grams = {g: n for g, n in grams.items() if g.strip() and not (len(g) == 3 and g[1] == " ")}
        code = {g: sum((ord(c) + 1 if c != " " else 1) << 21 * (len(g) - 1 - i) for i, c in enumerate(g)) for g in grams}
        want += sorted((k, code[g], n) for g, n in grams.items())
    data, offsets = text_bytes(pa.array(texts))
    points, owner, _ = language_id._letters(data, offsets)
    for widest in (1 << 63, 1000):
        monkeypatch.setattr(language_id, "WIDEST", widest)
        found = language_id._counted(points, np.minimum(owner, len(texts) - 1), len(texts))
        assert list(zip(*(x.tolist() for x in found), strict=True)) == want
        order = language_id._by_count(found[0], found[2])
        assert [want[i] for i in order] == sorted(want, key=lambda r: (r[0], -r[2], r[1]))
