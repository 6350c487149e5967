"""The corpus pipeline, stage by stage and as a whole, against plain versions of the stages."""

import collections
import random
import re
import time

import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from shelfmark.llm import byte_bpe, near_copies, queries, simhash  # noqa: E402

from .test_operators import LOWER, SCHEMA, WORD, mix_brute  # noqa: E402


def rows():
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(2, 7))) for _ in range(200)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(30, 120))) for _ in range(60)]
    texts += [texts[0], texts[0] + "\n", "  " + texts[1], texts[2].replace(" ", "  ")]
    long_ = texts[3] + " " + " ".join(rng.choice(words) for _ in range(400))
    texts += [long_, long_ + " end", None, "", "123 456 !!!"]
    made = [(i, t, "aa" if i % 3 else "bb", f"src{i % 5}", len(t or "")) for i, t in enumerate(texts)]
    made += [made[7], made[7]]
    return [(*r, 0.5, "i", "o", "k", "c", "t", 1, 2, 3) for r in made]


ROWS = rows()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


def after_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = []
    for k, (_, function) in enumerate(corpus_pipeline.STAGES):
        docs = function(spark, docs, folder)
        docs.write.parquet(f"{folder}/after-{k}")
        docs = spark.read.parquet(f"{folder}/after-{k}")
        found.append(docs)
    return found


def alike_brute(texts):
    """The smallest id of each component of texts with 0.8 or more of their five-word shingles in common."""
    sets = {}
    for i, text in texts.items():
        w = WORD.findall((text or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))}
    low = {i: i for i in sets}
    for i in sorted(sets):
        for j in sets:
            if j < i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and low[i] != low[j]:
                a, b = max(low[i], low[j]), min(low[i], low[j])
                low = {k: b if v == a else v for k, v in low.items()}
    return low


def test_stages(spark, folder):
    known, exact, near, mixed, tokens = after_stages(spark, folder)
    columns = [f.name for f in spark.createDataFrame([], SCHEMA).schema]
    assert all(df.columns == columns for df in (known, exact, near, mixed))
    texts = {r[0]: r[1] for r in ROWS}

    # language ID: documents without a letter go, all others stay
    wanted = collections.Counter(r[0] for r in ROWS if r[1] and any(c.isalpha() for c in r[1]))
    assert collections.Counter(r.doc_id for r in known.collect()) == wanted

    # exact dedup: one of each content stays, the longest, then the smallest id
    best = {}
    for i in wanted:
        content = re.sub(r"[\x20\x09-\x0D]", "", texts[i])
        best[content] = min(best.get(content, (0, i)), (-len(texts[i]), i))
    assert sorted(r.doc_id for r in exact.collect()) == sorted(i for _, i in best.values())

    # near copies: the smallest id of each component
    component = alike_brute({i: texts[i] for _, i in best.values()})
    assert sorted(r.doc_id for r in near.collect()) == sorted(set(component.values()))
    assert len(set(component.values())) < len(best)

    # the mixture repeats and leaves out
    plain = []
    for r in near.collect():
        domain = ("web", "books", "code")[int(r.source[3:]) % 3]
        plain.append({"doc_id": r.doc_id, "domain": domain, "lang": r.lang, "source": r.source, "n_tokens": len(WORD.findall(r.text))})
    read = mix_brute(plain, queries.MIX_WEIGHTS, ("domain", "lang", "source"), queries.MIX_SHARE, queries.MIX_EPOCHS, 17)
    copies = collections.Counter({x[0]: x[-2] for x in read})
    assert collections.Counter(r.doc_id for r in mixed.collect()) == +copies

    # tokens of every copy give the text back
    path = queries.bpe_path()
    for r in byte_bpe.decode(tokens, path).collect():
        assert bytes(r.decoded).decode() == texts[r.doc_id] and r.n_tokens == len(r.ids) == len(r.offsets)
    assert collections.Counter(r.doc_id for r in tokens.collect()) == +copies
    whole = corpus_pipeline.run(spark, folder)
    assert whole.columns == tokens.columns and whole.count() == tokens.count()


def test_stages_take_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, function in corpus_pipeline.STAGES:
        after = function(spark, docs, "")
        assert after.count() == 0
        docs = after if after.columns == docs.columns else docs


def test_staged_tables_can_be_discarded(spark):
    from shelfmark.llm import stages

    df = stages.stage(spark.range(3).toDF("id"), "discard")
    assert df.count() == 3
    path = df.inputFiles()[0].rsplit("/", 1)[0]
    stages.discard(spark)
    from shelfmark.sources.tables import exists

    assert not exists(spark, path) and not stages._made


def test_near_copies_keep_rows_without_an_id(spark):
    docs = spark.createDataFrame([(None, "a b c d e"), (1, "a b c d e"), (2, "a b c d e")], "doc_id long, text string")
    assert sorted((r.doc_id or 0) for r in simhash.keep(docs).collect()) == [0, 1]


def test_near_copies_beyond_the_reach_of_fingerprints_go(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghiklmnoprstu") for _ in range(6)) for _ in range(500)]

    def shingles(text):
        w = text.lower().split()
        return {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))}

    made = []
    for i in range(40):
        text = [rng.choice(words) for _ in range(300)]
        made.append((3 * i, " ".join(text)))
        for k, changes in ((1, 4), (2, 14)):  # similarity 0.87 and 0.62
            copy = text[:]
            for j in range(changes):
                copy[10 + 20 * j] = "changed"
            made.append((3 * i + k, " ".join(copy)))
    made += [(1000, "a b"), (1001, "A  b"), (1002, "a c"), (None, "a b")]
    sets = {i: shingles(t) for i, t in made if i is not None}
    best = {i: min([j for j in sets if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]) for i in sets}
    docs = spark.createDataFrame(made, "doc_id long, text string")
    found = [r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect()]
    assert sorted(i for i in found if i is not None) == sorted(set(best.values())) and found.count(None) == 1
    assert all(len(x) == 40 for x in ([i for i in found if i is not None and i < 1000 and i % 3 == 0],
                                      [i for i in found if i is not None and i < 1000 and i % 3 == 2]))
    assert len([i for i in simhash.keep(docs.where("doc_id IS NOT NULL")).collect() if i.doc_id % 3 == 1 and i.doc_id < 1000]) > 20


def test_large_groups_of_near_copies_make_few_pairs(spark):
    rng = random.Random(6)
    text = [str(rng.randrange(10_000)) for _ in range(200)]
    made = [(i, " ".join([*text[:50], str(-i), *text[50:]])) for i in range(600)]
    docs = spark.createDataFrame(made, "id long, _text string")
    half = near_copies.candidates(docs.where("id < 300")).count()
    assert half < near_copies.candidates(docs).count() < 3 * half
    assert [r.id for r in near_copies.keep(docs, "id", "_text").collect()] == [0]


def test_tokens_are_decoded_and_held_against_the_text(spark, monkeypatch):
    import hashlib

    from pyspark.sql import functions as F

    texts = ["it's a  té漢\n", "", None, "x" * 300]
    docs = spark.createDataFrame([(i, "aa", "s", t) for i, t in enumerate(texts)], "doc_id long, lang string, source string, text string")
    for r in corpus_pipeline.tokens(spark, docs, "").collect():
        assert r.round_trip and r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
    encode = byte_bpe.encode
    monkeypatch.setattr(byte_bpe, "encode", lambda *a, **b: encode(*a, **b).withColumn("decoded", F.lit(b"other")))
    assert not any(r.round_trip for r in corpus_pipeline.tokens(spark, docs, "").collect())


def test_a_stage_leaves_no_shuffle_files(spark):
    from shelfmark.llm.stages import stage

    def shuffled():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}

    before = shuffled()
    staged = stage(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.2)
    assert not shuffled() - before
    assert staged.count() == 7
