"""Near copies against all pairs of shingle sets: templates, odd rows, clashing names."""

import random

from shelfmark.llm import near_copies, simhash, stages

from .test_pipeline import alike_brute


def kept(spark, texts, monkeypatch=None):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    return sorted(r.doc_id for r in near_copies.keep(docs).collect())


def templated(n, changed, seed):
    """Texts on one template, in twins that differ in one word."""
    rng = random.Random(seed)
    template = [f"t{rng.randrange(5000)}" for _ in range(300)]
    texts = {}
    for i in range(n // 2):
        own = template[:]
        for k in range(changed):
            own[(k * 300) // changed + 3] = f"own{i}x{k}"
        twin = own[:]
        twin[150] = f"twin{i}"
        texts[2 * i], texts[2 * i + 1] = " ".join(own), " ".join(twin)
    return texts


def test_no_link_is_lost_in_a_group_on_one_template(spark):
    """600 documents whose cross similarity is about 0.6: each pair of twins is found, and nothing else is linked."""
    texts = templated(600, 7, 1)
    assert kept(spark, texts) == [i for i in sorted(texts) if i % 2 == 0]


def test_as_all_pairs(spark):
    rng = random.Random(2)
    words = [f"w{k}" for k in range(40)]
    texts = {-4: None, -3: "", -2: "  \n", -1: "one two", 0: "ONE\ttwo", 1: "one three", 2: "x " * 20_000}
    for i in range(10, 200):
        base = [rng.choice(words) for _ in range(rng.choice([3, 5, 60]))]
        texts[i] = " ".join(base)
        for k in range(1, rng.randint(1, 4)):
            copy = base[:]
            copy[rng.randrange(len(copy))] = "other"
            texts[1000 * k + i] = " ".join(copy)
    assert kept(spark, texts) == sorted(set(alike_brute(texts).values()))


def test_repeated_ids_and_clashing_columns(spark):
    long_text = " ".join(f"v{k}" for k in range(100))
    rows = [(1, long_text, 7, 7, "x", "x"), (1, long_text, 7, 7, "x", "x"), (2, long_text + " end", 8, 8, "y", "y"), (3, "another", 9, 9, "z", "z")]
    rows += [(4, "another", 1, 1, "z", "z"), (4, "and so to say", 1, 1, "z", "z"), (None, long_text, 1, 1, "n", "n"), (5, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _gone int, id int, key string, a string")
    found = near_copies.keep(docs.withColumnRenamed("a", "b"))
    assert found.columns == ["doc_id", "text", "_gone", "id", "key", "b"]
    assert sorted(r.doc_id or 0 for r in found.collect()) == [0, 1, 1, 3, 5]
    assert near_copies.keep(docs.where("doc_id = 77")).count() == 0


def test_rounds_leave_one_table_and_no_shuffle_files(spark):
    """Tables of earlier rounds and shuffle files of counts added up with every round, to 0.7 GB on small input."""
    spark._jvm.System.gc()
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {f for f in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}

    files, tables = shuffled(), list(stages._made)
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 102), (101, 102)], "a long, b long")
    found = simhash.components(edges)
    assert len(stages._made) == len(tables) + 1
    assert not shuffled() - files
    assert {(r.node, r.component) for r in found.collect()} == {(i, 0) for i in range(61)} | {(i, 100) for i in (100, 101, 102)}

    tables = list(stages._made)
    texts = templated(40, 7, 3)
    assert kept(spark, texts) == [i for i in sorted(texts) if i % 2 == 0]
    assert len(stages._made) == len(tables) + 1
