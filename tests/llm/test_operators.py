"""Each operator against a brute-force version, over rows that are null, empty, long, tied or repeated."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from shelfmark.llm import (  # noqa: E402
    byte_bpe, exact_dedup, language_id, license_scan, lm_scoring, mixing, queries, simhash, substring_dedup, token_shards,
    topk_search,
)
from shelfmark.llm.stages import stage  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
# Other columns whose names the operators use themselves.
CLASHES = "score double, ids string, offsets string, kept string, chunk string, text2 string, copies int, fp int, `a.b` int"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}"


def rows():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    fremd = ["".join(rng.choice("äöüßzwkchsn") for _ in range(rng.randint(3, 8))) for _ in range(300)]

    def text(n, words=vocabulary):
        return " ".join(rng.choice(words) for _ in range(n))

    passage, near = text(60), text(200).split()
    texts = [None, None, "", "", "   \t\n", "one", "don't we'll I'M 's", "!!! 123 ...", "é漢字 ñ　x", text(12), text(13)]
    texts += [text(rng.randint(20, 90)) for _ in range(20)]
    texts += [text(rng.randint(20, 90), fremd) for _ in range(12)]
    texts += [f"{text(10)}\n{passage} {text(8)}" for _ in range(6)]  # a passage that repeats
    texts += [" ".join([*near[:k], "changed", *near[k:]]) for k in (10, 60, 150)] + [" ".join(near), " ".join(near) + "\n"]
    texts += ["All  rights reserved.\nsome other words", f"{text(30)}\nReleased under the MIT License.\n{text(5)}"]
    texts += [text(40_000), "x" * 5000, "ab " * 3000]
    found = []
    for i, t in enumerate(texts):
        foreign = t is not None and any(c in t for c in "äöüß")
        lang = None if i % 11 == 4 else "xx" if foreign else "aa"
        found.append((i * 3, t, lang, f"src{i % 4}" if i % 9 else None, len(t or "")))
    found += [found[20]] * 3  # rows that repeat wholly
    found.append((None, text(15), None, None, 0))
    found.append((None, None, None, None, None))
    return [(*r, 0.5, "i", "o", "k", "c", "t", 1, 2, 3) for r in found]


ROWS = rows()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs():
    return [(r[0], r[1]) for r in ROWS]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def counted(found):
    return collections.Counter(tuple(r) for r in found)


# -- language-model scoring

def test_lm_scores_count_all_training_documents(docs, empty):
    found = lm_scoring.score(docs).collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    words = [(i, [*WORD.findall((t or "").translate(LOWER)), None]) for i, t in pairs()]
    count = collections.Counter(w for i, ws in words if not held(i) for w in ws)
    n, v = sum(count.values()), len(count)
    wanted = collections.Counter(
        (i, held(i), len(ws), sum(count[w] > 0 for w in ws), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws), 4))
        for i, ws in words
    )
    assert counted((r[0], r[1], r[2], r[3], r[4], round(r[5], 4)) for r in found) == wanted
    assert all(r["score"] < 0 for r in found)
    assert lm_scoring.score(empty).count() == 0


def test_lm_learns_what_follows_what(spark):
    """Held-out documents of a text where each word allows four successors beat their counts clearly."""
    rng = random.Random(12)
    words = [f"w{k}" for k in range(40)]
    follow = {w: rng.sample(words, 4) for w in words}
    made = []
    for i in range(400):
        at, text = rng.choice(words), []
        for _ in range(rng.randint(50, 200)):
            text.append(at)
            at = rng.choice(follow[at])
        made.append((i, " ".join(text)))
    found = [r for r in lm_scoring.score(spark.createDataFrame(made, "doc_id long, text string").repartition(2)).collect() if r["held_out"]]
    gain = sum(r["score"] - r["base_score"] for r in found) / sum(r["n_tokens"] for r in found)
    assert gain > 0.2 and all(r["score"] > r["base_score"] for r in found)


def test_lm_probabilities_sum_to_one():
    """Over all known words and one unknown word in each tail class, after any document."""
    rng = np.random.default_rng(1)
    head = np.sort(rng.integers(1, 2**63, 70).astype(np.uint64))
    place = rng.permutation(70)
    tail_tokens, tail_words = rng.integers(0, 50, lm_scoring.TAIL), rng.integers(0, 9, lm_scoring.TAIL)
    vocabulary = lm_scoring.Vocabulary(head, place, np.sort(rng.integers(1, 99, 70))[::-1], tail_tokens, tail_words, 1000, 100)
    network = vocabulary.network()
    classes = np.r_[np.arange(vocabulary.head_classes).repeat(lm_scoring.WIDTH), vocabulary.head_classes + np.arange(lm_scoring.TAIL)]
    words = np.r_[np.tile(np.arange(lm_scoring.WIDTH), vocabulary.head_classes), np.full(lm_scoring.TAIL, -1)]
    start = rng.integers(0, 70, 5)
    total = 0.0
    for c, w in zip(classes, words, strict=True):
        log_p = network.score(
            np.array([6]), np.r_[start, 0], np.r_[start // lm_scoring.WIDTH, c], np.r_[start % lm_scoring.WIDTH, w], 3
        )
        total += math.exp(log_p[-1])
    assert total == pytest.approx(1, abs=1e-4)


def test_lm_state_is_carried_over_windows_and_reset_between_documents():
    from shelfmark.llm.recurrent import Network

    rng = np.random.default_rng(2)
    network = Network.new(20, np.full(8, 1 / 8), np.full((2, 4), 1 / 4))
    items = rng.integers(0, 20, 500)
    classes = items % 8
    words = np.where(classes < 2, items % 4, -1)
    sizes = np.array([200, 1, 0, 99, 120, 80])
    together = network.score(sizes, items, classes, words, 7, lanes=3)
    begin = np.cumsum(sizes) - sizes
    alone = np.concatenate([
        network.score(np.array([n]), items[a : a + n], classes[a : a + n], words[a : a + n], 7) for a, n in zip(begin, sizes, strict=True) if n
    ])
    assert np.allclose(together, alone, atol=1e-4)


def test_lm_gradients_agree_with_differences():
    from shelfmark.llm.recurrent import Network, Trainer

    rng = np.random.default_rng(4)
    network = Network.new(12, np.full(6, 1 / 6), np.full((2, 3), 1 / 3), hidden=5)
    for k in network.weights:
        network.weights[k] = rng.normal(0, 0.5, network.weights[k].shape).astype(np.float64)
    items = rng.integers(0, 12, 16)
    classes, words = items % 6, np.where(items % 6 < 2, items % 3, -1)
    sizes = np.array([16])

    def loss():
        return -network.score(sizes, items, classes, words, 0).astype(np.float64).mean()

    grads = {}
    trainer = Trainer(network)
    trainer._step = grads.update
    trainer.learn(sizes, items, classes, words, 0)
    for k, g in grads.items():
        w = network.weights[k]
        for at in rng.choice(w.size, 4, replace=False):
            old = w.flat[at]
            w.flat[at] = old + 1e-2
            up = loss()
            w.flat[at] = old - 1e-2
            down = loss()
            w.flat[at] = old
            assert (up - down) / 2e-2 == pytest.approx(g.flat[at], abs=3e-3), k


# -- licences

def test_licence_notices_are_found_and_others_left(docs, empty):
    classifier = license_scan.learn(docs)
    found = {r["doc_id"]: r for r in license_scan.scan(docs, classifier).collect()}
    for i, t in pairs():
        wanted = {"all-rights-reserved"} if t and "rights reserved" in t else {"mit"} if t and "MIT License" in t else set()
        assert {x["family"] for x in found[i]["findings"]} == wanted
        assert i is None or found[i]["n_paragraphs"] == sum(bool(license_scan.words_of(x)) for x in (t or "").split("\n"))
    assert license_scan.scan(empty, classifier).count() == 0


def test_every_template_is_told_from_the_others():
    classifier = license_scan.Classifier.learned(license_scan.examples([]))
    import pyarrow as pa

    from shelfmark.llm.bytewise import slice_hashes, text_bytes

    for family, templates in license_scan.TEMPLATES.items():
        for template in templates:
            data, offsets = text_bytes(pa.array([template]))
            plain, starts, ends, _, _, _, at, size, _ = license_scan._units(data, offsets)
            p = classifier.probabilities(slice_hashes(plain, starts, ends), at, size)[0]
            assert license_scan.FAMILIES[p.argmax()] == family, template
            assert license_scan.similarity(license_scan.words_of(template), family) == 1


# -- languages

def profile_brute(texts, size):
    count = collections.Counter()
    for t in texts:
        clean = " " + " ".join("".join(c if c.isalpha() else " " for c in t.lower()).split()) + " "
        for n in (1, 2, 3):
            for i in range(len(clean) - n + 1):
                g = clean[i : i + n]
                if (n == 1 and g != " ") or (n == 2 and g.strip()) or (n == 3 and g[1] != " "):
                    count[g] += 1
    code = lambda g: (len(g), [0 if c == " " else ord(c) for c in g])
    return {g: k for k, (g, _) in enumerate(sorted(count.items(), key=lambda x: (-x[1], code(x[0])))[:size])}


def test_languages_by_rank_order_profiles(spark, docs, empty):
    learned = stage(language_id.profiles(docs.where(language_id.is_training(F.col("doc_id")))), "t")
    found = language_id.predict(docs, learned).collect()
    training = collections.defaultdict(list)
    for r in ROWS:
        if r[1] is not None and r[2] is not None and zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5:
            training[r[2]].append(r[1])
    size = language_id.PROFILE
    known = {lang: profile_brute(texts, size) for lang, texts in training.items()}
    wanted = []
    for r in ROWS:
        ours = profile_brute([r[1] or ""], size)
        if not ours:
            wanted.append((r[0], "und", 0.0))
            continue
        far = {lang: sum(min(abs(k - p[g]), size) if g in p else size for g, k in ours.items()) for lang, p in known.items()}
        best = min(sorted(far), key=far.get)
        wanted.append((r[0], best, round(1 - far[best] / (size * len(ours)), 6)))
    assert counted((r["doc_id"], r["lang_pred"], round(r["score"], 6)) for r in found) == collections.Counter(wanted)
    assert [c for c in found[0].asDict() if c not in docs.columns] == ["lang_pred"]
    assert language_id.predict(empty, learned).count() == 0
    nothing = stage(language_id.profiles(empty), "t")
    assert {r["lang_pred"] for r in language_id.predict(docs, nothing).collect()} == {"und"}
    kept = language_id.keep(docs, learned)
    assert kept.columns == docs.columns
    assert kept.count() == sum(w[1] != "und" and w[2] >= language_id.LEAST_SCORE for w in wanted)


# -- byte-level BPE

def test_bpe_equals_the_library(docs, empty):
    import tiktoken

    path = queries.bpe_path()
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.ranks_of(path).ranks, special_tokens={}
    )
    encoded = byte_bpe.encode(docs, path, with_decoded=True)
    wanted = collections.Counter((i, tuple(library.encode_ordinary(t or "")), (t or "").encode()) for i, t in pairs())
    assert counted((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in encoded.collect()) == wanted
    assert "a.b" in encoded.columns and "text" not in encoded.columns
    again = byte_bpe.decode(byte_bpe.encode(docs, path), path)
    assert counted((r["doc_id"], bytes(r["decoded"])) for r in again.collect()) == counted((i, b) for i, _, b in wanted.elements())
    assert byte_bpe.encode(empty, path).count() == 0


def test_bpe_boundaries_on_random_texts():
    import pyarrow as pa
    import tiktoken

    from shelfmark.llm.bytewise import text_bytes

    ranks = byte_bpe.ranks_of(queries.bpe_path())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.ranks, special_tokens={})
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab'sstmdrevll  \n\t1²é.!? 漢") for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    texts += ["'s't're's" * 300, "a" * 1000, "!'" * 50 + "s", "x" * 250 + "'ll"]
    data, offsets = text_bytes(pa.array(texts))
    ids, begins, counts = ranks.encode(data, offsets)
    ends = np.r_[0, np.cumsum(counts)]
    for t, a, b in zip(texts, ends[:-1], ends[1:], strict=True):
        assert ids[a:b].tolist() == library.encode_ordinary(t)
        assert ranks.decode(ids[a:b], begins[a:b]) == t.encode()


# -- SimHash

def fingerprint_brute(text, n=4):
    words = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_brute(fps):
    """fps: list of (node, fp); the smallest node reachable."""
    parent = {n: n for n, _ in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, f) in enumerate(fps):
        for b, g in fps[:i]:
            if (f ^ g).bit_count() <= simhash.RADIUS:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: find(n) for n, _ in fps}


def test_simhash_components(docs, empty):
    found = simhash.near_duplicates(docs).collect()
    fps = [(i, fingerprint_brute(t)) for i, t in pairs()]
    component = components_brute([(i, f) for i, f in fps if i is not None])
    by_fp = {f: component[i] for i, f in fps if i is not None}
    wanted = collections.Counter((i, f, by_fp.get(f)) for i, f in fps)
    assert counted((r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in found) == wanted
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} - {None} == set(component.values())


@pytest.mark.parametrize("limit", [4, 1024])
def test_simhash_links_of_dense_groups(spark, limit):
    """A chain and a dense ball of fingerprints, with shards cut into parts and without."""
    rng = random.Random(9)
    fps = {rng.getrandbits(64) for _ in range(60)}
    ball = rng.getrandbits(64)
    fps |= {ball ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(a)}
    at = rng.getrandbits(64)
    for k in range(20):
        fps.add(at)
        at ^= 0b111 << 3 * k
    nodes = list(enumerate(sorted(fps, key=lambda f: hash((f, 1)))))
    signed = [(i, f - (1 << 64) if f >> 63 else f) for i, f in nodes]
    edges = simhash.links(spark.createDataFrame(signed, "id long, fp long"), shard_limit=limit)
    found = {r["node"]: r["component"] for r in simhash.components(edges).collect()}
    assert {i: found.get(i, i) for i, _ in nodes} == components_brute(nodes)


# -- token shards

def test_token_shards_read_back(spark, docs, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    written = stage(token_shards.shards(docs, path, 1, n_parts=3, shard_ids=2000), "t")
    bases = token_shards.directory(written).select("part", "seq", "base")
    found = token_shards.read(written).join(bases, ["part", "seq"]).collect()
    ids = {(i, t): [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t in pairs()}
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    wanted = collections.Counter((i, len(ids[i, t]), crc(ids[i, t])) for i, t in pairs())
    assert counted((r["key"], r["n_ids"], r["digest"]) for r in found) == wanted
    at = 0
    order = []
    for r in sorted(found, key=lambda r: r["base"] + r["at"]):
        assert r["base"] + r["at"] == at
        at += r["n_ids"]
        order.append(-1 if r["key"] is None else r["key"])
    assert order == sorted(order)
    keys = spark.createDataFrame([(0,), (60,), (7,), (10**9,), (-5,), (None,)], "key long")
    looked = collections.Counter((r["key"], tuple(r["ids"])) for r in token_shards.lookup(written, keys).collect())
    assert looked == collections.Counter((i, tuple(ids[i, t])) for i, t in pairs() if i in (0, 60))
    none = stage(token_shards.shards(empty, path, 1), "t")
    assert token_shards.read(none).count() == 0 and token_shards.lookup(none, keys).count() == 0


@pytest.mark.parametrize("n", [1, 2, 5, 64, 3000])
def test_index_is_minimal_and_perfect(n):
    keys = np.unique(np.random.default_rng(n).integers(-(2**63), 2**63 - 1, n))
    seeds, place = token_shards.build_index(keys)
    assert sorted(place.tolist()) == list(range(len(keys)))
    slots = np.zeros((len(keys), 3), np.uint32)
    slots[place, 0] = (token_shards._hash(keys) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    slots[place, 1], slots[place, 2] = np.arange(len(keys)), 1
    first, count = token_shards.find(keys, seeds, slots)
    assert first.tolist() == list(range(len(keys))) and (count == 1).all()
    assert token_shards.find(keys + 1, seeds, slots)[1].sum() == np.isin(keys + 1, keys).sum()


# -- exact dedup

def test_exact_dedup(docs, empty):
    found = exact_dedup.report(docs).collect()
    plain = re.compile(r"[\x20\x09-\x0D]")
    groups = collections.defaultdict(list)
    for i, t in pairs():
        groups[plain.sub("", t or "")].append((-len(t or ""), 2**63 if i is None else i))
    wanted = collections.Counter()
    for content, members in groups.items():
        best = min(members)
        keep = None if best[1] == 2**63 else best[1]
        once = True
        for m in sorted(members):
            kept = m == best and once
            once = once and not kept
            wanted[(None if m[1] == 2**63 else m[1], keep, len(members), kept, sha(content))] += 1
    assert counted(found) == wanted
    assert exact_dedup.report(empty).count() == 0
    kept = exact_dedup.keep(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


# -- top-k

@pytest.mark.parametrize("shard", [7, 4096])
def test_top_k_is_exact(spark, shard):
    rng = np.random.default_rng(6)
    made = [(i, [float(x) for x in np.round(rng.normal(size=8), 1)]) for i in range(60)]
    made += [(100 + i, made[10][1]) for i in range(30)]  # ties
    made += [(200, None), (201, [1.0, None] + [0.0] * 6), (202, [float("nan")] * 8), (203, [float("inf")] * 8), (204, []),
             (None, made[0][1]), (205, [1.0, 2.0]), (20, made[20][1]), (206, [3e15] * 8), (207, [1.0] * 8)]
    vectors = spark.createDataFrame([(*r, 1, 2) for r in made], "vec_id long, embedding array<double>, score int, asked int")
    found = topk_search.top_k(vectors, F.col("vec_id") % 20 == 0, shard=shard, block=3).collect()
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in made
             if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    wanted = []
    for q, v in {i: v for i, v in whole if i % 20 == 0}.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in whole if i != q and len(w) == len(v))
        wanted += [(q, rank, i, max(-(2**63), min(2**63 - 1, -s))) for rank, (s, i) in enumerate(scores[:10], 1)]
    assert counted(found) == collections.Counter(wanted)
    assert topk_search.top_k(vectors.where("vec_id < 0"), F.col("vec_id") % 20 == 0).count() == 0


# -- substring dedup

def test_repeated_passages_go(docs, empty):
    found = substring_dedup.dedup(docs).collect()
    words = [(2**63 if i is None else i, WORD.findall(t or "")) for i, t in pairs()]
    least = {}
    for i, w in words:
        for k in range(len(w) - 12):
            window = tuple(w[k : k + 13])
            least[window] = min(least.get(window, i), i)
    wanted = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if least[tuple(w[k : k + 13])] < i:
                gone[k : k + 13] = [True] * 13
        spans = [m.span() for m in re.finditer("1+", "".join("01"[g] for g in gone))]
        wanted.append((None if i == 2**63 else i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g), tuple(spans)))
    assert sum(x[2] for x in wanted) > 500
    assert counted((*r[:4], tuple(tuple(s) for s in r["removed"])) for r in found) == collections.Counter(wanted)
    assert substring_dedup.dedup(empty).count() == 0


# -- mixing

def mix_brute(docs, weights, levels, share, epochs, seed):
    supply = collections.Counter()
    for d in docs:
        supply[tuple(d[c] for c in levels)] += d["n_tokens"]
    weight = lambda level, v: weights.get(level, {}).get(v, weights.get(level, {}).get("*", 1))

    def cap(prefix):
        usable = [k for k in supply if k[: len(prefix)] == prefix]
        return sum(supply[k] * epochs for k in usable if all(weight(c, v) > 0 for c, v in list(zip(levels, k, strict=True))[len(prefix):]))

    given = {(): sum(supply.values()) * share[0] // share[1]}
    for depth, level in enumerate(levels):
        after = {}
        for parent, budget in given.items():
            children = sorted({k[: depth + 1] for k in supply if k[:depth] == parent}, key=lambda k: (k[-1] is not None, k[-1] or ""))
            caps = {c: cap(c) if weight(level, c[-1]) > 0 else 0 for c in children}
            order = sorted(children, key=lambda c: caps[c] / weight(level, c[-1]) if weight(level, c[-1]) else -1)
            left, full = budget, 0
            for k, c in enumerate(order):
                total = sum(weight(level, x[-1]) for x in order[k:])
                if caps[c] * total > left * weight(level, c[-1]):
                    break
                after[c] = caps[c]
                left -= caps[c]
                full = k + 1
            open_ = order[full:]
            total = sum(weight(level, x[-1]) for x in open_)
            for c in open_:
                after[c] = weight(level, c[-1]) * left // total
            for c in open_[: left - sum(after[c] for c in open_)] if open_ else []:
                after[c] += 1
        given = after
    out = []
    for leaf, budget in given.items():
        mine = [d for d in docs if tuple(d[c] for c in levels) == leaf]
        whole, rest = divmod(budget, supply[leaf]) if supply[leaf] else (0, 0)
        key = lambda d: sha(f"{seed}:{whole}:{'null' if d['doc_id'] is None else d['doc_id']}")  # noqa: E731, B023
        tokens = collections.Counter()
        for d in mine:
            tokens[key(d)] += d["n_tokens"]
        at, read = 0, set()
        for k in sorted(tokens):
            if at < rest:
                read.add(k)
            at += tokens[k]
        out += [(d["doc_id"], *leaf, d["n_tokens"], whole + (key(d) in read), budget) for d in mine]
    return out


@pytest.mark.parametrize("share,epochs", [((3, 4), 3), ((5, 1), 2), ((1, 9), 1), ((0, 1), 1)])
def test_mixing_budgets_and_prefixes(docs, empty, share, epochs):
    weights = {"domain": {"a": 3, "b": 1}, "lang": {"aa": 2, "xx": 5, "*": 1}, "source": {"src0": 0, "src1": 4, "*": 1}}
    levels = ("domain", "lang", "source")
    domain = F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b")
    given = docs.withColumns({"domain": domain, "n_tokens": mixing.word_count(F.col("text"))})
    found = mixing.mix(given, weights, levels, budget_share=share, max_epochs=epochs, seed=3)
    plain = [{"doc_id": r[0], "domain": "a" if r[0] is not None and r[0] % 2 == 0 else "b", "lang": r[2], "source": r[3],
              "n_tokens": len(WORD.findall(r[1] or ""))} for r in ROWS]
    columns = ["doc_id", *levels, "n_tokens", "copies", "leaf_budget"]
    assert counted(found.select(columns).collect()) == collections.Counter(mix_brute(plain, weights, levels, share, epochs, 3))
    nothing = empty.withColumns({"domain": F.lit("a"), "n_tokens": F.lit(1).cast("long")})
    assert mixing.mix(nothing, weights, levels).count() == 0


def test_native_operators_run_no_python(spark, docs, tmp_path):
    for df in (exact_dedup.report(docs), mixing.mix(docs.withColumns({"domain": F.lit("a"), "n_tokens": F.lit(3).cast("long")}), {})):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


# -- licence notices over several lines, and several in a line

WRAPPED = {
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:""",
    "bsd": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:""",
    "gpl-3.0": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
}


@pytest.fixture(scope="module")
def licence_families(spark, docs):
    classifier = license_scan.learn(docs)

    def run(texts):
        rows = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), classifier).collect()
        return [r["findings"] for r in sorted(rows, key=lambda r: r["doc_id"])]

    return run


def test_wrapped_notices_are_found(licence_families):
    some = "\n".join(t for _, t, *_ in ROWS[11:20])
    texts = [w for t in WRAPPED.values() for w in (t, f"{some}\n{t}\n{some}", "\n".join(f" * {x}" for x in t.split("\n")))]
    for k, findings in enumerate(licence_families(texts)):
        family = list(WRAPPED)[k // 3]
        assert {x["family"] for x in findings} == {family}, texts[k]
        assert len({x["paragraph"] for x in findings}) == 1
    mit = licence_families([f"{some}\n\n{WRAPPED['mit']}"])[0][0]
    assert (mit["paragraph"], mit["word"]) == (len(some.split("\n")), 0)
    halves = WRAPPED["bsd"].split("\n")
    assert licence_families([f"{halves[0]}\n\n{halves[1]}"]) == [[]]  # no unit crosses a blank line


def test_several_notices_in_one_unit_are_found(licence_families):
    m, a, b = "Licensed under the MIT license.", "Licensed under the Apache License, Version 2.0.", "All rights reserved."
    single = "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License"
    texts = [f"{m} {a}", f"{a} {m}", f"{m}\n{a}", f"{a} Some words here. {b} {m}", single, f"{single} {m}"]
    wanted = [{"mit", "apache-2.0"}] * 3 + [{"mit", "apache-2.0", "all-rights-reserved"}, {"gpl-2.0"}, {"gpl-2.0", "mit"}]
    assert [{x["family"] for x in f} for f in licence_families(texts)] == wanted
