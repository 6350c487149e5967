"""The registered queries of this subpackage, and the same results in SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    byte_bpe, collocations, exact_dedup, language_id, license_scan, lm_scoring, mixing, periodic_runs, sentence_pieces, simhash,
    substring_dedup, token_shards, topk_search,
)
from .stages import stage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(_table(spark, sf_dir, "documents").select("doc_id", "text"), from_files=True)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = license_scan.scan(docs, license_scan.learn(docs))
    return found.select(
        "doc_id", "n_paragraphs",
        F.size(F.array_distinct(F.transform("findings", lambda x: x["paragraph"]))).cast("long").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("findings", lambda x: x["family"]))), ",").alias("families"),
        "findings",
    )


def language_profiles(docs: DataFrame) -> DataFrame:
    """Learned from the documents outside the held-out fifth."""
    return language_id.profiles(docs.where(language_id.is_training(F.col("doc_id"))))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learned = stage(language_profiles(docs), "profiles")
    held = docs.select("doc_id", "text", (~language_id.is_training(F.col("doc_id"))).alias("held_out"))
    return language_id.predict(held, learned).select("doc_id", "held_out", "lang_pred", "score")


def bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = byte_bpe.encode(docs, bpe_path(), with_decoded=True)
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


END_ID = 1


def op6_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    made = token_shards.shards(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID)
    written = stage(made, "token-shards")
    bases = token_shards.directory(written).select("part", "seq", "base")
    found = token_shards.read(written).join(bases, ["part", "seq"])
    return found.select(
        F.col("key").alias("doc_id"), (F.col("base") + F.col("at")).alias("start"),
        F.col("n_ids").alias("n_tokens"), F.col("digest").alias("ids_crc32"),
    )


def op8_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk_search.top_k(vectors, F.col("vec_id") % 100 == 0)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.report(_table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = substring_dedup.dedup(docs, from_files=True)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


# The mixture of op10 and of the pipeline: sources fall into three domains by their number.
MIX_WEIGHTS = {
    "domain": {"web": 5, "books": 3, "code": 2},
    "lang": {"en": 4, "de": 2, "fr": 2, "es": 2, "*": 1},
    "source": {"src0": 1, "*": 2},
}
MIX_SHARE = (3, 4)
MIX_EPOCHS = 3


def mix_domain(source):
    number = F.coalesce(F.regexp_extract(source, r"(\d+)$", 1).try_cast("bigint"), F.lit(0)) % 3
    return F.when(number == 0, "web").when(number == 1, "books").otherwise("code")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", mix_domain(F.col("source")).alias("domain"), "lang", "source",
        mixing.word_count(F.col("text")).alias("n_tokens"),
    )
    mixed = mixing.mix(docs, MIX_WEIGHTS, budget_share=MIX_SHARE, max_epochs=MIX_EPOCHS)
    return mixed.select("doc_id", "domain", "lang", "source", "n_tokens", "copies", "leaf_budget")


def op11_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = sentence_pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), with_decoded=True)
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(_table(spark, sf_dir, "documents").select("text", "lang"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """A tenth of the documents, by a checksum of the id, with the words from some place on repeating."""
    checksum = F.coalesce(F.crc32(F.col("doc_id").cast("string")), F.lit(1))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    number = F.floor(checksum / 10).cast("long")
    n = F.size(words).cast("long")
    before = F.when(n > 0, number % F.greatest(n, F.lit(1)))
    period = F.floor((n - before) / (3 + number % 8)).cast("long") + 1
    copies = F.floor((n - before) / period).cast("int") + 1
    tail = F.flatten(F.array_repeat(F.slice(words, (before + 1).cast("int"), period.cast("int")), copies))
    made = F.concat(F.slice(words, 1, before.cast("int")), F.slice(tail, 1, (n - before).cast("int")))
    changed = F.when((checksum % 10 == 0) & (n > 0), F.array_join(made, " ")).otherwise(F.col("text"))
    return docs.withColumn("text", changed)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs.find(docs).withColumn("best", periodic_runs.longest(F.col("runs")))
    line = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_license_scan": op2_license_scan,
    "op3_language_id": op3_language_id,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_simhash": op5_simhash,
    "op6_token_shards": op6_token_shards,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_topk_search": op8_topk_search,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_mixing": op10_mixing,
    "op11_sentence_pieces": op11_sentence_pieces,
    "op12_collocations": op12_collocations,
    "op13_periodic_runs": op13_periodic_runs,
}

_DEAL = """
{name}_o AS (
  SELECT *, sum(cap) OVER (PARTITION BY {parents} ORDER BY ratio NULLS FIRST, {node} ROWS UNBOUNDED PRECEDING) - cap AS before_,
    sum(weight) OVER (PARTITION BY {parents} ORDER BY ratio NULLS FIRST, {node} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS from_,
    row_number() OVER (PARTITION BY {parents} ORDER BY ratio NULLS FIRST, {node}) AS place
  FROM (SELECT *, CASE WHEN weight > 0 THEN cap::DOUBLE / weight::DOUBLE END AS ratio FROM {name}_n)),
{name}_f AS (SELECT *, cap * from_ <= (budget - before_) * weight AS full_ FROM {name}_o),
{name}_l AS (
  SELECT *, budget - min(CASE WHEN NOT full_ THEN before_ END) OVER (PARTITION BY {parents}) AS left_,
    max(CASE WHEN NOT full_ THEN from_ END) OVER (PARTITION BY {parents}) AS open_weight,
    min(CASE WHEN NOT full_ THEN place END) OVER (PARTITION BY {parents}) AS first_open
  FROM {name}_f),
{name}_p AS (SELECT *, CASE WHEN full_ THEN cap ELSE weight * left_ // open_weight END AS part FROM {name}_l),
{name} AS (
  SELECT *, part + CASE WHEN NOT full_ AND place - first_open <
    left_ - sum(CASE WHEN NOT full_ THEN part END) OVER (PARTITION BY {parents}) THEN 1 ELSE 0 END AS share
  FROM {name}_p)"""

_WEIGHTS = {
    "domain": "CASE domain WHEN 'web' THEN 5 WHEN 'books' THEN 3 ELSE 2 END",
    "lang": "CASE lang WHEN 'en' THEN 4 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 WHEN 'es' THEN 2 ELSE 1 END",
    "source": "CASE source WHEN 'src0' THEN 1 ELSE 2 END",
}

SQL: dict[str, str] = {
    "op7_exact_dedup": r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content FROM documents),
ranked AS (
  SELECT doc_id, content, first_value(doc_id) OVER (PARTITION BY content ORDER BY n DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY content) AS group_size FROM rows)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256 FROM ranked""",
    "op8_topk_search": r"""
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * x::DOUBLE) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
parts AS (SELECT vec_id, unnest(v) AS x, unnest(range(len(v))) AS i, len(v) AS dim FROM whole),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM parts q JOIN parts c ON q.i = c.i AND q.dim = c.dim AND q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0 GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10""",
    "op9_substring_dedup": r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM docs),
runs AS (
  SELECT doc_id, i, string_agg(word, ' ') OVER w AS run, count(*) OVER w AS n FROM words
  WINDOW w AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)),
starts AS (SELECT doc_id, i, run, min(doc_id) OVER (PARTITION BY run) AS first_doc FROM runs WHERE n = 13),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM starts, (SELECT unnest(range(13)) AS k) WHERE first_doc < doc_id),
kept AS (
  SELECT w.doc_id, count(*) AS n_words, count(g.i) AS n_removed,
    string_agg(CASE WHEN g.i IS NULL THEN w.word END, ' ' ORDER BY w.i) AS text
  FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i GROUP BY w.doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id""",
    "op10_mixing": r"""
WITH docs AS (
  SELECT doc_id, lang, source,
    CASE coalesce(try_cast(regexp_extract(source, '(\d+)$', 1) AS BIGINT), 0) % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'books' ELSE 'code' END AS domain,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS supply FROM docs GROUP BY ALL),
total AS (SELECT sum(supply) * 3 // 4 AS budget FROM leaves),
d_n AS (SELECT domain, sum(supply * 3) AS cap, (SELECT budget FROM total) AS budget, """
    + _WEIGHTS["domain"] + " AS weight FROM leaves GROUP BY domain),"
    + _DEAL.format(name="d", parents="1", node="domain")
    + """,
l_n AS (SELECT x.domain, x.lang, x.cap, d.share AS budget, """ + _WEIGHTS["lang"] + """ AS weight
  FROM (SELECT domain, lang, sum(supply * 3) AS cap FROM leaves GROUP BY domain, lang) x JOIN d ON x.domain = d.domain),"""
    + _DEAL.format(name="l", parents="domain", node="lang")
    + """,
s_n AS (SELECT x.domain, x.lang, x.source, x.supply, x.supply * 3 AS cap, l.share AS budget, """ + _WEIGHTS["source"] + """ AS weight
  FROM leaves x JOIN l ON x.domain = l.domain AND x.lang = l.lang),"""
    + _DEAL.format(name="s", parents="domain, lang", node="source")
    + """,
given AS (SELECT domain, lang, source, share::BIGINT AS leaf_budget, (share // supply)::BIGINT AS q, (share % supply)::BIGINT AS r FROM s),
keyed AS (SELECT docs.*, leaf_budget, q, r,
    sha256('17:' || q::VARCHAR || ':' || docs.doc_id::VARCHAR) AS key
  FROM docs JOIN given ON docs.domain = given.domain AND docs.lang = given.lang AND docs.source = given.source),
placed AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key ROWS UNBOUNDED PRECEDING) - n_tokens AS first_token FROM keyed)
SELECT doc_id, domain, lang, source, n_tokens::BIGINT AS n_tokens, q + CASE WHEN first_token < r THEN 1 ELSE 0 END AS copies, leaf_budget FROM placed""",
    "op12_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (
  SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3 FROM placed),
ones AS (SELECT lang, w1, count(*) AS f FROM grams GROUP BY ALL),
twos AS (SELECT lang, w1, w2, count(*) AS f FROM grams WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
threes AS (SELECT lang, w1, w2, w3, count(*) AS f FROM grams WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM ones GROUP BY lang),
gone AS (
  SELECT DISTINCT s.lang, s.w1 || ' ' || s.w2 AS g FROM twos s JOIN (
    SELECT lang, w1, w2, f FROM threes UNION ALL SELECT lang, w2, w3, f FROM threes) x
  ON s.lang = x.lang AND s.w1 = x.w1 AND s.w2 = x.w2 WHERE 100 * x.f >= 50 * s.f),
parts AS (
  SELECT c.lang, c.w1 || ' ' || c.w2 AS g, c.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM twos c JOIN ones x ON x.lang = c.lang AND x.w1 = c.w1 JOIN ones y ON y.lang = c.lang AND y.w1 = c.w2
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, 1, x.f, y.f
  FROM threes c JOIN ones x ON x.lang = c.lang AND x.w1 = c.w1 JOIN twos y ON y.lang = c.lang AND y.w1 = c.w2 AND y.w2 = c.w3
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, 2, x.f, y.f
  FROM threes c JOIN twos x ON x.lang = c.lang AND x.w1 = c.w1 AND x.w2 = c.w2 JOIN ones y ON y.lang = c.lang AND y.w1 = c.w3),
cuts AS (SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM parts),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS place FROM cuts),
ranked AS (
  SELECT lang, g AS phrase, a, l, r, score, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank
  FROM best WHERE place = 1 AND NOT EXISTS (SELECT 1 FROM gone WHERE gone.lang = best.lang AND gone.g = best.g))
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total ON ranked.lang = total.lang WHERE rank <= 2000""",
}
