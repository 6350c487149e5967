"""From raw documents to training tokens: a list of stages, each one call of an operator of ``shelfmark.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import byte_bpe, exact_dedup, language_id, mixing, near_copies as near, queries
from shelfmark.llm.stages import quoted, stage


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled documents teach; texts without letters and the like go."""
    learned = stage(queries.language_profiles(docs), "profiles")
    return language_id.keep(docs, learned)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for white space, the longest stays."""
    return exact_dedup.keep(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 0.8 or more of their five-word shingles in common, the one with the smallest id stays."""
    return near.keep(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture reads them."""
    leaves = docs.select(
        F.struct(*[quoted(c) for c in docs.columns]).alias("_row"), "doc_id", "lang", "source",
        queries.mix_domain(F.col("source")).alias("_domain"), mixing.word_count(F.col("text")).alias("_tokens"),
    )
    weights = {"_domain": queries.MIX_WEIGHTS["domain"], **queries.MIX_WEIGHTS}
    mixed = mixing.mix(
        leaves, weights, ("_domain", "lang", "source"), "_tokens",
        budget_share=queries.MIX_SHARE, max_epochs=queries.MIX_EPOCHS,
    )
    again = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    return mixed.withColumn("_copy", again).select("_row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the offset of each token in the text, and whether they decode to the text's bytes."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", "lang", "source", "text", F.sha2(text, 256).alias("_sha256"))
    encoded = byte_bpe.encode(rows, queries.bpe_path(), with_decoded=True)
    encoded = encoded.withColumn("n_tokens", F.size("ids").cast("long")).withColumn("decoded_sha256", F.sha2("decoded", 256))
    return encoded.withColumn("round_trip", F.col("decoded_sha256") == F.col("_sha256")).drop("decoded", "_sha256")


STAGES = [
    ("language ID", known_language),
    ("exact dedup", exact_copies),
    ("SimHash near-dedup", near_copies),
    ("mixing", mixture),
    ("byte-level BPE", tokens),
]

# Near-duplicate components and token ids are beyond SQL; the tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stage(docs, name.replace(" ", "-"))
    return docs
