"""From raw documents to token ids: a chain of stages, each stored before the next reads it.

Stages take any table with doc_id, text, lang and source, whatever other columns it
has, and an empty one. A null text counts as empty and fails the quality rules; null
ids are ordinary ids, of which the smallest known one stays; repeated rows are copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kelpfit.llm import bpe, exact_dedup, mixing, ngram_join, quality
from kelpfit.llm.common import hex_sha256, stored
from kelpfit.llm.queries import tokenizer_file
from kelpfit.session import ship_package


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.keep_good(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts."""
    return exact_dedup.drop_exact(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group linked by a similarity of 0.8 or more of five-word shingles."""
    return ngram_join.one_of_each(docs, words=5, percent=80)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: never, once or twice."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with a digest and the digest of the text they decode to."""
    rows = bpe.encoded(docs, tokenizer_file(), decode=True)
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
        hex_sha256(bpe.id_text("ids")).alias("ids_sha256"), hex_sha256(F.col("decoded")).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_copies),
    ("ngram_join", near_copies),
    ("mixing", source_mix),
    ("bpe", token_ids),
]

#: SQL cannot express the encoding; tests/llm compares all stages with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
