"""A training-data pipeline over ``documents``: language ID, near-dedup, decontamination, secret removal, tokens.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and is written as Parquet and reread
before the next. All but the last return the columns of their input. Null, empty and letterless texts go in the first
stage; rows without a doc_id are never near copies; repeated rows are one document from the second stage on; empty
tables stay empty. Extra columns travel along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edilake.llm import bpe, contamination, language, minhash, secrets
from edilake.llm.io import keep, table
from edilake.llm.queries import tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language one of the learned ones is, with a score of a half or more."""
    return language.accepted(docs, language.fit(docs, ~language.held_out()))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return minhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark."""
    return secrets.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids (packed), and whether the ids decode to the text."""
    coded = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), tokenizer_path())
    return coded.select("doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), "ids",
                        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("secret_scan", secret_scan), ("bpe", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs


ORACLE_SQL = None
