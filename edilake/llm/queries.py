"""One query per operator over the given tables, with SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edilake.llm import bpe, contamination, language, licenses, merkle, minhash, ngrams, quality, secrets, simhash, spelling, substrings, urls
from edilake.llm.io import table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(table(spark, sf_dir, "documents"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.scores(table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("blocks")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


def op11_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.linked(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 5 == 0)


QUERIES = {
    "op1_near_dedup": (op1_near_dedup, minhash.components_sql(3, 85)),
    "op2_secret_scan": (op2_secret_scan, None),
    "op3_decontaminate": (op3_decontaminate, None),
    "op4_quality_rules": (op4_quality_rules, None),
    "op5_suffix_dedup": (op5_suffix_dedup, None),
    "op6_lm_score": (op6_lm_score, None),
    "op7_license_scan": (op7_license_scan, None),
    "op8_url_filter": (op8_url_filter, urls.JUDGE_SQL),
    "op10_language_id": (op10_language_id, None),
    "op9_bpe": (op9_bpe, None),
    "op11_simhash_dedup": (op11_simhash_dedup, None),
    "op12_spelling_variants": (op12_spelling_variants, spelling.spelling_sql()),
    "op13_merkle_manifest": (op13_merkle_manifest, merkle.verified_sql()),
}
