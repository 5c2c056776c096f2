"""The operators as queries over the whole given tables, and the SQL that checks those it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterline.llm import ann, decontam, divergence, language_id, license_scan, personal_data, piece_codec, quality, resample, secret_scan, simhash_dedup, token_files, toxicity
from rosterline.llm.base import table
from rosterline.llm.oracles import ORACLES

#: Files of the public tokenizers' package; a path is a parameter of every operator that needs one.
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
TRAIN_ROWS = 20_000  # labelled rows a classifier is fitted on at most
SHINGLE_WORDS = 3  # of a fingerprint


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digests(license_scan.scan(table(spark, sf_dir, "documents")))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.digests(table(spark, sf_dir, "documents"), PIECES)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.digests(table(spark, sf_dir, "documents"), WORDS, end_id=2)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.held_out_predictions(table(spark, sf_dir, "documents"), PIECES, TRAIN_ROWS)


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.groups(table(spark, sf_dir, "documents"), width=SHINGLE_WORDS)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.held_out_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), TRAIN_ROWS)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(secret_scan.scan(table(spark, sf_dir, "documents")))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.digests(personal_data.scan(table(spark, sf_dir, "documents")))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.held_out_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_sentencepiece, op3_token_files, op4_language_id, op5_simhash_dedup, op6_nearest_vectors, op7_quality,
        op8_decontaminate, op9_secrets, op10_personal_data, op11_source_divergence, op12_importance_resample, op13_toxicity,
    )
}
__all__ = ["ORACLES", "QUERIES"]
