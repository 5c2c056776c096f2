"""A corpus from raw documents: known languages, one of each group of copies, no benchmark items, no secrets, then ids.

Each stage takes all rows its predecessor kept. The first four return the columns of ``documents``; the last returns
doc_id, n_tokens, ids_sha256 and decoded_sha256 of what is left. Nulls, empties, repeats, ties and very long texts: as the
operators say (a null or empty text is rejected by the first stage; of equal texts the one with the smallest id stays). An
empty table gives empty results; extra columns stay up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rosterline import staging
from rosterline.llm import decontam, language_id, piece_codec, secret_scan, simhash_dedup
from rosterline.llm.base import table
from rosterline.llm.queries import PIECES, SHINGLE_WORDS, TRAIN_ROWS


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a language, however narrow its lead (only texts without letters go); learned from the labelled rows of ``docs`` themselves."""
    model = language_id.train(docs.filter(language_id.fold("doc_id", 5) != 0), PIECES, train_rows=TRAIN_ROWS)
    return language_id.with_language(docs, model)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that op5's fingerprints link (three-word shingles, two differing bits)."""
    return simhash_dedup.keep_first(docs, width=SHINGLE_WORDS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item and are none, whole or clipped."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, secrets cut out of the texts."""
    return secret_scan.redact(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of each row."""
    return piece_codec.digests(docs, PIECES)


STAGES = [
    ("language ID", known_languages),
    ("SimHash near-dedup", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("SentencePiece encoding and decoding", token_ids),
]
#: SQL cannot express the language model, the fingerprints or the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage stages for itself goes as soon as its result is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with staging.run(spark):
            docs = staging.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
