"""A corpus pipeline of five stages over `documents`.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents; n_chars follows the text. The first stage rejects null texts
and those without a letter, as they have no language; the others keep a null text, which is packed as an empty one. Rows
that repeat an id share the decision on it. An empty table gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.llm import jaccard, language, packing, secrets, suffixes
from tarn.llm.common import documents, written


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; dictionaries are fitted on the labelled ones that are not held out."""
    return language.accepted(docs, language.fit(docs.where(~language.held_out("doc_id"))))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id."""
    gone = jaccard.groups(docs).where("component_id <> doc_id").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone.hint("merge"), F.col("doc_id") == F.col("gone_id"), "left_anti")


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 100-byte strings that an earlier one has; a document that loses its whole text stays, empty."""
    return _sized(suffixes.remove(docs))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with a mark in place of each secret."""
    return _sized(secrets.redact(docs, null_ids=True))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    return packing.pack(packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json")), docs.count())


STAGES = [
    ("language_id", known_language),
    ("jaccard_join", one_of_each_group),
    ("suffix_dedup", without_repeats),
    ("secret_scan", without_secrets),
    ("best_fit_packing", packed),
]
#: SQL can express neither compression nor the packing rule; a brute-force version tests them instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the whole table."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
