"""Corpus pipeline: quality, toxicity, near duplicates, benchmark leaks, tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir),
works on all documents that the stage before it kept, and returns a DataFrame
that is written as Parquet and read again as the next one's ``docs``. All but
the last return the columns of ``documents``.

Every stage judges each row by its own text, whole however long; a NULL text
counts as an empty one, an empty table gives an empty result, and other columns,
whatever their names, go along unread. Ids choose only between near copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardlake.llm import decontaminate, pieces, quality, simhash, toxicity
from cardlake.llm.common import stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labelled documents of the source table.

    A score of exactly one half is accepted; rows alike are all kept or all go.
    """
    return quality.filtered(docs, quality.trained(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject; it learns from the labelled documents of the source table.

    A score of exactly one half is rejected; rows alike are all kept or all go.
    """
    return toxicity.filtered(docs, toxicity.trained(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of SimHash near duplicates (3-word shingles, 3 bits): that with the least id (NULL last).

    Of rows with that id the first as stored stays. Rows that share an id, or have none, are grouped by their texts.
    Texts without a word are one group.
    """
    return simhash.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with a benchmark item.

    A text without words has no window and stays, as do all if the benchmark is empty.
    """
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token count, digests and ids (binary, little-endian unsigned 32-bit) of what is left, a row for each row."""
    return pieces.encoded(docs, keep=("ids",))


STAGES = [
    ("quality classifier", quality_stage),
    ("toxicity", toxicity_stage),
    ("SimHash near-dedup", near_duplicates_stage),
    ("benchmark decontamination", decontamination_stage),
    ("SentencePiece encoding and decoding", tokens_stage),
]

#: SQL can't express fitted classifiers, fingerprints or tokenizers; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"stage{k}")
    return docs
