"""A training-data pipeline over ``documents``: each stage's result is written and is the next stage's input.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. All but the last
return the columns of ``docs``. Null texts are empty texts, null ids are ids like others; repeated rows are told apart from copies
by nothing, so near_dedup leaves one of them; empty tables give empty tables; other columns are carried along unseen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomlake.llm import bpe, langid, mixing, simhash
from loomlake.llm.common import doc_crc, read, staged


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language identification rejects go: null, empty or without a letter, or too far from every centroid for their length. Learns from two thirds of the labelled rows; without any, all go."""
    model = langid.fit(docs.where(F.pmod(doc_crc(F.col("doc_id")), F.lit(3)) != 1), key=F.xxhash64("doc_id"))
    return langid.accepted(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies stays, that of the least id (null ids last): five-word shingles, similarity 0.8. Texts without words are one group."""
    return simhash.one_of_each(docs)


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn by expected copies raked to tempered source, language and topic weights: some not at all, some more than once. Repeated rows are drawn alike."""
    return mixing.mix(docs).select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, decoded again to see that nothing is lost. The text goes; columns named n_tokens, ids or same are replaced."""
    import public_tokenizers

    kept = [c for c in docs.columns if c not in ("text", "n_tokens", "ids", "same")]
    return bpe.checked_ids(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, kept)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("mixing", mixing_to_targets), ("byte_bpe", byte_bpe)]

#: Fingerprints, raking and merges are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
