"""A training corpus from raw documents: toxicity, exact and near duplicates, mixing, encoding.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the columns of documents, but for
the last, which returns encodings. Stages follow on each other by Parquet tables in the shared folder.

Defined cases, of all stages: a null text is an empty text, and stays what it is in the rows that a stage keeps; rows with a null id are documents
like others; very long texts are read whole; repeated rows are documents of their own until a stage drops them as copies; an empty table gives
an empty result; other columns pass through to the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from peakloom.llm import bpe, exact_dedup, mixing, ngram_join, toxicity
from peakloom.llm.common import discard, made, materialise


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs but for those predicted toxic. Empty texts stay; without labels of both classes all rows stay."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space the row with the least id (null ids last); of rows that repeat id and text any one."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked at a similarity of 0.8 the one with the least id. Texts without words and rows with a null id all stay."""
    return ngram_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in order of its slots: documents, or their pieces where a block ends, as often as the slots take them. Documents without words and those beyond their source's target are in no slot."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row; an empty text has no tokens."""
    return bpe.digests(docs)


STAGES = [("toxicity", reject_toxic), ("exact_dedup", drop_copies), ("ngram_jaccard_join", drop_near_copies), ("source_mix", mix_sources), ("bpe_encode", encode)]

#: The first stage learns its model from labels, which SQL can't state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. A stage's intermediate tables are deleted once its result is written, and its input too, but for the given documents."""
    docs, own = spark.read.parquet(f"{sf_dir}/documents.parquet"), set(made())
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
        *others, _ = made()
        discard(spark, [p for p in others if p not in own])
    return STAGES[-1][1](spark, docs, sf_dir)
