"""From raw documents to packed training sequences, in five stages.

quality: documents that read like trusted text of their language (operator 4).
exact: one row of each text (operator 10). near: one document of each group of
near duplicates (operator 3). mix: each document as often as its source's target
wants it (operator 8). pack: token pieces in sequences (operator 1).

A stage takes (spark, docs, sf_dir) and works on all that the one before kept;
all but the last return the columns of documents. Tables without rows pass
through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from jobloom.llm import exact, mixing, neardup, packing, quality
from jobloom.llm.common import written


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier keeps, with all their columns.

    Texts without words, null ones too, stay; a null language is one of its own; a
    null doc_id is judged by its text. Labels that are null, repeated or of unknown
    documents do no harm: see quality.judged. Without labels all documents stay."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def stage_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id, with all its columns.

    Null and empty texts are equal to one another. Null doc_ids come after all
    others; of rows that repeat a doc_id and its text, one stays. No rows give none."""
    return exact.drop_exact(docs)


def stage_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates the smallest doc_id, with all its columns.

    Texts without words and rows without doc_id stay; rows that repeat a doc_id go or
    stay together. No rows give none."""
    return neardup.drop_near(docs)


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them, shard by shard, in random order there,
    with the columns of docs.

    A null source is a source of its own. Texts without words come with whole passes
    over their source only. Rows that agree in doc_id, source and number of words are
    taken together. No rows give none."""
    return mixing.mixed_shards(docs)


def stage_pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, piece, start, length, ids, sequence_id, offset) of each row's pieces.

    A null text is the end id alone, a null doc_id stays null, repeated rows are
    packed each for itself, and columns beside doc_id and text are left out. No rows
    give none. ids: little-endian 32-bit."""
    pieces = packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packing.pack(pieces, numbers=packing.NUMBERS)


STAGES = [("quality", stage_quality), ("exact", stage_exact), ("near", stage_near), ("mix", stage_mix), ("pack", stage_pack)]

#: Kneser-Ney perplexity, MinHash and the tokenizer are beyond SQL; tests hold the
#: stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
