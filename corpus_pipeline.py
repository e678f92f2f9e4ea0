"""A corpus pipeline of five operators of ``featuremill.llm``, each stage written as Parquet and
read back as the next one's documents: quality rules and toxicity reject documents, SimHash
near-dedup keeps one document of each group, the secret scan blanks what it finds, and packing
lays the rest into windows of tokens.

Stages keep the columns of ``documents`` (further ones included, whatever their names), but for the
last, which returns the packed pieces. An empty table gives an empty result; a null text counts
as empty (so the quality rules reject it); null ids stay; rows that share an id are documents of
their own, told apart by their texts; of repeated rows near-dedup keeps one; very long texts are
taken whole, one Arrow batch and one text's figures at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from featuremill.llm import packing, quality_rules, secrets, simhash, toxicity
from featuremill.llm.common import read, stored
from featuremill.llm.queries import PACK_END_ID, PACK_WINDOW, SIMHASH_BITS, SIMHASH_WORDS


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled documents among those that reach this stage."""
    return toxicity.keep_clean(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one_of_each(docs, SIMHASH_WORDS, SIMHASH_BITS)


def blank_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, PACK_WINDOW, end_id=PACK_END_ID)


STAGES = [("quality", quality), ("toxicity", clean), ("near_dedup", near_dedup), ("secrets", blank_secrets),
          ("packing", pack)]

#: Training a classifier, XXH64 and the tokenizer have no SQL form; tests/llm compares the
#: rows of run() with a plain version of every stage instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
