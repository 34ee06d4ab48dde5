"""The training-corpus pipeline: language ID, SimHash near-dedup, benchmark
decontamination, mixing to target weights, token output.

Each stage takes what its predecessor kept, written as Parquet and read again;
all but the last return the columns of ``documents``, whatever further ones there are.

A text that is null or has no letter is of no language and goes in the first stage.  Null
ids are ids: of near duplicates the one with the smallest id stays, a null id last, and of
rows with that id one; the copies a row without an id gets are drawn by its text.
Repeated rows are copies of each other.  Long texts are read whole.  An empty table gives
no rows, an empty benchmark contaminates nothing.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from likewise.llm import decontaminate, language_id, mixing, simhash_dedup, token_output
from likewise.llm.common import materialize, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a clear margin."""
    model = language_id.fit(docs.filter(~language_id.held_out()))
    return language_id.keep_identified(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash_dedup.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a contaminating share of benchmark passages."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by their source's rate, in global random order."""
    return mixing.mix_sources(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards of every copy; a row per document read back from them."""
    return token_output.token_table(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mix_sources", mix_sources),
    ("token_output", write_tokens),
]

# Compression, fingerprints and tokens have no SQL form; tests/llm compares each stage's
# operator with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
