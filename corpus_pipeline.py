"""From raw documents to packed sequences in five stages, each reading what the one before has written.

Stages take (spark, docs, sf_dir); all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areaflow.llm import mixing, packing, quality, simhash, toxicity
from areaflow.llm.common import bucket_of, saved, table
from areaflow.llm.queries import piece_columns, tokenizer_path

#: The stages have no SQL: hashing by word shingles, nearest examples and tokenizers are beyond it.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep_good(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic, by examples among the documents that the stage gets."""
    train = bucket_of(F.col("doc_id"), 3) != 1
    rows = toxicity.sample(docs, table(spark, sf_dir, "labels"), train, "doc_id", "text", "toxic", toxicity.SAMPLE_ROWS)
    return toxicity.scored(docs, toxicity.fit(rows)).filter(F.col("toxicity.predicted") == 0).select(*docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: fingerprints of three-word shingles that differ in three bits or less."""
    return simhash.drop_near_copies(docs)


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return mixing.repeated(mixing.mixed(docs), docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in packed sequences."""
    return piece_columns(packing.pack(docs, tokenizer_path()))


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("simhash_dedup", simhash_dedup),
    ("mixing", mixing_to_weights),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each result written and read again before the next stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
