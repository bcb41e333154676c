"""A corpus pipeline of five stages, each one operator over all that the stage before kept.

Every stage is called as ``(spark, docs, sf_dir)``; its result is written as Parquet and read
again as the next stage's documents. The first four drop whole rows and keep all columns,
whatever their names; the last returns the packed pieces. Null, empty, very long and repeated
texts are treated as the operators say; no documents: no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pumpguard.llm import decontaminate, packing, quality_rules, simhash, toxicity
from pumpguard.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is 0.5 or more go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the learned decision list rejects go."""
    return quality_rules.without_rejected(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays."""
    return simhash.one_of_each(docs, k=simhash.SHINGLE_WORDS, max_bits=simhash.MAX_BITS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, tokenised and packed into sequences."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("quality_rules", drop_low_quality),
          ("simhash_near_dedup", drop_near_duplicates),
          ("benchmark_decontamination", drop_contaminated), ("best_fit_packing", pack)]

#: SQL cannot express the trained stages: tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
