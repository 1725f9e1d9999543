"""The corpus pipeline: documents in, weighted documents out, each stage written and read again.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. It works on all that the one before it kept, and
what it decides takes effect: rows or lines are gone, the last one leaves the documents of the mix with the
number of words the mix takes of each. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meridia.llm import decontaminate, language_id, line_dedup, mixing, near_dedup
from meridia.session import materialize, ship

# A document goes when no learned language has this share of its words, or none can be told.
LEAST_LANGUAGE_SHARE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs, language_id.fit(docs), LEAST_LANGUAGE_SHARE)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one(docs, width=5, threshold=0.8)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("mixing", mix_sources),
]

# Learned languages, hashed candidates and drawn slots can't be said in SQL; tests hold the stages against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over documents; every result is a written table that the next one reads."""
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
