"""The corpus pipeline: from raw documents to packed token windows.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
and read again as the next stage's ``docs``.  All but the last keep the columns of
``documents``.  The near-duplicate stage takes five words and a similarity of
0.8.  The last stage's ids come from a tokenizer, so SQL cannot express run();
tests compare it with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabwatch.llm import exact_dedup, fair_mix, ngram_join, packing, quality_divergence
from tabwatch.llm.common import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the divergence rules keep."""
    return quality_divergence.passing(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of equal texts."""
    return exact_dedup.keep_one_of_each(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar texts."""
    return ngram_join.keep_one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents taken twice come twice."""
    return fair_mix.mixed(docs, chars_col="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed windows."""
    return packing.packed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("mix", mix),
    ("pack", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between two stages is written to the
    cluster's shared folder."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
