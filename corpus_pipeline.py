"""The corpus pipeline: from documents to a mixed, clean training corpus.

Every stage takes the documents its predecessor kept and returns those it keeps,
with the columns of documents; the last adds the place in the mix. Each stage is
written as a table in the shared folder and read again, so a lost executor costs
the work of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from balcao.llm import decontam, langid, mixing, neardup, pii
from balcao.session import written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language stay."""
    return langid.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five words, a similarity of 0.8."""
    return neardup.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are a twentieth benchmark or more go."""
    return decontam.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets get pseudonyms."""
    return pii.pseudonymize_rows(docs, pii.key_of(spark))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix, weighted by the square root of the sources' sizes."""
    return mixing.in_order(mixing.mix(docs, mixing.root_weights(docs)), docs.columns)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pseudonyms", pseudonyms),
    ("mixing", mixing_sources),
]

#: Profiles, sketches and keyed permutations are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
