"""Corpus pipeline over ``documents``: quality rules, SimHash near-duplicates,
benchmark decontamination, personal data, packing.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet on shared storage and read again as the next stage's ``docs``.  All
stages but the last return the columns of ``documents``:

* quality: documents that the rules reject go, boilerplate lines of the others go
* near_duplicates: one document of each SimHash component stays
* decontamination: documents holding a benchmark item go
* personal_data: texts with personal numbers, dates and secrets replaced
* packing: one row per piece of a document in a training sequence
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pktscope.llm import decontam, packing, pii, quality, simhash
from pktscope.llm.common import land, scratch, temporary
from pktscope.session import remove_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.strip_boilerplate(docs, length_col="n_chars")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=simhash.SHINGLE, distance=simhash.DISTANCE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(docs, length_col="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", pack),
]

#: SQL cannot express these stages; a test holds the chain against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result reads its stage's folder; all other folders of the run are
    removed as soon as nothing reads them."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        with temporary(spark):
            docs = land(stage(spark, docs, sf_dir), name, path)
        if before:
            remove_path(spark, before)
        before = path
    return docs
