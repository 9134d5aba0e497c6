"""Corpus preparation as a chain of stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dustline.llm.common import stored, table
from dustline.llm.decontamination import decontamination_stage
from dustline.llm.language_id import language_stage
from dustline.llm.mixing import mixing_stage
from dustline.llm.near_duplicates import near_duplicate_stage
from dustline.llm.pii import personal_data_stage

#: (name, function(spark, docs, sf_dir)); all but the last return the columns of ``documents``.
STAGES = [
    ("language_id", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("mixing", mixing_stage),
]

#: None: the fitted stages cannot be expressed in SQL; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one reading what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
