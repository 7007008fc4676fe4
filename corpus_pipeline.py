"""From raw documents to packed training sequences: five stages, each on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lonja.llm import stages
from lonja.session import materialized

STAGES = [
    ("quality classifier", stages.keep_quality),
    ("exact dedup", stages.keep_first_copies),
    ("n-gram Jaccard join", stages.keep_one_of_near_copies),
    ("mixing sources to target weights", stages.mix_to_targets),
    ("best-fit packing", stages.pack),
]

#: The classifier, the banding and the packing are not expressible in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
