"""The stages of the corpus pipeline: ``(spark, docs, sf_dir)`` to a DataFrame.

Each stage decides over all documents of its predecessor. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lonja.llm import curriculum, exact_dedup, near_join, packing, quality
from lonja.llm.rows import table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier trained on ``labels`` does not reject (score of 0.5 or more).

    Null and empty texts have a score like any other text; repeated rows have equal scores. An empty table stays empty.
    """
    model, score = quality.train(docs, table(spark, sf_dir, "labels")), "_quality_score"
    while score in docs.columns:
        score += "_"
    return quality.score(docs, model, output=score).where(F.col(score) >= 0.5).drop(score)


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal up to white space, the document with the smallest id; see ``drop_duplicates`` for the cases."""
    return exact_dedup.drop_duplicates(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents connected by near-duplicate links, the one with the smallest id.

    Texts without words are no near copies of anything. Nulls, repeated rows: see ``near_duplicates``.
    """
    return near_join.drop_near_duplicates(docs)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix uses them, in training order; see ``curriculum`` for the cases."""
    return curriculum.curriculum(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in training sequences; see ``packing.pack`` for the cases."""
    return packing.pack(docs)
