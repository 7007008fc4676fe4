"""The two CSV sources and the guards on what was read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lonja.sources.located_csv import CHUNK, read_located_csv
from lonja.vocabulary import CATALOGUE_COLUMNS, ORDER_COLUMNS


def scan_catalogue(spark: SparkSession, path: str, chunk: int = CHUNK) -> DataFrame:
    """Catalogue: Latin-1, semicolons, quoted multi-line fields."""
    return read_located_csv(spark, path, CATALOGUE_COLUMNS, ";", "latin-1", chunk)


def scan_orders(spark: SparkSession, path: str, chunk: int = CHUNK) -> DataFrame:
    """Order lines: UTF-8 with an optional byte order mark, commas."""
    return read_located_csv(spark, path, ORDER_COLUMNS, ",", "utf-8", chunk)


def records_of(scanned: DataFrame) -> DataFrame:
    return scanned.where("problem is null").drop("problem")


def structural_problems(scanned: DataFrame) -> DataFrame:
    """Problems that make a whole source unusable, with their position."""
    return scanned.where("problem is not null").select("problem", "locator")


def with_provenance(records: DataFrame, source: str) -> DataFrame:
    """Name the source beside the locator; several lines give ``first-last``."""
    return records.withColumn("source", F.lit(source))


def empty_source(accepted: DataFrame, code: str) -> DataFrame:
    """One row with the code if nothing was accepted, else no row."""
    return (
        accepted.limit(1)
        .agg(F.count("*").alias("n"))
        .where("n = 0")
        .select(F.lit(code).alias("problem"))
    )
