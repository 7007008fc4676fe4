"""Tariff documents: structure gate, discount rules, agreed prices and terms that are never applied.

All functions take the element rows of :func:`lonja.sources.xml_elements.read_elements`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lonja.sources import xml_elements

ROOT = "TarifasProveedor"
#: Each section, and the only element it may hold.
SECTIONS = {"Condiciones": None, "Descuentos": "Descuento", "Excepciones": "Producto"}
DOCUMENT_SHIFT = 40


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    return xml_elements.read_elements(spark, path)


def _of(elements: DataFrame, section: str) -> DataFrame:
    """Elements of one section, in the order of the documents' paths and of their positions."""
    tag = SECTIONS[section]
    # One small row per document here.
    documents = elements.where("section IS NULL").select("path")
    documents = documents.withColumn("_document", F.row_number().over(Window.orderBy("path")) - 1)
    rows = elements.where((F.col("section") == section) & (F.lit(True) if tag is None else F.col("tag") == tag))
    return rows.join(documents, "path").withColumns(
        {
            "ord": F.shiftleft(F.col("_document").cast("bigint"), DOCUMENT_SHIFT) + F.col("position"),
            "locator": F.concat(F.lit(f"/{ROOT}/{section}/{tag or '*'}["), F.col("position").cast("string"), F.lit("]")),
        }
    )


def _named(tag: str) -> Column:
    return F.filter("children", lambda child: child["tag"] == tag)


def _others(*tags: str) -> Column:
    return F.size(F.filter("children", lambda child: ~child["tag"].isin(*tags)))


def _first(children: Column, field: str) -> Column:
    return F.get(children, F.lit(0))[field]


def scan_rules(elements: DataFrame) -> DataFrame:
    bases, volumes = _named("PorcentajeBase"), _named("PorVolumen")
    return _of(elements, "Descuentos").select(
        "ord",
        "locator",
        F.col("attributes")["tipo"].alias("kind"),
        F.col("attributes")["valor"].alias("label"),
        F.size(bases).alias("bases"),
        _first(bases, "text").alias("base_text"),
        F.coalesce(_first(bases, "nested"), F.lit(False)).alias("nested"),
        _others("PorcentajeBase", "PorVolumen").alias("other_children"),
        F.size(volumes).alias("volumes"),
        "excerpt",
        F.transform(volumes, lambda volume: volume["excerpt"]).alias("volume_excerpts"),
    )


def scan_exceptions(elements: DataFrame) -> DataFrame:
    prices, flags = _named("PrecioNetoAcordado"), _named("AplicaDescuentoAdicional")
    return _of(elements, "Excepciones").select(
        "ord",
        "locator",
        F.col("attributes")["sku"].alias("sku"),
        F.size(prices).alias("prices"),
        _first(prices, "text").alias("price_text"),
        F.coalesce(_first(prices, "nested"), F.lit(False)).alias("nested"),
        F.size(flags).alias("flags"),
        _first(flags, "text").alias("flag_text"),
        _others("PrecioNetoAcordado", "AplicaDescuentoAdicional").alias("other_children"),
        "excerpt",
    )


def scan_conditions(elements: DataFrame) -> DataFrame:
    """Children of the conditions section: ``locator, entity, excerpt``."""
    return _of(elements, "Condiciones").select("locator", F.lit(None).cast("string").alias("entity"), "excerpt")


def volume_terms(rules: DataFrame) -> DataFrame:
    """Volume terms of validated rules (``locator, entity, volumes, volume_excerpts``), with the key of their rule."""
    return rules.where("volumes > 0").select(
        F.explode(F.sequence(F.lit(1), "volumes")).alias("i"), "locator", "entity", "volume_excerpts"
    ).select(
        F.concat("locator", F.lit("/PorVolumen["), F.col("i"), F.lit("]")).alias("locator"), "entity",
        F.get("volume_excerpts", F.col("i") - 1).alias("excerpt"),
    )


def structure_problems(elements: DataFrame) -> DataFrame:
    """``problem`` per document: NULL if it is UTF-8, well formed and has the expected sections and elements."""
    sections = F.col("sections")
    sections_good = (
        (F.col("root") == ROOT)
        & (F.size(F.array_distinct(sections)) == F.size(sections))
        & (F.size(F.array_except(sections, F.array(*map(F.lit, SECTIONS)))) == 0)
        & F.array_contains(sections, "Descuentos")
        & F.array_contains(sections, "Excepciones")
    )
    expected = F.create_map(*[F.lit(x) for pair in SECTIONS.items() if pair[1] for x in pair])
    strangers = elements.where(F.col("tag") != expected[F.col("section")]).select("path").distinct()
    documents = elements.where("section IS NULL").join(strangers.withColumn("_stranger", F.lit(True)), "path", "left")
    problem = (
        F.when(F.col("problem").isNotNull(), F.col("problem"))
        .when(~sections_good, "INVALID_XML")
        .when(F.col("_stranger"), "INVALID_TARIFF")
    )
    return documents.select("path", problem.alias("problem"))
