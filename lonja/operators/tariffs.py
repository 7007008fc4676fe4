"""Supplier tariffs: discount rules per category or brand, and agreed net prices per SKU.

Input frames hold raw text as :mod:`lonja.sources.tariffs` reads it. Problems that make the whole document
unsafe come out as ``problem`` (INVALID_TARIFF, CONFLICTING_TARIFF); the load plan stops on any of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lonja.functions import numbers, text
from lonja.functions.parser import parse
from lonja.operators.grouping import attach_group, lookup
from lonja.operators.issues import issue, issue_list
from lonja.vocabulary import DEDUPLICATE, DETAIL, TARIFFS, WARN

KINDS = ["categoria", "marca"]


def validate_rules(rules: DataFrame) -> DataFrame:
    """``ord, locator, kind, label, bases, base_text, nested, other_children`` to a keyed ratio.

    ``bases`` counts the base elements, ``nested`` says that the base has elements of its own and
    ``other_children`` counts children of any other kind than base and volume terms.
    """
    rows = parse(
        rules,
        {
            "label": (text.clean_text, F.col("label")),
            "key": (text.comparison_key, F.col("label")),
            "_ratio": (numbers.discount, F.col("base_text")),
        },
    )
    bad = (
        ~F.coalesce(F.col("kind").isin(KINDS), F.lit(False))
        | F.col("key").isNull()
        | (F.col("bases") != 1)
        | (F.col("other_children") > 0)
        | F.col("nested")
        | F.col("_ratio.value").isNull()
    )
    return rows.withColumns(
        {
            "source": F.lit(TARIFFS),
            "ratio": F.col("_ratio.value"),
            "entity": F.concat_ws(":", "kind", "key"),
            "problem": F.when(bad, "INVALID_TARIFF"),
        }
    ).drop("_ratio")


def deduplicate_rules(rules: DataFrame) -> DataFrame:
    """Mark the first rule per kind and key; a repeated rule with another ratio is a conflict."""
    valid = F.when(F.col("problem").isNull(), F.col("ord"))
    rows = attach_group(
        rules.withColumn("_key", F.coalesce("key", F.concat(F.lit("\x00"), "locator"))),
        ["kind", "_key"],
        F.min_by(F.struct("ord", "locator", "ratio"), valid).alias("_kept"),
    )
    return _mark_repeats(
        rows, F.col("ratio") == F.col("_kept.ratio"), DETAIL["same_rule"], F.lit(False), None
    ).drop("_key")


def _mark_repeats(
    rows: DataFrame, same: Column, detail: str, warn: Column, warning: Column | None
) -> DataFrame:
    kept = F.col("_kept")
    first = F.col("problem").isNull() & (F.col("ord") == kept["ord"])
    repeat = F.col("problem").isNull() & ~first
    entries = [
        (
            repeat & same,
            issue(TARIFFS, "EXACT_DUPLICATE", DEDUPLICATE, None, F.concat(F.lit(detail), kept["locator"])),
        )
    ]
    if warning is not None:
        entries.append((first & warn, warning))
    return rows.withColumns(
        {
            "issues": issue_list(*entries),
            "kept": first,
            "problem": F.coalesce("problem", F.when(repeat & ~same, "CONFLICTING_TARIFF")),
        }
    ).drop("_kept")


def rule_dimension(rules: DataFrame, kind: str) -> DataFrame:
    """One ratio per comparison key for one kind of rule."""
    name = {"categoria": "category", "marca": "brand"}[kind]
    return rules.where(F.col("kept") & (F.col("kind") == kind)).select(
        F.col("key").alias(f"{name}_key"), F.col("ratio").alias(f"{name}_discount")
    )


def validate_exceptions(exceptions: DataFrame) -> DataFrame:
    """``ord, locator, sku, prices, price_text, nested, flags, flag_text, other_children`` to a price.

    An unusable price or an unknown flag keeps the exception as blocking: its product will be rejected.
    """
    rows = parse(
        exceptions.withColumn("flag", F.when(F.col("flags") > 0, F.coalesce("flag_text", F.lit("")))),
        {
            "_sku": (text.identifier, F.col("sku")),
            "_price": (numbers.money, F.col("price_text")),
            "flag": (text.Parser(text.strip, text.fold_case), F.col("flag")),
        },
    )
    unusable = (
        F.col("_price.value").isNull()
        | F.col("nested")
        | (F.col("flag").isNotNull() & (F.col("flag") != "false"))
    )
    bad = (
        F.col("_sku.value").isNull()
        | (F.col("prices") > 1)
        | (F.col("flags") > 1)
        | (F.col("other_children") > 0)
    )
    return rows.withColumns(
        {
            "source": F.lit(TARIFFS),
            "sku": F.col("_sku.value"),
            "entity": F.col("_sku.value"),
            "agreed_price": F.when(~unusable, F.col("_price.value")),
            "blocked": unusable,
            "problem": F.when(bad, "INVALID_TARIFF"),
        }
    ).drop("_sku", "_price")


def deduplicate_exceptions(exceptions: DataFrame) -> DataFrame:
    """Mark the first exception per SKU; a repeat must agree in price, or be the same invalid input."""
    valid = F.when(F.col("problem").isNull(), F.col("ord"))
    rows = attach_group(
        exceptions.withColumn("_key", F.coalesce("sku", F.concat(F.lit("\x00"), "locator"))),
        ["_key"],
        F.min_by(
            F.struct("ord", "locator", "agreed_price", "blocked", "price_text", "flag"), valid
        ).alias("_kept"),
    )
    kept = F.col("_kept")
    same = F.when(
        F.col("blocked"),
        kept["blocked"]
        & F.col("price_text").eqNullSafe(kept["price_text"])
        & F.col("flag").eqNullSafe(kept["flag"]),
    ).otherwise(~kept["blocked"] & (F.col("agreed_price") == kept["agreed_price"]))
    warning = issue(TARIFFS, "INVALID_EXCEPTION_PRICE", WARN, None, DETAIL["bad_exception"])
    return _mark_repeats(rows, same, DETAIL["same_exception"], F.col("blocked"), warning).drop("_key")


def exception_dimension(exceptions: DataFrame) -> DataFrame:
    return exceptions.where("kept").select("sku", "agreed_price", F.lit(True).alias("has_exception"))


def unapplied_terms(conditions: DataFrame, volumes: DataFrame) -> DataFrame:
    """Warnings for commercial conditions and volume discounts, which are never priced.

    Both inputs have ``locator, entity, excerpt``; a volume term carries the key of its rule.
    """

    def warned(frame: DataFrame, detail: str) -> DataFrame:
        entry = issue(TARIFFS, "UNAPPLIED_TARIFF_TERM", WARN, None, DETAIL[detail])
        return frame.select(
            F.lit(TARIFFS).alias("source"), "locator", "entity", F.array(entry).alias("issues"), "excerpt"
        )

    return warned(conditions, "condition").unionByName(warned(volumes, "volume"))


def orphan_exceptions(exceptions: DataFrame, candidates: DataFrame) -> DataFrame:
    """Warnings for agreed prices whose SKU has no catalogue candidate; no product is created."""
    known = candidates.where("candidate").select("sku").distinct()
    entry = issue(TARIFFS, "UNKNOWN_PRODUCT_SKU", WARN, None, DETAIL["orphan"])
    return (
        lookup(exceptions.where("kept"), known, ["sku"], "left_anti")
        .select("source", "locator", "entity", F.array(entry).alias("issues"))
    )
