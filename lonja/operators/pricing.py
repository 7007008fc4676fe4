"""Net purchase price of catalogue candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lonja.functions.numbers import MONEY, RATIO
from lonja.operators.catalogue import no_verdict
from lonja.operators.grouping import lookup
from lonja.operators.issues import issue
from lonja.vocabulary import CATALOGUE, DETAIL, REJECT


def price_by_exception(candidates: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Attach the agreed price of the SKU. A blocked exception leaves ``has_exception`` without price."""
    return lookup(candidates, exceptions, ["sku"]).withColumn(
        "has_exception", F.coalesce("has_exception", F.lit(False))
    )


def price_by_discounts(
    candidates: DataFrame, categories: DataFrame, brands: DataFrame
) -> DataFrame:
    """``round(cost * (1 - category - brand), 4)``; the discounts add up and are 0 where no rule exists."""
    zero = F.lit(0).cast(RATIO)
    rows = lookup(lookup(candidates, categories, ["category_key"]), brands, ["brand_key"])
    rows = rows.withColumns(
        {
            "category_discount": F.coalesce("category_discount", zero),
            "brand_discount": F.coalesce("brand_discount", zero),
        }
    )
    combined = (F.col("category_discount") + F.col("brand_discount")).cast(RATIO)
    kept = (F.lit(1).cast("decimal(1,0)") - combined).cast(RATIO)
    raw = F.round(F.col("base_cost") * kept, 4)
    problem = (
        F.when(F.col("base_cost").isNull(), F.col("cost_problem"))
        .when((combined >= 1) | (raw <= 0), "NON_POSITIVE_PRICE")
        .when(raw.try_cast(MONEY).isNull(), "NUMERIC_OUT_OF_RANGE")
    )
    return rows.withColumns(
        {
            "discounted_cost": F.when(problem.isNull(), raw.try_cast(MONEY)),
            "discount_problem": problem,
        }
    )


def quote(
    candidates: DataFrame, exceptions: DataFrame, categories: DataFrame, brands: DataFrame
) -> DataFrame:
    """Net cost with its origin and the reason where there is none. An exception always has priority."""
    rows = price_by_discounts(
        price_by_exception(candidates, exceptions), categories, brands
    )
    agreed = F.col("has_exception")
    zero = F.lit(0).cast(RATIO)
    return rows.withColumns(
        {
            "net_cost": F.when(agreed, F.col("agreed_price")).otherwise(F.col("discounted_cost")),
            "price_origin": F.when(agreed, "exception").otherwise("base_with_discounts"),
            "price_problem": F.when(
                agreed, F.when(F.col("agreed_price").isNull(), "INVALID_EXCEPTION_PRICE")
            ).otherwise(F.col("discount_problem")),
            "category_discount": F.when(agreed, zero).otherwise(F.col("category_discount")),
            "brand_discount": F.when(agreed, zero).otherwise(F.col("brand_discount")),
        }
    ).drop("discounted_cost", "discount_problem", "agreed_price", "has_exception")


def price_verdict(quoted: DataFrame) -> DataFrame:
    """Reject rows without a net cost or with one above the recommended retail price."""
    problem = F.col("price_problem")
    too_high = problem.isNull() & (F.col("net_cost") > F.col("pvp"))
    detail = F.concat(
        F.lit("Coste neto "), F.col("net_cost").cast("string"), F.lit(" > PVP "), F.col("pvp_text"),
        F.lit("; origen "), F.col("price_origin"),
    )
    plain = issue(CATALOGUE, problem, REJECT, None, DETAIL["price"])
    field = F.when(problem == F.col("cost_problem"), "precio_coste")
    return quoted.withColumn(
        "verdict",
        F.when(F.col("candidate") & problem.isNotNull(), plain.withField("field", field))
        .when(
            F.col("candidate") & too_high,
            issue(CATALOGUE, "COST_EXCEEDS_PVP", REJECT, "net_cost", detail),
        )
        .otherwise(no_verdict()),
    )


def price_judge(exceptions: DataFrame, categories: DataFrame, brands: DataFrame):
    """Verdict function for ``select_first_valid``: quote every record, then judge the quote."""
    return lambda records: price_verdict(quote(records, exceptions, categories, brands))
