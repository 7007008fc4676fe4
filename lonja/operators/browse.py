"""Catalogue browsing and publication facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lonja.functions import text
from lonja.session import materialized
from lonja.vocabulary import CATALOGUE, PAGE_SIZE


def catalog_search(products: DataFrame, query: str = "") -> DataFrame:
    """Catalogue products whose SKU, name or description contains the text, without case or accents."""
    rows = products.where("in_catalog")
    wanted = query.strip()
    if not wanted:
        return rows
    needle = F.collate(F.lit(wanted), "UNICODE_CI_AI")
    found = F.lit(False)
    for name in ("sku", "name", "description"):
        found = found | F.coalesce(F.contains(F.collate(F.col(name), "UNICODE_CI_AI"), needle), F.lit(False))
    return rows.where(found)


def catalog_category(products: DataFrame, category: str = "") -> DataFrame:
    """Products of one category, compared by key; a missing-value token matches nothing."""
    if not category:
        return products
    return products.where(F.col("category_key") == text.comparison_key(F.lit(category)))


def catalog_page(
    products: DataFrame, query: str = "", category: str = "", page: int = 1
) -> tuple[DataFrame, int, int, int]:
    """One page by SKU with the total, the page shown (clamped) and the number of pages.

    The products are range-partitioned by SKU once; the row counts of the ranges give the total and tell
    which of them hold the page, so a late page does not sort all that comes before it.
    """
    rows = catalog_category(catalog_search(products, query), category)
    columns = ["sku", "name", "category", "net_cost", "pvp", "stock_total", "stock_status"]
    ranges = rows.select(columns).repartitionByRange("sku").withColumn("_range", F.spark_partition_id())
    ranges = materialized(ranges, "page-ranges")
    # One row per range on the driver.
    counts = sorted((row["_range"], row["count"]) for row in ranges.groupBy("_range").count().collect())
    total = sum(count for _, count in counts)
    pages = max(1, -(-total // PAGE_SIZE))
    page = min(max(page, 1), pages)
    first, last = (page - 1) * PAGE_SIZE, page * PAGE_SIZE
    wanted, skipped, before = [], 0, 0
    for number, count in counts:
        if before + count <= first:
            skipped += count
        elif before < last:
            wanted.append(number)
        before += count
    shown = ranges.where(F.col("_range").isin(wanted)).drop("_range").orderBy("sku").offset(first - skipped).limit(PAGE_SIZE)
    return shown, total, page, pages


def catalog_categories(products: DataFrame) -> DataFrame:
    return (
        products.where("in_catalog")
        .groupBy("category_key")
        .agg(F.max("category").alias("label"))
        .orderBy("category_key")
    )


def latest_publication(runs: DataFrame) -> DataFrame:
    """The completed run that finished last."""
    return (
        runs.where(F.col("status") == "completed")
        .orderBy(F.desc("finished_at"), F.desc("started_at"), F.desc("run_id"))
        .limit(1)
    )


def conflicting_skus(ledger: DataFrame, products: DataFrame) -> DataFrame:
    """Catalogue SKUs that had conflicting rows in the run the ledger belongs to."""
    skus = ledger.where(
        (F.col("source") == CATALOGUE) & (F.col("reason_code") == "CONFLICTING_PRODUCT_SKU")
    ).select(F.col("entity_key").alias("sku"))
    return skus.join(products.where("in_catalog").select("sku"), "sku", "left_semi").distinct()
