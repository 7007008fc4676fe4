"""Merges of a new load into the previous snapshot.

A merge is one join and gives the complete new table; surrogate IDs of known keys stay. New IDs continue
after the largest old one and depend on the keys only, so that a retried task gives the same numbers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lonja.operators.grouping import lookup
from lonja.operators.issues import issue
from lonja.session import materialized
from lonja.vocabulary import DETAIL, ORDERS, WARN

ATTRIBUTES = [
    "ean", "name", "brand", "category", "brand_key", "category_key", "base_cost", "net_cost", "pvp",
    "tax_rate", "weight_kg", "listed_on", "description", "price_origin", "category_discount",
    "brand_discount",
]
STOCK_STATE = ["stock_total", "stock_status", "stock_as_of"]


def number_new_keys(rows: DataFrame, key: list[str], first: Column) -> DataFrame:
    """Add ``new_id``: consecutive numbers from ``first`` on over rows with unique keys.

    Rows are numbered inside 65536 even hash buckets; a table with one row per bucket holds the offsets.
    """
    text = F.concat_ws("\x1f", *key)
    bucket = F.conv(F.substring(F.md5(text), 1, 4), 16, 10).cast("int")
    rows = rows.withColumn("_bucket", bucket)
    sizes = rows.groupBy("_bucket").agg(F.count("*").alias("_size"))
    offsets = sizes.withColumn(
        "_offset",
        F.sum("_size").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)),
    )
    position = F.row_number().over(Window.partitionBy("_bucket").orderBy(*key))
    return (
        rows.withColumn("_position", position)
        # At most 65536 rows, one per bucket.
        .join(F.broadcast(offsets.select("_bucket", "_offset")), "_bucket")
        .withColumn("new_id", first + F.coalesce("_offset", F.lit(0)) + F.col("_position") - 1)
        .drop("_bucket", "_position", "_offset")
    )


def _next_id(previous: DataFrame) -> Column:
    return previous.agg((F.coalesce(F.max("id"), F.lit(0)) + 1).alias("next")).scalar()


def _with_ids(rows: DataFrame, previous: DataFrame, key: list[str], read: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Give every row of ``rows`` the ID its key had before, or a new one; ``read`` turns packed keys into texts.

    Only the rows without an ID travel to their new ones.
    """
    # Written once: the rows, the bucket sizes and the positions below all read it.
    known = materialized(lookup(rows, previous.select("id", *key), key), "known", "zstd")
    new = read(known.where(F.col("id").isNull()))
    fresh = number_new_keys(new.select(*key), key, _next_id(previous))
    numbered = lookup(new.drop("id"), fresh.withColumnRenamed("new_id", "id"), key)
    return read(known.where(F.col("id").isNotNull())).unionByName(numbered)


# The marks of packed texts: hexadecimal digits as the bytes they write, and any other text.
DIGITS, PLAIN = b"\x01", b"\x00"


def _packed(text: Column) -> Column:
    """A text that takes half the room if it is hexadecimal digits; different texts stay different."""
    digits = text.rlike(r"^(?:[0-9a-f]{2})+\z")
    return F.when(digits, F.concat(F.lit(DIGITS), F.unhex(text))).otherwise(F.concat(F.lit(PLAIN), text.cast("binary")))


def _unpacked(packed: Column) -> Column:
    content = F.substring(packed, 2, 2**31 - 1)
    digits = F.substring(packed, 1, 1) == F.lit(DIGITS)
    return F.when(digits, F.lower(F.hex(content))).otherwise(content.cast("string"))


def merge_products(previous: DataFrame, accepted: DataFrame, run_id: str) -> DataFrame:
    """Upsert the accepted products by SKU and retire the ones no longer accepted.

    ``accepted`` has ``sku``, the attributes and the stock state. A known SKU keeps its ID and a historical
    one is promoted in place. Nothing is deleted.
    """
    current = _with_ids(accepted, previous, ["sku"]).select(
        "id", "sku", *ATTRIBUTES,
        F.lit(False).alias("is_historical"), F.lit(True).alias("in_catalog"),
        *STOCK_STATE, F.lit(run_id).alias("last_run_id"),
    )
    absent = lookup(previous, accepted.select("sku"), ["sku"], "left_anti")
    return current.unionByName(_retire(absent, run_id).select(*current.columns))


def _retire(rows: DataFrame, run_id: str) -> DataFrame:
    types = dict(rows.dtypes)
    retired = F.col("in_catalog")
    cleared = {
        name: F.when(~retired, F.col(name)).cast(types[name])
        for name in [*ATTRIBUTES, "stock_total", "stock_as_of"]
    }
    return rows.withColumns(
        {
            **cleared,
            "stock_status": F.when(retired, "unknown").otherwise(F.col("stock_status")),
            "is_historical": F.lit(True),
            "last_run_id": F.when(retired, F.lit(run_id)).otherwise(F.col("last_run_id")),
            "in_catalog": F.lit(False),
        }
    )


def retire_absent_products(previous: DataFrame, accepted: DataFrame, run_id: str) -> DataFrame:
    """The catalogue products that the new load no longer has, as their retired rows."""
    absent = lookup(previous.where("in_catalog"), accepted.select("sku"), ["sku"], "left_anti")
    return _retire(absent, run_id)


def create_historical_products(
    products: DataFrame, lines: DataFrame, seen_skus: DataFrame, run_id: str
) -> tuple[DataFrame, DataFrame]:
    """Minimal rows for sold SKUs without a product, and their issues.

    ``lines`` has ``sku, source_order_id, ord, source_locator``; ``seen_skus`` the SKUs the catalogue
    source mentioned at all. The issue points at the first line of the first order with the SKU.
    """
    first = F.min_by(
        F.struct("source_order_id", "source_locator"), F.struct("source_order_id", "ord")
    )
    unknown = lookup(
        lines.groupBy("sku").agg(first.alias("_first")), products.select("sku"), ["sku"], "left_anti"
    )
    numbered = number_new_keys(unknown, ["sku"], _next_id(products))
    types = dict(products.dtypes)
    rows = numbered.select(
        F.col("new_id").alias("id"), "sku",
        *[F.lit(None).cast(types[name]).alias(name) for name in ATTRIBUTES],
        F.lit(True).alias("is_historical"), F.lit(False).alias("in_catalog"),
        F.lit(None).cast("bigint").alias("stock_total"), F.lit("unknown").alias("stock_status"),
        F.lit(None).cast("timestamp").alias("stock_as_of"), F.lit(run_id).alias("last_run_id"),
    )
    seen = seen_skus.select("sku").distinct().withColumn("_seen", F.lit(True))
    origin = F.when(F.col("_seen"), DETAIL["was_rejected"]).otherwise(DETAIL["was_absent"])
    detail = F.concat(
        F.lit(DETAIL["historical"]), origin, F.lit("; pedido "), F.col("_first.source_order_id")
    )
    issues = lookup(unknown, seen, ["sku"]).select(
        F.lit(ORDERS).alias("source"),
        F.col("_first.source_locator").alias("locator"),
        F.col("sku").alias("entity"),
        F.array(issue(ORDERS, "HISTORICAL_PRODUCT_CREATED", WARN, None, detail)).alias("issues"),
    )
    return rows, issues


def touch_products(products: DataFrame, lines: DataFrame, run_id: str) -> DataFrame:
    """Stamp the run on the products that its order lines point to."""
    sold = lines.select("sku").distinct().withColumn("_sold", F.lit(True))
    stamp = F.when(F.col("_sold"), F.lit(run_id)).otherwise(F.col("last_run_id"))
    return lookup(products, sold, ["sku"]).withColumn("last_run_id", stamp).drop("_sold")


def replace_stock(products: DataFrame, observations: DataFrame, run_id: str) -> DataFrame:
    """The complete new warehouse table; nothing of the previous one stays."""
    return lookup(
        observations, products.where("in_catalog").select("sku", F.col("id").alias("product_id")),
        ["sku"], "inner",
    ).select(
        "product_id", "warehouse_code", "quantity", "reserved", "updated_at",
        F.lit(run_id).alias("last_run_id"),
    )


def stock_catalogue_mismatch(products: DataFrame, totals: DataFrame) -> DataFrame:
    """SKUs that only one of the current catalogue and the stock totals has; must be empty."""
    current = products.where("in_catalog").select("sku", F.lit(True).alias("_catalogue"))
    observed = totals.select("sku", F.lit(True).alias("_stock"))
    return current.join(observed, "sku", "full").where("_catalogue is null or _stock is null").select("sku")


def merge_orders(previous: DataFrame, headers: DataFrame, run_id: str) -> DataFrame:
    """Upsert headers by order ID; orders absent from the load disappear."""
    return _with_ids(headers, previous, ["source_order_id"]).select(
        "id", "source_order_id", "order_date", "customer", "channel", "status", "has_rejected_lines",
        F.lit(run_id).alias("last_run_id"),
    )


def merge_order_lines(
    previous: DataFrame, lines: DataFrame, orders: DataFrame, products: DataFrame, run_id: str
) -> DataFrame:
    """Upsert lines by order and signature; a known line only gets its new locator, absent ones go."""
    # Signatures are most of what a line weighs, and random: they travel packed.
    pack = {"line_key": _packed(F.col("line_key"))}
    keyed = lookup(
        lines.withColumns(pack), orders.select("source_order_id", F.col("id").alias("order_id")), ["source_order_id"], "inner"
    )
    keyed = lookup(keyed.drop("source_order_id"), products.select("sku", F.col("id").alias("product_id")), ["sku"], "inner")
    # The business keys have done their work; they need not go through the shuffles and files of the numbering.
    keyed = keyed.drop("sku")
    merged = _with_ids(
        keyed, previous.select("id", "order_id", "line_key").withColumns(pack), ["order_id", "line_key"],
        lambda rows: rows.withColumn("line_key", _unpacked(F.col("line_key"))),
    )
    return merged.select(
        "id", "order_id", "product_id", "line_key", "quantity", "unit_price", "discount",
        "source_locator", F.lit(run_id).alias("last_run_id"),
    )


def fingerprint(table: DataFrame, columns: list[str]) -> DataFrame:
    """Row count and an order-insensitive checksum of the given columns."""
    cells = [F.coalesce(F.col(name).cast("string"), F.lit("~")) for name in columns]
    digest = F.conv(F.substring(F.md5(F.concat_ws("|", *cells)), 1, 8), 16, 10).cast("decimal(20,0)")
    return table.agg(F.count("*").alias("n_rows"), F.sum(digest).alias("checksum"))
