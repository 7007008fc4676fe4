"""Constraints of the published tables as queries: each gives one row per check with its violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lonja.operators.grouping import lookup
from lonja.operators.issues import source_counters
from lonja.vocabulary import ACTIONS, CATALOGUE, CHANNELS, ORDERS, RETURNED, SEVERITIES, STATUSES, STOCK, TARIFFS


def _violations(name: str, rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _broken(name: str, table: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """All row rules of a table in one pass; a rule is broken where it is not true."""
    counts = table.agg(
        *[F.count(F.when(~F.coalesce(rule, F.lit(False)), 1)).alias(rule_name) for rule_name, rule in rules.items()]
    )
    entries = [
        F.struct(F.lit(f"{name}.{r}").alias("check"), F.col(r).alias("violations")) for r in rules
    ]
    return counts.select(F.explode(F.array(*entries)).alias("x")).select("x.*")


def foreign_keys(
    products: DataFrame, orders: DataFrame, lines: DataFrame, stock: DataFrame, runs: DataFrame
) -> DataFrame:
    def orphans(rows: DataFrame, column: str, target: DataFrame, key: str) -> DataFrame:
        return rows.select(column).join(target.select(F.col(key).alias(column)), column, "left_anti")

    checks = [
        _violations("lines.order", orphans(lines, "order_id", orders, "id")),
        _violations("lines.product", orphans(lines, "product_id", products, "id")),
        _violations("stock.product", orphans(stock, "product_id", products.where("in_catalog"), "id")),
        _violations("orders.lines", orphans(orders, "id", lines, "order_id")),
    ]
    known = runs.select(F.col("run_id").alias("last_run_id"), F.lit(True).alias("known")).distinct()
    for name, table in (("products", products), ("orders", orders), ("lines", lines), ("stock", stock)):
        # Nearly all rows name the same run: they are counted per run first, and the few runs are looked up.
        per_run = table.groupBy("last_run_id").agg(F.count("*").alias("rows"))
        unknown = lookup(per_run, known, ["last_run_id"]).where(F.col("known").isNull())
        checks.append(unknown.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("violations")).select(
            F.lit(f"{name}.run").alias("check"), "violations"))
    return _union(checks)


def unique_keys(
    products: DataFrame, orders: DataFrame, lines: DataFrame, stock: DataFrame, ledger: DataFrame
) -> DataFrame:
    keys = {
        "products": (products, ["sku"]),
        "orders": (orders, ["source_order_id"]),
        "lines": (lines, ["order_id", "line_key"]),
        "stock": (stock, ["product_id", "warehouse_code"]),
        "ledger": (ledger, ["run_id", "source", "record_locator", "reason_code", "field_name"]),
    }
    return _union(
        [
            _violations(f"{name}.key", table.groupBy(*key).count().where("count > 1"))
            for name, (table, key) in keys.items()
        ]
    )


def _optional(name: str, rule: Column) -> Column:
    return F.col(name).isNull() | rule


def domains(products: DataFrame, orders: DataFrame, lines: DataFrame, ledger: DataFrame) -> DataFrame:
    prices = {n: _optional(n, F.col(n) > 0) for n in ("base_cost", "net_cost", "pvp")}
    ratios = {
        n: _optional(n, F.col(n).between(0, 1)) for n in ("tax_rate", "category_discount", "brand_discount")
    }
    weight = {"weight_kg": _optional("weight_kg", F.col("weight_kg") >= 0)}
    negative = (
        lines.where(F.col("quantity") < 0)
        .join(orders.select(F.col("id").alias("order_id"), "status"), "order_id")
        .where(F.col("status") != RETURNED)
    )
    return _union(
        [
            _broken("products", products, {**prices, **ratios, **weight}),
            _broken("orders", orders, {"channel": F.col("channel").isin(CHANNELS), "status": F.col("status").isin(STATUSES)}),
            _broken(
                "lines", lines,
                {
                    "quantity": F.col("quantity") != 0,
                    "unit_price": F.col("unit_price") > 0,
                    "discount": F.col("discount").between(0, 1),
                },
            ),
            _violations("lines.returned", negative),
            _broken("ledger", ledger, {"action": F.col("action").isin(ACTIONS), "severity": F.col("severity").isin(SEVERITIES)}),
        ]
    )


def states(products: DataFrame) -> DataFrame:
    """A product is either commercial or historical, and its stock state is consistent."""
    commercial = F.col("in_catalog") & ~F.col("is_historical") & (F.col("net_cost") > 0) & (F.col("pvp") > 0)
    for name in ("name", "brand", "category"):
        commercial = commercial & F.col(name).isNotNull()
    historical = ~F.col("in_catalog") & F.col("is_historical")
    for name in ("base_cost", "net_cost", "pvp", "stock_total"):
        historical = historical & F.col(name).isNull()
    total, as_of = F.col("stock_total"), F.col("stock_as_of")
    status = F.col("stock_status")
    stock = (
        ((status == "unknown") & total.isNull() & as_of.isNull())
        | ((status == "known") & (total >= 0) & as_of.isNotNull())
        | ((status == "invalid") & total.isNull() & as_of.isNull())
    )
    return _broken("products", products, {"state": commercial | historical, "stock_state": stock})


def stock_totals(products: DataFrame, stock: DataFrame) -> DataFrame:
    """Known totals that differ from their warehouse rows, or have none."""
    summed = stock.groupBy(F.col("product_id").alias("id")).agg(
        F.sum(F.col("quantity").cast("decimal(38,0)")).alias("summed")
    )
    known = products.where(F.col("stock_status") == "known").select("id", "stock_total")
    wrong = known.join(summed, "id", "left").where(
        F.col("summed").isNull() | (F.col("summed") != F.col("stock_total"))
    )
    return _violations("products.stock_total", wrong)


def ledger_counters(
    counters: DataFrame, ledger: DataFrame, products: DataFrame, stock: DataFrame, orders: DataFrame, lines: DataFrame
) -> DataFrame:
    """Counters of a run (long form ``source, counter, value``) beside what its ledger and tables say."""
    shared = ledger.withColumn(
        "source", F.when(F.col("source") == TARIFFS, CATALOGUE).otherwise(F.col("source"))
    ).select("source", "action", "record_locator")
    rows_only = source_counters(ledger).select("source", "rows_rejected", "rows_deduplicated")
    entries = source_counters(shared).select("source", "quality_warnings", "discarded_fields")

    def long(frame: DataFrame, names: list[str]) -> DataFrame:
        pairs = [F.struct(F.lit(n).alias("counter"), F.col(n).alias("found")) for n in names]
        return frame.select("source", F.explode(F.array(*pairs)).alias("x")).select("source", "x.*")

    def table(source: str, counter: str, rows: DataFrame) -> DataFrame:
        return rows.agg(F.count("*").alias("found")).select(
            F.lit(source).alias("source"), F.lit(counter).alias("counter"), "found"
        )

    found = _union(
        [
            long(rows_only, ["rows_rejected", "rows_deduplicated"]),
            long(entries, ["quality_warnings", "discarded_fields"]),
            table(CATALOGUE, "rows_accepted", products.where("in_catalog")),
            table(STOCK, "rows_accepted", stock),
            table(ORDERS, "rows_accepted", lines),
            table(ORDERS, "orders_loaded", orders),
            table(ORDERS, "partial_orders", orders.where("has_rejected_lines")),
        ]
    )
    checked = [
        "rows_rejected", "rows_deduplicated", "quality_warnings", "discarded_fields", "rows_accepted",
        "orders_loaded", "partial_orders",
    ]
    return (
        counters.where(F.col("counter").isin(checked))
        .join(found, ["source", "counter"], "left")
        .withColumn("found", F.coalesce("found", F.lit(0)))
        .withColumn("matches", F.col("value") == F.col("found"))
    )
