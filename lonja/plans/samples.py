"""The retail entities derived from the given star-schema tables.

Published tables come straight from the tables. Dirty inputs put a deterministic mixture of formats and
faults, chosen by key arithmetic, on every row; the same SELECT text runs on Spark and, with the other
dialect, in the SQL the results are checked against.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lonja.functions.numbers import MONEY, RATIO
from lonja.vocabulary import CATALOGUE_COLUMNS, ORDER_COLUMNS

START = date(1995, 4, 1)
AS_OF = date(2001, 6, 30)
PAGE = 50


class SparkDialect:
    text_type = "STRING"
    layouts = ["yyyy-MM-dd", "dd/MM/yyyy", "dd-MM-yyyy HH:mm:ss", "yyyy/MM/dd"]
    # Orders meet their customers first, so that lines need not travel for them. Lines always travel to their order: the
    # rows are cheap to move and dear to parse, and come from files that Spark may not be able to split.
    order_hint = "/*+ MERGE(o) */ "
    order_joins = (
        "JOIN {part} AS p ON l_partkey = p_partkey JOIN (SELECT o_orderkey, o_orderdate, o_custkey, c_name "
        "FROM {orders} AS h JOIN {customer} AS c ON o_custkey = c_custkey) AS o ON l_orderkey = o_orderkey"
    )

    def whole(self, a, b):
        return f"(({a}) div {b})"

    def day(self, value, layout):
        return f"date_format({value}, '{self.layouts[layout]}')"

    def next_day(self, value):
        return f"({value} + INTERVAL 1 DAY)"

    def iso(self, value):
        return f"date_format({value}, \"yyyy-MM-dd'T'HH:mm:ss\")"


class DuckDialect(SparkDialect):
    text_type = "VARCHAR"
    layouts = ["%Y-%m-%d", "%d/%m/%Y", "%d-%m-%Y %H:%M:%S", "%Y/%m/%d"]
    order_hint = ""
    order_joins = (
        "JOIN {orders} AS o ON l_orderkey = o_orderkey JOIN {customer} AS c ON o_custkey = c_custkey "
        "JOIN {part} AS p ON l_partkey = p_partkey"
    )

    def whole(self, a, b):
        return f"(({a}) // {b})"

    def day(self, value, layout):
        return f"strftime({value}, '{self.layouts[layout]}')"

    def iso(self, value):
        return f"strftime({value}, '%Y-%m-%dT%H:%M:%S')"


SPARK = SparkDialect()
DUCK = DuckDialect()
NBSP = "\u00a0"


def _text(d, expression):
    return f"CAST({expression} AS {d.text_type})"


def _money_text(d, cents, choice):
    """An amount in whole cents written in one of eight ways."""
    euros, rest = d.whole(cents, 100), f"lpad({_text(d, f'({cents}) % 100')}, 2, '0')"
    high = _text(d, d.whole(cents, 100000))
    low = f"lpad({_text(d, f'{euros} % 1000')}, 3, '0')"
    whole = _text(d, euros)
    return (
        f"CASE {choice} % 8 WHEN 0 THEN {whole} || ',' || {rest} WHEN 1 THEN {whole} || '.' || {rest} "
        f"WHEN 2 THEN {high} || '.' || {low} || ',' || {rest} WHEN 3 THEN {high} || ',' || {low} || '.' || {rest} "
        f"WHEN 4 THEN {high} || ' ' || {low} || ',' || {rest} || ' €' WHEN 5 THEN 'EUR ' || {whole} || ',' || {rest} "
        f"WHEN 6 THEN '€' || {whole} || '.' || {rest} ELSE {high} || '{NBSP}' || {low} || ',' || {rest} || ' eur' END"
    )


def catalogue_sql(d) -> str:
    """Catalogue rows as eleven texts, with ``ord`` and ``n_cells`` (11, or 3 for a cut row)."""
    i = "p_partkey"
    cost, pvp = ("CAST(round(p_retailprice * 240) AS BIGINT)", "CAST(round(p_retailprice * 400) AS BIGINT)")
    body = f"400000000000 + {i}"
    digits = [d.whole(body, 10 ** (11 - k)) + " % 10" for k in range(12)]
    weighted = " + ".join(f"({x}) * {3 if k % 2 else 1}" for k, x in enumerate(digits))
    check = f"(10 - ({weighted}) % 10) % 10"
    ean = f"{_text(d, body)} || {_text(d, check)}"
    euros = _text(d, d.whole(cost, 100))
    rows = f"""
      SELECT p_partkey, p_name, p_brand, p_type, p_retailprice, copy FROM (
        SELECT *, 0 AS copy FROM {{part}}
        UNION ALL SELECT *, 1 AS copy FROM {{part}} WHERE p_partkey % 11 = 0
        UNION ALL SELECT *, 2 AS copy FROM {{part}} WHERE p_partkey % 13 = 0) AS u"""
    return f"""
      SELECT {i} * 4 + copy AS ord,
        CASE WHEN {i} % 53 = 9 THEN 3 ELSE 11 END AS n_cells,
        CASE WHEN {i} % 101 = 50 THEN 'N/D' WHEN {i} % 101 = 51 THEN 'PRV-' || chr(9) || {_text(d, i)}
             WHEN {i} % 7 = 1 THEN ' prv-' || {_text(d, i)} || ' ' ELSE 'PRV-' || {_text(d, i)} END AS sku,
        CASE {i} % 9 WHEN 1 THEN '''' || {ean} WHEN 2 THEN '"' || {ean} || '"' WHEN 3 THEN {_text(d, body)} || 'X'
             WHEN 4 THEN '8,461061067530E+12' WHEN 5 THEN 'N/D' WHEN 6 THEN {_text(d, f'{body} * 10')}
             WHEN 7 THEN '96385074' ELSE {ean} END AS ean,
        CASE WHEN {i} % 89 = 7 THEN ' - ' WHEN {i} % 3 = 0 THEN '  ' || replace(p_name, ' ', '  ') || ' ' ELSE p_name || ' Ñu' END AS nombre,
        CASE WHEN {i} % 3 = 0 THEN upper(p_brand) WHEN {i} % 97 = 3 THEN '' ELSE p_brand END AS marca,
        CASE WHEN {i} % 4 = 0 THEN lower(p_type) || ' ' ELSE p_type END AS categoria,
        CASE {i} % 23 WHEN 3 THEN 'N/D' WHEN 5 THEN {_text(d, d.whole(cost, 100000))} || '.160' WHEN 7 THEN {euros} || ',5?'
             WHEN 9 THEN '-5,00' WHEN 11 THEN '9999,99' WHEN 13 THEN '?' WHEN 15 THEN 'x12' WHEN 17 THEN '100000000000000'
             ELSE {_money_text(d, cost, i)} END AS precio_coste,
        CASE {i} % 29 WHEN 2 THEN {_text(d, d.whole(pvp, 100))} || ',25?' WHEN 4 THEN '' WHEN 6 THEN '0'
             ELSE {_money_text(d, pvp, f'({i} + 3)')} END AS pvp_recomendado,
        CASE {i} % 6 WHEN 0 THEN '21' WHEN 1 THEN '21%' WHEN 2 THEN '0,21' WHEN 3 THEN 'N/D' WHEN 4 THEN '4 %' ELSE '999' END AS iva,
        CASE {i} % 7 WHEN 0 THEN '1,5' WHEN 1 THEN '-2' WHEN 2 THEN 'abc' WHEN 3 THEN '' WHEN 4 THEN '0' WHEN 5 THEN '1.997' ELSE '1e3' END AS peso_kg,
        CASE {i} % 8 WHEN 0 THEN '2025-04-19' WHEN 1 THEN '19/04/2025' WHEN 2 THEN '9-4-2025' WHEN 3 THEN '2025/04/19 19:57:00'
             WHEN 4 THEN '31/02/2025' WHEN 5 THEN '2026-09-23T23:30:00Z' WHEN 6 THEN '04/19/2025' ELSE '-' END AS fecha_alta,
        CASE WHEN copy = 2 THEN 'otra' WHEN {i} % 5 = 0 THEN 'línea uno' || chr(10) || '"dos"; ' || p_name ELSE p_name END AS descripcion
      FROM ({rows}) AS c"""


def orders_sql(d) -> str:
    """Order rows as nine texts, with ``ord`` (unique), ``locator`` and ``n_cells``."""
    k, ln, part, supp = "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    day = (
        f"CASE WHEN {k} % 37 = 0 AND {ln} % 2 = 0 THEN {d.next_day('o_orderdate')} ELSE o_orderdate END"
    )
    layouts = " ".join(f"WHEN {n} THEN {d.day(f'({day})', n)}" for n in range(4))
    qty, pct = _text(d, "CAST(l_quantity AS BIGINT)"), "CAST(round(l_discount * 100) AS BIGINT)"
    status = "CASE l_orderkey % 5 WHEN 0 THEN 'Completado' WHEN 1 THEN 'ENVIADO' WHEN 2 THEN 'pendiente' WHEN 3 THEN 'Cancelado' ELSE 'DEVUELTO' END"
    channel = "CASE o_custkey % 3 WHEN 0 THEN 'b2b' WHEN 1 THEN 'B2C' ELSE 'MarketPlace' END"
    order_number = "CAST({0} AS DECIMAL(38,0))"
    ord_ = (
        f"(({order_number.format(ln)} * {order_number.format(10**12)} + {order_number.format(part)}) "
        f"* {order_number.format(10**10)} + {order_number.format(supp)}) * {order_number.format(2)} + {order_number.format('copy')}"
    )
    return f"""
      SELECT {d.order_hint}CAST({ord_} AS DECIMAL(38,0)) AS ord,
        {_text(d, k)} || '-' || {_text(d, ln)} || '-' || {_text(d, part)} || '-' || {_text(d, supp)} || '-' || {_text(d, 'copy')} AS locator,
        CASE WHEN ({k} + {part}) % 173 = 0 THEN 5 ELSE 9 END AS n_cells,
        CASE WHEN ({k} * 7 + {ln}) % 211 = 0 THEN '' WHEN {k} % 6 = 0 THEN ' ped-' || {_text(d, k)} ELSE 'PED-' || {_text(d, k)} END AS id_pedido,
        CASE WHEN {ln} % 5 = 3 THEN '' WHEN {k} % 101 = 7 THEN '2025-13-01' ELSE CASE {ln} % 4 {layouts} END END AS fecha_pedido,
        CASE WHEN {ln} % 7 = 0 THEN 'N/D' WHEN {k} % 41 = 0 AND {ln} % 3 = 2 THEN c_name || ' Ñ'
             WHEN {ln} % 3 = 1 THEN upper(c_name) ELSE ' ' || c_name END AS cliente,
        CASE WHEN {k} % 43 = 0 AND {ln} = 2 THEN 'tienda' WHEN {ln} % 6 = 5 THEN '-' WHEN {ln} % 2 = 0 THEN lower({channel}) ELSE {channel} END AS canal,
        CASE WHEN {k} % 47 = 0 AND {ln} = 1 THEN 'facturado' WHEN {ln} % 6 = 4 THEN 'null' WHEN {ln} % 2 = 0 THEN upper({status}) ELSE {status} END AS estado,
        CASE WHEN {part} % 89 = 0 THEN '' WHEN {part} % 3 = 0 THEN 'prv-' || {_text(d, part)} ELSE 'PRV-' || {_text(d, part)} END AS sku,
        CASE WHEN {part} % 61 = 0 THEN '2,5' WHEN {part} % 67 = 0 THEN '0' WHEN {part} % 71 = 0 OR ({k} % 5 = 4 AND {ln} % 2 = 0) THEN '-' || {qty}
             WHEN {ln} % 3 = 0 THEN {qty} || ',0' WHEN {ln} % 3 = 1 THEN {qty} || '.0' ELSE {qty} END AS cantidad,
        CASE WHEN {part} % 73 = 0 THEN '1.234' WHEN {part} % 79 = 0 THEN '-1' ELSE {_money_text(d, 'CAST(round(p_retailprice * 400) AS BIGINT)', ln)} END AS precio_unitario,
        CASE WHEN {supp} % 83 = 5 THEN '101' WHEN {ln} % 4 = 3 THEN '' WHEN {ln} % 4 = 1 THEN {_text(d, pct)} || '%' ELSE '0,' || lpad({_text(d, pct)}, 2, '0') END AS descuento_linea
      FROM (SELECT *, 0 AS copy FROM {{lineitem}} UNION ALL SELECT *, 1 AS copy FROM {{lineitem}} WHERE l_orderkey % 97 = 0) AS l
      {d.order_joins}"""


def stock_sql(d) -> str:
    """Stock observations as five texts, with ``ord`` and ``locator``."""
    e = "event_id"
    hour = "date_trunc('hour', ts)"
    return f"""
      SELECT {e} * 2 + copy AS ord,
        'page:' || {_text(d, d.whole(e, PAGE) + ' + 1')} || '/row:' || {_text(d, f'{e} % {PAGE} + 1')} || CASE copy WHEN 1 THEN 'b' ELSE '' END AS locator,
        CASE WHEN {e} % 113 = 5 THEN ' ' ELSE 'prv-' || {_text(d, 'user_id')} END AS sku,
        CASE WHEN {e} % 331 = 5 THEN 'n/a' ELSE ' ' || event_type END AS warehouse,
        CASE WHEN {e} % 427 = 3 THEN 'true' WHEN {e} % 2 = 0 THEN {_text(d, f'{e} % 3')} || ',0' ELSE {_text(d, f'{e} % 3')} END AS quantity,
        {_text(d, f'{e} % 7')} AS reserved,
        CASE WHEN {e} % 431 = 1 THEN {d.iso(hour)} WHEN {e} % 3 = 0 THEN {d.iso(f"({hour} + INTERVAL 2 HOUR)")} || '+02:00' ELSE {d.iso(hour)} || 'Z' END AS updated_at
      FROM (SELECT *, 0 AS copy FROM {{events}} UNION ALL SELECT *, 1 AS copy FROM {{events}} WHERE event_id % 50 = 0) AS u"""


def rules_sql(d) -> str:
    """Discount rules, one per part: many repeats of few keys, some invalid, some in conflict."""
    i = "p_partkey"
    number = f"CASE WHEN {i} % 2 = 0 THEN length(p_type) ELSE CAST(substr(p_brand, 7) AS BIGINT) % 9 + 1 END"
    pct = _text(d, number)
    return f"""
      SELECT {i} AS ord, 'Descuento[' || {_text(d, i)} || ']' AS locator,
        CASE WHEN {i} % 307 = 5 THEN 'otro' WHEN {i} % 2 = 0 THEN 'categoria' ELSE 'marca' END AS kind,
        CASE WHEN {i} % 409 = 9 THEN 'N/D' WHEN {i} % 2 = 0 THEN CASE WHEN {i} % 3 = 0 THEN lower(p_type) ELSE ' ' || p_type END
             ELSE CASE WHEN {i} % 3 = 0 THEN upper(p_brand) ELSE p_brand || ' ' END END AS label,
        CASE WHEN {i} % 601 = 13 THEN 2 ELSE 1 END AS bases,
        CASE WHEN {i} % 503 = 11 THEN 'x' WHEN {i} % 401 = 17 THEN '50' WHEN {i} % 3 = 0 THEN {pct} || ' %' WHEN {i} % 3 = 1 THEN {pct} ELSE '0,0' || {pct} END AS base_text,
        {i} % 701 = 19 AS nested, 0 AS other_children, CAST({i} % 4 AS INT) AS volumes
      FROM {{part}}"""


def exceptions_sql(d) -> str:
    """Agreed prices: one per part, with agreeing, conflicting and repeated invalid entries."""
    i = "p_partkey"
    cents = "CAST(round(p_retailprice * 100) AS BIGINT)"
    return f"""
      SELECT {i} * 4 + copy AS ord, 'Producto[' || {_text(d, f'{i} * 4 + copy')} || ']' AS locator,
        CASE WHEN {i} % 509 = 3 THEN '' WHEN {i} % 3 = 0 THEN 'prv-' || {_text(d, f'{i} * 2')} ELSE 'PRV-' || {_text(d, f'{i} * 2')} END AS sku,
        CASE WHEN {i} % 29 = 1 THEN 0 ELSE 1 END AS prices,
        CASE WHEN {i} % 29 = 1 THEN NULL WHEN {i} % 23 = 0 THEN 'a convenir' WHEN copy = 2 THEN '1,50' ELSE {_money_text(d, cents, f'({i} + copy)')} END AS price_text,
        {i} % 613 = 5 AS nested,
        CASE WHEN {i} % 5 = 0 THEN 1 ELSE 0 END AS flags,
        CASE WHEN {i} % 5 = 0 THEN CASE WHEN {i} % 35 = 0 THEN 'TRUE' ELSE ' False ' END END AS flag_text,
        0 AS other_children
      FROM (SELECT *, 0 AS copy FROM {{part}} UNION ALL SELECT *, 1 AS copy FROM {{part}} WHERE p_partkey % 17 = 0 OR p_partkey % 23 = 0
            UNION ALL SELECT *, 2 AS copy FROM {{part}} WHERE p_partkey % 19 = 0) AS u"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _run(spark: SparkSession, folder: str, sql: str, first: str, *others: str) -> DataFrame:
    """Run a SELECT over the given tables; the rows of the first one are what the work is done on."""
    frames = {name: table(spark, folder, name) for name in others}
    # Rows that are cheap to move and dear to parse, from files that Spark may not be able to split.
    return spark.sql(sql, **{first: table(spark, folder, first).hint("rebalance")}, **frames)


def _cells(rows: DataFrame, names: list[str]) -> DataFrame:
    return rows.withColumn("cells", F.slice(F.array(*names), F.lit(1), F.col("n_cells")))


def catalogue_texts(spark: SparkSession, folder: str) -> DataFrame:
    return _run(spark, folder, catalogue_sql(SPARK), "part")


def catalogue_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = _cells(catalogue_texts(spark, folder), CATALOGUE_COLUMNS)
    return rows.select("ord", F.col("ord").cast("string").alias("locator"), "cells")


def order_texts(spark: SparkSession, folder: str) -> DataFrame:
    frames = {name: table(spark, folder, name) for name in ("lineitem", "orders", "customer", "part")}
    return spark.sql(orders_sql(SPARK), **frames)


def order_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _cells(order_texts(spark, folder), ORDER_COLUMNS).select("ord", "locator", "cells")


def stock_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _run(spark, folder, stock_sql(SPARK), "events")


def rule_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _run(spark, folder, rules_sql(SPARK), "part")


def exception_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _run(spark, folder, exceptions_sql(SPARK), "part")


def category_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Ratio per product type: its number of letters in per cent; none for LARGE."""
    parts = table(spark, folder, "part").select(F.lower("p_type").alias("category_key")).distinct()
    ratio = (F.length("category_key") * F.lit(1).cast(RATIO) / 100).cast(RATIO)
    return parts.where("category_key <> 'large'").withColumn("category_discount", ratio)


def brand_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Ratio per brand: its number in per cent times four; the largest reach the whole price."""
    parts = table(spark, folder, "part").select(F.lower("p_brand").alias("brand_key")).distinct()
    number = F.substring("brand_key", 7, 10).cast("int")
    return parts.withColumn("brand_discount", (number * F.lit(4).cast(RATIO) / 100).cast(RATIO))


def price_exceptions(spark: SparkSession, folder: str) -> DataFrame:
    """Agreed price for every 25th part at its retail price; every 75th is blocked."""
    parts = table(spark, folder, "part").where("p_partkey % 25 = 1")
    price = F.when(F.col("p_partkey") % 75 != 1, F.col("p_retailprice").cast(MONEY))
    return parts.select(
        F.concat(F.lit("PRV-"), "p_partkey").alias("sku"),
        price.alias("agreed_price"),
        F.lit(True).alias("has_exception"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    """Published products: every 20th part is historical, the rest are in the catalogue."""
    i = F.col("p_partkey")
    current = i % 20 != 0
    price = F.col("p_retailprice").cast(MONEY)
    status = F.when(~current | (i % 7 == 0), "unknown").when(i % 7 == 1, "invalid").otherwise("known")
    known = status == "known"
    rows = table(spark, folder, "part").select(
        i.alias("id"),
        F.concat(F.lit("PRV-"), i).alias("sku"),
        F.when(current, F.col("p_name")).alias("name"),
        F.when(current, F.col("p_brand")).alias("brand"),
        F.when(current, F.when(i % 3 == 0, F.initcap("p_type")).otherwise(F.col("p_type"))).alias("category"),
        F.when(current, F.lower("p_brand")).alias("brand_key"),
        F.when(current, F.lower("p_type")).alias("category_key"),
        F.when(current, (price * F.lit(6).cast("decimal(1,0)") / 10).cast(MONEY)).alias("base_cost"),
        F.when(current, price).alias("pvp"),
        (~current).alias("is_historical"),
        current.alias("in_catalog"),
        F.when(known, i % 9).alias("stock_total"),
        status.alias("stock_status"),
        F.when(known, F.lit("2024-01-31 00:00:00").cast("timestamp")).alias("stock_as_of"),
        F.when(current, F.concat(F.lit("Pieza "), "p_name", F.lit(" ñandú"))).alias("description"),
        F.when(current, F.lit("base_with_discounts")).alias("price_origin"),
    )
    return rows.withColumn("net_cost", F.col("base_cost"))


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Published orders; the days of the year's end carry partial orders."""
    rows = table(spark, folder, "orders")
    status = (
        F.when(F.col("o_orderstatus") == "F", "COMPLETADO")
        .when(F.col("o_orderstatus") == "O", "ENVIADO")
        .otherwise("PENDIENTE")
    )
    channel = F.when(F.col("o_custkey") % 3 == 0, "B2B").when(F.col("o_custkey") % 3 == 1, "B2C").otherwise("marketplace")
    return rows.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("PED-"), "o_orderkey").alias("source_order_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_custkey").cast("string").alias("customer"),
        channel.alias("channel"),
        status.alias("status"),
        (F.col("o_orderkey") % 11 == 0).alias("has_rejected_lines"),
    )


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Published lines at the retail price of their part."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_discount").cast(RATIO).alias("discount"),
    )
    prices = table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_retailprice").cast(MONEY).alias("unit_price")
    )
    return lines.join(prices, "product_id")
