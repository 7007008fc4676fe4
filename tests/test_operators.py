"""Operators on small frames with results worked out by hand, and plans under skew."""

from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from lonja.operators import browse, catalogue, integrity, issues, merge, metrics, orders, pricing, reporting, stock, tariffs
from lonja.operators.grouping import attach_group
from lonja.session import materialized
from lonja.vocabulary import CATALOGUE_COLUMNS, STOCK_FIELDS

#: A tea shop, open since March 2023; seen at the end of a month that is longer than the one three months before.
START, AS_OF = date(2023, 3, 1), date(2023, 12, 31)


@pytest.fixture(scope="module")
def shop(spark):
    products = spark.createDataFrame(
        [(11, "OOLONG", "Oolong", "Tea", "tea", D("3.5"), False, True, 2, "known"), (12, "KETTLE", "Kettle", "Ware", "ware", D(30), False, True, 3, "known"),
         (13, "GONE", None, None, None, None, True, False, None, "unknown"), (14, "MATCHA", "Matcha", "Tea", "tea", D(8), False, True, 1, "known"),
         (15, "CUP", "Cup", "Ware", "ware", D(4), False, True, 900, "known"), (16, "SIEVE", "Sieve", "Ware", "ware", D(1), False, True, None, "invalid")],
        "id bigint, sku string, name string, category string, category_key string, net_cost decimal(18,4), is_historical boolean, in_catalog boolean, stock_total bigint, stock_status string")
    sold = [
        # day, channel, status, partly rejected, (product, quantity, price, discount)
        (date(2023, 3, 1), "B2C", "ENVIADO", False, [(11, 4, "6.25", "0"), (15, 2, "7.50", "0.2")]),  # 25.00 + 12.00
        (date(2023, 9, 30), "marketplace", "COMPLETADO", True, [(12, 1, "49.99", "0")]),  # 49.99, on the limit of three months
        (date(2023, 9, 29), "B2B", "COMPLETADO", False, [(14, 3, "9.99", "0.15")]),  # 25.4745 -> 25.47, one day too old
        (date(2023, 11, 5), "B2C", "COMPLETADO", False, [(13, 2, "1.11", "0.5"), (11, 1, "6.25", "1")]),  # 1.11 + 0.00
        (date(2023, 12, 31), "B2C", "COMPLETADO", False, [(16, 10, "0.105", "0")]),  # 1.05
        (date(2023, 10, 1), "B2C", "PENDIENTE", False, [(11, 1, "500", "0")]), (date(2023, 10, 1), "B2B", "CANCELADO", False, [(12, 1, "500", "0")]),
        (date(2023, 10, 1), "B2B", "DEVUELTO", False, [(12, -1, "49.99", "0")]), (date(2023, 2, 28), "B2B", "COMPLETADO", False, [(12, 1, "500", "0")]),
        (date(2024, 1, 1), "B2B", "COMPLETADO", False, [(12, 1, "500", "0")]),
    ]
    heads = [(100 + i, *row[:4]) for i, row in enumerate(sold)]
    lines = [(100 + i, p, q, D(price), D(cut)) for i, row in enumerate(sold) for p, q, price, cut in row[4]]
    head = spark.createDataFrame(heads, "id bigint, order_date date, channel string, status string, has_rejected_lines boolean")
    line = spark.createDataFrame(lines, "order_id bigint, product_id bigint, quantity bigint, unit_price decimal(18,4), discount decimal(9,6)")
    return products, metrics.eligible_lines(head, line, products, START, AS_OF).persist()


def test_sales(shop):
    products, eligible = shop
    row = metrics.sales_summary(eligible).first()
    assert (row.revenue, row.orders, row.average_ticket, row.partial_orders) == (D("114.62"), 5, D("22.92"), 1)
    months = {r.month: r for r in metrics.monthly_sales(eligible, START, AS_OF).collect()}
    assert len(months) == 10 and [m.month for m in months if months[m].is_partial] == [12]
    assert {m.month: (r.revenue, r.units) for m, r in months.items() if r.units} == {
        3: (D("37.00"), 6), 9: (D("75.46"), 4), 11: (D("1.11"), 3), 12: (D("1.05"), 10)}
    assert {r.channel: r.revenue for r in metrics.sales_by_channel(eligible).collect()} == {
        "B2B": D("25.47"), "B2C": D("39.16"), "marketplace": D("49.99")}
    assert {r.label: r.revenue for r in metrics.sales_by_category(eligible).collect()} == {
        "Ware": D("63.04"), "Tea": D("50.47"), "Sin categoría": D("1.11")}
    assert [r.sku for r in metrics.top_products(eligible).collect()] == ["KETTLE", "MATCHA", "OOLONG", "CUP", "GONE", "SIEVE"]
    margin = metrics.margin_summary(eligible).first()
    # 25 - 14, 12 - 8, 49.99 - 30, 25.47 - 24, 0 - 3.5, 1.05 - 10
    assert (margin.known_margin, margin.known_revenue, margin.unknown_revenue, margin.coverage) == (
        D("24.01"), D("113.51"), D("1.11"), D("0.9903"))
    previous = metrics.previous_month_sales(eligible, AS_OF).first()
    assert (previous.revenue, previous.orders, previous.average_ticket) == (D("1.11"), 1, D("1.11"))
    assert all(r.matches for r in metrics.independent_recalculation(eligible, START, AS_OF).collect())
    first = reporting.chart_series(metrics.monthly_sales(eligible, START, AS_OF)).first()
    assert (first.label, first.revenue, first.units) == ("03/2023", "37.00", 6)


def test_year_on_year_over_months_without_sales(spark):
    sold = spark.createDataFrame(
        [(date(2021, 1, 9), D("40.00"), 4), (date(2021, 3, 9), D("3.00"), 1), (date(2022, 1, 5), D("50.00"), 5), (date(2022, 2, 5), D("7.00"), 1)],
        "order_date date, amount decimal(38,2), quantity bigint")
    rows = metrics.year_on_year(metrics.monthly_sales(sold, date(2021, 1, 1), date(2022, 3, 31))).collect()
    assert len(rows) == 15 and all(r.revenue_year_before is None and r.revenue_ratio is None for r in rows[:12])
    assert [(str(r.month)[:7], r.revenue_year_before, r.units_year_before, r.revenue_ratio) for r in rows[12:]] == [
        ("2022-01", D("40.00"), 4, D("1.2500")), ("2022-02", D("0.00"), 0, None), ("2022-03", D("3.00"), 1, D("0.0000"))]


def test_low_stock_looks_back_whole_months(shop):
    products, eligible = shop
    low = metrics.low_stock_products(eligible, products, AS_OF).collect()
    # 30 September is three months before 31 December; the matcha of the day before no longer counts.
    assert [(r.sku, r.stock_total, r.recent_units) for r in low] == [("OOLONG", 2, 1), ("KETTLE", 3, 1)]
    with pytest.raises(ValueError):
        metrics.trailing_months(eligible, AS_OF, -1)
    with pytest.raises(TypeError):
        metrics.trailing_months(eligible, datetime(2023, 12, 31), 1)


def test_summary_counts_any_number_of_low_products(spark):
    many = 10_500
    products = spark.range(many).select(
        "id", F.concat(F.lit("S"), "id").alias("sku"), F.lit("x").alias("name"), F.lit("c").alias("category"), F.lit("c").alias("category_key"),
        F.lit(D(1)).cast("decimal(18,4)").alias("net_cost"), F.lit(False).alias("is_historical"), F.lit(True).alias("in_catalog"),
        F.lit(0).cast("bigint").alias("stock_total"), F.lit("known").alias("stock_status"))
    eligible = spark.range(many).select(
        F.col("id").alias("order_id"), F.col("id").alias("product_id"), F.lit(1).cast("bigint").alias("quantity"), F.lit(AS_OF).alias("order_date"),
        F.lit("B2B").alias("channel"), F.lit(False).alias("has_rejected_lines"), F.lit(D(1)).cast("decimal(18,2)").alias("amount"))
    ledger = spark.createDataFrame([], "source string, reason_code string, record_locator string, action string")
    counters = {"catalog_csv": spark.sql("SELECT 0L AS rows_rejected, 1L AS products_loaded")}
    row = reporting.run_summary({"run_id": "r", "finished_at": "f", "rules_version": "v"}, counters, ledger, eligible, products, AS_OF, 0).first()
    assert row.low_stock_count == many and row.alert_required and row.previous_month == "2023-11"


def _parsed(spark, *changes):
    base = dict(zip(CATALOGUE_COLUMNS, ["tea-1", "-", "Sencha", "Kyoto", "Tea", "20", "31,5", "10", "0,1", "2023-01-15", ""], strict=True))
    rows = [(i, f"line {i}", list((base | change).values())) for i, change in enumerate(changes, 1)]
    return catalogue.parse_catalogue(spark.createDataFrame(rows, "ord bigint, locator string, cells array<string>"))


def test_pricing(spark):
    category = spark.createDataFrame([("tea", D("0.25"))], "category_key string, category_discount decimal(9,6)")
    brand = spark.createDataFrame([("kyoto", D("0.1")), ("free", D("0.75"))], "brand_key string, brand_discount decimal(9,6)")
    agreed = spark.createDataFrame([("DEAL", D("11.0000"), True), ("BLOCKED", None, True)], "sku string, agreed_price decimal(18,4), has_exception boolean")
    rows = _parsed(
        spark, {}, {"sku": "one", "marca": "unknown"}, {"sku": "two", "categoria": "cake"}, {"sku": "none", "categoria": "cake", "marca": "unknown"},
        {"sku": "deal", "precio_coste": "?"}, {"sku": "blocked"}, {"sku": "gift", "marca": "FREE"}, {"sku": "dear", "precio_coste": "60"},
        {"sku": "Dear", "precio_coste": "40"}, {"sku": "DEAR", "precio_coste": "40,00"}, {"sku": "Dear", "precio_coste": "40"})
    chosen = catalogue.select_first_valid(rows, pricing.price_judge(agreed, category, brand))
    got = [(r.sku, r.net_cost, r.outcome, [i.code for i in r.issues]) for r in chosen.orderBy("ord").collect()]
    assert got == [
        ("TEA-1", D("13.0000"), "accepted", []), ("ONE", D("15.0000"), "accepted", []), ("TWO", D("18.0000"), "accepted", []),
        ("NONE", D("20.0000"), "accepted", []), ("DEAL", D("11.0000"), "accepted", ["INVALID_PRICE"]),
        ("BLOCKED", None, "rejected", ["INVALID_EXCEPTION_PRICE"]), ("GIFT", None, "rejected", ["NON_POSITIVE_PRICE"]),
        ("DEAR", D("39.0000"), "rejected", ["COST_EXCEEDS_PVP"]), ("DEAR", D("26.0000"), "accepted", []),
        ("DEAR", D("26.0000"), "rejected", ["CONFLICTING_PRODUCT_SKU"]), ("DEAR", D("26.0000"), "deduplicated", ["EXACT_DUPLICATE"])]


def test_tariff_conflicts(spark):
    schema = "ord bigint, locator string, kind string, label string, bases int, base_text string, nested boolean, other_children int, volumes int"
    rows = [(5, "e5", "categoria", "TEA ", 1, "12,5", False, 0, 0), (2, "e2", "categoria", "tea", 1, "12.5 %", False, 0, 1), (7, "e7", "categoria", "Tea", 1, "13", False, 0, 0),
            (8, "e8", "color", "x", 1, "1", False, 0, 0), (9, "e9", "marca", "tea", 1, "13", False, 0, 0)]
    found = tariffs.deduplicate_rules(tariffs.validate_rules(spark.createDataFrame(rows, schema))).orderBy("ord").collect()
    assert [(r.ord, r.kept, r.problem) for r in found] == [
        (2, True, None), (5, False, None), (7, False, "CONFLICTING_TARIFF"), (8, False, "INVALID_TARIFF"), (9, True, None)]
    assert [i.code for i in found[1].issues] == ["EXACT_DUPLICATE"] and found[1].issues[0].detail.endswith("e2")


def test_orders(spark):
    rows = [
        ("t-9", "15/06/2023", "Iñaki", "b2c", "enviado", "TEA-1", "3", "6,25", "20%"), ("T-9", "", "iñaki ", "", "", "tea-1", "3,0", "6.25", "0,2"),
        ("T-9", "2023-06-15 09:30:00", "", "B2C", "Enviado", "CUP", "0", "7,5", ""), ("u-1", "2023-06-16", "Ona", "web", "Enviado", "CUP", "1", "7,5", ""),
        ("u-2", "2023-06-16", "Ona", "b2b", "Enviado", "CUP", "1", "7,5", ""), ("U-2", "2023-06-17", "Ona", "b2b", "Enviado", "TEA-1", "1", "7,5", ""),
        ("u-3", "2023-06-18", "Pau", "b2b", "Devuelto", "CUP", "-4", "7,5", "0"), ("u-3", "2023-06-18", "Pau", "b2b", "Devuelto", "CUP", "-4", "7,5", "10%"),
        ("N/A", "2023-06-18", "Pau", "b2b", "Devuelto", "CUP", "-4", "7,5", ""), ("u-4", "only two"),
    ]
    found = orders.select_orders(spark.createDataFrame([(i, f"l{i}", list(r)) for i, r in enumerate(rows)], "ord bigint, locator string, cells array<string>"))
    rows = found.orderBy("ord").collect()
    assert [r.outcome for r in rows] == ["accepted", "deduplicated", *["rejected"] * 4, "accepted", "accepted", "rejected", "rejected"]
    codes = [sorted(i.code for i in r.issues if i.action != "warn") for r in rows]
    assert codes[1] == ["DUPLICATE_ORDER_LINE"] and codes[2] == ["INVALID_QUANTITY"] and "UNKNOWN_CHANNEL" in codes[3]
    assert codes[4] == codes[5] == ["CONFLICTING_ORDER_HEADER"] and codes[9] == ["INVALID_COLUMN_COUNT"]
    assert sorted(i.field for i in rows[1].issues if i.code == "HEADER_VALUE_INHERITED") == ["canal", "estado", "fecha_pedido"]
    heads = {r.source_order_id: (r.customer, r.has_rejected_lines) for r in orders.order_headers(found).collect()}
    assert heads == {"T-9": ("Iñaki", True), "U-3": ("Pau", False)}


def test_order_chain_keeps_only_repeated_lines(spark):
    """Besides the parsed rows, only short hashes and first rows of lines that occur several times are written out."""
    kept = []
    cells = ["2023-06-16", "Ona", "b2b", "Enviado", "CUP"]
    rows = [(i, f"l{i}", [order, *cells, count, "7,5", "0"]) for i, (order, count) in enumerate([("a", "1"), ("a", "2"), ("b", "1"), ("A", "1,0")])]
    frame = spark.createDataFrame(rows, "ord bigint, locator string, cells array<string>")
    found = orders.select_orders(frame, keep=lambda rows: kept.append(materialized(rows)) or kept[-1]).orderBy("ord").collect()
    assert [r.outcome for r in found] == ["accepted", "accepted", "accepted", "deduplicated"] and len({r.line_key for r in found}) == 3
    assert [frame.count() for frame in kept[1:]] == [1, 1] and dict(kept[0].dtypes)["line_key"] == "binary"


def test_stock(spark):
    early, late = "2023-05-05T05:00:00+02:00", "2023-05-05T04:00:00Z"
    rows = [("CUP", "N", "7", "9", early), ("cup", "S", "1,0", "0", late), ("JAR", "N", "4", "0", early), ("JAR", "N", "6", "0", late), ("JAR", "N", "6", "0", late),
            ("POT", "N", "2", "0", early), ("POT", "N", "2", "1", early), ("POT", "S", "5", "0", late), ("TIN", "N", "2,5", "0", early), ("XXX", "N", "2", "0", early),
            ("TIN", "S", "8", "0", late), ("BOX", "N", "0", "0", early)]
    frame = spark.createDataFrame([(i, f"r{i}", *r) for i, r in enumerate(rows)], "ord bigint, locator string, " + ", ".join(f"{f} string" for f in STOCK_FIELDS))
    skus = spark.createDataFrame([(s,) for s in ("CUP", "JAR", "POT", "TIN", "BOX", "LID")], "sku string")
    done = stock.reconcile_versions(stock.validate_observations(frame, skus))
    totals = {r.sku: (r.stock_status, r.stock_total) for r in stock.stock_totals(done, skus).collect()}
    assert totals == {"CUP": ("known", 8), "JAR": ("known", 6), "POT": ("invalid", None), "TIN": ("invalid", None), "BOX": ("known", 0), "LID": ("unknown", None)}
    codes = {r.ord: [i.code for i in r.issues] for r in done.collect() if r.issues}
    assert codes == {0: ["RESERVED_EXCEEDS_QUANTITY"], 2: ["SUPERSEDED_STOCK"], 4: ["EXACT_DUPLICATE"], 5: ["CONFLICTING_STOCK"], 6: ["CONFLICTING_STOCK"],
                     8: ["INVALID_STOCK"], 9: ["UNKNOWN_PRODUCT_SKU"]}
    assert [r.locator for r in stock.conflict_warnings(done).collect()] == ["conflict:POT:N:2023-05-05T03:00:00+00:00"]


def test_control_characters_in_excerpts(spark):
    row = spark.createDataFrame([(["a\x1fb", "\\u001F", 'q"\x0b\\\x0e', "ñ"],)], "cells array<string>")
    assert row.select(issues.cells_excerpt(F.col("cells"))).first()[0] == r'["a\u001fb", "\\u001F", "q\"\u000b\\\u000e", "ñ"]'


def test_new_ids_are_dense_and_stable(spark):
    rows = spark.range(5000).select(F.concat(F.lit("K"), "id").alias("k"))
    first = {r.k: r.new_id for r in merge.number_new_keys(rows, ["k"], F.lit(11)).collect()}
    again = {r.k: r.new_id for r in merge.number_new_keys(rows.repartition(7), ["k"], F.lit(11)).collect()}
    assert first == again and sorted(first.values()) == list(range(11, 5011))


def test_pages_in_order(spark):
    products = spark.range(230).select(
        F.format_string("S%03d", F.col("id")).alias("sku"), F.lit("n").alias("name"), F.lit("c").alias("category"), F.lit("c").alias("category_key"),
        F.lit("").alias("description"), F.lit(True).alias("in_catalog"), F.lit(1).alias("net_cost"), F.lit(1).alias("pvp"),
        F.lit(1).alias("stock_total"), F.lit("known").alias("stock_status")).repartition(5)
    seen, total, pages = [], None, 1
    for number in range(1, 100):
        shown, total, page, pages = browse.catalog_page(products, "", "", number)
        if page < number:
            break
        seen += [r.sku for r in shown.collect()]
    assert total == 230 and seen == [f"S{i:03d}" for i in range(230)] and page == pages
    assert browse.catalog_page(products, "nothing", "", 3)[1:] == (0, 1, 1)


def test_run_check_counts_rows_of_unknown_runs(spark):
    rows = spark.createDataFrame([(1, 1, "a"), (2, 2, "b"), (3, 3, None)], "id bigint, order_id bigint, last_run_id string")
    products = rows.withColumn("in_catalog", F.lit(True))
    lines = rows.withColumn("product_id", F.col("id"))
    found = {r.check: r.violations for r in integrity.foreign_keys(
        products, rows, lines, lines, spark.createDataFrame([("a",), ("a",)], "run_id string")).collect()}
    assert {name: n for name, n in found.items() if n} == {f"{t}.run": 2 for t in ("products", "orders", "lines", "stock")}


def test_hot_group_is_split(spark, tmp_path):
    """A third of the rows share one key: the join that brings the group value back must be split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000)
    spark.range(0, 200_000, 1, 8).select(key.alias("k"), F.col("id").alias("ord")).write.parquet(str(tmp_path / "t"))
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        rows = attach_group(spark.read.parquet(str(tmp_path / "t")), ["k"], F.min("ord").alias("first"))
        total = rows.agg(F.count("*").alias("n"), F.sum("first").alias("s"))
        assert total.collect()[0].n == 200_000
        assert "skew=true" in total._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_history_and_alerts(spark):
    history = spark.createDataFrame([("r1", True, None), ("r2", False, None)], "run_id string, alert_required boolean, email_sent_at timestamp")
    new = spark.createDataFrame([("r1", True, None), ("r3", True, None)], history.schema)
    added = reporting.append_history(history, new)
    assert [r.run_id for r in added.collect()] == ["r3"]
    assert sorted(r.run_id for r in reporting.pending_mails(history.unionByName(added)).collect()) == ["r1", "r3"]
    row = spark.range(1).select(*[reporting.alert_required(F.lit(a), F.lit(b), 5).alias(f"x{a}{b}") for a, b in ((5, 0), (6, 0), (0, 1))]).first()
    assert tuple(row) == (False, True, True)
    with pytest.raises(ValueError):
        reporting.alert_required(F.lit(1), F.lit(1), -1)
