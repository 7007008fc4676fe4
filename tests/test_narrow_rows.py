"""What the order chain, its reports and the merge of lines shuffle and write out between their steps."""

from datetime import datetime
from decimal import Decimal as D

import pytest

from lonja.operators import merge, orders
from lonja.plans import queries

DAY = datetime(2023, 6, 16)
TABLES = {
    "lineitem": ([(97, 1, 1, 1, 2.0, 0.1)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber long, l_quantity double, l_discount double"),
    "orders": ([(97, 3, "F", DAY)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp"),
    "customer": ([(3, "Ona")], "c_custkey long, c_name string"),
    "part": ([(1, "tin", "Brand#1", "SMALL", 9.5)], "p_partkey long, p_name string, p_brand string, p_type string, p_retailprice double"),
    "events": ([(1, 1, "click", 2.0, DAY)], "event_id long, user_id long, event_type string, value double, ts timestamp"),
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    for name, (rows, schema) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def spy(monkeypatch, module):
    """Lists the columns that the module writes out."""
    seen = []
    monkeypatch.setattr(module, "materialized", lambda rows, *purpose: seen.append(rows.columns) or rows)
    return seen


def test_rows_meet_their_order_without_header_cells(spark, monkeypatch):
    met, lookup = {}, orders.lookup
    monkeypatch.setattr(orders, "lookup", lambda rows, *rest: met.update({rest[1][0]: dict(rows.dtypes)}) or lookup(rows, *rest))
    cells = ["a", "", "Ona", "b2b", "Enviado", "CUP", "1", "7,5", "0"]
    frame = spark.createDataFrame([(1, "l1", cells), (2, "l2", ["a", "2023-06-16", *cells[2:]])], "ord bigint, locator string, cells array<string>")
    found = orders.select_orders(frame).orderBy("ord").collect()
    assert not [name for name in met["_group"] if name.startswith("h_")] and met["_group"]["line_key"] == "binary"
    assert [r.outcome for r in found] == ["accepted", "deduplicated"] and len(found[0].line_key) == 64
    assert [i.field for i in found[0].issues] == ["fecha_pedido"]


@pytest.mark.parametrize("name", ["rejections_by_reason", "severity_assignment", "orders_counters", "ledger_counter_check", "missing_order_reasons"])
def test_order_reports_write_neither_cells_nor_signatures(spark, folder, monkeypatch, name):
    seen = spy(monkeypatch, queries)
    queries.QUERIES[name](spark, folder)
    settled = [columns for columns in seen if "outcome" in columns and "order_date" in columns]
    assert len(settled) == 1 and "line_key" not in settled[0]
    assert not [columns for columns in seen if "cells" in columns and ("h_date" in columns or "order_date" in columns)]


def test_signatures_come_back_from_the_line_values(spark, folder):
    rows = queries._selected_orders(spark, folder).select("locator", "line_key").collect()
    again = queries._settled_orders(spark, folder).select("locator", "line_key").collect()
    assert len(rows) == 2 and sorted(rows) == sorted(again)


def test_merged_lines_are_numbered_without_business_keys(spark, monkeypatch):
    seen = spy(monkeypatch, merge)
    line = [("o", "k", "CUP", 1, D("7.5"), D(0), "l1")]
    lines = spark.createDataFrame(line, "source_order_id string, line_key string, sku string, quantity bigint, unit_price decimal(18,4), discount decimal(9,6), source_locator string")
    previous = spark.createDataFrame([], "id bigint, order_id bigint, line_key string")
    known = spark.createDataFrame([(5, "o")], "id bigint, source_order_id string")
    products = spark.createDataFrame([(9, "CUP")], "id bigint, sku string")
    row = merge.merge_order_lines(previous, lines, known, products, "r").first()
    assert (row.id, row.order_id, row.product_id) == (1, 5, 9) and not {"sku", "source_order_id"} & set(seen[0])
