"""What order rows carry on their way to their order and their line, and how often they travel."""

from datetime import datetime

import pytest

from lonja.operators import orders
from lonja.plans import queries, samples
from lonja.session import materialized

TABLES = {
    "lineitem": ([(97, 1, 1, 1, 2.0, 0.1), (None, 1, 1, 1, 2.0, 0.1), (98, 1, 1, 4, 3.0, 0.1), (99, None, 1, 4, 3.0, 0.1)],
                 "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber long, l_quantity double, l_discount double"),
    "orders": ([(97, 3, datetime(2023, 6, 16)), (98, 4, datetime(2023, 6, 16)), (99, 3, datetime(2023, 6, 16)), (100, None, None)],
               "o_orderkey long, o_custkey long, o_orderdate timestamp"),
    "customer": ([(3, "Ona"), (None, "x")], "c_custkey long, c_name string"),
    "part": ([(1, "tin", "Brand#1", "SMALL", 9.5), (None, "tin", "Brand#1", "SMALL", 1.0)],
             "p_partkey long, p_name string, p_brand string, p_type string, p_retailprice double"),
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    for name, (rows, schema) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


@pytest.fixture
def written(monkeypatch):
    seen = []
    monkeypatch.setattr(queries, "materialized", lambda rows, *purpose: seen.append(rows.columns) or rows)
    return seen


def test_lines_travel_to_their_order_without_an_extra_round(spark, folder, capsys):
    rows = samples.order_rows(spark, folder)
    assert sorted(row.locator for row in rows.collect()) == ["97-1-1-1-0", "97-1-1-1-1"]
    rows.explain()
    plan = capsys.readouterr().out
    assert "REBALANCE" not in plan and "SortMergeJoin" in plan


@pytest.mark.parametrize("name", ["customer_first_spelling", "resolve_order_header"])
def test_header_queries_write_neither_cells_nor_lines(spark, folder, written, name):
    assert queries.QUERIES[name](spark, folder).count() == {"customer_first_spelling": 1, "resolve_order_header": 2}[name]
    assert len(written) == 1 and not {"cells", "line_key", "line_sku", "line_price"} & set(written[0])


def test_line_signature_writes_line_cells_only(spark, folder, written):
    assert {len(row.line_key) for row in queries.QUERIES["line_signature"](spark, folder).collect()} == {64}
    assert "line_price" in written[0] and not {"cells", "line_key"} & set(written[0])


@pytest.mark.parametrize("name", ["missing_order_reasons", "ledger_counter_check"])
def test_reports_write_no_signature(spark, folder, written, name):
    queries.QUERIES[name](spark, folder)
    assert written and not [columns for columns in written if "line_key" in columns]


def test_lines_without_signatures_meet_the_same_first_row(spark):
    cells = ["a", "2023-06-16", "Ona", "b2b", "Enviado", "CUP", "1", "7,5", "0"]
    kinds = [cells, [*cells[:7], "7.50", ""], [*cells[:7], "x", "0"], [*cells[:7], "x", "0"], [*cells[:6], "2", "7,5", "0"], ["", *cells[1:]], ["", *cells[1:]]]
    frame = spark.createDataFrame([(i, f"l{i}", row) for i, row in enumerate(kinds)], "ord bigint, locator string, cells array<string>")

    def found(drop):
        rows = orders.select_orders(frame, keep=lambda rows: materialized(rows.drop(*drop))).orderBy("ord")
        return [(r.outcome, r.line_key, [i.detail for i in r.issues]) for r in rows.collect()]

    again = found(["line_key"])
    assert again == found([])
    assert [row[0] for row in again] == ["accepted", "deduplicated", "rejected", "rejected", "accepted", "rejected", "rejected"]
