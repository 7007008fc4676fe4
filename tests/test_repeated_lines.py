"""How repeated order lines are found, and where the ledger gets raw cells from."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lonja.functions import numbers
from lonja.functions.parser import parse
from lonja.operators import orders
from lonja.operators.issues import no_issues
from lonja.plans import queries, samples
from lonja.session import materialized

ORD = "ord bigint, locator string, cells array<string>"


def rows(spark):
    cells = [["a", "2023-06-16", "Ona", "b2b", "Enviado", "CUP", count, "7,5", ""] for count in ("1", "2", "1,0", "x", "x")]
    return spark.createDataFrame([(i, f"l{i}", row) for i, row in enumerate([*cells, ["", *cells[0][1:]]])], ORD)


def test_only_lines_with_a_repeated_hash_are_marked(spark):
    parsed = materialized(orders.parse_order_rows(rows(spark)))
    words = orders.repeated_words(parsed)
    marked = orders._mark_repeats(parsed, words)
    assert words.count() == 1 and sorted(r.ord for r in marked.where("_several").collect()) == [0, 2]


def test_a_full_table_of_bits_changes_nothing(spark, monkeypatch):
    def found():
        return [(r.outcome, r.line_key, [i.detail for i in r.issues]) for r in orders.select_orders(rows(spark)).orderBy("ord").collect()]

    plain = found()
    full = spark.range(orders.WORDS).select(F.col("id").cast("int").alias("_word"), F.lit(-1).cast("bigint").alias("_bits"))
    monkeypatch.setattr(orders, "repeated_words", lambda parsed: full)
    assert found() == plain
    assert [row[0] for row in plain] == ["accepted", "accepted", "deduplicated", "rejected", "rejected", "rejected"]


def test_rows_travel_to_their_order_only(spark, monkeypatch):
    met, lookup = [], orders.lookup
    monkeypatch.setattr(orders, "lookup", lambda rows, *rest: met.append(rest[1]) or lookup(rows, *rest))
    orders.select_orders(rows(spark))
    assert met == [["_group"]]


def test_cells_come_from_the_source_for_those_who_read_them(spark, tmp_path, capsys):
    tables = {
        "lineitem": ([(97, 1, 1, 1, 2.0, 0.1)] * 2, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber long, l_quantity double, l_discount double"),
        "orders": ([(97, 3, datetime(2023, 6, 16))], "o_orderkey long, o_custkey long, o_orderdate timestamp"),
        "customer": ([(3, "Ona")], "c_custkey long, c_name string"),
        "part": ([(1, "tin", "Brand#1", "SMALL", 9.5)], "p_partkey long, p_name string, p_brand string, p_type string, p_retailprice double"),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    source = samples.order_rows(spark, str(tmp_path))
    marked = source.select("ord", "locator", F.array(F.struct(F.lit("c").alias("code"))).alias("issues"))
    found = queries._with_cells(spark, str(tmp_path), marked)
    assert sorted(map(tuple, found.select("locator", "cells").collect())) == sorted(map(tuple, source.select("locator", "cells").collect()))
    assert queries._with_cells(spark, str(tmp_path), source.select("ord", "locator", no_issues().alias("issues"))).isEmpty()
    places = spark.createDataFrame([(Decimal(1), "x", ["c"])], "ord decimal(38,0), locator string, issues array<string>")
    queries._with_cells(spark, str(tmp_path), places).select("locator").explain()
    assert "Join" not in capsys.readouterr().out


@pytest.mark.parametrize("text, value", [("9" * 38 + "8", None), ("9223372036854775807", 2**63 - 1), ("0" * 20 + "5", 5), ("-12,0", -12)])
def test_whole_numbers_of_any_length(spark, text, value):
    frame = parse(spark.createDataFrame([(text,)], "v string"), {"q": (numbers.quantity, F.col("v"))})
    assert frame.first().q.value == value
