"""What the merge of lines moves: packed signatures, and new rows only to their new IDs."""

from decimal import Decimal as D

from pyspark.sql import functions as F

from lonja.operators import merge

SIGNATURES = ["00ff", "ab", "AB", "a", "", "ab\n", "cd\x00", "ñ", None]


def test_packed_texts_come_back(spark):
    rows = spark.createDataFrame([(text,) for text in SIGNATURES], "k string").withColumn("p", merge._packed(F.col("k")))
    found = rows.select("k", merge._unpacked(F.col("p")).alias("again"), F.octet_length("p").alias("n")).collect()
    assert [r.again for r in found] == SIGNATURES and [r.n for r in found][:3] == [3, 2, 3]


def test_only_new_lines_travel_to_their_ids(spark, monkeypatch):
    met, lookup = [], merge.lookup
    monkeypatch.setattr(merge, "lookup", lambda rows, *rest: met.append((rest[1], rows)) or lookup(rows, *rest))
    lines = spark.createDataFrame(
        [("o", key, "CUP", 1, D("7.5"), D(0), f"l{i}") for i, key in enumerate(["00ff", "ab", "ñ"])],
        "source_order_id string, line_key string, sku string, quantity bigint, unit_price decimal(18,4), discount decimal(9,6), source_locator string")
    previous = spark.createDataFrame([(4, 5, "00ff"), (7, 5, "gone")], "id bigint, order_id bigint, line_key string")
    known = spark.createDataFrame([(5, "o")], "id bigint, source_order_id string")
    products = spark.createDataFrame([(9, "CUP")], "id bigint, sku string")
    rows = merge.merge_order_lines(previous, lines, known, products, "r").collect()
    assert sorted((r.id, r.line_key, r.source_locator) for r in rows)[0] == (4, "00ff", "l0")
    assert sorted(r.id for r in rows) == [4, 8, 9] and {r.line_key for r in rows} == {"00ff", "ab", "ñ"}
    by_line = [rows for key, rows in met if key == ["order_id", "line_key"]]
    assert dict(by_line[0].dtypes)["line_key"] == "binary" and [rows.count() for rows in by_line] == [3, 2]
