"""Stock pages as a stream: order, repetition and restarts against one full load."""

import itertools
import json

import pytest

from lonja.operators import stock
from lonja.sources import stock_pages
from lonja.streaming import stock_stream

SKUS = ["CUP", "JAR", "POT", "TIN", "LID"]


def seen(sku, warehouse, quantity, hour, reserved=0):
    return {"sku": sku, "warehouse": warehouse, "quantity": quantity, "reserved": reserved, "updated_at": f"2023-05-05T{hour:02d}:00:00Z"}


PAGES = [
    [seen("CUP", "N", 7, 5), seen("CUP", "S", 1, 4), seen("JAR", "N", 4, 3)],
    [seen("JAR", "N", 6, 4), seen("POT", "N", 2, 3), seen("TIN", "N", -2, 3)],
    [seen("POT", "N", 3, 3), seen("POT", "N", 9, 8), seen("CUP", "N", 7, 5), seen("OTHER", "N", 1, 1)],
]


def page(number, rows):
    return json.dumps({"data": rows, "meta": {"page": number, "per_page": 4, "total_records": 10, "total_pages": 3, "has_next": number < 3}})


def result(totals):
    return sorted((r.sku, r.stock_total, r.stock_status, str(r.stock_as_of), [i.code for i in r.issues]) for r in totals.collect())


@pytest.fixture
def skus(spark):
    return spark.createDataFrame([(s,) for s in SKUS], "sku string")


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 2, 0)])
def test_any_order_and_a_restart_between_batches(spark, tmp_path, skus, order):
    whole = tmp_path / "whole"
    whole.mkdir()
    for i, rows in enumerate(PAGES):
        (whole / f"p{i}.json").write_text(page(i + 1, rows))
    full = stock.stock_totals(stock.validate_observations(stock_pages.scan_snapshot(stock_pages.read_pages(spark, str(whole))), skus), skus)
    landing, root = tmp_path / "landing", str(tmp_path / "root")
    landing.mkdir()
    assert {r.stock_status for r in stock_stream.current_totals(spark, root, skus).collect()} == {"unknown"}
    for step, i in enumerate(order):
        (landing / f"step{step}.json").write_text(page(i + 1, PAGES[i]))
        if step == 1:  # the first page lands once more
            (landing / "again.json").write_text(page(order[0] + 1, PAGES[order[0]]))
        query = stock_stream.stream_stock(spark, str(landing), root, skus, files_per_batch=1, available_now=True)
        query.awaitTermination()
        assert query.exception() is None
    assert result(stock_stream.current_totals(spark, root, skus)) == result(full)
    assert result(full)[0][:3] == ("CUP", 8, "known") and {r[0] for r in result(full) if r[2] == "invalid"} == {"POT", "TIN"}
    assert len(stock_stream.versions(spark, f"{root}/state")) == stock_stream.KEPT


def test_a_batch_run_again_changes_nothing(spark, tmp_path, skus):
    """A batch whose state was written, but whose progress was not, is folded a second time."""
    fold = stock_stream.fold_into(str(tmp_path / "state"), skus)
    batches = [spark.createDataFrame([(page(i + 1, rows),)], "value string") for i, rows in enumerate(PAGES)]
    results = []
    for again in (False, True):
        for number, batch in enumerate(batches):
            for _ in range(1 + again):
                fold(batch, number + 10 * again)
        results.append(result(stock.totals_of_instants(stock_stream.read_state(spark, str(tmp_path / "state")), skus)))
    assert results[0] == results[1] and len(list(itertools.chain(*results))) == 2 * len(SKUS)
