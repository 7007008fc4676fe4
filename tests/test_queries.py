"""Every query runs and a cross-section equals its SQL at the smallest scale."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect
from checks.oracle import ORACLE
from lonja.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_keys():
    assert len(QUERIES) == 108 and set(ORACLE) == set(QUERIES)
    assert set(entry.queries()) >= set(QUERIES) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", [
    "scan_catalog_csv", "scan_tariff_exceptions", "stock_page_completeness", "clean_money", "clean_ean", "clean_date",
    "select_first_valid_candidate", "dedup_order_lines", "stock_totals", "merge_products", "publish_snapshot",
    "monthly_sales", "monthly_year_on_year", "margin_summary", "catalog_page", "fk_check", "bounded_excerpt", "source_fingerprint", "scan_orders_csv",
    "resolve_order_header", "stock_latest_version",
])
def test_equal_to_sql(spark, name):
    same, note = compare(spark, connect(FOLDER), FOLDER, name)
    assert same, note
