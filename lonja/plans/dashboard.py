"""Everything the sales panel shows, as DataFrames over one published snapshot."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from lonja.operators import browse, metrics, reporting
from lonja.session import materialized
from lonja.sources.snapshots import SnapshotStore
from lonja.vocabulary import SALES_START


def dashboard(
    store: SnapshotStore, as_of: date, query: str = "", category: str = "", page: int = 1
) -> dict[str, DataFrame]:
    """Search text, category and page only affect the catalogue, never the metrics."""
    run_id = store.current_run()
    products, orders, lines = (
        store.read(name, run_id) for name in ("products", "orders", "order_lines")
    )
    start = date.fromisoformat(SALES_START)
    # Every metric reads the same rows, from the shared folder.
    eligible = materialized(metrics.eligible_lines(orders, lines, products, start, as_of), "eligible")
    shown, _, _, _ = browse.catalog_page(products, query, category, page)
    monthly = metrics.monthly_sales(eligible, start, as_of)
    frames = {
        "publication": browse.latest_publication(store.runs()),
        "summary": metrics.sales_summary(eligible),
        "previous_month": metrics.previous_month_sales(eligible, as_of),
        "monthly": monthly,
        "chart": reporting.chart_series(monthly),
        "channels": metrics.sales_by_channel(eligible),
        "categories": metrics.sales_by_category(eligible),
        "top_products": metrics.top_products(eligible),
        "margin": metrics.margin_summary(eligible),
        "low_stock": metrics.low_stock_products(eligible, products, as_of),
        "catalogue": shown,
        "catalogue_categories": browse.catalog_categories(products),
    }
    if run_id is not None:
        frames["conflicting_skus"] = browse.conflicting_skus(store.ledger(run_id), products)
    return frames
