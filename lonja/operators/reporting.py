"""Run counters, the frozen run summary and the alert decision."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lonja.operators import metrics
from lonja.vocabulary import BUSINESS_ZONE, DROP, REJECT, SUMMARY_VERSION, WARN


def _entries(action: str) -> Column:
    return F.coalesce(F.sum(F.size(F.filter("issues", lambda i: i["action"] == action))), F.lit(0))


def record_counters(records: DataFrame) -> DataFrame:
    """Read, accepted, rejected and deduplicated rows, warnings and dropped fields of one source."""

    def rows(outcome: str) -> Column:
        return F.count(F.when(F.col("outcome") == outcome, 1))

    return records.agg(
        F.count("*").alias("rows_read"),
        rows("accepted").alias("rows_accepted"),
        rows("rejected").alias("rows_rejected"),
        rows("deduplicated").alias("rows_deduplicated"),
        _entries(WARN).alias("quality_warnings"),
        _entries(DROP).alias("discarded_fields"),
    )


def issue_counters(records: DataFrame) -> DataFrame:
    """Warnings and dropped fields of issues that belong to no row (tariffs, totals, conflicts)."""
    return records.agg(
        _entries(WARN).alias("extra_warnings"), _entries(DROP).alias("extra_fields")
    )


def add_warnings(counters: DataFrame, extra: DataFrame) -> DataFrame:
    """Counters with the warnings of a second one-row frame added."""
    return counters.withColumns(
        {
            "quality_warnings": F.col("quality_warnings") + extra.select("extra_warnings").scalar(),
            "discarded_fields": F.col("discarded_fields") + extra.select("extra_fields").scalar(),
        }
    )


def catalog_counters(records: DataFrame, tariff_issues: DataFrame) -> DataFrame:
    """Counters of the catalogue, which include the warnings of its tariffs."""
    counters = add_warnings(record_counters(records), issue_counters(tariff_issues))
    return counters.withColumn("products_loaded", F.col("rows_accepted"))


def orders_counters(records: DataFrame, headers: DataFrame, historical_issues: DataFrame) -> DataFrame:
    created = issue_counters(historical_issues)
    orders = headers.agg(
        F.count("*").alias("loaded"), F.count(F.when(F.col("has_rejected_lines"), 1)).alias("partial")
    )
    return add_warnings(record_counters(records), created).withColumns(
        {
            "orders_loaded": orders.select("loaded").scalar(),
            "partial_orders": orders.select("partial").scalar(),
            "historical_products_created": created.select("extra_warnings").scalar(),
        }
    )


def stock_counters(records: DataFrame, totals: DataFrame, conflicts: DataFrame) -> DataFrame:
    counters = add_warnings(record_counters(records), issue_counters(totals))
    return add_warnings(counters, issue_counters(conflicts))


def reconciles() -> Column:
    """The invariant of every source: each row read has exactly one outcome."""
    return F.col("rows_read") == F.col("rows_accepted") + F.col("rows_rejected") + F.col("rows_deduplicated")


def rejections_by_reason(ledger: DataFrame) -> DataFrame:
    return (
        ledger.where(F.col("action") == REJECT)
        .groupBy("source", "reason_code")
        .agg(F.count_distinct("record_locator").alias("rows"))
        .orderBy("source", "reason_code")
    )


def missing_order_reasons(selected: DataFrame, headers: DataFrame) -> DataFrame:
    """Order IDs of the source that were not loaded, with the distinct reasons in their issues."""
    reasons = (
        selected.where(F.col("entity").isNotNull())
        .select(F.col("entity").alias("source_order_id"), F.explode_outer("issues").alias("i"))
        .groupBy("source_order_id")
        .agg(F.array_sort(F.collect_set("i.code")).alias("reasons"))
    )
    return reasons.join(headers.select("source_order_id"), "source_order_id", "left_anti")


def alert_required(rejected: Column, low_stock: Column, threshold: int) -> Column:
    """Strictly more rejected rows than the threshold, or any low stock."""
    if threshold < 0:
        raise ValueError("threshold must not be negative")
    return (rejected > threshold) | (low_stock > 0)


def chart_series(monthly: DataFrame) -> DataFrame:
    return monthly.select(
        "month",
        F.date_format("month", "MM/yyyy").alias("label"),
        F.col("revenue").cast("string").alias("revenue"),
        "units",
    ).orderBy("month")


def run_summary(
    run: dict,
    counters: dict[str, DataFrame],
    ledger: DataFrame,
    eligible: DataFrame,
    products: DataFrame,
    as_of: date,
    threshold: int,
    zone: str = BUSINESS_ZONE,
) -> DataFrame:
    """One nested row that describes a completed run, frozen with it.

    The reasons are at most one per code and source. Low-stock products are counted here; the complete list
    is the ``low_stock`` table published with the run, whatever its length.
    """
    spark = ledger.sparkSession
    reasons = rejections_by_reason(ledger).agg(
        F.array_sort(F.collect_list(F.struct("source", "reason_code", "rows"))).alias("x")
    )
    low_count = metrics.low_stock_products(eligible, products, as_of).agg(F.count("*")).scalar()
    revenue = metrics.previous_month_sales(eligible, as_of).select(F.col("revenue").cast("string"))
    row = spark.range(1).select(
        F.lit(SUMMARY_VERSION).alias("schema_version"),
        F.lit(run["run_id"]).alias("run_id"),
        F.lit("completed").alias("status"),
        F.lit(run["finished_at"]).alias("finished_at"),
        F.lit(run["rules_version"]).alias("rules_version"),
        F.lit(as_of.isoformat()).alias("as_of"),
        F.lit(zone).alias("business_timezone"),
        F.struct(
            *[frame.select(F.struct(*frame.columns)).scalar().alias(name) for name, frame in counters.items()]
        ).alias("rows"),
        reasons.scalar().alias("rejected_by_reason"),
        revenue.scalar().alias("revenue_previous_month"),
        F.date_format(F.add_months(F.trunc(F.lit(as_of), "month"), -1), "yyyy-MM").alias("previous_month"),
        F.lit(None).cast("string").alias("currency"),
        F.lit("unconfirmed").alias("tax_basis"),
        low_count.alias("low_stock_count"),
        F.lit(threshold).alias("rejection_threshold"),
    )
    rejected = F.lit(0).cast("bigint")
    for name in counters:
        rejected = rejected + F.col(f"rows.{name}.rows_rejected")
    row = row.withColumns(
        {
            "products_loaded": F.col("rows.catalog_csv.products_loaded"),
            "rows_rejected": rejected,
        }
    )
    return row.withColumn(
        "alert_required", alert_required(F.col("rows_rejected"), F.col("low_stock_count"), threshold)
    )


def append_history(history: DataFrame, summaries: DataFrame) -> DataFrame:
    """The summaries whose run is not in the history yet."""
    return summaries.join(history.select("run_id"), "run_id", "left_anti")


def pending_mails(history: DataFrame) -> DataFrame:
    """Runs that need an alert mail and have none sent."""
    return history.where(F.col("alert_required") & F.col("email_sent_at").isNull())
