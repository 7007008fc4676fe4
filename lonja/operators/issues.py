"""Issues beside records, and the ledger made from them.

Record frames carry ``source, ord, locator, entity`` (where a record comes from) and ``issues`` (an array
of what was rejected, dropped, merged or corrected in it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lonja.vocabulary import (
    CATALOGUE,
    DEDUPLICATE,
    DROP,
    EXCERPT,
    FAIL,
    NORMALIZE,
    ORDER_COLUMNS,
    ORDERS,
    REJECT,
    STOCK_FIELDS,
    TARIFFS,
    WARN,
)

ISSUE = "struct<code:string,action:string,severity:string,field:string,detail:string>"
LEDGER = [
    "source", "record_locator", "entity_key", "reason_code", "field_name",
    "action", "severity", "detail", "raw_excerpt",
]


def severity(source: Column, action: Column, code: Column) -> Column:
    """Severity of an issue by its source and action."""
    return (
        F.when(action == DEDUPLICATE, "info")
        .when(action == FAIL, "error")
        .when(
            source == CATALOGUE,
            F.when(action == REJECT, "error").when(action == NORMALIZE, "info").otherwise("warning"),
        )
        .when(
            source == TARIFFS,
            F.when(action == WARN, F.when(code == "UNKNOWN_PRODUCT_SKU", "warning").otherwise("info"))
            .otherwise("error"),
        )
        .when(source == ORDERS, F.when(action == REJECT, "error").otherwise("warning"))
        .otherwise(F.when(action == WARN, "warning").otherwise("error"))
    )


def _fixed_severity(source: str, action: str) -> str | None:
    """The severity where source and action alone decide it."""
    if action == FAIL or action == REJECT:
        return "error"
    if action in (DEDUPLICATE, NORMALIZE):
        return "info"
    return None if source == TARIFFS else "warning"


def issue(
    source: str,
    code: str | Column,
    action: str,
    field: str | None = None,
    detail: str | Column | None = None,
) -> Column:
    code_column = F.lit(code) if isinstance(code, str) else code
    if detail is None:
        detail = code_column
    detail_column = F.lit(detail) if isinstance(detail, str) else detail
    fixed = _fixed_severity(source, action)
    level = F.lit(fixed) if fixed else severity(F.lit(source), F.lit(action), code_column)
    return F.struct(
        code_column.alias("code"),
        F.lit(action).alias("action"),
        level.alias("severity"),
        F.lit(field).cast("string").alias("field"),
        detail_column.alias("detail"),
    )


def issue_list(*entries: tuple[Column, Column]) -> Column:
    """Array of the issues whose condition holds, from ``(condition, issue)`` pairs."""
    return F.array_compact(F.array(*[F.when(condition, entry) for condition, entry in entries]))


def no_issues() -> Column:
    return F.array().cast(f"array<{ISSUE}>")


def explode_issues(records: DataFrame, excerpt: Column) -> DataFrame:
    """One ledger row per issue of each record."""
    return (
        records.where(F.size("issues") > 0)
        .select("source", "locator", "entity", excerpt.alias("raw_excerpt"), F.explode("issues").alias("i"))
        .select(
            "source",
            F.col("locator").alias("record_locator"),
            F.col("entity").alias("entity_key"),
            F.col("i.code").alias("reason_code"),
            F.coalesce("i.field", F.lit("")).alias("field_name"),
            F.col("i.action").alias("action"),
            F.col("i.severity").alias("severity"),
            F.col("i.detail").alias("detail"),
            "raw_excerpt",
        )
    )


def json_text(value: Column) -> Column:
    """The JSON literal of one string; control characters with small hexadecimal digits."""
    text = F.to_json(F.array(value))
    small = text
    for digit in "ABCDEF":
        # An odd number of backslashes begins an escape; an even one is text.
        small = F.regexp_replace(small, rf"(?<!\\)((?:\\\\)*\\u00[01]){digit}", f"$1{digit.lower()}")
    text = F.when(value.rlike("[\\x00-\\x1F]"), small).otherwise(text)
    escaped = F.substring(text, F.lit(2), F.length(text) - 2)
    # Most texts hold nothing to escape.
    return F.when(~value.rlike(r'[\x00-\x1F"\\]'), F.concat(F.lit('"'), value, F.lit('"'))).otherwise(escaped)


def cells_excerpt(cells: Column) -> Column:
    """Raw cells as a JSON list with ``, `` between the items, cut at the ledger width."""
    texts = F.transform(cells, json_text)
    return F.left(F.concat(F.lit("["), F.array_join(texts, ", "), F.lit("]")), F.lit(EXCERPT))


def order_excerpt(cells: Column) -> Column:
    """Cells of an order row without the customer; only their number where they are misaligned."""
    parts = []
    for position, name in enumerate(ORDER_COLUMNS):
        if name != "cliente":
            parts.append(
                F.concat(F.lit(f'"{name}": '), json_text(F.left(F.get(cells, position), F.lit(100))))
            )
    whole = F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))
    count = F.concat(F.lit('{"column_count": '), F.size(cells).cast("string"), F.lit("}"))
    return F.left(F.when(F.size(cells) == len(ORDER_COLUMNS), whole).otherwise(count), F.lit(EXCERPT))


def stock_excerpt(row: dict[str, Column]) -> Column:
    """The five named scalars of a stock observation, each cut at 70 characters."""
    parts = [
        F.concat(
            F.lit(f'"{name}": '),
            F.coalesce(json_text(F.left(row[name], F.lit(70))), F.lit("null")),
        )
        for name in STOCK_FIELDS
    ]
    return F.left(F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}")), F.lit(EXCERPT))


def source_counters(ledger: DataFrame) -> DataFrame:
    """Rejected and deduplicated records, warnings and dropped fields per source."""

    def records(action: str) -> Column:
        return F.count_distinct(F.when(F.col("action") == action, F.col("record_locator")))

    def entries(action: str) -> Column:
        return F.count(F.when(F.col("action") == action, 1))

    return ledger.groupBy("source").agg(
        records(REJECT).alias("rows_rejected"),
        records(DEDUPLICATE).alias("rows_deduplicated"),
        entries(WARN).alias("quality_warnings"),
        entries(DROP).alias("discarded_fields"),
    )

