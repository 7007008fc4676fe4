"""Landed pages of the stock source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lonja.operators.issues import stock_excerpt
from lonja.vocabulary import STOCK, STOCK_FIELDS

TEXT_FIELDS = ["sku", "warehouse", "updated_at"]
NUMBER = "\x01"
EXPONENT = r"^(-?)([0-9]+)(?:\.([0-9]+))?[eE]([-+]?[0-9]+)$"
# Ledger texts.
WRONG_TYPE = "[tipo inválido]"
WRONG_RECORD = "Tipo de registro inválido: "
FILE_SHIFT = 32


def read_pages(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per page: ``data`` (array of record texts) and ``meta`` (text); numbers stay as written.

    A page is a file of its own, or a line of one with ``multi_line=False``. Spark's JSON reader rewrites
    numbers (``1e3`` to ``1000.0``), so those of the records are made marked texts before they are parsed.
    """
    pages = spark.read.text(path, wholetext=multi_line)
    return parsed_pages(pages if multi_line else pages.where(F.trim("value") != ""))


def parsed_pages(pages: DataFrame) -> DataFrame:
    """``data`` and ``meta`` of page texts (``value``), whether read at once or as a stream."""
    return pages.select(
        F.from_json(_quoted_numbers(F.col("value")), "data array<string>")["data"].alias("data"),
        F.try_parse_json(F.from_json("value", "meta string")["meta"]).alias("meta"),
    )


def _quoted_numbers(text: Column) -> Column:
    """JSON text with each number as a text that begins with ``NUMBER``.

    Control characters never occur in valid JSON text, so two of them can mark the places meanwhile.
    """
    marked = F.regexp_replace(text, r'("(?:[^"\\]|\\.)*+")|(-?[0-9][0-9.eE+-]*+)', "$1\x01$2\x02")
    marked = F.replace(marked, F.lit("\x01\x02"), F.lit(""))
    return F.replace(F.replace(marked, F.lit("\x01"), F.lit('"\\u0001')), F.lit("\x02"), F.lit('"'))


def _meta(name: str, type_name: str) -> Column:
    """A value of the page's metadata, NULL unless it has the JSON type asked for."""
    value = F.try_variant_get("meta", f"$.{name}", "variant")
    kind = {"bigint": "BIGINT", "boolean": "BOOLEAN"}[type_name]
    return F.when(F.schema_of_variant(value) == kind, F.try_variant_get("meta", f"$.{name}", type_name))


def with_metadata(pages: DataFrame) -> DataFrame:
    return pages.select(
        "data",
        _meta("page", "bigint").alias("page"),
        _meta("per_page", "bigint").alias("per_page"),
        _meta("total_records", "bigint").alias("total_records"),
        _meta("total_pages", "bigint").alias("total_pages"),
        _meta("has_next", "boolean").alias("has_next"),
    )


def page_problems(pages: DataFrame, per_page: int) -> DataFrame:
    """What makes the snapshot incomplete: one row per problem, none if it may be used.

    Every page must agree with its own metadata, and together they must be all pages of one snapshot.
    """
    rows = with_metadata(pages).withColumn("_print", F.sha2(F.array_join("data", "\x1e"), 256))
    total, page = F.col("total_records"), F.col("page")
    count = F.ceil(total / per_page).cast("bigint")
    expected = F.least(F.lit(per_page), F.greatest(F.lit(0), total - (page - 1) * per_page))
    good = (
        (total >= 0)
        & (page >= 1)
        & (F.col("per_page") == per_page)
        & (F.col("total_pages") == count)
        & (page <= F.greatest(F.lit(1), count))
        & (F.col("has_next") == (page < count))
        & (F.size("data") == expected)
    )
    bad_pages = rows.where(~F.coalesce(good, F.lit(False))).select(
        F.concat(F.lit("page:"), F.coalesce(page.cast("string"), F.lit("?"))).alias("locator"),
        F.lit("inconsistent page").alias("problem"),
    )
    repeated = (
        rows.groupBy("_print").agg(F.count("*").alias("n"), F.max("page").alias("page")).where("n > 1")
        .select(F.concat(F.lit("page:"), "page").alias("locator"), F.lit("repeated page").alias("problem"))
    )
    whole = rows.agg(
        F.min("total_records").alias("low"),
        F.max("total_records").alias("high"),
        F.coalesce(F.sum(F.size("data")), F.lit(0)).alias("n"),
        F.count("*").alias("pages"),
        F.count_distinct("page").alias("distinct_pages"),
    ).where(
        ~F.coalesce(
            (F.col("low") == F.col("high"))
            & (F.col("n") == F.col("low"))
            & (F.col("pages") == F.col("distinct_pages")),
            F.lit(False),
        )
    ).select(F.lit("snapshot").alias("locator"), F.lit("incomplete snapshot").alias("problem"))
    return bad_pages.unionByName(repeated).unionByName(whole)


def scan_snapshot(pages: DataFrame) -> DataFrame:
    """Observations as text: ``ord, locator``, the five fields and ``excerpt``; a field of a wrong type is NULL.

    Numbers are taken as the record has them, not as a number type would show them. ``excerpt`` shows the
    five fields for the ledger, or the type of a record that is no object.
    """
    rows = with_metadata(pages).select("page", F.posexplode("data").alias("_i", "_text"))
    record = F.try_parse_json("_text")
    written = F.from_json("_text", ", ".join(f"{name} string" for name in STOCK_FIELDS))
    kinds = {
        f"_kind_{name}": F.schema_of_variant(F.try_variant_get("_record", f"$.{name}", "variant")) for name in STOCK_FIELDS
    }
    rows = rows.withColumns({"_record": record, "_written": written}).withColumns(
        {**kinds, "_kind": F.schema_of_variant("_record")}
    )

    def number(value: Column) -> Column:
        return F.when(value.startswith(NUMBER), _plain_number(F.substring(value, F.lit(2), F.length(value))))

    def field(name: str) -> Column:
        kind, value = F.col(f"_kind_{name}"), F.col(f"_written.{name}")
        text = F.when((kind == "STRING") & ~value.startswith(NUMBER), value)
        return text if name in TEXT_FIELDS else F.coalesce(text, number(value))

    def shown(name: str) -> Column:
        kind, value = F.col(f"_kind_{name}"), F.col(f"_written.{name}")
        return (
            F.when(kind.isNull() | (kind == "VOID"), None)
            .when(kind == "BOOLEAN", F.initcap(value))
            .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), WRONG_TYPE)
            .otherwise(F.coalesce(number(value), value))
        )

    kind = F.col("_kind")
    type_name = (
        F.when(F.col("_text").isNull(), "NoneType").when(kind.startswith("ARRAY"), "list").when(kind == "BOOLEAN", "bool")
        .when(F.col("_text").rlike(f"^{NUMBER}-?[0-9]+$"), "int").when(F.col("_text").startswith(NUMBER), "Decimal")
        .otherwise("str")
    )
    excerpt = F.when(kind.startswith("OBJECT"), stock_excerpt({name: shown(name) for name in STOCK_FIELDS})).otherwise(
        F.concat(F.lit(WRONG_RECORD), type_name)
    )
    row = F.col("_i") + 1
    return rows.select(
        F.lit(STOCK).alias("source"),
        (F.shiftleft("page", FILE_SHIFT) + row).alias("ord"),
        F.concat(F.lit("page:"), "page", F.lit("/row:"), row).alias("locator"),
        *[field(name).alias(name) for name in STOCK_FIELDS],
        excerpt.alias("excerpt"),
    )


def _plain_number(text: Column) -> Column:
    """A JSON number with an exponent as a decimal type prints it; any other as it is written."""
    sign, places = F.regexp_extract(text, EXPONENT, 1), F.length(F.regexp_extract(text, EXPONENT, 3))
    written = F.concat(F.regexp_extract(text, EXPONENT, 2), F.regexp_extract(text, EXPONENT, 3))
    digits = F.regexp_replace(written, "^0+(?=.)", "")
    shift = F.regexp_replace(F.regexp_extract(text, EXPONENT, 4), r"^\+", "").try_cast("int") - places
    size = F.length(digits)
    power = size - 1 + shift
    padded = F.lpad(digits, F.greatest(size, 1 - shift), F.lit("0"))
    cut = F.length(padded) + shift
    plain = F.concat(F.substring(padded, F.lit(1), cut), F.lit("."), F.substring(padded, cut + 1, -shift))
    rest = F.substring(digits, F.lit(2), size)
    scientific = F.concat(
        F.substring(digits, 1, 1), F.when(size > 1, F.concat(F.lit("."), rest)).otherwise(""), F.lit("E"),
        F.when(power >= 0, "+").otherwise(""), power.cast("string"),
    )
    number = F.when((shift > 0) | (power < -6), scientific).when(shift == 0, digits).otherwise(plain)
    return F.when(text.rlike(EXPONENT) & shift.isNotNull(), F.concat(sign, number)).otherwise(text)


def changed_since(observations: DataFrame, since: str) -> DataFrame:
    """Observations updated at or after a time; an unreadable time filters nothing."""
    limit = F.lit(since).try_cast("timestamp")
    stamp = F.col("updated_at").try_cast("timestamp")
    return observations.where(F.coalesce(stamp >= limit, limit.isNull()))
