"""Order history: one header per order, validated lines, line signatures and duplicates."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lonja.functions import dates, numbers, text
from lonja.functions.parser import counted, parse
from lonja.operators.grouping import attach_group, lookup
from lonja.operators.issues import ISSUE, issue, issue_list, json_text
from lonja.session import materialized
from lonja.vocabulary import (
    BUSINESS_ZONE,
    DEDUPLICATE,
    DETAIL,
    LINE_KEY_VERSION,
    MAX_CUSTOMER,
    ORDER_COLUMNS,
    ORDERS,
    REJECT,
    RETURNED,
    WARN,
)

HEADER_FIELDS = {
    "fecha_pedido": "date",
    "cliente": "customer",
    "canal": "channel",
    "estado": "status",
}
# The codes a header field can bring, in the order the ledger lists them.
FIELD_CODES = {
    "fecha_pedido": ["INVALID_DATE", "INVALID_ORDER_HEADER"],
    "cliente": ["INVALID_ORDER_HEADER"],
    "canal": ["UNKNOWN_CHANNEL"],
    "estado": ["UNKNOWN_ORDER_STATUS"],
}


def parse_order_rows(scanned: DataFrame, zone: str = BUSINESS_ZONE) -> DataFrame:
    """Parse rows of raw cells (``ord, locator, cells``).

    ``entity`` is the order ID (NULL if unusable); ``grouped`` marks the rows that take part in their
    order. Header cells become ``h_date, h_customer, h_channel, h_status``; line cells keep their codes.
    ``line_key`` is the signature of the line cells of a grouped row where all of them are usable.
    """
    cells = F.col("cells")

    def cell(name: str) -> Column:
        return F.get(cells, ORDER_COLUMNS.index(name))

    rows = parse(
        scanned,
        {
            "_id": (text.identifier, cell("id_pedido")),
            "_date": (dates.date_in(zone), cell("fecha_pedido")),
            "_customer": (text.clean_text, cell("cliente")),
            "_channel": (text.channel, cell("canal")),
            "_status": (text.status, cell("estado")),
            "line_sku": (text.identifier, cell("sku")),
            "line_quantity": (numbers.quantity, cell("cantidad")),
            "line_price": (numbers.money, cell("precio_unitario")),
            "line_discount": (numbers.discount, cell("descuento_linea")),
        },
    )
    # A clean text needs no second cleaning for its key.
    rows = parse(rows, {"_customer_key": (text.folded, F.col("_customer"))})
    aligned = F.size(cells) == len(ORDER_COLUMNS)
    early = F.year("_date.value") < 1000
    long_name = F.char_length("_customer") > MAX_CUSTOMER
    issues = issue_list(
        (F.col("_id.value").isNull(), issue(ORDERS, "INVALID_IDENTIFIER", REJECT, "id_pedido")),
        (~aligned, issue(ORDERS, "INVALID_COLUMN_COUNT", REJECT)),
    )
    return rows.select(
        F.lit(ORDERS).alias("source"),
        "ord",
        "locator",
        "cells",
        F.col("_id.value").alias("entity"),
        (aligned & F.col("_id.value").isNotNull()).alias("grouped"),
        F.struct(
            F.when(~early, F.col("_date.value")).alias("value"),
            F.when(early, "INVALID_ORDER_HEADER").otherwise(F.col("_date.code")).alias("code"),
        ).alias("h_date"),
        F.struct(
            F.when(~long_name, F.col("_customer")).alias("value"),
            F.when(long_name, "INVALID_ORDER_HEADER").alias("code"),
            F.when(~long_name, F.col("_customer_key")).alias("key"),
        ).alias("h_customer"),
        F.col("_channel").alias("h_channel"),
        F.col("_status").alias("h_status"),
        "line_sku",
        "line_quantity",
        "line_price",
        "line_discount",
        issues.alias("issues"),
    ).withColumn("line_key", _line_key())


def _usable_line() -> Column:
    """Whether the line cells can be used, whatever the header says."""
    required = [F.col(f"line_{name}.value").isNotNull() for name in ("sku", "quantity", "price")]
    return required[0] & required[1] & required[2] & F.col("line_discount.code").isNull()


def _discount() -> Column:
    return F.coalesce(F.col("line_discount.value"), F.lit(0).cast(numbers.RATIO))


def _signature(order_id: Column) -> Column:
    return line_signature(
        order_id, F.col("line_sku.value"), F.col("line_quantity.value"), F.col("line_price.value"), _discount()
    )


def _line_key() -> Column:
    """The signature of the line cells of a grouped row where all of them are usable."""
    return F.when(F.col("grouped") & _usable_line(), _signature(F.col("entity")))


def header_aggregates() -> list[Column]:
    """What a group of rows must know to settle its header."""
    grouped = F.col("grouped")
    aggregates = []
    for field, name in HEADER_FIELDS.items():
        found = F.col(f"h_{name}")
        key = found["key"] if name == "customer" else found["value"]
        key = F.when(grouped, key)
        aggregates += [F.min(key).alias(f"g_{name}"), (F.max(key) != F.min(key)).alias(f"g_{name}_differs")]
        if name == "customer":
            aggregates.append(
                F.min_by(found["value"], F.when(key.isNotNull(), F.col("ord"))).alias("g_customer_label")
            )
        for code in FIELD_CODES[field]:
            aggregates.append(
                F.max(F.coalesce(grouped & (found["code"] == code), F.lit(False))).alias(f"g_{name}_{code}")
            )
    return aggregates


def header_errors() -> Column:
    """Sorted array of ``struct<code, field>`` for the whole order."""
    entries = []
    for field, name in HEADER_FIELDS.items():
        found = [(F.col(f"g_{name}_{code}"), code) for code in FIELD_CODES[field]]
        found.append((F.coalesce(F.col(f"g_{name}_differs"), F.lit(False)), "CONFLICTING_ORDER_HEADER"))
        if name != "customer":
            missing = "MISSING_ORDER_DATE" if name == "date" else "MISSING_REQUIRED_FIELD"
            found.append((F.col(f"g_{name}").isNull(), missing))
        entries += [
            F.when(condition, F.struct(F.lit(code).alias("code"), F.lit(field).alias("field")))
            for condition, code in found
        ]
    return F.array_sort(F.array_compact(F.array(*entries)))


def order_groups(rows: DataFrame) -> DataFrame:
    """One row per order with its settled values and errors, judged here once rather than on each of its rows."""
    groups = rows.where(F.col("entity").isNotNull()).groupBy(_order_group().alias("_group")).agg(*header_aggregates())
    found = F.when(F.col("g_customer").isNotNull(), F.lit(True))
    return groups.select(
        "_group", "g_date", found.alias("g_customer"), "g_customer_label", "g_channel", "g_status", header_errors().alias("_errors")
    )


def _order_group() -> Column:
    """The order of a row; a row without a usable order ID is a group of its own."""
    return F.coalesce("entity", F.concat(F.lit("\x00"), "locator"))


def _settled_order() -> Column:
    """The order whose header a row takes; a row without a usable order ID finds none, whatever its number here."""
    return F.coalesce("entity", F.concat(F.lit("\x00"), F.col("ord").cast("string")))


def resolve_headers(rows: DataFrame) -> DataFrame:
    """Settle date, customer, channel and status per order and attach them to its rows.

    Any error rejects all rows of the order, with every error reported on every row. Else a blank cell
    takes the value of its order, with one warning per blank cell.
    """
    rows = counted(rows.withColumn("_group", _settled_order()))
    return settle_headers(lookup(_blank_cells(rows), order_groups(rows), ["_group"]))


def _blank_cells(rows: DataFrame) -> DataFrame:
    """Whether each header cell is blank, in place of the cell: all that a row needs of it beside its order."""
    blank = {}
    for name in HEADER_FIELDS.values():
        found = F.col(f"h_{name}")
        blank[f"blank_{name}"] = found["value"].isNull() & found["code"].isNull()
    return rows.withColumns(blank).drop(*[f"h_{name}" for name in HEADER_FIELDS.values()])


def settle_headers(rows: DataFrame) -> DataFrame:
    """The same for rows that carry the row of their order and the marks of their blank cells already."""
    none = F.array().cast("array<struct<code:string,field:string>>")
    rows = rows.withColumn("_errors", F.coalesce("_errors", none))
    bad = F.col("grouped") & (F.size("_errors") > 0)
    rows = rows.withColumn("header_ok", F.col("grouped") & (F.size("_errors") == 0))
    per_error = F.transform(
        F.when(bad, F.col("_errors")).otherwise(none),
        lambda e: F.struct(
            e["code"].alias("code"),
            F.lit(REJECT).alias("action"),
            F.lit("error").alias("severity"),
            e["field"].alias("field"),
            e["code"].alias("detail"),
        ),
    ).cast(f"array<{ISSUE}>")
    inherited = []
    for field, name in HEADER_FIELDS.items():
        inherited.append(
            (
                F.col("header_ok") & F.col(f"blank_{name}") & F.col(f"g_{name}").isNotNull(),
                issue(ORDERS, "HEADER_VALUE_INHERITED", WARN, field),
            )
        )
    settled = {
        "order_date": F.col("g_date"),
        "customer": F.col("g_customer_label"),
        "channel": F.col("g_channel"),
        "status": F.col("g_status"),
    }
    return rows.withColumns(
        {
            **{name: F.when(F.col("header_ok"), value) for name, value in settled.items()},
            "issues": F.concat("issues", per_error, issue_list(*inherited)),
        }
    ).drop(*[c for c in rows.columns if c.startswith(("g_", "blank_"))], "_errors", "_group")


def validate_lines(rows: DataFrame) -> DataFrame:
    """Check the line cells of rows whose header is settled; ``line_ok`` marks the good ones.

    A missing discount counts as 0 with a warning; a negative quantity is only good in a returned order.
    """
    quantity, discount = F.col("line_quantity"), F.col("line_discount")
    required = F.lit("MISSING_REQUIRED_FIELD")
    codes = {
        "sku": F.col("line_sku.code"),
        "cantidad": F.coalesce(
            quantity["code"],
            F.when(quantity["value"].isNull(), required),
            F.when((quantity["value"] < 0) & (F.col("status") != RETURNED), "INVALID_QUANTITY_FOR_STATUS"),
        ),
        "precio_unitario": F.coalesce(
            F.col("line_price.code"), F.when(F.col("line_price.value").isNull(), required)
        ),
        "descuento_linea": discount["code"],
    }
    rows = rows.withColumns({f"_{name}": F.when(F.col("header_ok"), code) for name, code in codes.items()})
    good = F.col("header_ok")
    for name in codes:
        good = good & F.col(f"_{name}").isNull()
    no_discount = discount["value"].isNull() & discount["code"].isNull()
    added = issue_list(
        *[(F.col(f"_{name}").isNotNull(), issue(ORDERS, F.col(f"_{name}"), REJECT, name)) for name in codes],
        (
            F.col("header_ok") & no_discount,
            issue(ORDERS, "MISSING_DISCOUNT_ASSUMED_ZERO", WARN, "descuento_linea"),
        ),
    )
    return rows.withColumns(
        {
            "line_ok": good,
            "sku": F.col("line_sku.value"),
            "quantity": quantity["value"],
            "unit_price": F.col("line_price.value"),
            "discount": _discount(),
            "issues": F.concat("issues", added),
        }
    ).drop(*[f"_{name}" for name in codes], "line_sku", "line_quantity", "line_price", "line_discount")


def line_signature(
    order_id: Column, sku: Column, quantity: Column, price: Column, discount: Column
) -> Column:
    """SHA-256 over validated values; independent of row position, header and number format."""
    text_ = F.concat(
        F.lit(f'["{LINE_KEY_VERSION}",'),
        json_text(order_id), F.lit(","), json_text(sku), F.lit(","),
        quantity.cast("string"),
        F.lit(',"'), price.cast(numbers.MONEY).cast("string"),
        F.lit('","'), discount.cast(numbers.RATIO).cast("string"), F.lit('"]'),
    )
    return F.sha2(text_, 256)


def _line_group() -> Column:
    """The line of a row within its order; unusable lines of an order are one group."""
    return F.coalesce("line_key", F.lit(""))


def _first_line() -> Column:
    return F.min_by(F.struct("ord", "locator"), "ord").alias("_kept")


def deduplicate_lines(rows: DataFrame) -> DataFrame:
    """Keep the first line per signature and order; ``outcome`` is set for every row of the source."""
    rows = rows.withColumns({"_group": _order_group(), "_line": _line_group()})
    return settle_lines(attach_group(rows, ["_group", "_line"], _first_line()))


def settle_lines(rows: DataFrame) -> DataFrame:
    """The same for rows that carry the first row of their line already; without one they are alone.

    Lines with one signature share their order, so either all of them are good or none is.
    """
    first = F.col("line_ok") & (F.col("ord") == F.coalesce("_kept.ord", "ord"))
    repeat = F.col("line_ok") & ~first
    entry = issue(
        ORDERS, "DUPLICATE_ORDER_LINE", DEDUPLICATE, None,
        F.concat(F.lit(DETAIL["kept_line"]), F.col("_kept.locator")),
    )
    return rows.withColumns(
        {
            "line_key": F.when(F.col("line_ok"), F.col("line_key")),
            "outcome": F.when(first, "accepted").when(repeat, "deduplicated").otherwise("rejected"),
            "issues": F.concat("issues", issue_list((repeat, entry))),
        }
    ).drop("_group", "_line", "_kept")


# Words of 64 bits in the table that tells which line hashes may occur several times: 2 MB of bits, whatever the input.
WORDS = 1 << 18


def repeated_words(parsed: DataFrame) -> DataFrame:
    """Bits of the short hashes that several lines have, in at most ``WORDS`` rows ``_word, _bits``."""
    counts = parsed.select(_line_values()["_line_hash"].alias("_hash")).where("_hash IS NOT NULL").groupBy("_hash").count()
    word, bit = _place(F.col("_hash"))
    return counts.where("count > 1").groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits"))


def _place(line_hash: Column) -> tuple[Column, Column]:
    """Word and bit of a hash."""
    high = F.shiftrightunsigned(line_hash, 6)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), line_hash.bitwiseAND(63).cast("int"))
    return high.bitwiseAND(WORDS - 1).cast("int"), bit


def _mark_repeats(rows: DataFrame, words: DataFrame) -> DataFrame:
    """Rows with ``_hash`` and ``_several``: whether their line may be a repeated one. Equal lines have equal hashes."""
    rows = rows.withColumn("_hash", _line_values()["_line_hash"])
    word, bit = _place(F.col("_hash"))
    several = F.coalesce(F.col("_bits").bitwiseAND(bit) != 0, F.lit(False))
    # At most WORDS rows of two numbers.
    marked = rows.withColumn("_word", word).join(F.broadcast(words), "_word", "left")
    return marked.withColumn("_several", several).drop("_word", "_bits")


def repeated_lines(marked: DataFrame) -> DataFrame:
    """The first row of every line that several rows have: ``_line_*`` (what its signature is made of), ``_kept``."""
    values = [value.alias(name) for name, value in _line_values().items()]
    lines = marked.where("_several").groupBy(*values).agg(_first_line(), F.count(F.lit(1)).alias("_n"))
    return lines.where("_n > 1").drop("_n")


def _line_values() -> dict[str, Column]:
    """What the signature of a line is made of, and a hash of it, which is NULL where a row has no signature."""
    values = {
        "_line_order": F.col("entity"), "_line_sku": F.col("line_sku.value"), "_line_quantity": F.col("line_quantity.value"),
        "_line_price": F.col("line_price.value"), "_line_discount": _discount(),
    }
    return {"_line_hash": F.when(F.col("grouped") & _usable_line(), F.xxhash64(*values.values())), **values}


def _with_repeats(marked: DataFrame, repeated: DataFrame) -> DataFrame:
    """Rows with the first row of their line, if it is a repeated one.

    Only rows whose line may be one meet the repeated lines; the others need no shuffle for that.
    """
    values = _line_values()
    same = F.col("_hash") == F.col("_line_hash")
    values.pop("_line_hash")
    for name, value in values.items():
        same = same & (value == F.col(name))
    found = marked.where("_several").join(repeated, same, "left").drop("_line_hash", *values)
    alone = marked.where("NOT _several").withColumn("_kept", F.lit(None).cast(repeated.schema["_kept"].dataType))
    return found.unionByName(alone).drop("_hash", "_several")


def select_orders(
    scanned: DataFrame,
    zone: str = BUSINESS_ZONE,
    keep: Callable[[DataFrame], DataFrame] = materialized,
) -> DataFrame:
    """From raw cells to every source row with its outcome, settled header, line values and issues.

    Parsed rows are read by the aggregates and by the joins with them; ``keep`` writes them, the table of bits and
    the repeated lines out. Signatures, the widest column but the cells, are kept as bytes; ``keep`` may leave them out, as the line
    values give them again to those who read them.
    """
    parsed = keep(parse_order_rows(scanned, zone).withColumn("line_key", F.unhex("line_key")))
    if "line_key" not in parsed.columns:
        parsed = parsed.withColumn("line_key", F.unhex(_line_key()))
    marked = _mark_repeats(_blank_cells(parsed), keep(repeated_words(parsed)))
    rows = _with_repeats(marked, keep(repeated_lines(marked))).withColumn("_group", _settled_order())
    rows = lookup(rows, order_groups(parsed), ["_group"]).withColumn("line_key", F.lower(F.hex("line_key")))
    return settle_lines(validate_lines(settle_headers(rows)))


def order_headers(selected: DataFrame) -> DataFrame:
    """Orders with at least one accepted line; partial if any of their rows was rejected."""
    return (
        selected.where(F.col("entity").isNotNull())
        .groupBy(F.col("entity").alias("source_order_id"))
        .agg(
            F.max("order_date").alias("order_date"),
            F.max("customer").alias("customer"),
            F.max("channel").alias("channel"),
            F.max("status").alias("status"),
            F.max(F.col("outcome") == "rejected").alias("has_rejected_lines"),
            F.max(F.col("outcome") == "accepted").alias("_loaded"),
        )
        .where("_loaded")
        .drop("_loaded")
    )


def order_lines(selected: DataFrame) -> DataFrame:
    return selected.where(F.col("outcome") == "accepted").select(
        F.col("entity").alias("source_order_id"), "line_key", "sku", "quantity", "unit_price",
        "discount", "ord", F.col("locator").alias("source_locator"),
    )
