"""Decimal, money, ratio and quantity parsing, and exact half-up arithmetic.

The parsers give ``struct<value, code>`` as in :mod:`lonja.functions.text`. A missing value has neither.
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from lonja.functions.parser import Parser, outcome
from lonja.functions.text import BLANK_CLASS, beyond_ascii, present, strip, unless_missing
from lonja.vocabulary import MAX_LONG

MONEY = "decimal(18,4)"
RATIO = "decimal(9,6)"
AMOUNT = "decimal(38,2)"
WIDE = "decimal(38,18)"

PLAIN = r"^[+-]?\d+(?:[.,]\d+)?$"

# Decimal digits of every script, mapped to 0-9.
_DIGITS = [
    (chr(c), str(unicodedata.decimal(chr(c))))
    for c in range(0x80, sys.maxunicode + 1)
    if unicodedata.decimal(chr(c), None) is not None
]


def ascii_digits(text: Column) -> Column:
    source = "".join(d[0] for d in _DIGITS)
    target = "".join(d[1] for d in _DIGITS)
    return F.when(beyond_ascii(text), F.translate(text, source, target)).otherwise(text)


def _point(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("."))


def _without(text: Column, mark: str) -> Column:
    return F.replace(text, F.lit(mark), F.lit(""))


def _refused(value: Column, text: Column, code: str) -> Column:
    """The value, or the code where a text was there but gave none."""
    return outcome(value, F.when(text.isNotNull() & value.isNull(), code))


def _decimal(text: Column) -> Column:
    value = F.when(text.rlike(PLAIN), _point(text).try_cast(WIDE))
    return _refused(value, text, "INVALID_DECIMAL")


def _leading_euro(text: Column) -> Column:
    marked = text.startswith("€") | (F.lower(F.left(text, F.lit(3))) == "eur")
    cut = F.regexp_replace(text, r"^(?:€|[eE][uU][rR])" + BLANK_CLASS + "*", "")
    return F.when(marked, cut).otherwise(text)


def _trailing_euro(text: Column) -> Column:
    marked = text.endswith("€") | (F.lower(F.right(text, F.lit(3))) == "eur")
    cut = F.regexp_replace(text, BLANK_CLASS + r"*(?:€|[eE][uU][rR])\z", "")
    return F.when(marked, cut).otherwise(text)


# One leading and one trailing euro mark, in any case, are dropped with the blanks around them.
strip_currency = Parser(_leading_euro, _trailing_euro)


def _plain_spaces(text: Column) -> Column:
    return F.when(beyond_ascii(text), F.translate(text, "\u00a0\u202f", "  ")).otherwise(text)


def _join_groups(text: Column) -> Column:
    """Remove well-formed space groups; a badly grouped text becomes one that no grammar accepts."""
    grouped = text.rlike(r"^[+-]?\d{1,3}(?: \d{3})+(?:[.,]\d{1,4})?$")
    return (
        F.when(~text.contains(" "), text)
        .when(grouped, _without(text, " "))
        .when(text.isNotNull(), "invalid")
    )


def _money_plain(text: Column) -> Column:
    """The text beside its plain form with a decimal point; the plain form is NULL if not money."""
    plain = (
        F.when(text.rlike(r"^[+-]?\d+$"), text)
        .when(text.rlike(r"^[+-]?\d+[.,](?!\d{3}$)\d{1,4}$"), _point(text))
        .when(text.rlike(r"^[+-]?\d{1,3}(?:\.\d{3})+,\d{1,4}$"), _point(_without(text, ".")))
        .when(
            text.rlike(r"^[+-]?\d{1,3}(?:(?:,\d{3})+\.\d{1,4}|(?:,\d{3}){2,})$"),
            _without(text, ","),
        )
        .when(text.rlike(r"^[+-]?\d{1,3}(?:\.\d{3}){2,}$"), _without(text, "."))
    )
    return F.struct(text.alias("text"), plain.alias("plain"), plain.try_cast(MONEY).alias("value"))


def _money(found: Column) -> Column:
    text, plain, value = found["text"], found["plain"], found["value"]
    # No plain form is ambiguous, and a value in range tells its sign itself.
    unread = F.when(text.rlike(r"^[+-]?\d+[.,][^.,]{3}$"), "AMBIGUOUS_NUMBER").otherwise("INVALID_PRICE")
    beyond = F.when(plain.rlike(r"^-|^[+]?[0.]*$"), "NON_POSITIVE_PRICE").otherwise("NUMERIC_OUT_OF_RANGE")
    code = F.when(
        text.isNotNull(),
        F.when(plain.isNull(), unread).when(value.isNull(), beyond).when(value <= 0, "NON_POSITIVE_PRICE"),
    )
    return outcome(F.when(code.isNull(), value), code)


def _cut_suffix(text: Column) -> Column:
    """Drop a final ``?`` if it is the only one; the cut text keeps a leading mark to say so."""
    degraded = text.endswith("?") & (F.char_length(text) - F.char_length(_without(text, "?")) == 1)
    kept = strip(F.regexp_replace(text, r"\?$", ""))
    return F.struct(F.when(degraded, kept).otherwise(text).alias("text"), degraded.alias("degraded"))


def _on_text(step):
    """Apply a step to the ``text`` of ``struct<text, degraded>`` and keep the flag."""
    return lambda found: F.struct(step(found["text"]).alias("text"), found["degraded"].alias("degraded"))


def _catalogue_money(found: Column) -> Column:
    result = _money(found["text"])
    degraded = F.coalesce(found["degraded"], F.lit(False))
    code = F.when(degraded & found["text"]["text"].isNull(), "INVALID_PRICE").otherwise(result["code"])
    return F.struct(
        result["value"].alias("value"),
        code.alias("code"),
        (degraded & result["value"].isNotNull()).alias("repaired"),
        F.regexp_replace(found["text"]["plain"], r"^\+?0*(?=\d)", "").alias("plain"),
    )


def _ratio_parts(text: Column) -> Column:
    cut = strip(F.left(text, F.char_length(text) - 1))
    body = F.when(text.endswith("%"), cut).otherwise(text)
    return F.struct(
        text.alias("text"),
        body.alias("body"),
        F.when(body.rlike(PLAIN), _point(body).try_cast(WIDE)).alias("amount"),
    )


def _ratio(found: Column) -> Column:
    text, body, amount = found["text"], found["body"], found["amount"]
    points = text.endswith("%") | (amount >= 1)
    exact = F.when(points, body.rlike(r"^[+-]?\d+(?:[.,]\d{1,4}0*)?$")).otherwise(
        body.rlike(r"^[+-]?\d+(?:[.,]\d{1,6}0*)?$")
    )
    small = amount.try_cast("decimal(13,10)")
    value = F.when(
        amount.between(0, 100) & exact,
        F.when(points, small / 100).otherwise(small).cast(RATIO),
    )
    return _refused(value, text, "INVALID_DISCOUNT")


def _tax(rate: Column) -> Column:
    return outcome(rate["value"], F.when(rate["code"].isNotNull(), "INVALID_TAX"))


def _weight(number: Column) -> Column:
    value = F.when(number["value"] >= 0, number["value"].try_cast(MONEY))
    missing = number["value"].isNull() & number["code"].isNull()
    return outcome(value, F.when(value.isNull() & ~missing, "INVALID_WEIGHT"))


def _digits(text: Column) -> Column:
    """The text beside its whole number as text; NULL if it is none."""
    whole = text.rlike(r"^[+-]?\d+(?:[.,]0+)?$")
    cut = F.when(text.rlike("[.,]"), F.regexp_replace(text, r"[.,]0+$", "")).otherwise(text)
    return F.struct(text.alias("text"), F.when(whole, cut).alias("digits"))


def _whole(found: Column) -> Column:
    """The number; NULL beyond 64 bits. Short texts, nearly all, need no wide decimal for that."""
    digits = found["digits"]
    wide = digits.try_cast("decimal(38,0)")
    fits = wide.between(*[F.lit(sign * MAX_LONG).cast("decimal(19,0)") for sign in (-1, 1)])
    number = F.when(F.octet_length(digits) <= 18, digits.try_cast("bigint")).when(fits, wide.cast("bigint"))
    return F.struct(found["text"].alias("text"), number.alias("number"))


def _quantity(found: Column) -> Column:
    number = found["number"]
    return _refused(F.when(number != 0, number), found["text"], "INVALID_QUANTITY")


def _stock_quantity(found: Column) -> Column:
    value = F.when(found["number"] >= 0, found["number"])
    return outcome(value, F.when(value.isNull(), "INVALID_STOCK"))


decimal = Parser(present, ascii_digits, _decimal)
money = Parser(
    present, strip_currency, _plain_spaces, ascii_digits, _join_groups, _money_plain, _money
)
catalogue_money = Parser(
    present,
    _cut_suffix,
    *[
        _on_text(step)
        for step in (
            unless_missing, *strip_currency.steps, _plain_spaces, ascii_digits, _join_groups, _money_plain
        )
    ],
    _catalogue_money,
)
discount = Parser(present, ascii_digits, _ratio_parts, _ratio)
tax = Parser(discount, _tax)
weight = Parser(decimal, _weight)
quantity = Parser(present, ascii_digits, _digits, _whole, _quantity)
stock_quantity = Parser(present, ascii_digits, _digits, _whole, _stock_quantity)


def round_half_up(value: Column, places: int) -> Column:
    if not 0 <= places <= 6:
        raise ValueError("places must be between 0 and 6")
    return F.round(value, places)


def line_amount(quantity_: Column, price: Column, ratio: Column) -> Column:
    """``round(quantity * price * (1 - ratio), 2)`` without any intermediate rounding.

    The plain decimal product would be cut to six places first. The unit amount is exact at ten places;
    quantities beyond nine digits are multiplied in two exact parts (the high part has one place only).
    """
    unit = price.cast(MONEY) * (F.lit(1).cast("decimal(1,0)") - ratio.cast(RATIO)).cast("decimal(7,6)")
    return _times(quantity_, unit.cast("decimal(26,10)"))


def line_cost(quantity_: Column, unit_cost: Column) -> Column:
    return _times(quantity_, unit_cost.cast("decimal(26,10)"))


def _times(quantity_: Column, unit: Column) -> Column:
    billion = 10**9
    rest = quantity_ % billion
    low = F.round(unit * rest.cast("decimal(9,0)"), 2).cast(AMOUNT)
    count = ((quantity_ - rest).cast("decimal(19,0)") / billion).cast("decimal(10,0)")
    high = (unit * count).cast("decimal(38,10)") * F.lit(billion).cast("decimal(10,0)")
    return F.when(rest == quantity_, low).otherwise((high.cast(AMOUNT) + low).cast(AMOUNT))


def half_up_ratio(numerator: Column, denominator: Column, places: int) -> Column:
    """Exact ``numerator / denominator`` for non-negative integers, rounded half up; NULL over zero."""
    top = numerator.cast("decimal(38,0)") * F.lit(2 * 10**places).cast("decimal(6,0)")
    top = (top + denominator.cast("decimal(30,0)")).cast("decimal(38,0)")
    bottom = (denominator.cast("decimal(30,0)") * F.lit(2).cast("decimal(1,0)")).cast("decimal(38,0)")
    floor = (top - top % bottom).cast("decimal(38,0)") / bottom
    scale = F.lit(10**places).cast("decimal(6,0)")
    return F.when(
        denominator != 0, (floor.cast("decimal(30,0)") / scale).cast(f"decimal(38,{places})")
    )
