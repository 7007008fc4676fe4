"""Text, identifier and enumeration cleaning.

The parsers give ``struct<value, code>``: ``code`` is the reason a value was refused, and both are NULL for
a missing value. All work stays in the JVM; composition (NFC) and full case folding, which Spark has no
function for, call the ICU library Spark ships through ``reflect`` and only for rows with non-ASCII text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lonja.functions.parser import Parser, outcome
from lonja.vocabulary import CHANNELS, MAX_IDENTIFIER, MISSING_TOKENS, STATUSES

# The Unicode white space characters, as a set for trimming and as a regex class.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
BLANK_CLASS = (
    r"[\t-\r\x1c-\x20\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
)
ASCII_BLANK_CLASS = r"[\t-\r\x1c-\x20]"
# Blanks of ASCII that are no single space.
UNEVEN = r"[\t-\r\x1c-\x1f]|  "


def beyond_ascii(text: Column) -> Column:
    """Whether a text holds any non-ASCII character: it then has more bytes than characters."""
    return F.octet_length(text) > F.char_length(text)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def unless_missing(text: Column) -> Column:
    """NULL where the complete trimmed text is one of the missing tokens, none of which is longer than the longest of them."""
    longer = F.octet_length(text) > max(len(token) for token in MISSING_TOKENS)
    return F.when(longer | ~F.lower(text).isin(MISSING_TOKENS), text)


def compose(text: Column) -> Column:
    call = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(False))
    return F.when(beyond_ascii(text), call).otherwise(text)


def fold_case(text: Column) -> Column:
    call = F.reflect(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), text, F.lit(True))
    return F.when(beyond_ascii(text), call).otherwise(F.lower(text))


def single_blanks(text: Column) -> Column:
    """Each run of blanks as one space; ASCII text gets by with a class that matches much faster, if it has any such run."""
    return F.when(
        beyond_ascii(text), F.regexp_replace(text, BLANK_CLASS + "+", " ")
    ).when(text.rlike(UNEVEN), F.regexp_replace(text, ASCII_BLANK_CLASS + "+", " ")).otherwise(text)


def _required(text: Column) -> Column:
    return outcome(text, F.when(text.isNull(), "MISSING_REQUIRED_FIELD"))


CONTROL = r"[\x00-\x1f\x7f]"


def _mark_control(raw: Column) -> Column:
    """Only the control character survives where one occurs, so that later steps can tell."""
    return F.when(raw.rlike(CONTROL), F.lit("\x00")).otherwise(strip(raw))


def _identifier(value: Column) -> Column:
    code = (
        F.when(value.isNull(), "MISSING_REQUIRED_FIELD")
        .when((value == "\x00") | (F.char_length(value) > MAX_IDENTIFIER), "INVALID_IDENTIFIER")
    )
    return outcome(F.when(code.isNull(), value), code)


def _status(value: Column) -> Column:
    known = value.isin(STATUSES)
    return outcome(F.when(known, value), F.when(~known, "UNKNOWN_ORDER_STATUS"))


def _channel(key: Column) -> Column:
    value = F.lit(None).cast("string")
    for name in CHANNELS:
        value = F.when(key == name.lower(), F.lit(name)).otherwise(value)
    known = key.isin([name.lower() for name in CHANNELS])
    return outcome(value, F.when(~known, "UNKNOWN_CHANNEL"))


def _ean_digits(text: Column) -> Column:
    """Drop one pair of outer quotes or a leading apostrophe, and all blanks."""
    size = F.char_length(text)
    quoted = text.rlike(r"(?s)^(['\"]).*\1\z") & (size >= 2)
    bare = F.when(quoted, F.substring(text, F.lit(2), size - 2)).otherwise(
        F.regexp_replace(text, "^'", "")
    )
    return F.translate(bare, BLANKS, "")


def _ean(digits: Column) -> Column:
    # Left padding with zeros aligns the EAN-8 weights (3, 1) with the EAN-13 weights (1, 3).
    long_form = F.lpad(digits, 13, "0")
    total = F.lit(0)
    for i in range(13):
        digit = F.ascii(F.substring(long_form, i + 1, 1)) - 48
        total = total + digit * (3 if i % 2 else 1)
    code = F.when(
        digits.rlike(r"^\d+(?:[.,]\d+)?[Ee][+-]?\d+$"), "UNSAFE_SCIENTIFIC_EAN"
    ).when(~digits.rlike(r"^(?:[0-9]{8}|[0-9]{13})$") | (total % 10 != 0), "INVALID_EAN")
    return outcome(F.when(code.isNull(), digits), code)


present = Parser(strip, unless_missing)
clean_text = Parser(present, compose, single_blanks)
folded = Parser(fold_case)
comparison_key = Parser(clean_text, folded)
required_text = Parser(clean_text, _required)
identifier = Parser(_mark_control, unless_missing, compose, single_blanks, F.upper, _identifier)
status = Parser(clean_text, F.upper, _status)
channel = Parser(comparison_key, _channel)
ean = Parser(present, _ean_digits, _ean)
