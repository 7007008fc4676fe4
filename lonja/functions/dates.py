"""Dates and instants. The parsers give ``struct<value, code>`` as in :mod:`lonja.functions.text`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lonja.functions.numbers import ascii_digits
from lonja.functions.parser import Parser, outcome
from lonja.functions.text import BLANK_CLASS, present
from lonja.vocabulary import BUSINESS_ZONE

_MONTH = r"(1[0-2]|0[1-9]|[1-9])"
_DAY = r"(3[01]|[12]\d|0[1-9]|[1-9]| [1-9])"
_CLOCK = rf"(?:(?:{BLANK_CLASS}+|T)(?:2[0-3]|[01]\d|\d):(?:[0-5]\d|\d):(?:[0-5]\d|\d))?$"
YEAR_FIRST = rf"^(\d{{4}})([-/]){_MONTH}\2{_DAY}{_CLOCK}"
DAY_FIRST = rf"^{_DAY}([-/]){_MONTH}\2(\d{{4}}){_CLOCK}"
ZONED = r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2})(?:\.(\d{1,6})\d*)?(?:Z|([+-])(\d{2}):([0-5]\d))$"


def _calendar_text(found: Column) -> Column:
    """A text in one of the layouts rewritten as ``=year-month-day``; each pattern runs once and marks what it rewrote."""
    iso = F.regexp_replace(found["text"], YEAR_FIRST, "=$1-$3-$4")
    iso = F.when(iso.startswith("="), iso).otherwise(F.regexp_replace(iso, DAY_FIRST, "=$4-$3-$1"))
    iso = F.when(~found["zoned"], iso)
    return F.struct(found["text"].alias("text"), found["zoned"].alias("zoned"), found["utc"].alias("utc"), iso.alias("iso"))


def _calendar_day(zone: str):
    """The day of either kind of text, in steps of its own, so that no later step repeats the patterns."""

    def day(found: Column) -> Column:
        iso = found["iso"]
        calendar = F.when(
            iso.startswith("="), F.translate(F.substring(iso, 2, 11), " ", "").try_cast("date")
        )
        local = F.convert_timezone(F.lit("UTC"), F.lit(zone), found["utc"]).cast("date")
        return F.struct(
            found["text"].alias("text"), found["zoned"].alias("zoned"),
            F.when(found["zoned"], local).otherwise(calendar).alias("day"),
        )

    return day


def _zoned_parts(text: Column) -> Column:
    """The groups of an ISO text with an explicit zone, each found once."""
    zoned = (F.substring(text, 11, 1) == "T") & text.rlike(ZONED)
    groups = [F.regexp_extract(text, ZONED, i).alias(name) for i, name in enumerate(("local", "micros", "sign", "hours", "minutes"), 1)]
    return F.struct(text.alias("text"), zoned.alias("zoned"), F.when(zoned, F.struct(*groups)).alias("parts"))


def _zoned_numbers(found: Column) -> Column:
    parts = found["parts"]
    local = F.concat(parts["local"], F.lit("."), F.rpad(parts["micros"], 6, "0")).try_cast("timestamp_ntz")
    hours = F.coalesce(parts["hours"].try_cast("int"), F.lit(0))
    minutes = F.coalesce(parts["minutes"].try_cast("int"), F.lit(0))
    return F.struct(
        found["text"].alias("text"), found["zoned"].alias("zoned"), local.alias("local"), (parts["sign"] == "-").alias("west"),
        hours.alias("hours"), F.make_dt_interval(hours=hours, mins=minutes).alias("offset"),
    )


def _utc_wall_clock(found: Column) -> Column:
    """UTC wall clock (timestamp without zone) of an ISO text with an explicit zone."""
    utc = F.when(found["west"], found["local"] + found["offset"]).otherwise(found["local"] - found["offset"])
    near = found["zoned"] & (found["hours"] < 24)
    return F.struct(found["text"].alias("text"), found["zoned"].alias("zoned"), F.when(near, utc).alias("utc"))


def _within_years(found: Column) -> Column:
    good = F.year(found["utc"]).between(1, 9999)
    return F.struct(found["text"].alias("text"), found["zoned"].alias("zoned"), F.when(good, found["utc"]).alias("utc"))


_wall_clocks = Parser(_zoned_parts, _zoned_numbers, _utc_wall_clock, _within_years)


def _calendar_digits(found: Column) -> Column:
    return F.struct(ascii_digits(found["text"]).alias("text"), found["zoned"].alias("zoned"), found["utc"].alias("utc"))


def _date(found: Column) -> Column:
    good = F.when(found["zoned"], F.year(found["day"]).between(1, 9999)).otherwise(F.year(found["day"]) >= 1)
    value = F.when(good, found["day"])
    return outcome(value, F.when(found["text"].isNotNull() & value.isNull(), "INVALID_DATE"))


def date_in(zone: str) -> Parser:
    """Four calendar layouts with an optional time, or a zoned instant as a day in the given zone.

    Digits of other scripts are read as such in the calendar layouts only.
    """
    return Parser(present, _wall_clocks, _calendar_digits, _calendar_text, _calendar_day(zone), _date)


def _instant(found: Column) -> Column:
    text = F.concat(F.date_format(found["utc"], "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    bad = found["text"].isNotNull() & found["utc"].isNull()
    return outcome(text.try_cast("timestamp"), F.when(bad, "INVALID_DATE"))


def _stock_instant(found: Column) -> Column:
    first = F.lit("1000-01-01T00:00:00Z").cast("timestamp")
    value = F.when(found["value"] >= first, found["value"])
    return outcome(value, F.when(value.isNull(), "INVALID_DATE"))


date = date_in(BUSINESS_ZONE)
# ISO text with an explicit zone to an instant (UTC microseconds).
instant = Parser(present, _wall_clocks, _instant)
# As instant, but a missing value or a year before 1000 is an error.
stock_instant = Parser(instant, _stock_instant)
