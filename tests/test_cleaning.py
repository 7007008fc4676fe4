"""Values that each cleaning function takes and refuses, derived from the grammar of its format."""

from datetime import date, datetime, timezone
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from lonja.functions import dates, numbers, text
from lonja.functions.parser import parse

LONGEST = 2**63 - 1


def outcomes(spark, parser, raws):
    frame = spark.createDataFrame(list(enumerate(raws)), "i int, raw string")
    return [r.p for r in parse(frame, {"p": (parser, F.col("raw"))}).orderBy("i").collect()]


#: Parser, accepted texts with their values, refused texts by code.
FORMATS = {
    "identifier": (
        text.identifier,
        {"zx_9/b": "ZX_9/B", "   kk ": "KK", "q" * 64: "Q" * 64, "ñandú-7": "ÑANDÚ-7"},
        {"MISSING_REQUIRED_FIELD": ["", "   ", "null", None], "INVALID_IDENTIFIER": ["q" * 65, "a\tb\x07", "kk\n"]},
    ),
    "required_text": (
        text.required_text, {"  dos   palabras ": "dos palabras", "0": "0"}, {"MISSING_REQUIRED_FIELD": ["N/A", "-", "\n"]},
    ),
    "decimal": (
        numbers.decimal,
        {"000,5": D("0.5"), "+7.25": D("7.25"), "-0": D(0), "88": D(88), "null": None},
        {"INVALID_DECIMAL": ["+", "+-1", ".", ",", "7.1.2", "6E2", "inf", "0x1F", "1 000", "5%"]},
    ),
    "money": (
        numbers.money,
        {"7": D(7), "8,1": D("8.1"), "6.05": D("6.05"), "2.345.678,9": D("2345678.9"), "2,345,678.9": D("2345678.9"),
         "€9": D(9), "9€": D(9), "EUR 12,50": D("12.50"), "12,50 eur": D("12.50"), "9 876,5": D("9876.5"), "7.654,3": D("7654.3"),
         "५,५": D("5.5"), "null": None},
        {"AMBIGUOUS_NUMBER": ["7.654", "7,654", "77,75?"], "NON_POSITIVE_PRICE": ["0,0", "-7", "-0,01"],
         "INVALID_PRICE": ["7..5", ",", "£5", "5 5", "7.65.4", "nan", "1E2", "€", "7,12345"],
         "NUMERIC_OUT_OF_RANGE": ["7" + "0" * 14, "8" * 40]},
    ),
    "discount": (
        numbers.discount,
        {"25%": D("0.25"), "25": D("0.25"), "0,25": D("0.25"), "0": D(0), "7,5 %": D("0.075"), "100": D(1), "null": None},
        {"INVALID_DISCOUNT": ["100,5", "-0,5", "%5", "5%%", "abc", "0,7654321"]},
    ),
    "tax": (numbers.tax, {"10": D("0.1"), "4": D("0.04"), "-": None}, {"INVALID_TAX": ["diez", "1e1"]}),
    "weight": (numbers.weight, {"12,75": D("12.75"), "0,0": D(0), "n/d": None}, {"INVALID_WEIGHT": ["-0,1", "2 kg"]}),
    "quantity": (
        numbers.quantity,
        {"41": 41, "-6": -6, "7,00": 7, "-8.0": -8, str(-LONGEST): -LONGEST, "null": None},
        {"INVALID_QUANTITY": ["0,0", "-0", "3,14", "7E1", str(LONGEST + 1), "9" * 3000]},
    ),
    "stock_quantity": (
        numbers.stock_quantity, {"0,00": 0, "17": 17, str(LONGEST): LONGEST},
        {"INVALID_STOCK": ["", None, "-3", "0,5", "False", "1E+3", str(LONGEST + 1)]},
    ),
    "date": (
        dates.date,
        {**{day: date(2023, 8, 7) for day in ("2023-08-07", "2023/8/7", "7-8-2023", "07/08/2023", "2023-8-7 6:05:09", "07/08/2023T23:59:59")},
         # Summer and winter time of the business zone; the zoned day may be the next or the one before.
         "2023-07-01T21:59:59Z": date(2023, 7, 1), "2023-07-01T22:00:00Z": date(2023, 7, 2), "2023-01-01T22:59:59Z": date(2023, 1, 1),
         "2023-01-01T23:00:00Z": date(2023, 1, 2), "2023-01-01T00:30:00+05:30": date(2022, 12, 31),
         "2023-06-30T20:00:00-03:00": date(2023, 7, 1), "٢٠٢٣-٠٨-٠٧": date(2023, 8, 7), "28/02/2023": date(2023, 2, 28), "null": None},
        {"INVALID_DATE": ["2023-02-29", "7/8-2023", "2023-8", "7.8.2023", "08/13/2023", "2023-08-07 6:60:00", "2023-08-07T06:00:00+24:00",
                          "٢٠٢٣-٠٨-٠٧T٠٦:٠٠:٠٠Z", "0000-01-01", "mañana"]},
    ),
    "status": (
        text.status, {" pendiente ": "PENDIENTE", "CANCELADO": "CANCELADO", "null": None},
        {"UNKNOWN_ORDER_STATUS": ["roto", "completado?", "en curso"]},
    ),
    "channel": (text.channel, {" B2b": "B2B", "MarketPlace": "marketplace", "-": None}, {"UNKNOWN_CHANNEL": ["b2", "web"]}),
    "ean": (
        text.ean,
        {"5901234123457": "5901234123457", "590 1234 123457": "5901234123457", '"73513537"': "73513537", "null": None},
        {"INVALID_EAN": ["5901234123458", "59012341234", "73513538", "ean", "٧٣٥١٣٥٣٧"], "UNSAFE_SCIENTIFIC_EAN": ["5,9E+12", "7E7"]},
    ),
}


@pytest.mark.parametrize("name", FORMATS)
def test_format(spark, name):
    parser, good, bad = FORMATS[name]
    found = outcomes(spark, parser, [*good, *[x for texts in bad.values() for x in texts]])
    assert [(r.value, r.code) for r in found[: len(good)]] == [(value, None) for value in good.values()]
    assert [(r.value, r.code) for r in found[len(good) :]] == [(None, code) for code, texts in bad.items() for _ in texts]


def test_texts_and_keys(spark):
    raws = ["null", "- ", "\tn/a", "  Über \n  alles ", "ΣΊΣΥΦΟΣ", "été", "ﬁn"]
    frame = spark.createDataFrame(list(enumerate(raws)), "i int, raw string")
    rows = parse(frame, {"t": (text.clean_text, F.col("raw")), "k": (text.comparison_key, F.col("raw"))}).orderBy("i").collect()
    assert [r.t for r in rows] == [None, None, None, "Über alles", "ΣΊΣΥΦΟΣ", "été", "ﬁn"]
    assert [r.k for r in rows] == [None, None, None, "über alles", "σίσυφοσ", "été", "fin"]


def test_instants(spark):
    raws = ["2022-12-31T23:00:00-02:30", "2022-07-04T05:06:07.0000019Z", "2022-07-04 05:06:07Z", "2022-07-04T05:06:07", "-", "0999-12-31T23:59:59Z"]
    found = outcomes(spark, dates.instant, raws)
    first = found[0].value.astimezone(timezone.utc).replace(tzinfo=None)
    assert first == datetime(2023, 1, 1, 1, 30) and found[1].value.microsecond == 1
    assert [r.code for r in found] == [None, None, "INVALID_DATE", "INVALID_DATE", None, None]
    assert [r.code for r in outcomes(spark, dates.stock_instant, ["-", raws[-1], "1000-01-01T00:00:00Z"])] == ["INVALID_DATE", "INVALID_DATE", None]


def test_question_mark_after_a_price(spark):
    found = outcomes(spark, numbers.catalogue_money, ["7,25?", "  81.5 ? ", "7?25", "??", "7,2 5?", "7.250?", "-1?", "0,00?", "3,5"])
    assert [(r.value, r.code, r.repaired) for r in found] == [
        (D("7.25"), None, True), (D("81.5"), None, True), (None, "INVALID_PRICE", False), (None, "INVALID_PRICE", False),
        (None, "INVALID_PRICE", False), (None, "AMBIGUOUS_NUMBER", False), (None, "NON_POSITIVE_PRICE", False),
        (None, "NON_POSITIVE_PRICE", False), (D("3.5"), None, False)]


def test_exact_arithmetic(spark):
    cases = [(3, D("0.0050"), D("0")), (7, D("19.9900"), D("0.125")), (2**41 + 3, D("987.6543"), D("0.111111")), (-9, D("0.0150"), D("0.5"))]
    frame = spark.createDataFrame(cases, "q bigint, p decimal(18,4), d decimal(9,6)")
    rows = frame.select(numbers.line_amount(F.col("q"), F.col("p"), F.col("d")).alias("a")).collect()
    assert [r.a for r in rows] == [(q * p * (1 - d)).quantize(D("0.01"), rounding="ROUND_HALF_UP") for q, p, d in cases]
    ratio = spark.createDataFrame([(7, 2), (5, 32), (0, 3), (3, 0)], "a bigint, b bigint")
    got = ratio.select(numbers.half_up_ratio(F.col("a"), F.col("b"), 0).alias("t"), numbers.half_up_ratio(F.col("a"), F.col("b"), 4).alias("c")).collect()
    assert [r.t for r in got] == [4, 0, 0, None] and got[1].c == D("0.1563")
    rounded = spark.createDataFrame([(D("2.675"),), (D("-0.005"),)], "v decimal(18,4)").select(numbers.round_half_up(F.col("v"), 2).alias("r")).collect()
    assert [r.r for r in rounded] == [D("2.68"), D("-0.01")]
    with pytest.raises(ValueError):
        numbers.round_half_up(F.col("v"), 7)
