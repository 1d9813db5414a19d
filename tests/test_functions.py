import random
from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from shelfstar.functions import convert, dates, money, text


def one(spark, value, build, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(build("x")).first()[0]


@pytest.mark.parametrize("value, expected", [(None, None), ("", None), ("   ", None), (" a ", "a"), ("\t", "\t")])
def test_blank_is_null_and_tabs_are_text(spark, value, expected):
    assert one(spark, value, text.blank_to_null) == expected
    assert one(spark, value, text.is_blank) is (expected is None)


@pytest.mark.parametrize("value, expected", [
    ("251,55", Decimal("251.55")), (" 12.5 ", Decimal("12.50")), ("x", None), ("", None), (None, None),
])
def test_decimal_comma(spark, value, expected):
    assert one(spark, value, convert.comma_decimal) == expected


def test_bad_text_becomes_null_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert one(spark, "abc", convert.to_int) is None
    assert one(spark, "2021/02/30", convert.to_day) is None
    assert one(spark, "2025/13", convert.to_month) is None
    assert one(spark, "99999999999", convert.to_int) is None


def test_dates_and_moments(spark):
    assert one(spark, " 2025/03/15 ", convert.to_day) == date(2025, 3, 15)
    assert one(spark, "2025/03", convert.to_month) == date(2025, 3, 1)
    df = spark.createDataFrame([("2025/03/15", "08:09:10")], "d string, h string")
    assert df.select(convert.to_moment("d", "h")).first()[0] == datetime(2025, 3, 15, 8, 9, 10)
    shown = spark.createDataFrame([("2026-10-10T15:24:54.462420+02:00",)], "x string").select(
        F.date_format(convert.iso_moment("x"), "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    assert shown.first()[0] == "2026-10-10 13:24:54.462420"


@pytest.mark.parametrize("value, expected", [(None, 0), (" ", 0), ("15", 15), ("x", None)])
def test_missing_discount_is_zero(spark, value, expected):
    assert one(spark, value, lambda c: convert.int_or(c, 0)) == expected


def test_title_case(spark):
    assert one(spark, "  BILLETERA digital ", text.title_case) == "Billetera Digital"


def test_display_name_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([("Lima", 112), (None, 113)], "n string, i int")
    assert [r[0] for r in df.select(text.display_name("n", "i")).collect()] == ["Lima (112)", None]


@pytest.mark.parametrize("value, expected", [
    ("12345678", "12XXXX78"), ("12345", "12XXXX45"), ("1234", "XXXX"), ("", "XXXX"), (None, None),
])
def test_mask(spark, value, expected):
    assert one(spark, value, text.mask_partial) == expected


def totals(spark, lines):
    df = spark.createDataFrame(lines, "q int, p decimal(10,2), d int")
    return df.select(money.line_total("q", "p", "d"), money.line_total_double("q", "p", "d")).collect()


def test_line_total_is_exact_and_the_double_rule_differs_on_ties(spark):
    exact, double = totals(spark, [(3, Decimal("10.05"), 10)])[0]
    assert exact == Decimal("27.14")
    assert double == Decimal("27.13")


def test_line_total_against_decimal_arithmetic(spark):
    rng = random.Random(7)
    lines = [
        (rng.randint(-50, 500), Decimal(rng.randint(0, 10**8)) / 100, rng.choice([0, 5, 10, 15, 20, 33, 90, 100]))
        for _ in range(2000)
    ]
    cent = Decimal("0.01")
    for (q, p, d), (got, _) in zip(lines, totals(spark, lines)):
        want = (q * p * (100 - d) / 100).quantize(cent, ROUND_HALF_UP)
        assert got == (want if abs(want) < 10**10 else None)


def test_line_total_null_parts(spark):
    lines = [(None, Decimal("1.00"), 0), (1, None, 0), (1, Decimal("1.00"), None)]
    assert [r[0] for r in totals(spark, lines)] == [None, None, None]


def test_variation_worked_example(spark):
    df = spark.createDataFrame(
        [(Decimal("32223.08"), Decimal("13360.38")), (Decimal("5.00"), Decimal("0.00")), (Decimal("5.00"), None)],
        "r decimal(14,2), m decimal(12,2)")
    assert [r[0] for r in df.select(money.variation_pct("r", "m")).collect()] == [Decimal("141.18"), None, None]


def test_calendar_attributes(spark):
    df = spark.createDataFrame([(date(2025, 1, 1),), (date(2025, 3, 15),), (date(2024, 12, 29),)], "fecha date")
    got = [tuple(r) for r in df.select(*dates.calendar_columns("fecha")).collect()]
    assert got[0] == (20250101, date(2025, 1, 1), 2025, 1, 1, "Enero", "2025/01", "Miércoles", 3, False)
    assert got[1] == (20250315, date(2025, 3, 15), 2025, 3, 1, "Marzo", "2025/03", "Sábado", 6, True)
    assert got[2][7:] == ("Domingo", 7, True)
