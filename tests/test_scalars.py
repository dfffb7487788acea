from datetime import datetime

import pytest
from pyspark.sql import functions as F

from advertlake.functions import scalars as S


def evaluate(spark, values, expression, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r.out for r in df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


def test_clean_string_collapses_every_kind_of_space(spark):
    given = ["  a  b ", "a  b", "\t\n", "", None, "x　", "a\x1cb\x85c", "über  uns"]
    assert evaluate(spark, given, S.clean_string) == ["a b", "a b", None, None, None, "x", "a b c", "über uns"]


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("£32,500", 32500.0), ("€1,234.5", 1234.5), (" 7 ", 7.0), (" 7", 7.0), ("-3", -3.0), ("+.5", 0.5),
        ("1e3", 1000.0), ("5.", 5.0), ("12d", None), ("12f", None), ("n/a", None), ("", None), (None, None),
        ("nan", None), ("inf", None), ("1_000", None), ("$5", None), ("1 000", None), ("0x10", None),
    ],
)
def test_money(spark, text, value):
    assert evaluate(spark, [text], S.money) == [value]


def test_balanced_pair(spark):
    df = spark.createDataFrame([(9.0, 7.0), (1.0, None), (None, 2.0), (None, None), (1.0, 3.0)], "a double, b double")
    low, high = S.balanced_pair(F.col("a"), F.col("b"))
    rows = [tuple(r) for r in df.select(low, high).collect()]
    assert rows == [(7.0, 9.0), (1.0, 1.0), (2.0, 2.0), (None, None), (1.0, 3.0)]


def test_contract_label(spark):
    assert evaluate(spark, ["Full_Time ", "part  time", "FULL-TIME", " ", None], S.contract_label) == [
        "full_time", "part_time", "full-time", None, None,
    ]


def test_parse_utc(spark):
    given = ["2026-07-15T09:30:00Z", "2026-07-15T09:30:00+02:00", "2026-07-15", "rubbish", "09:30", None, "2026-13-01"]
    assert evaluate(spark, given, S.parse_utc) == [
        datetime(2026, 7, 15, 9, 30), datetime(2026, 7, 15, 7, 30), datetime(2026, 7, 15), None, None, None, None,
    ]
    listed = evaluate(spark, ["15/07/2026", "2026-07-15"], lambda c: S.parse_utc(c, ["dd/MM/yyyy"]))
    assert listed == [datetime(2026, 7, 15)] * 2


def test_predicted_flag(spark):
    given = ["1", "0", "2", "0.5", "-1", "true", "TRUE", "false", "x", "", None]
    got = evaluate(spark, given, S.truthy_number)
    assert got == [True, False, True, False, True, True, True, False, False, False, False]


def test_currency_default_per_country(spark):
    df = spark.createDataFrame([(None, "fr"), (None, "us"), (" USD", "fr"), ("", "gb")], "own string, country string")
    currency = S.currency_or_default(F.col("own"), F.col("country"))
    assert [r[0] for r in df.select(currency).collect()] == ["EUR", "GBP", "USD", "GBP"]
    dollars = S.currency_or_default(F.col("own"), F.col("country"), {"us": "USD"}, "XXX")
    assert [r[0] for r in df.select(dollars).collect()] == ["XXX", "USD", "USD", "XXX"]


def test_weeks_start_on_monday(spark):
    df = spark.createDataFrame([(datetime(2026, 5, 3, 23, 59),), (datetime(2026, 5, 4),)], "t timestamp")
    week = S.period_start(F.col("t"))
    rows = df.select(week.cast("string"), S.week_label(week)).collect()
    assert [tuple(r) for r in rows] == [
        ("2026-04-27", "2026-04-27/2026-05-03"), ("2026-05-04", "2026-05-04/2026-05-10"),
    ]


@pytest.mark.parametrize(
    "value", [0.2, 0.35, 2.0, 2.5, -0.0, 12345678.5, 1e7, 123456789012345.6, 1e-3, 0.00012, 1.5e-5, 1e-5, 1e15, -1e-7, 3.3e-12]
)
def test_float_cells_read_like_plain_text(spark, value):
    expected = str(int(value)) if value.is_integer() else str(value)
    assert evaluate(spark, [value], lambda c: S.cell_text(c, "double"), "double") == [expected]


def test_other_cells(spark):
    assert evaluate(spark, [None, float("nan"), float("inf")], lambda c: S.cell_text(c, "double"), "double") == ["", "", "inf"]
    assert evaluate(spark, [True, None], lambda c: S.cell_text(c, "boolean"), "boolean") == ["True", ""]
    assert evaluate(spark, [3, None], lambda c: S.cell_text(c, "bigint"), "bigint") == ["3", ""]
