from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from statloom.functions import columns as c


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "v " + ("string" if isinstance(value, str) else "double")).select(
        expression.alias("x")
    ).first().x


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("93220", 93220.0),
        ("93,220", 93220.0),
        (" 12.5 ", 12.5),
        ("n.d.", None),
        ("", None),
        ("-", None),
        ("1d", None),
        ("NaN", None),
        ("1e3", 1000.0),
        ("-7", -7.0),
    ],
)
def test_number(spark, text, expected):
    assert one(spark, text, c.number("v")) == expected


def test_number_with_another_locale(spark):
    assert one(spark, "1.234,5", c.number("v", decimal=",", thousands=".")) == 1234.5


@pytest.mark.parametrize(("value", "expected"), [(0.5, 0), (1.5, 2), (2.5, 2), (-0.5, 0), (7.2, 7)])
def test_counts_round_half_to_even(spark, value, expected):
    assert one(spark, value, c.to_count("v")) == expected


@pytest.mark.parametrize(
    ("published", "label", "marked"),
    [
        ("Subtotal Norte *", "Subtotal Norte", True),
        ("Subtotal Águilas + Sur #", "Subtotal Águilas + Sur", True),
        ("La Playa", "La Playa", False),
        ("X * ", "X *", True),
        ("A*B", "A*B", False),
    ],
)
def test_marker_split(spark, published, label, marked):
    clean, flag = c.split_marker("v")
    assert one(spark, published, clean) == label
    assert one(spark, published, flag) is marked


def test_capitalised_touches_only_the_first_letter(spark):
    assert one(spark, "ábc def", c.capitalised("v", " (x)")) == "Ábc def (x)"


def test_dates(spark):
    df = spark.createDataFrame([(datetime.date(2019, 7, 1), datetime.date(2018, 11, 30))], "a date, b date")
    r = df.select(
        c.month_key("a").alias("k"),
        c.month_text("a").alias("t"),
        c.key_text(c.month_key("b")).alias("u"),
        c.month_gap("a", "b").alias("g"),
        c.month_of("b").alias("m"),
        c.month_start(F.year("a"), F.month("a")).alias("s"),
    ).first()
    assert tuple(r) == (201907, "2019-07", "2018-11", 8, datetime.date(2018, 11, 1), datetime.date(2019, 7, 1))


def test_secrecy_keeps_null_zero_and_absent_flag_apart(spark):
    df = spark.createDataFrame([(5.0, False), (0.0, True), (7.0, None), (None, False)], "v double, s boolean")
    assert [r.x for r in df.select(c.mask_secret("v", "s").alias("x")).collect()] == [5.0, None, 7.0, None]


def test_last_entry_of_a_repeated_key_wins(spark):
    df = spark.sql("select array(named_struct('k','a','v','1'), named_struct('k','a','v','2')) as m")
    r = df.select(c.entry_of("m", "a", "k", "v").alias("a"), c.entry_of("m", "b", "k", "v").alias("b")).first()
    assert (r.a, r.b) == ("2", None)


def test_notes_are_joined_and_missing_notes_stay_missing(spark):
    df = spark.sql(
        "select array(named_struct('texto','x'), named_struct('texto',cast(null as string)),"
        " named_struct('texto','y')) as n union all select null"
    )
    assert [r.t for r in df.select(c.join_texts("n", "texto").alias("t")).collect()] == ["x | y", None]


def test_ratio_of_zero_is_unknown(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0)], "a double, b double")
    assert [tuple(r) for r in df.select(c.ratio(F.col("a"), F.col("b")), c.percent(F.col("a"), F.col("b"))).collect()] == [
        (None, None),
        (0.25, 25.0),
    ]
