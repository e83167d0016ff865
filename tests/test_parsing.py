import datetime as dt
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from casemart.functions import (
    age_years,
    is_blank,
    null_if,
    parse_date,
    parse_date_lenient,
    parse_int,
    yes_no,
    yes_no_nullable,
)


def column(spark, values, expr):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    out = frame.select("i", expr.alias("r")).collect()
    return [r.r for r in sorted(out, key=lambda r: r.i)]


def test_parse_int_never_raises(spark):
    values = ["7", " 42 ", "-3", "abc", "", None, "12.5", "99999999999"]
    assert column(spark, values, parse_int("v")) == [7, 42, -3, None, None, None, None, None]


DATES = ["2020-03-04", "2020-3-4", "2020-03", "2020", "", None, "2020-13-40", "2021-02-29",
         "2020-02-29", " 2020-03-04", "2020-03-4 ", "2020-03-04T10:00", "2020-03-04\n", "+2020-3-04"]


def test_strict_date_takes_one_form_only(spark):
    got = column(spark, DATES, parse_date("v"))
    want = [None] * len(DATES)
    want[0], want[8] = dt.date(2020, 3, 4), dt.date(2020, 2, 29)
    assert got == want


def test_lenient_date_takes_short_forms(spark):
    got = column(spark, DATES[:6], parse_date_lenient("v"))
    day = dt.date(2020, 3, 4)
    assert got == [day, day, dt.date(2020, 3, 1), dt.date(2020, 1, 1), None, None]
    assert column(spark, ["2020-13-40"], parse_date_lenient("v")) == [None]


def test_strict_date_equals_the_pattern_parser(spark):
    rng = random.Random(7)
    digits = "0123456789"
    values = [
        f"{rng.randint(0, 9999):04d}-{rng.randint(0, 13):02d}-{rng.randint(0, 32):02d}"
        for _ in range(3000)
    ]
    for _ in range(3000):  # damage one character
        v = list(rng.choice(values))
        v[rng.randrange(len(v))] = rng.choice(digits + "- /T:")
        values.append("".join(v))
    ours = column(spark, values, parse_date("v").cast("string"))
    theirs = column(spark, values, F.try_to_date("v", "yyyy-MM-dd").cast("string"))
    assert ours == theirs


def test_yes_no_two_and_three_valued(spark):
    values = ["SI", "NO", "SIN ESPECIFICAR", "", None]
    assert column(spark, values, yes_no("v")) == [True, False, False, False, False]
    assert column(spark, values, yes_no_nullable("v")) == [True, False, None, None, None]


def test_placeholder_and_blank(spark):
    values = ["*sin dato*", "Privado", "", None]
    assert column(spark, values, null_if("v", "*sin dato*")) == [None, "Privado", "", None]
    assert column(spark, values, is_blank("v")) == [False, False, True, True]


@pytest.mark.parametrize(
    "value, unit, want",
    [
        ("30", "Años", 30),
        ("0", "Años", 0),
        ("120", "Años", 120),
        ("121", "Años", None),
        ("-1", "Años", None),
        ("abc", "Años", None),
        (None, "Años", None),
        ("8", "Meses", 0),
        ("abc", "Meses", 0),
        (None, "Meses", 0),
        ("8", None, None),
        ("8", "Días", None),
    ],
)
def test_age(spark, value, unit, want):
    frame = spark.createDataFrame([(value, unit)], "v string, u string")
    assert frame.select(age_years("v", "u")).first()[0] == want


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=12), min_size=1, max_size=50))
def test_parsers_survive_any_text(spark, values):
    for expr in (parse_int("v"), parse_date("v"), parse_date_lenient("v"), yes_no_nullable("v")):
        clean = [v for v in values if "\ud800" > v or v > "\udfff"]
        assert len(column(spark, clean or ["x"], expr)) == len(clean or ["x"])
