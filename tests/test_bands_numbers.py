import datetime as dt

from pyspark.sql import functions as F

from casemart.functions import (
    band_start,
    days_between,
    decade_band,
    fixed_band,
    label_null,
    mean_of,
    month_label,
    month_of,
    months_between,
    percent,
    round_half_even,
)


def test_fixed_bands(spark):
    ages = [0, 9, 10, 19, 20, 39, 40, 69, 70, 79, 80, 120, None]
    frame = spark.createDataFrame([(a,) for a in ages], "a int")
    got = [r[0] for r in frame.select(fixed_band("a")).collect()]
    assert got == ["0-9", "0-9", "10-19", "10-19", "20-29", "30-39", "40-49", "60-69", "70-79",
                   "70-79", "80+", "80+", None]


def test_decade_bands_have_no_cap_and_a_label_on_demand(spark):
    frame = spark.createDataFrame([(a,) for a in [0, 9, 35, 99, 100, 120, None]], "a int")
    got = frame.select(decade_band("a").alias("b"), decade_band("a", "Sin dato").alias("l"))
    bands = [tuple(r) for r in got.collect()]
    assert [b for b, _ in bands] == ["0-9", "0-9", "30-39", "90-99", "100-109", "120-129", None]
    assert bands[-1][1] == "Sin dato"


def test_band_start(spark):
    frame = spark.createDataFrame([("30-39",), ("100-109",), ("80+",), (None,)], "b string")
    assert [r[0] for r in frame.select(band_start("b")).collect()] == [30, 100, None, None]


def test_month(spark):
    frame = spark.createDataFrame([(dt.date(2020, 3, 31),), (None,)], "d date")
    out = frame.select(month_of("d").alias("m"), month_label(month_of("d")).alias("l"))
    assert [tuple(r) for r in out.collect()] == [(dt.datetime(2020, 3, 1), "2020-03"), (None, None)]
    assert out.dtypes[0][1] == "timestamp_ntz"
    assert months_between("2019-11", "2020-02") == ["2019-11", "2019-12", "2020-01", "2020-02"]


def test_month_does_not_depend_on_the_session_zone(spark):
    frame = spark.createDataFrame([(dt.date(2020, 3, 1),)], "d date").select(month_of("d"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Argentina/Buenos_Aires")
        assert frame.first()[0] == dt.datetime(2020, 3, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_days_between(spark):
    frame = spark.sql(
        "select * from values (date'2020-03-05', date'2020-03-01'),"
        " (date'2020-02-28', date'2020-03-01'), (null, date'2020-03-01') as t(e, s)"
    )
    out = frame.select(days_between("e", "s").alias("d"))
    assert [r[0] for r in out.collect()] == [4, -2, None]
    assert out.dtypes == [("d", "int")]


def test_rounding(spark):
    frame = spark.createDataFrame([(0.125,), (2.675,), (1.005,)], "x double")
    half_up = [r[0] for r in frame.select(F.round("x", 2)).collect()]
    even = [r[0] for r in frame.select(round_half_even("x", 2)).collect()]
    assert half_up == [0.13, 2.68, 1.01]
    assert even == [round(x, 2) for x in (0.125, 2.675, 1.005)]


def test_division_by_zero_is_null(spark):
    frame = spark.createDataFrame([(1, 3), (0, 0), (5, 0)], "a long, b long")
    assert [r[0] for r in frame.select(percent("a", "b")).collect()] == [33.33, None, None]
    assert [r[0] for r in frame.select(mean_of("a", "b", 1)).collect()] == [0.3, None, None]


def test_label_null_keeps_groups_apart(spark):
    """Labelling after grouping leaves NULL and a literal label as two rows; before, as one."""
    frame = spark.createDataFrame([(None,), ("Sin dato",), ("AR",)], "pais string")
    after = frame.groupBy("pais").count().withColumn("pais", label_null("pais", "Sin dato"))
    before = frame.groupBy(label_null("pais", "Sin dato").alias("p")).count()
    assert after.count() == 3 and before.count() == 2
