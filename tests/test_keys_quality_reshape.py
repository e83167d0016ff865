import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from casemart.functions import month_label
from casemart.operators import (
    Check,
    any_value_per_group,
    check_not_null,
    check_unique,
    code_collisions,
    distinct_rows,
    long_form,
    matrix,
    merge_null_safe,
    run_checks,
    sort_nulls_last,
    top_n,
    with_surrogate_key,
)


def test_surrogate_key_is_dense_ordered_and_stable(spark):
    pairs = [(p, f"d{i:03d}") for p in (None, "01", "02", "03") for i in range(40)]
    want = {pair: n for n, pair in enumerate(sorted(pairs, key=lambda x: (x[0] or "", x[1])), 1)}
    for seed in (1, 2):
        shuffled = random.Random(seed).sample(pairs, len(pairs))
        frame = spark.createDataFrame(shuffled, "p string, d string").repartition(5 + seed)
        out = with_surrogate_key(frame, ["p", "d"], "sk").collect()
        assert {(r.p, r.d): r.sk for r in out} == want


def test_any_value_is_the_smallest_and_not_sorted(spark, rows, plan):
    data = [("a", "2"), ("a", None), ("a", "1"), ("b", None), (None, "9")]
    frame = spark.createDataFrame(data, "k string, c string")
    out = any_value_per_group(frame, ["k"], "c")
    assert rows(out) == [(None, "9"), ("a", "1"), ("b", None)]
    below_shuffle = plan(out).split("Exchange")[-1]
    assert "SortAggregate" not in below_shuffle and "HashAggregate" in below_shuffle


def test_distinct_rows_need_the_required_column(spark, rows):
    frame = spark.createDataFrame([("1", "x"), ("1", "x"), ("1", "y"), (None, "z")], "k string, n string")
    assert rows(distinct_rows(frame, ["k", "n"], "k")) == [("1", "x"), ("1", "y")]


@pytest.fixture(scope="module")
def people(spark):
    data = [("1", "x", None), ("1", "y", "v"), (None, "z", "v"), (None, "z", None), ("2", None, "v")]
    return spark.createDataFrame(data, "id string, name string, val string")


def test_unique_and_not_null(people, rows):
    assert rows(check_unique(people, "id")) == [("1", 2)]
    assert rows(check_unique(people, "id", null_is_key=True)) == [(None, 2), ("1", 2)]
    assert rows(check_unique(people, ["id", "name"])) == [(None, "z", 2)]
    assert check_not_null(people, "val").count() == 2


def test_report_counts_violations(people, rows):
    checks = [
        Check("unique", "people", "id"),
        Check("unique", "people", "name"),
        Check("not_null", "people", "id"),
        Check("not_null", "people", "val"),
        Check("not_null", "other", "id"),
    ]
    other = people.filter(F.col("id").isNotNull())
    report = run_checks({"people": people, "other": other}, checks)
    assert rows(report) == [
        ("not_null", "other", "id", 0, True),
        ("not_null", "people", "id", 2, False),
        ("not_null", "people", "val", 2, False),
        ("unique", "people", "id", 1, False),
        ("unique", "people", "name", 1, False),
    ]
    empty = run_checks({"people": people.filter("false"), "other": other}, checks)
    assert all(r.passed for r in empty.collect())


def test_code_collisions(spark, rows):
    data = [("035", "06", "A"), ("035", "06", "B"), ("035", "06", None), ("035", "07", "A"),
            (None, "06", "A"), (None, "06", "B")]
    frame = spark.createDataFrame(data, "code string, prov string, name string")
    assert rows(code_collisions(frame, ["code", "prov"], "name")) == [("035", "06", 2, 3)]


def test_sorts(spark):
    frame = spark.createDataFrame([(None, "n"), (2, "b"), (1, "a"), (2, "a")], "v int, k string")
    assert [r.v for r in sort_nulls_last(frame, "v").collect()] == [1, 2, 2, None]
    assert [tuple(r) for r in top_n(frame, "v", 2, ["k"]).collect()] == [(2, "a"), (2, "b")]


def test_long_form(spark, rows):
    frame = spark.createDataFrame([("p", 1, 0.5)], "g string, n long, r double")
    out = long_form(frame, ["g"], ["n", "r"], "metric", "value")
    assert rows(out) == [("p", "n", 1.0), ("p", "r", 0.5)]


def test_matrix_fills_gaps_and_keeps_unlisted_months_in_the_total(spark):
    d = dt.datetime
    data = [("A", d(2020, 1, 1), 3), ("B", d(2020, 2, 1), 9), ("B", d(2020, 1, 1), 1),
            ("A", d(2021, 1, 1), 100)]
    frame = spark.createDataFrame(data, "p string, m timestamp_ntz, n long")
    out = matrix(frame, "p", month_label("m"), ["2020-01", "2020-02"], "n", "total")
    assert out.columns == ["p", "total", "2020-01", "2020-02"]
    assert [tuple(r) for r in out.collect()] == [("A", 103, 3, 0), ("B", 10, 1, 9)]


def test_null_safe_merge(spark, rows):
    a = spark.createDataFrame([(None, 1), ("x", 2), ("y", 3)], "k string, a int")
    b = spark.createDataFrame([(None, 10), ("x", 20)], "k string, b int")
    assert rows(merge_null_safe(a, b, "k")) == [(None, 1, 10), ("x", 2, 20)]
    assert a.join(b, "k").count() == 1
