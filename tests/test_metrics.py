import pytest

from casemart.operators import (
    Summary,
    delay_by_group,
    flag_counts,
    group_counts,
    rate_by_group,
    share_of_total,
    summarise,
    summarise_by_dimension,
)

CASES = [
    # g, key, flag, delay
    ("a", "01", True, 4),
    ("a", "01", False, None),
    ("a", "02", True, 1),
    ("b", "02", None, -2),
    ("b", "99", None, None),
    (None, None, True, 3),
]


@pytest.fixture(scope="module")
def cases(spark):
    return spark.createDataFrame(CASES, "g string, key string, flag boolean, delay int")


def test_null_flags_count_as_null_or_as_zero(cases, rows):
    two = flag_counts(cases, ["g"], {"hits": "flag"})
    assert rows(two) == [(None, 1, 1), ("a", 3, 2), ("b", 2, None)]
    three = flag_counts(cases, ["g"], {"hits": "flag"}, null_as_zero=True)
    assert rows(three) == [(None, 1, 1), ("a", 3, 2), ("b", 2, 0)]


def test_rate(cases, rows):
    out = rate_by_group(cases, ["g"], {"hits": "flag"})
    assert out.columns == ["g", "n", "hits", "hits_pct"]
    assert rows(out) == [(None, 1, 1, 100.0), ("a", 3, 2, 66.67), ("b", 2, None, None)]


def test_delay_ignores_nulls(cases, rows):
    out = delay_by_group(cases, ["g"], {"mean": "delay"}, digits=1)
    assert rows(out) == [(None, 3.0), ("a", 2.5), ("b", -2.0)]


def test_share_of_total_sums_to_all_rows(cases, rows):
    assert rows(share_of_total(cases, ["g"], digits=2)) == [
        (None, 1, 16.67), ("a", 3, 50.0), ("b", 2, 33.33),
    ]
    assert share_of_total(cases.filter("false"), ["g"]).collect() == []


def test_group_counts_keep_null(cases, rows):
    assert rows(group_counts(cases, ["g"])) == [(None, 1), ("a", 3), ("b", 2)]


SUMMARY = Summary(
    total="n", flags={"hits": "flag"}, rates={"rate": "hits"}, means={"mean": "delay"}
)
# A repeated id (two spellings) fans out, and two ids share a label.
DIM = [("01", "North"), ("02", "South"), ("02", "SOUTH"), ("03", "North")]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_folding_before_the_join_changes_nothing(spark, cases, rows, how):
    dim = spark.createDataFrame(DIM, "key string, name string")
    plain = summarise(cases.join(dim, "key", how), ["name"], SUMMARY)
    folded = summarise_by_dimension(cases, "key", dim, "name", SUMMARY, how)
    assert rows(folded) == rows(plain)
    names = {r.name for r in folded.collect()}
    assert (None in names) == (how == "left")


def test_dimension_summary_with_extra_keys(spark, cases, rows):
    dim = spark.createDataFrame(DIM, "key string, name string")
    plain = summarise(cases.join(dim, "key", "left"), ["name", "g"], SUMMARY)
    folded = summarise_by_dimension(cases, "key", dim, "name", SUMMARY, extra_keys=["g"])
    assert rows(folded) == rows(plain)


def test_means_of_long_and_double_columns(spark):
    frame = spark.createDataFrame([(1.5, 10), (2.5, 13), (None, None)], "x double, y long")
    out = delay_by_group(frame, [], {"x": "x", "y": "y"}, digits=None).first()
    assert tuple(out) == (2.0, 11.5)
