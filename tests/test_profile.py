import pytest

from casemart.operators import null_audit, profile, value_counts


@pytest.fixture(scope="module")
def frame(spark):
    data = [("a", "", 1, 0.5), ("a", None, 2, 0.5), ("b", "x", 2, None), (None, "x", 2, -0.0)]
    return spark.createDataFrame(data, "s string, t string, i int, d double")


WANT = [("d", 3, 1, 25.0), ("i", 2, 0, 0.0), ("s", 3, 1, 25.0), ("t", 3, 2, 50.0)]


def test_profile_counts_null_as_a_value(frame, rows):
    assert rows(profile(frame)) == WANT


def test_approximate_profile_agrees_on_few_values(frame, rows):
    assert rows(profile(frame, approx=True)) == WANT


def test_profile_of_chosen_columns(frame, rows):
    assert rows(profile(frame, ["t", "i"])) == WANT[1:2] + WANT[3:]


def test_one_scan_per_type(spark, frame, tmp_path, plan):
    frame.write.parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    texts = stored.select("s", "t")
    assert plan(profile(texts)).count("FileScan") == 1
    assert plan(null_audit(stored)).count("FileScan") == 1
    scans = [x for x in plan(profile(stored)).splitlines() if "FileScan" in x]
    schemas = sorted(x.split("ReadSchema: ")[1] for x in scans)
    assert schemas == ["struct<d:double>", "struct<i:int>", "struct<s:string,t:string>"]


def test_value_counts(frame):
    got = [tuple(r) for r in value_counts(frame, ["s", "i"]).collect()]
    assert got == [("i", "2", 3), ("i", "1", 1), ("s", "a", 2), ("s", None, 1), ("s", "b", 1)]


def test_null_audit_lists_only_columns_with_nulls(frame, rows):
    assert rows(null_audit(frame)) == [("d", 1, 25.0), ("s", 1, 25.0), ("t", 1, 25.0)]
    assert null_audit(frame.filter("false")).collect() == []
