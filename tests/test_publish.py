"""Write, audit, publish: what readers see before, during and after a refresh."""

import pytest
from pyspark.sql import functions as F

from casemart.operators import Check, run_checks
from casemart.plans import marts
from casemart.plans.checks import CHECKS
from casemart.schema import RAW_SCHEMA, Flavour
from casemart.sources import AuditFailed, matching, publish
from casemart.sources.publish import expire
from tests.test_marts import case


def unique_ids(staged):
    return run_checks({"t": staged}, [Check("unique", "t", "id"), Check("not_null", "t", "id")])


def ids(frame):
    return sorted(r.id for r in frame.collect())


def test_a_failing_check_leaves_the_old_version(spark, tmp_path):
    publish(spark.range(3), "wap_kept", unique_ids, str(tmp_path))
    twice = spark.range(5).unionByName(spark.range(1))
    with pytest.raises(AuditFailed, match="unique id: 1") as error:
        publish(twice, "wap_kept", unique_ids, str(tmp_path))
    assert ids(spark.table("wap_kept")) == [0, 1, 2]
    assert spark.read.parquet(error.value.folder).count() == 6  # there to be looked at
    assert ids(publish(spark.range(4), "wap_kept", unique_ids, str(tmp_path))) == [0, 1, 2, 3]


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    publish(spark.range(3), "wap_lost", None, str(tmp_path))
    with pytest.raises(Exception, match="lost"):
        publish(spark.range(5).select(F.raise_error(F.lit("lost")).cast("long").alias("id")), "wap_lost",
                None, str(tmp_path))
    assert ids(spark.table("wap_lost")) == [0, 1, 2]


def test_a_reader_that_started_before_a_refresh_ends(spark, tmp_path):
    publish(spark.range(0, 5000, 1, 10), "wap_reader", None, str(tmp_path))
    reader = spark.table("wap_reader").toLocalIterator()
    seen = [next(reader).id for _ in range(10)]
    publish(spark.range(7).withColumn("b", F.lit(1)), "wap_reader", None, str(tmp_path))
    seen += [r.id for r in reader]
    assert sorted(seen) == list(range(5000))
    assert spark.table("wap_reader").columns == ["id", "b"]


def test_versions_stay_for_the_set_time(spark, tmp_path):
    path = str(tmp_path)
    for n in (1, 2, 3):
        publish(spark.range(n), "wap_versions", None, path, keep_seconds=3600)
    folders = matching(spark, f"{path}/*")
    assert len(folders) == 3
    newest = int(folders[-1].rsplit("/", 1)[1].split("-")[0]) / 1000
    assert expire(spark, path, 3600, newest + 3599) in ([], folders[:1])
    assert expire(spark, path, 3600, newest + 3601)[-1] == folders[1]
    assert expire(spark, path, 0, newest + 9e9) == []  # the published one never goes
    assert ids(spark.table("wap_versions")) == [0, 1, 2]


def test_a_version_may_read_the_one_before(spark, tmp_path):
    publish(spark.range(4), "wap_self", None, str(tmp_path))
    out = publish(spark.table("wap_self").filter("id > 1"), "wap_self", unique_ids, str(tmp_path))
    assert ids(out) == [2, 3]


def test_build_publishes_what_passes(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS wap_build")

    def build(*rows):
        raw = spark.createDataFrame(list(rows), RAW_SCHEMA)
        return marts.build(spark, raw, Flavour.ALLCASES, ["kpis_generales"], "published", "wap_build", CHECKS)

    kpis = "wap_build.gold_kpis_generales"
    build(case("1"), case("2"))
    assert spark.table(kpis).first().total_casos == 2
    with pytest.raises(AuditFailed, match="fact_casos.*not_null fallecido: 1"):
        build(case("1"), case("2"), case("3", fallecido=None))
    assert spark.table(kpis).first().total_casos == 2
    assert spark.table("wap_build.fact_casos").count() == 2
