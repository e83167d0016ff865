"""Buckets, clustered files, counts that ride on the write, and profiles of loads."""

import glob
import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from casemart.operators import (
    check_unique,
    dedup_by_priority,
    duplicate_audit,
    null_audit,
    profile,
    value_counts,
)
from casemart.plans.layers import Layers, WrittenCounts, keep_clustered, keep_under
from casemart.plans.fixture import raw_cases
from casemart.schema import Flavour
from casemart.sources.layout import cluster_by, interleaved, save_bucketed
from casemart.sources.sketches import ProfileStore


@pytest.fixture
def cases(spark):
    return spark.range(20_000).select(
        (F.col("id") % 9_000).alias("k"),
        F.when(F.col("id") % 11 > 0, F.concat(F.lit("class "), F.col("id") % 5)).alias("c"),
        F.date_add(F.lit("2020-03-01").cast("date"), (F.col("id") * 7919 % 900).cast("int")).alias("d"),
        F.when(F.col("id") % 3 > 0, F.col("id") % 17).alias("v"),
    )


@pytest.fixture
def bucketed(spark, cases, tmp_path):
    name = f"b_{uuid.uuid4().hex}"
    yield save_bucketed(cases, name, "k", 4, str(tmp_path / "b"))
    spark.sql(f"DROP TABLE {name}")


def test_bucketed_tables_group_and_rank_without_a_shuffle(cases, bucketed, plan, rows):
    found = [
        lambda df, **how: check_unique(df, "k"),
        lambda df, **how: duplicate_audit(df, "k", **how),
        lambda df, **how: dedup_by_priority(df, "k", [F.col("v").desc()]),
    ]
    for run in found:
        out = run(bucketed, colocated=True)
        assert "Exchange" not in plan(out) and plan(out).count("FileScan") == 1
        assert rows(out) == rows(run(cases))


def test_bucketed_tables_join_without_a_shuffle(spark, bucketed, shuffled_joins, plan):
    other = bucketed.groupBy("k").agg(F.max("v").alias("most"))
    joined = bucketed.join(other, "k")
    assert "Exchange" not in plan(joined) and joined.count() == 20_000


def test_a_bucket_is_one_file(bucketed, tmp_path):
    assert len(glob.glob(str(tmp_path / "b" / "*.parquet"))) == 4


def test_bits_take_turns(spark):
    code = interleaved([(F.col("a"), 2), (F.col("b"), 3)])
    got = spark.createDataFrame([(0b10, 0b011), (0b01, 0b110)], "a int, b int").select(code)
    assert [r[0] for r in got.collect()] == [0b10011, 0b01110]


def touched(folder, column, value):
    """Share of the rows in row groups that may hold a value, by the files' own statistics."""
    seen = total = 0
    for path in glob.glob(f"{folder}/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        for g in range(meta.num_row_groups):
            group = meta.row_group(g)
            at = [group.column(i).path_in_schema for i in range(group.num_columns)].index(column)
            stats = group.column(at).statistics
            total += group.num_rows
            if stats.has_min_max and stats.min <= value <= stats.max:
                seen += group.num_rows
    return seen / total


def test_a_filter_on_either_column_skips_most_rows(spark, cases, tmp_path, rows):
    folder = str(tmp_path / "z")
    cluster_by(cases, ["c", "d"], 64).write.parquet(folder)
    stored = spark.read.parquet(folder)
    assert rows(stored) == rows(cases)
    day = cases.select(F.lit("2021-05-05").cast("date")).first()[0]
    assert touched(folder, "c", "class 3") < 0.4
    assert touched(folder, "d", day) < 0.4
    plain = str(tmp_path / "p")
    cases.sortWithinPartitions("c").write.parquet(plain)
    assert touched(plain, "d", day) > 0.9


def test_clustering_of_nulls_and_of_nothing(spark, cases, rows):
    empty = cluster_by(cases.filter("false"), ["c", "d"], 4)
    assert empty.count() == 0 and empty.columns == cases.columns
    nulls = cases.withColumn("c", F.lit(None).cast("string")).limit(10)
    assert cluster_by(nulls, ["c", "v"], 4).count() == 10


def test_written_counts_equal_a_scan(spark, sf_dir, tmp_path, rows):
    counts = WrittenCounts(keep_under(str(tmp_path)))
    layers = Layers(raw_cases(spark, sf_dir), Flavour.CONFIRMED, counts.store)
    for name in ("silver_casos", "fact_casos"):
        assert rows(counts.null_audit(name) if layers.tables() else None) == rows(
            null_audit(layers.tables()[name])
        )
        assert counts.rows(name) == layers.tables()[name].count()


def test_written_counts_read_nothing(cases, tmp_path, plan):
    counts = WrittenCounts(keep_under(str(tmp_path)))
    counts.store("empty", cases.filter("false"))
    counts.store("cases", cases, ("c",))
    assert "FileScan" not in plan(counts.null_audit("cases"))
    assert counts.rows("empty") == 0 and counts.null_audit("empty").collect() == []


def test_clustered_layers_keep_their_rows(spark, cases, tmp_path, rows):
    store = keep_clustered(keep_under(str(tmp_path)), {"a": ("c", "d")}, 8)
    assert rows(store("a", cases, ("k",))) == rows(cases) == rows(store("b", cases, ("k",)))


def test_sketches_of_loads_equal_one_profile(spark, cases, tmp_path, rows):
    store = ProfileStore(spark, str(tmp_path), ["k", "c", "v"], ["c", "v"])
    assert store.profile().collect() == [] and store.value_counts().collect() == []
    parts = [cases.filter("k < 100"), cases.filter("k >= 100 AND k < 4000"), cases.filter("k >= 4000")]
    for n, part in enumerate([*parts, cases.filter("false")]):
        store.add(part, f"load{n}")
    store.add(parts[1], "load1")
    want = {r["column"]: r for r in profile(cases.select("k", "c", "v")).collect()}
    got = {r["column"]: r for r in store.profile().collect()}
    assert got.keys() == want.keys()
    for name, row in want.items():
        assert abs(got[name].n_distinct - row.n_distinct) <= 0.03 * row.n_distinct
        assert (got[name].n_missing, got[name].pct_missing) == (row.n_missing, row.pct_missing)
    assert rows(store.value_counts()) == rows(value_counts(cases, ["c", "v"]))


def test_a_profile_reads_sketches_only(spark, cases, tmp_path, plan):
    source, kept = str(tmp_path / "cases"), str(tmp_path / "kept")
    cases.write.parquet(source)
    store = ProfileStore(spark, kept, ["k", "c"], ["c"])
    store.add(spark.read.parquet(source), "one")
    for out in (store.profile(), store.value_counts()):
        assert source not in plan(out, "formatted") and kept in plan(out, "formatted")
