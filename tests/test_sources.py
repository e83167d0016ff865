import os

import pytest
from pyspark.sql import functions as F

from casemart.schema import RAW_COLUMNS, RAW_SCHEMA
from casemart.sources import (
    create_raw_table,
    export_mart,
    file_version,
    read_raw_csv,
    read_raw_lines,
    replace_table,
    save_mart,
    shared_dir,
    write_and_read,
)
from casemart.sources.raw import rejected

HEADER = ",".join(RAW_COLUMNS)


def line(case_id, **values):
    cells = {"id_evento_caso": case_id, **values}
    return ",".join(cells.get(c, "") for c in RAW_COLUMNS)


def write_csv(path, *lines, header=HEADER):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")


def test_raw_schema_is_25_text_columns():
    assert len(RAW_COLUMNS) == 25 and len(set(RAW_COLUMNS)) == 25
    assert {f.dataType.simpleString() for f in RAW_SCHEMA} == {"string"}


def test_csv_scan_keeps_text_and_reads_empty_as_null(spark, tmp_path):
    write_csv(
        tmp_path / "a.csv",
        line("007", sexo="M", edad='""', residencia_provincia_id="06", origen_financiamiento="Público"),
    )
    row = read_raw_csv(spark, str(tmp_path / "a.csv")).first()
    assert (row.id_evento_caso, row.residencia_provincia_id) == ("007", "06")
    assert row.origen_financiamiento == "Público"
    assert row.edad is None and row.fallecido is None


def test_csv_with_columns_in_another_order_is_an_error(spark, tmp_path):
    swapped = ",".join(["sexo", "id_evento_caso", *RAW_COLUMNS[2:]])
    write_csv(tmp_path / "a.csv", line("1"), header=swapped)
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_csv(spark, str(tmp_path / "a.csv")).collect()


def test_raw_table_is_created_once(spark, tmp_path):
    path = str(tmp_path / "raw")
    table = create_raw_table(spark, "raw_created_once", path)
    assert table.columns == RAW_COLUMNS and table.count() == 0
    row = spark.createDataFrame([tuple(RAW_COLUMNS)], RAW_SCHEMA)
    row.write.insertInto("raw_created_once")
    assert create_raw_table(spark, "raw_created_once", path).count() == 1


def test_full_refresh_replaces_rows_and_schema(spark):
    save_mart(spark.range(3).withColumn("a", F.lit(1)), "mart_refreshed")
    out = save_mart(spark.range(2).withColumn("b", F.lit("x")), "mart_refreshed")
    assert out.columns == ["id", "b"] and out.count() == 2


def test_table_derived_from_itself(spark):
    save_mart(spark.range(4), "mart_in_place")
    save_mart(spark.table("mart_in_place").filter("id > 0"), "mart_in_place")
    out = replace_table(spark, "mart_in_place", lambda t: t.filter("id > 1"))
    assert sorted(r.id for r in out.collect()) == [2, 3]


@pytest.mark.parametrize("refresh", ["save", "replace"])
def test_a_failed_refresh_leaves_the_old_rows(spark, refresh):
    name = f"mart_kept_{refresh}"
    save_mart(spark.range(3), name)
    bad = F.raise_error(F.lit("lost")).cast("long").alias("id")
    with pytest.raises(Exception, match="lost"):
        if refresh == "save":
            save_mart(spark.range(5).select(bad), name)
        else:
            replace_table(spark, name, lambda t: t.select(bad))
    assert spark.table(name).count() == 3


def test_old_files_go_after_a_refresh(spark, tmp_path):
    path = tmp_path / "versions"
    for n in (1, 2, 3):
        save_mart(spark.range(n), "mart_versions", str(path))
    assert len(list(path.iterdir())) == 1 and spark.table("mart_versions").count() == 3


def test_lines_that_do_not_fit_are_kept_whole(spark, tmp_path):
    surplus, short = line("2") + ",one,more", "3,x"
    broken = ['4,"multi', 'line",z']
    write_csv(tmp_path / "a.csv", line("1"), surplus, short, *broken, line("5"))
    lines = read_raw_lines(spark, str(tmp_path / "a.csv"))
    assert sorted(r.line for r in rejected(lines).collect()) == sorted([surplus, short, *broken])
    good = read_raw_csv(spark, str(tmp_path / "a.csv"))
    assert sorted(r.id_evento_caso for r in good.collect()) == ["1", "5"]


def test_file_version_sees_a_file_below_an_unchanged_folder(spark, tmp_path):
    folder = tmp_path / "t" / "p=1"
    spark.range(5).write.parquet(str(folder))
    before = file_version(spark, [f"file:{tmp_path}/t"])
    assert before == file_version(spark, [str(tmp_path / "t")])
    part = next(p for p in folder.iterdir() if p.name.endswith(".parquet"))
    times = [(d, d.stat().st_mtime_ns) for d in (folder, tmp_path / "t")]
    part.write_bytes(part.read_bytes() + b"x")
    for d, t in times:
        os.utime(d, ns=(t, t))
    assert before != file_version(spark, [f"file:{tmp_path}/t"])


def test_export_refuses_to_cut(spark):
    assert len(export_mart(spark.range(5), 5)) == 5
    with pytest.raises(ValueError, match="more than 4"):
        export_mart(spark.range(5), 4)


def test_written_layer_is_a_fresh_scan(spark, tmp_path, plan):
    out = write_and_read(spark.range(100).withColumn("c", F.col("id") % 4), str(tmp_path / "t"), ["c"])
    text = plan(out.filter("c = 1").select("id"))
    assert "Range" not in text and "EqualTo(c,1)" in text
    assert out.filter("c = 1").count() == 25


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_without_the_setting_it_lies_in_the_warehouse(spark):
    class Session:
        conf = {"spark.sql.warehouse.dir": "hdfs://lake/warehouse"}

    assert shared_dir(Session()) == "hdfs://lake/warehouse/_work"
