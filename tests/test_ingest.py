import os

import pytest

from casemart.sources import create_loaded_view
from casemart.streaming import ingest_new_files, rejected_lines
from tests.test_sources import line, write_csv


@pytest.fixture
def load(spark, tmp_path):
    def run(**options):
        return ingest_new_files(
            spark,
            str(tmp_path / "in"),
            str(tmp_path / "table"),
            str(tmp_path / "checkpoint"),
            **options,
        )

    return run


def ids(frame):
    return sorted(r.id_evento_caso for r in frame.select("id_evento_caso").collect())


def test_each_file_is_loaded_once(load, tmp_path):
    write_csv(tmp_path / "in" / "a.csv", line("1"), line("2"))
    write_csv(tmp_path / "in" / "b.csv", line("3"))
    assert ids(load()) == ["1", "2", "3"]
    assert ids(load()) == ["1", "2", "3"]
    write_csv(tmp_path / "in" / "c.csv", line("4"))
    assert ids(load()) == ["1", "2", "3", "4"]


def test_a_file_changed_in_place_is_not_read_again(load, tmp_path):
    write_csv(tmp_path / "in" / "a.csv", line("1"))
    load()
    write_csv(tmp_path / "in" / "a.csv", line("1"), line("2"))
    assert ids(load()) == ["1"]


def test_a_late_delivery_of_an_old_file_is_loaded(load, tmp_path):
    write_csv(tmp_path / "in" / "new.csv", line("1"))
    load()
    write_csv(tmp_path / "in" / "old.csv", line("2"))
    os.utime(tmp_path / "in" / "old.csv", (1_000_000_000, 1_000_000_000))  # 2001
    assert ids(load()) == ["1", "2"]


def test_only_matching_names_are_loaded(load, tmp_path):
    write_csv(tmp_path / "in" / "cases_1.csv", line("1"))
    write_csv(tmp_path / "in" / "other_1.csv", line("2"))
    assert ids(load(pattern="cases_*.csv")) == ["1"]


def test_a_backlog_can_be_split_into_commits(load, tmp_path):
    for i in range(5):
        write_csv(tmp_path / "in" / f"{i}.csv", line(str(i)))
    assert ids(load(max_bytes_per_batch=1000)) == ["0", "1", "2", "3", "4"]
    commits = [f for f in os.listdir(tmp_path / "checkpoint" / "commits") if f.isdigit()]
    assert len(commits) > 1


def test_interrupted_batch_counts_once(spark, load, tmp_path):
    """Lose the commit marker of a finished batch, as a crash would: the rerun adds nothing."""
    write_csv(tmp_path / "in" / "a.csv", line("1"), line("2"))
    load()
    commits = tmp_path / "checkpoint" / "commits"
    for name in os.listdir(commits):
        os.remove(commits / name)
    assert ids(load()) == ["1", "2"]


def test_the_raw_table_can_sit_on_the_loaded_files(spark, load, tmp_path):
    write_csv(tmp_path / "in" / "a.csv", line("1"), line("2"), "short")
    load()
    view = create_loaded_view(spark, "raw_on_loaded_files", str(tmp_path / "table"))
    assert ids(view) == ["1", "2"]
    write_csv(tmp_path / "in" / "b.csv", line("3"))
    load()
    spark.catalog.refreshTable("raw_on_loaded_files")
    assert ids(spark.table("raw_on_loaded_files")) == ["1", "2", "3"]


def test_rejected_lines_are_stored_beside_the_cases(spark, load, tmp_path):
    write_csv(tmp_path / "in" / "a.csv", line("1"), line("2") + ",surplus", "short")
    assert ids(load()) == ["1"]
    lost = rejected_lines(spark, str(tmp_path / "table"))
    assert sorted(r.line for r in lost.collect()) == sorted([line("2") + ",surplus", "short"])


def test_loaded_files_can_be_archived(load, tmp_path):
    archive = str(tmp_path / "archive")
    for i in range(3):
        write_csv(tmp_path / "in" / f"{i}.csv", line(str(i)))
        assert len(ids(load(archive_dir=archive))) == i + 1
