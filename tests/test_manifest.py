"""Loading by content: the same content under another name, and a file changed in place."""

import os

import pytest

from casemart.sources import records
from casemart.streaming import ContentTable
from tests.test_sources import line, write_csv


@pytest.fixture
def landing(spark, tmp_path):
    return ContentTable(spark, str(tmp_path / "in"), str(tmp_path / "table"))


def ids(frame):
    return sorted(r.id_evento_caso for r in frame.select("id_evento_caso").collect())


def test_the_same_content_under_another_name(landing, tmp_path):
    write_csv(tmp_path / "in" / "a.csv", line("1"), line("2"))
    assert ids(landing.load()) == ["1", "2"]
    write_csv(tmp_path / "in" / "b.csv", line("1"), line("2"))
    write_csv(tmp_path / "in" / "below" / "c.csv", line("1"), line("2"))
    write_csv(tmp_path / "in" / "d.csv", line("3"))
    assert ids(landing.load()) == ["1", "2", "3"]
    assert ids(landing.load()) == ["1", "2", "3"]


def test_a_file_changed_in_place(landing, tmp_path):
    write_csv(tmp_path / "in" / "a.csv", line("1"), line("2"))
    write_csv(tmp_path / "in" / "b.csv", line("5"))
    landing.load()
    write_csv(tmp_path / "in" / "a.csv", line("1"), line("2", sexo="F"), line("3"))
    out = landing.load()
    assert ids(out) == ["1", "2", "3", "5"]
    assert [r.sexo for r in out.filter("id_evento_caso = '2'").collect()] == ["F"]
    folders = lambda: sum(d.startswith("content=") for _, ds, _ in os.walk(tmp_path / "table") for d in ds)
    assert folders() == 3
    landing.clean()
    assert folders() == 2 and ids(landing.cases()) == ["1", "2", "3", "5"]


def test_replaced_content_stays_while_another_file_holds_it(landing, tmp_path):
    for name in "ab":
        write_csv(tmp_path / "in" / f"{name}.csv", line("1"))
    landing.load()
    write_csv(tmp_path / "in" / "a.csv", line("2"))
    assert ids(landing.load()) == ["1", "2"]


def test_cases_of_a_file_that_left_stay_and_state_is_bounded(landing, tmp_path):
    for i in range(4):
        write_csv(tmp_path / "in" / "only.csv", line(str(i)))
        landing.load()
    assert ids(landing.cases()) == ["3"] and landing.manifest().count() == 1
    os.remove(tmp_path / "in" / "only.csv")
    write_csv(tmp_path / "in" / "next.csv", line("9"))
    assert ids(landing.load()) == ["3", "9"]
    write_csv(tmp_path / "in" / "back.csv", line("3"))  # delivered again later
    assert ids(landing.load()) == ["3", "9"]
    assert landing.manifest().filter("path is not null").count() == 2
    assert len(os.listdir(tmp_path / "table" / "manifest")) == 2


def test_a_failed_load_is_repeated(landing, tmp_path, monkeypatch):
    write_csv(tmp_path / "in" / "a.csv", line("1"))
    landing.load()
    write_csv(tmp_path / "in" / "b.csv", line("2"))
    with monkeypatch.context() as broken:
        broken.setattr("casemart.streaming.manifest.VERSIONS_KEPT", "lost")
        with pytest.raises(TypeError):
            landing.load()  # after the commit: the cases are there
    assert ids(landing.cases()) == ["1", "2"]
    write_csv(tmp_path / "in" / "c.csv", line("3"))
    with monkeypatch.context() as broken:
        broken.setattr(ContentTable, "manifest", lambda self: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            landing.load()
    assert ids(landing.load()) == ["1", "2", "3"]


def test_quoted_breaks_rejects_and_empty_files(landing, tmp_path):
    write_csv(tmp_path / "in" / "a.csv", line("1", sexo='"a\nb"'), "short,x")
    (tmp_path / "in" / "empty.csv").write_text("")
    write_csv(tmp_path / "in" / "head.csv")
    out = landing.load()
    assert [(r.id_evento_caso, r.sexo) for r in out.collect()] == [("1", "a\nb")]
    assert [r.line for r in landing.rejected().collect()] == ["short,x"]
    assert ids(landing.load()) == ["1"]


def test_the_hash_does_not_depend_on_splits(spark, landing, tmp_path):
    write_csv(tmp_path / "in" / "a.csv", *(line(str(i)) for i in range(300)))
    read = lambda: landing._contents([str(tmp_path / "in" / "a.csv")]).first().content
    whole, before = read(), spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        assert records.numbered_lines(spark, str(tmp_path / "in")).select("block").distinct().count() > 5
        assert read() == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
