"""Records with quoted line breaks, read from files that are split far inside them."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from casemart.schema import RAW_COLUMNS
from casemart.sources import read_raw_csv, records
from casemart.sources.raw import REJECTED, fitting
from tests.test_sources import HEADER, line, write_csv


@pytest.fixture
def small_splits(spark):
    settings = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def cases(frame):
    return sorted(
        (tuple(v or "" for v in r[:25]) for r in frame.filter(f"{REJECTED} is null").collect())
    )


def rejects(frame):
    return sorted(r[REJECTED] for r in frame.filter(f"{REJECTED} is not null").collect())


BREAKS = ["l1\nl2", "\n", "a,\nb,\n", "é\r\nz", "x" * 3000 + "\ny", 'say "hi"\nto', '",\n"', "a\n" + "b," * 24]


def test_every_case_of_many_splits(spark, tmp_path, small_splits):
    rng, want = random.Random(5), []
    for f in range(3):
        with open(tmp_path / f"{f}.csv", "w", newline="", encoding="utf-8") as out:
            out.write(HEADER + "\n")
            for i in range(300):
                row = [f"{f}-{i}", *(rng.choice(BREAKS) if rng.random() < 0.06 else rng.choice(["v", ""])
                                     for _ in range(24))]
                want.append(tuple(row))
                style = csv.QUOTE_ALL if any('"' in v for v in row) else rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL])
                csv.writer(out, lineterminator="\n", doublequote=False, escapechar="\\", quoting=style).writerow(row)
    lines = records.numbered_lines(spark, str(tmp_path))
    assert lines.select("file", "block").distinct().count() > 100
    out = records.read_raw_records(spark, str(tmp_path))
    assert rejects(out) == [] and cases(out) == sorted(want)


def test_agrees_with_the_line_reader_where_nothing_spans_lines(spark, tmp_path):
    good = [line(str(i), sexo='"a,b"', edad='""', origen_financiamiento="Público") for i in range(5)]
    write_csv(tmp_path / "a.csv", *good, "", line("9") + ",surplus", "short,x")
    out = records.read_raw_records(spark, str(tmp_path))
    assert rejects(out) == sorted([line("9") + ",surplus", "short,x"])
    assert cases(out) == sorted(tuple(v or "" for v in r) for r in read_raw_csv(spark, str(tmp_path)).collect())


def test_windows_line_ends(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(
        "\r\n".join([HEADER, line("1"), line("2", ultima_actualizacion='"a\r\nb"'), line("3"), ""]).encode()
    )
    out = cases(records.read_raw_records(spark, str(tmp_path)))
    assert [r[0] for r in out] == ["1", "2", "3"] and out[1][-1] == "a\r\nb" and out[0][-1] == ""


def test_a_stray_quote_costs_no_case(spark, tmp_path, small_splits):
    after = [line(str(i)) for i in range(10, 60)]
    write_csv(tmp_path / "a.csv", line("1"), '4,"never closed', *after)
    write_csv(tmp_path / "b.csv", line("2", sexo='a"b'), line("3", sexo='"c\nd"'))
    out = records.read_raw_records(spark, str(tmp_path))
    assert rejects(out) == ['4,"never closed']
    assert {r[0] for r in cases(out)} == {"1", "2", "3", *(str(i) for i in range(10, 60))}


def test_a_span_beyond_the_bound_is_judged_line_by_line(spark, tmp_path, monkeypatch):
    write_csv(tmp_path / "a.csv", line("1", sexo='"a\nb\nc"'), line("2", sexo='"a\nb"'))
    whole = records.read_raw_records(spark, str(tmp_path))
    assert [r[0] for r in cases(whole)] == ["1", "2"]
    monkeypatch.setattr(records, "MAX_LINES", 2)
    cut = records.read_raw_records(spark, str(tmp_path))
    assert [r[0] for r in cases(cut)] == ["2"] and len(rejects(cut)) == 3


def test_columns_in_another_order_are_an_error(spark, tmp_path):
    write_csv(tmp_path / "a.csv", line("1"), header=",".join(["sexo", "id_evento_caso", *RAW_COLUMNS[2:]]))
    with pytest.raises(Exception, match="(?i)header"):
        records.read_raw_records(spark, str(tmp_path)).collect()


def test_maps_compose_to_the_state_of_a_plain_scan(spark, small_splits):
    rng = random.Random(2)
    values = ['"a', 'b"', ',"', '"', "plain", '"x","y"', 'z",', ',"",', '\\"', '"""', 'a""b']
    rows = [(f"f{f}", b, b * 1000 + n, rng.choice(values)) for f in range(4) for b in range(6)
            for n in range(rng.randint(1, 12))]
    frame = spark.createDataFrame(rows, "file string, block long, line long, value string")
    maps = {tuple(r)[:3]: (r.fixed, r.flip) for r in records.line_maps(frame).collect()}
    want, opened = set(), None
    for file in sorted({r[0] for r in rows}):
        state = 0
        for r in sorted(r for r in rows if r[0] == file):
            fixed, flip = maps.get(r[:3], (None, 0))
            after = ((state if fixed is None else fixed) + flip) % 2
            if state == 0 and after == 1:
                opened = r[1:3]
            if state or after:
                want.add((*r[:3], opened))
            state = after
    found = records.spans(frame).withColumn("line", F.explode(F.sequence("from", "to")))
    got = {(r.file, r.block, r.line, tuple(r.record)) for r in found.collect()}
    assert got == want and want


def test_no_task_reads_a_whole_file(spark, tmp_path, plan):
    write_csv(tmp_path / "a.csv", line("1"))
    text = plan(records.read_raw_records(spark, str(tmp_path)))
    assert "SinglePartition" not in text and "Python" not in text and "MapInArrow" not in text


def test_a_filter_does_not_parse_a_line_again(spark, tmp_path, plan):
    (tmp_path / "a.csv").write_text(HEADER + "".join(line(str(i)) for i in range(5)))
    text = plan(fitting(records.read_raw_records(spark, str(tmp_path))), "formatted")
    conditions = [x for x in text.splitlines() if x.startswith("Condition")]
    assert conditions and not any("from_csv" in x for x in conditions)
    assert all(x.count("from_csv") <= 2 for x in text.splitlines())  # a span: whole, or its lines
