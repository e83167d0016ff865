"""Survivors in buckets, cells by signed changes, and marts from one scan of the fact."""

import os
import random

import pytest
from pyspark.sql import DataFrameWriter, functions as F

from casemart.operators import changed, fold
from casemart.plans import clean, cube, deliveries, marts
from casemart.plans.layers import Layers, keep_under
from casemart.plans.queries import Workspace
from casemart.schema import RAW_SCHEMA, Flavour
from casemart.sources import buckets
from casemart.sources.buckets import BucketStore
from tests.test_marts import case

C, A = Flavour.CONFIRMED, Flavour.ALLCASES


def reports(rng, n, ids):
    """Reports of few cases: repeated, replaced, late, without an id, place or date."""
    out = []
    for _ in range(n):
        out.append(case(
            rng.choice([*ids, None]), sexo=rng.choice("FM"), edad=rng.choice(["8", "95", "x"]),
            origen_financiamiento=rng.choice(["Público", "Privado", "*sin dato*"]),
            clasificacion_resumen=rng.choice(["Confirmado", "Confirmado", "Descartado", None]),
            fecha_inicio_sintomas=rng.choice(["2020-06-01", "2020-07-09", None]),
            fecha_diagnostico=rng.choice(["2020-07-12", None]),
            fallecido=rng.choice(["SI", "NO"]),
            **rng.choice([{}, {"residencia_provincia_id": "02", "residencia_provincia_nombre": "Caba"},
                          {"residencia_provincia_id": None, "residencia_provincia_nombre": None}]),
        ))
    return out


def files(path):
    """Data files per bucket folder."""
    return {d: sorted(f for f in os.listdir(path / d) if f.endswith(".parquet"))
            for d in os.listdir(path) if d.startswith("_bucket=")}


def all_rows(frame, sort=sorted):
    return sort((tuple(r) for r in frame.collect()), key=str)


@pytest.fixture
def three(spark):
    rng = random.Random(6)
    few = [str(i) for i in range(3)]
    rows = [reports(rng, 120, [str(i) for i in range(60)]), reports(rng, 15, few)]
    rows.append(rows[0][:30] + reports(rng, 5, ["late"]))
    return [spark.createDataFrame(r, RAW_SCHEMA) for r in rows]


def test_deliveries_end_as_one_full_run(spark, tmp_path, three):
    kept = deliveries.Deliveries(spark, str(tmp_path), buckets=32)
    for n, delivery in enumerate(three):
        kept.load(delivery, f"d{n}")
    everything = three[0].unionByName(three[1]).unionByName(three[2])
    assert all_rows(kept.store.read()) == all_rows(clean.best_reports(everything))
    full = Layers(everything, C, keep_under(str(tmp_path / "full")))
    for name in marts.mart_names(C):
        got = all_rows(marts.MARTS[name].build(kept.layers()))
        assert got == all_rows(marts.MARTS[name].build(full)), name


def test_only_touched_buckets_are_rewritten(spark, tmp_path, three):
    store = deliveries.report_store(spark, str(tmp_path), buckets=32)
    store.merge(three[0], "a")
    before = files(tmp_path / "rows")
    touched = {f"_bucket={r[0]}" for r in three[1].select(store._bucket()).distinct().collect()}
    store.merge(three[1], "b")
    after = files(tmp_path / "rows")
    assert len(touched) < len(before) / 2
    assert {d for d in after if after[d] != before.get(d)} == touched


def test_the_merge_reads_touched_buckets_only(spark, tmp_path, three, plan):
    store = deliveries.report_store(spark, str(tmp_path), buckets=32)
    store.merge(three[0], "a")
    text = plan(store._stored().filter(F.col("_bucket").isin([1, 2])), "formatted")
    assert "_bucket" in text.split("PartitionFilters:")[1].splitlines()[0]


@pytest.mark.parametrize("step", ["_replace", "_stage"])
def test_a_failed_merge_is_repeated(spark, tmp_path, three, step, monkeypatch):
    kept = deliveries.Deliveries(spark, str(tmp_path), buckets=8)
    kept.load(three[0], "a")
    with monkeypatch.context() as broken:
        def lose(*args):
            raise RuntimeError("lost")
        broken.setattr(BucketStore, step, lose)
        with pytest.raises(RuntimeError):
            kept.load(three[1], "b")
    assert all_rows(kept.store.read()) == all_rows(clean.best_reports(three[0]))
    kept.load(three[1], "b")
    once = all_rows(kept.store.read())
    both = three[0].unionByName(three[1])
    assert once == all_rows(clean.best_reports(both))
    again = kept.store.merge(three[1], "b")  # the same delivery under its name
    assert all_rows(kept.store.read()) == once
    assert again.added.count() >= again.removed.count() > 0
    later = deliveries.Deliveries(spark, str(tmp_path), buckets=8)  # another run goes on here
    later.load(three[2], "c")
    later.load(three[0], "a")
    want = clean.best_reports(both.unionByName(three[2]))
    assert all_rows(later.store.read()) == all_rows(want)
    assert all_rows(later.cells) == all_rows(cube.fold_cases(deliveries.measured_cases(want), C))


def test_a_staged_merge_is_finished_before_the_next(spark, tmp_path, three, monkeypatch):
    store = deliveries.report_store(spark, str(tmp_path), buckets=8)
    with monkeypatch.context() as broken:
        broken.setattr(BucketStore, "_replace", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.merge(three[0], "a")
    store.merge(three[1], "b")
    assert all_rows(store.read()) == all_rows(clean.best_reports(three[0].unionByName(three[1])))


def test_a_repeated_delivery_under_another_name_changes_nothing(spark, tmp_path, three):
    store = deliveries.report_store(spark, str(tmp_path), buckets=8)
    store.merge(three[0], "a")
    change = store.merge(three[0], "b")
    assert change.added.count() == change.removed.count() == 0


@pytest.fixture
def removed_plans(monkeypatch, plan):
    """The plans of the frames that are written as removed rows, in order."""
    plans, write = [], DataFrameWriter.parquet

    def parquet(self, path, *args, **kwargs):
        if path.endswith("/removed"):
            plans.append(plan(self._df))
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return plans


def test_many_winners_are_not_broadcast(spark, tmp_path, three, removed_plans, monkeypatch):
    store = deliveries.report_store(spark, str(tmp_path), buckets=8)
    monkeypatch.setattr(buckets, "BROADCAST_KEYS", 0, raising=False)
    replaced = 0
    for n, delivery in enumerate(three):
        before = {tuple(r) for r in store.read().collect()}
        change = store.merge(delivery, f"d{n}")
        after = {tuple(r) for r in store.read().collect()}
        assert {tuple(r) for r in change.removed.collect()} == before - after
        replaced += len(before - after)
    assert replaced
    assert "Join" not in removed_plans[0] and "SortMergeJoin" in removed_plans[1]
    assert not any("BroadcastHashJoin" in text for text in removed_plans)


def test_few_winners_are_broadcast(spark, tmp_path, three, removed_plans):
    store = deliveries.report_store(spark, str(tmp_path), buckets=8)
    store.merge(three[0], "a")
    assert store.merge(three[1], "b").removed.count()
    store.merge(three[0], "c")  # without a winner nothing is joined
    assert [text.count("BroadcastHashJoin") for text in removed_plans] == [0, 1, 0]


def test_a_hot_case_is_cut_before_the_shuffle(spark, tmp_path, three, plan):
    store = deliveries.report_store(spark, str(tmp_path), buckets=8)
    rows = three[0].withColumns({"_new": F.lit(True), "_bucket": store._bucket()})
    assert plan(store.pick(rows, [F.col("_new")])).count("WindowGroupLimit") == 2


def test_empty_deliveries(spark, tmp_path):
    kept = deliveries.Deliveries(spark, str(tmp_path), buckets=4)
    empty = spark.createDataFrame([], RAW_SCHEMA)
    kept.load(empty, "a")
    kept.load(spark.createDataFrame([case("1")], RAW_SCHEMA), "b")
    kept.load(empty, "c")
    assert marts.kpis_generales(kept.layers()).first().total_confirmados == 1
    assert kept.silver().count() == 1


def test_signed_changes_equal_a_new_fold(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.choice([3, None])) for _ in range(300)]
    frame = lambda part: spark.createDataFrame(part, "x string, y int, v int")
    folded = lambda part: fold(
        frame(part), {"x": ["x"], "xy": ["x", "y"], "all": []},
        {"n": F.count(F.lit(1)), "s": F.count("v")})
    out = changed(folded(rows[:200]), folded(rows[200:]), folded(rows[:50]), ["n", "s"], "n")
    assert all_rows(out) == all_rows(folded(rows[50:]))


def test_marts_of_a_build_read_the_fact_once(spark, sf_dir, plan):
    layers = Workspace.of(spark, sf_dir).layers
    for flavour in Flavour:
        source = cube.from_cells(layers[flavour])
        folding = plan(cube.fold_cases(layers[flavour].fact, flavour))
        assert folding.count("FileScan") == 1 and folding.count("Exchange") == 1
        for name in marts.mart_names(flavour):
            scans = plan(marts.MARTS[name].build(source), "formatted")
            assert "fact_casos" not in scans and "gold_cells" in scans, name


def test_build_folds_cells_for_tables(spark, tmp_path):
    raw = spark.createDataFrame(reports(random.Random(1), 40, ["1", "2", "3", "4"]), RAW_SCHEMA)
    spark.sql("CREATE DATABASE IF NOT EXISTS cells_build")
    for flavour in Flavour:
        tables = marts.build(spark, raw, flavour, database="cells_build")
        direct = Layers(raw, flavour, keep_under(str(tmp_path / flavour.value)))
        for name in marts.mart_names(flavour):
            got = all_rows(tables[f"gold_{name}"])
            assert got == all_rows(marts.MARTS[name].build(direct)), name
