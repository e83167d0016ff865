import pytest

import pipeline
from casemart.schema import Flavour
from casemart.session import TEXT_TO_SHUFFLE, shuffle_partitions_for
from casemart.sources import file_version
from tests.test_sources import line, write_csv

CASE = {
    "sexo": "F", "edad": "40", "edad_años_meses": "Años", "residencia_provincia_id": "66",
    "residencia_provincia_nombre": "Salta", "residencia_departamento_nombre": "Capital",
    "fecha_inicio_sintomas": "2020-06-01", "cuidado_intensivo": "NO", "fallecido": "NO",
    "asistencia_respiratoria_mecanica": "NO", "clasificacion_resumen": "Confirmado",
}


@pytest.fixture(autouse=True)
def own_shuffle_setting(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_second_run_adds_the_new_files(spark, tmp_path, capsys):
    args = [
        "--landing", str(tmp_path / "in"), "--raw", str(tmp_path / "raw"),
        "--checkpoint", str(tmp_path / "checkpoint"), "--database", "pipeline_run",
    ]
    write_csv(tmp_path / "in" / "a.csv", line("1", **CASE), line("2", **CASE), line("2", **CASE))
    assert pipeline.main(args) == 0
    kpis = "pipeline_run.gold_kpis_generales"
    assert spark.table(kpis).first().total_confirmados == 2
    dead = {**CASE, "fallecido": "SI"}
    write_csv(tmp_path / "in" / "b.csv", line("3", **dead))
    assert pipeline.main(args) == 0
    spark.catalog.refreshTable(kpis)
    row = spark.table(kpis).first()
    assert (row.total_confirmados, row.tasa_mortalidad_pct) == (3, 33.33)
    assert capsys.readouterr().out.count("ok ") == 18
    _, stored, _ = file_version(spark, [str(tmp_path / "raw")])
    used = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert stored > 0 and used == shuffle_partitions_for(stored * TEXT_TO_SHUFFLE) == 200


def test_failed_checks_are_counted(spark, tmp_path):
    unclear = {**CASE, "fallecido": "SIN ESPECIFICAR"}
    write_csv(tmp_path / "in" / "a.csv", line("1", **unclear))
    args = [
        "--landing", str(tmp_path / "in"), "--raw", str(tmp_path / "raw"),
        "--checkpoint", str(tmp_path / "checkpoint"), "--database", "pipeline_failed",
        "--flavour", Flavour.ALLCASES.value, "--marts", "casos_por_pais",
    ]
    assert pipeline.main(args) == 1
