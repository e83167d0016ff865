"""Marts on hand-written cases, flavour differences, and invariants on the derived cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from casemart.plans import clean, feeds, marts
from casemart.plans.checks import CHECKS, dim_key_check, quality_report
from casemart.plans.fixture import RAW_INPUTS, raw_cases
from casemart.plans.layers import Layers, keep_under
from casemart.plans.queries import Workspace
from casemart.schema import RAW_COLUMNS, RAW_SCHEMA, Flavour

C, A = Flavour.CONFIRMED, Flavour.ALLCASES


def case(case_id, **values):
    defaults = {
        "sexo": "F", "edad": "30", "edad_años_meses": "Años", "residencia_pais_nombre": "Argentina",
        "residencia_provincia_nombre": "Salta", "residencia_provincia_id": "66",
        "residencia_departamento_nombre": "Capital", "residencia_departamento_id": "028",
        "fecha_inicio_sintomas": "2020-06-01", "fecha_apertura": "2020-06-02",
        "cuidado_intensivo": "NO", "fallecido": "NO", "asistencia_respiratoria_mecanica": "NO",
        "origen_financiamiento": "Público", "clasificacion": "por laboratorio",
        "clasificacion_resumen": "Confirmado", "ultima_actualizacion": "2022-06-05",
    }
    cells = {**defaults, **values, "id_evento_caso": case_id}
    return tuple(cells.get(c) for c in RAW_COLUMNS)


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(
        [
            case("1", fallecido="SI", cuidado_intensivo="SI", fecha_diagnostico="2020-06-05"),
            case("1", fallecido="SI", cuidado_intensivo="SI", fecha_diagnostico="2020-06-05",
                 origen_financiamiento="Privado"),
            case("2", edad="8", edad_años_meses="Meses", origen_financiamiento="*sin dato*"),
            case("3", residencia_provincia_id=None, residencia_provincia_nombre=None, edad="95",
                 fecha_inicio_sintomas=None, fallecido="SI"),
            case("4", clasificacion_resumen="Descartado", fallecido=None, edad="abc",
                 cuidado_intensivo="SIN ESPECIFICAR", residencia_pais_nombre=None),
            case("5", fecha_inicio_sintomas="2020-6-7", sexo="NR", edad="121"),
            case("6", fecha_inicio_sintomas="2020-06-09", fecha_apertura="2020-06-01", sexo="M",
                 residencia_departamento_nombre=None, residencia_departamento_id="035"),
        ],
        RAW_SCHEMA,
    )


@pytest.fixture(scope="module")
def layers(raw, tmp_path_factory):
    root = tmp_path_factory.mktemp("layers")
    return {f: Layers(raw, f, keep_under(str(root / f.value))) for f in Flavour}


def by_key(frame, key):
    return {r[key]: r.asDict() for r in frame.collect()}


def test_one_row_per_case_and_the_public_report_wins(layers):
    for flavour in Flavour:
        silver = by_key(layers[flavour].silver, "id_caso")
        assert sorted(silver) == ["1", "2", "3", "4", "5", "6"]
        assert silver["1"]["origen_financiamiento"] == "Público"
        assert silver["2"]["origen_financiamiento"] is None
        assert silver["1"]["clasificacion"] == "Confirmado"
        assert silver["1"]["clasificacion_detalle"] == "por laboratorio"
        assert [silver[i]["edad_anios"] for i in "123456"] == [30, 0, 95, None, None, 30]


def test_flavours_differ_in_flags_and_dates(layers):
    confirmed, allcases = (by_key(layers[f].silver, "id_caso") for f in (C, A))
    assert confirmed["4"]["fallecido"] is False and allcases["4"]["fallecido"] is None
    assert confirmed["4"]["requirio_uti"] is False and allcases["4"]["requirio_uti"] is None
    assert confirmed["5"]["fecha_inicio_sintomas"] is None
    assert allcases["5"]["fecha_inicio_sintomas"] == dt.date(2020, 6, 7)


def test_columns_of_each_layer(layers):
    assert len(layers[C].silver.columns) == 23 and len(layers[A].silver.columns) == 20
    assert len(layers[C].fact.columns) == len(layers[A].fact.columns) == 22
    assert "ultima_actualizacion" not in layers[C].silver.columns
    assert layers[C].dim_provincia.columns == ["provincia_id", "provincia_nombre"]
    assert layers[A].dim_provincia.columns == ["provincia_id", "provincia"]


def test_fact_keeps_every_case_and_negative_delays(layers):
    for flavour in Flavour:
        fact = by_key(layers[flavour].fact, "id_caso")
        assert len(fact) == 6
        assert fact["6"]["dias_a_notificacion"] == -8
        assert fact["1"]["dias_a_diagnostico"] == 4
        assert fact["3"]["dias_a_notificacion"] is None
        assert fact["3"]["provincia_id"] is None
    confirmed = by_key(layers[C].fact, "id_caso")
    assert confirmed["6"]["departamento_sk"] is None  # no department name
    assert confirmed["3"]["departamento_sk"] is None  # department known, province not
    assert confirmed["1"]["departamento_sk"] is not None
    assert by_key(layers[A].fact, "id_caso")["1"]["departamento"] == "Capital"


def test_sex(layers):
    confirmed = by_key(marts.mortalidad_por_sexo(layers[C]), "sexo")
    assert confirmed["F"] == {
        "sexo": "F", "total_casos": 3, "total_fallecidos": 2, "total_uti": 1, "total_arm": 0,
        "tasa_mortalidad_pct": 66.67, "tasa_uti_pct": 33.33, "tasa_arm_pct": 0.0,
    }
    allcases = by_key(marts.mortalidad_por_sexo(layers[A]), "sexo")
    assert allcases["F"]["total_casos"] == 4 and allcases["F"]["tasa_letalidad"] == 50.0


def test_country_is_not_filtered_and_null_is_kept_or_labelled(layers):
    confirmed = by_key(marts.casos_por_pais(layers[C]), "pais")
    assert confirmed[None]["total_casos"] == 1
    assert confirmed["Argentina"]["pct_del_total"] == 83.3333
    assert by_key(marts.casos_por_pais(layers[A]), "pais")["Sin dato"]["total_casos"] == 1


def test_kpis(layers):
    confirmed = marts.kpis_generales(layers[C])
    assert confirmed.columns == sorted(confirmed.columns)
    got = confirmed.first().asDict()
    assert got["total_casos_notificados"] == 6 and got["total_confirmados"] == 5
    assert got["total_descartados"] == 1 and got["total_fallecidos"] == 2
    assert got["tasa_mortalidad_pct"] == 40.0 and got["promedio_dias_a_diagnostico"] == 4.0
    assert got["promedio_dias_a_fallecimiento"] is None
    allcases = marts.kpis_generales(layers[A]).first().asDict()
    assert allcases["total_casos"] == 6 and allcases["provincias_afectadas"] == 1
    assert allcases["tasa_letalidad"] == 33.33


def test_kpis_of_no_cases(layers, raw):
    for flavour in Flavour:
        empty = Layers(raw.filter("false"), flavour)
        row = marts.kpis_generales(empty).first().asDict()
        assert {v for k, v in row.items() if k.startswith("total")} == {0}
        assert {v for k, v in row.items() if k.startswith(("tasa", "promedio"))} == {None}
    empty = Layers(raw.filter("false"), C)
    assert marts.composicion_fallecidos_sexo(empty).collect() == []
    assert marts.piramide_edad(empty).collect() == []


def test_provinces_keep_or_drop_the_unknown_one(layers):
    confirmed = by_key(marts.resumen_provincia(layers[C]), "provincia_nombre")
    assert set(confirmed) == {"Salta", None}
    assert confirmed["Salta"]["promedio_dias_diagnostico"] == 4.0
    assert set(by_key(marts.resumen_provincia(layers[A]), "provincia")) == {"Salta"}
    assert None in by_key(marts.demoras_sistema_salud(layers[C]), "provincia_nombre")
    assert None not in by_key(marts.demoras_sistema_salud(layers[A]), "provincia")


def test_ages_drop_or_label_the_unknown(layers):
    confirmed = by_key(marts.mortalidad_por_edad(layers[C]), "franja_etaria")
    assert {k: v["total_casos"] for k, v in confirmed.items()} == {"0-9": 1, "30-39": 2, "80+": 1}
    allcases = by_key(marts.mortalidad_por_edad(layers[A]), "rango_edad")
    assert {k: v["total_casos"] for k, v in allcases.items()} == {
        "0-9": 1, "30-39": 2, "90-99": 1, "Sin dato": 2,
    }


def test_funding_drops_or_labels_the_unknown(layers):
    assert set(by_key(marts.publico_vs_privado(layers[C]), "origen_financiamiento")) == {"Público"}
    allcases = by_key(marts.publico_vs_privado(layers[A]), "origen_financiamiento")
    assert set(allcases) == {"Público", "Sin dato"}


def test_care_flag_is_two_or_three_valued(layers):
    assert set(by_key(marts.efectividad_uti(layers[C]), "requirio_uti")) == {True, False}
    allcases = by_key(marts.efectividad_uti(layers[A]), "requirio_uti")
    assert sum(r["total_casos"] for r in allcases.values()) == 5  # the unclear one is left out


def test_month_of_unknown_onset_is_a_group(layers):
    months = by_key(marts.letalidad_mensual(layers[C]), "mes")
    assert months[None]["total_casos"] == 2  # missing, and not in the strict form
    assert months[dt.datetime(2020, 6, 1)]["total_casos"] == 3
    assert feeds.monthly_rate(layers[C]).count() == 1


def test_pyramid_shares(layers):
    bands = by_key(marts.piramide_edad(layers[C]), "franja_etaria")
    assert bands["0-9"] == {
        "franja_etaria": "0-9", "total_casos": 1, "total_fallecidos": 0,
        "pct_casos": 25.0, "pct_fallecidos": 0.0,
    }
    assert bands["90-99"]["pct_fallecidos"] == 50.0


def test_feeds(layers):
    x = layers[C]
    assert [tuple(r) for r in feeds.died_survived(x).orderBy("grupo").collect()] == [
        ("Fallecidos", 2), ("No fallecidos", 3),
    ]
    assert {r.etiqueta for r in feeds.deaths_sex(x).collect()} == {"100.0%\n(2)"}
    assert {(r.intervencion, r.requirio) for r in feeds.uti_arm(x).collect()} == {
        ("UTI", "True"), ("UTI", "False"), ("ARM", "False"),
    }
    assert {r.metrica for r in feeds.funding_long(x).collect()} == {
        "tasa_mortalidad_pct", "total_uti", "total_casos",
    }
    matrix = feeds.province_month_matrix(x).collect()
    assert [tuple(r) for r in matrix] == [("Salta", 3, 3)]
    assert tuple(feeds.matrix_bounds(x).first()) == (3, 3)
    crossed = by_key(feeds.delay_vs_rate(x), "provincia_nombre")
    assert set(crossed) == {"Salta", None}
    assert crossed[None]["tasa_mortalidad_pct"] == 100.0
    delays = [r.promedio_dias_diagnostico for r in feeds.province_delay(x).collect()]
    assert delays == [4.0, None]  # NULL last


def test_second_spelling_of_a_province_fans_out_and_is_reported(spark, tmp_path):
    raw = spark.createDataFrame(
        [case("1"), case("2", residencia_provincia_nombre="SALTA")], RAW_SCHEMA
    )
    x = Layers(raw, A, keep_under(str(tmp_path)))
    assert x.dim_provincia.count() == 2
    assert x.fact.count() == 4
    report = {(r.check, r.table, r.column): r.violations for r in quality_report(x).collect()}
    assert report["unique", "dim_provincia", "provincia_id"] == 1
    assert report["unique", "fact_casos", "id_caso"] == 2
    assert report["unique", "silver_casos", "id_caso"] == 0


def test_report_fails_on_three_valued_flags_only(layers):
    for flavour, failed in ((C, set()), (A, {"fallecido", "requirio_uti"})):
        report = quality_report(layers[flavour]).collect()
        assert len(report) == len(CHECKS) == 9
        assert {r.column for r in report if not r.passed} == failed
        assert dim_key_check(layers[flavour]).count() == 0


def test_tables_and_views_give_the_same_marts(spark, raw, rows):
    spark.sql("create database if not exists built")
    tables = marts.build(spark, raw, C, ["resumen_provincia", "casos_por_pais"], "table", "built")
    views = marts.build(spark, raw, C, ["resumen_provincia", "casos_por_pais"], "view")
    assert set(tables) == set(views) == {
        "silver_casos", "dim_provincia", "dim_departamento", "fact_casos",
        "gold_resumen_provincia", "gold_casos_por_pais",
    }
    for name in tables:
        assert rows(tables[name]) == rows(views[name])
        assert spark.catalog.tableExists(f"built.{name}")
    assert rows(spark.table("gold_casos_por_pais")) == rows(spark.table("built.gold_casos_por_pais"))
    # A second build replaces the tables.
    assert rows(marts.build(spark, raw, C, [], "table", "built")["fact_casos"]) == rows(
        views["fact_casos"]
    )
    with pytest.raises(ValueError, match="does not exist"):
        marts.build(spark, raw, C, ["edad_fallecidos"])


def test_invariants_on_the_derived_cases(spark, sf_dir, tmp_path):
    raw = raw_cases(spark, sf_dir)
    n_cases = raw.select("id_evento_caso").distinct().count()
    assert raw.count() > n_cases
    for flavour in Flavour:
        x = Layers(raw, flavour, keep_under(str(tmp_path / flavour.value)))
        assert x.silver.count() == x.fact.count() == n_cases
        in_scope = marts.cases_in_scope(x).count()
        for name in ("mortalidad_por_sexo",):
            total = marts.MARTS[name].build(x).agg(F.sum("total_casos")).first()[0]
            assert total == in_scope
    x = Layers(raw, C, keep_under(str(tmp_path / "again")))
    for name in ("resumen_provincia", "letalidad_mensual", "casos_provincia_mes"):
        total = marts.MARTS[name].build(x).agg(F.sum("total_casos")).first()[0]
        assert total == marts.cases_in_scope(x).count()
    for mart, share in ((marts.casos_por_pais, "pct_del_total"), (marts.piramide_edad, "pct_casos"),
                        (marts.piramide_edad, "pct_fallecidos"),
                        (marts.composicion_fallecidos_sexo, "pct_del_total")):
        assert abs(mart(x).agg(F.sum(share)).first()[0] - 100) < 0.5


def test_first_and_second_reports_make_up_the_raw_cases(spark, sf_dir):
    whole = raw_cases(spark, sf_dir)
    parts = raw_cases(spark, sf_dir, "first").unionByName(raw_cases(spark, sf_dir, "second"))
    assert whole.exceptAll(parts).count() == parts.exceptAll(whole).count() == 0
    assert clean.clean_cases(whole, A).columns == clean.ALLCASES_COLUMNS


def test_changed_input_files_open_a_new_workspace(spark, sf_dir, tmp_path):
    for name in RAW_INPUTS:
        frame = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        frame.write.parquet(str(tmp_path / f"{name}.parquet"))
    first = Workspace.of(spark, str(tmp_path))
    assert Workspace.of(spark, f"{tmp_path}/") is first
    n = first.raw.count()
    few = spark.read.parquet(f"{sf_dir}/orders.parquet").filter("o_orderkey < 100")
    few.write.mode("overwrite").parquet(str(tmp_path / "orders.parquet"))
    second = Workspace.of(spark, str(tmp_path))
    assert second is not first and second.raw.count() < n == first.raw.count()


def test_matrix_has_a_column_for_every_month_that_occurs(spark, layers):
    from casemart.plans import feeds
    from casemart.plans.layers import Layers

    x = layers[C]
    moved = x.raw.withColumn(
        "fecha_inicio_sintomas",
        F.add_months(F.to_date("fecha_inicio_sintomas"), 240).cast("string"),
    )
    for source in (x.raw, moved):
        out = feeds.province_month_matrix(Layers(source, C))
        for row in out.collect():
            assert sum(row[2:]) == row.total_casos
        assert out.count() > 0


def test_shares_scan_the_fact_once(layers):
    """The total reads the shuffled groups again, not the fact."""
    out = marts.composicion_fallecidos_sexo(layers[C])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "ReusedExchange" in plan
