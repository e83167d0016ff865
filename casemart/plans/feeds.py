"""The tables the reports draw, derived on Spark from the stored marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from casemart.functions import band_start, month_label
from casemart.operators import long_form, matrix, merge_null_safe, sort_nulls_last
from casemart.plans.layers import Layers
from casemart.plans.marts import stored
from casemart.plans.star import ONSET

OLDEST_BAND = 90


def daily_curve(layers: Layers) -> DataFrame:
    return sort_nulls_last(stored(layers, "casos_por_dia").select(ONSET, "total_casos"), ONSET)


def age_rate(layers: Layers) -> DataFrame:
    return stored(layers, "mortalidad_por_edad").select("franja_etaria", "tasa_mortalidad_pct")


def deaths_age(layers: Layers) -> DataFrame:
    """Needs the allcases layers: only that flavour has the mart."""
    return stored(layers, "edad_fallecidos")


def _provinces(mart: DataFrame, metric: str) -> DataFrame:
    return sort_nulls_last(mart.select("provincia_nombre", metric), metric, "provincia_nombre")


def province_rate(layers: Layers) -> DataFrame:
    return _provinces(stored(layers, "resumen_provincia"), "tasa_mortalidad_pct")


def province_delay(layers: Layers) -> DataFrame:
    return _provinces(stored(layers, "demoras_sistema_salud"), "promedio_dias_diagnostico")


def province_volume(layers: Layers) -> DataFrame:
    return _provinces(stored(layers, "resumen_provincia"), "total_casos")


def funding_long(layers: Layers) -> DataFrame:
    return long_form(
        stored(layers, "publico_vs_privado"),
        ["origen_financiamiento"],
        ["tasa_mortalidad_pct", "total_uti", "total_casos"],
        "metrica",
        "valor",
    )


def uti_arm(layers: Layers) -> DataFrame:
    """Death rate with and without intensive care, and with and without ventilation."""

    def side(mart: DataFrame, flag: str, label: str) -> DataFrame:
        return mart.select(
            F.lit(label).alias("intervencion"),
            F.initcap(F.col(flag).cast("string")).alias("requirio"),
            "tasa_mortalidad_pct",
        )

    uti = side(stored(layers, "efectividad_uti"), "requirio_uti", "UTI")
    return uti.unionByName(side(stored(layers, "efectividad_arm"), "requirio_arm", "ARM"))


def died_survived(layers: Layers) -> DataFrame:
    totals = stored(layers, "kpis_generales").select(
        F.col("total_fallecidos").alias("Fallecidos"),
        (F.col("total_confirmados") - F.col("total_fallecidos")).alias("No fallecidos"),
    )
    return totals.unpivot([], totals.columns, "grupo", "total_casos")


def deaths_sex(layers: Layers) -> DataFrame:
    mart = stored(layers, "composicion_fallecidos_sexo")
    label = F.format_string("%.1f%%\n(%,d)", "pct_del_total", "total_fallecidos")
    return mart.withColumn("etiqueta", label)


def monthly_rate(layers: Layers) -> DataFrame:
    mart = stored(layers, "letalidad_mensual").select("mes", "tasa_mortalidad_pct")
    return mart.dropna(subset=["mes"]).orderBy("mes")


def _province_months(layers: Layers) -> tuple[DataFrame, list[str]]:
    """The cells, and the months that occur: one value per calendar month with a case."""
    cells = stored(layers, "casos_provincia_mes").dropna(subset=["mes", "provincia_nombre"])
    return cells, sorted(r[0] for r in cells.select(month_label("mes")).distinct().collect())


def province_month_matrix(layers: Layers) -> DataFrame:
    """Provinces by the months that occur, with 0 for gaps."""
    cells, months = _province_months(layers)
    label = month_label("mes")
    return matrix(cells, "provincia_nombre", label, months, "total_casos", "total_casos")


def province_month_cells(layers: Layers) -> DataFrame:
    """The matrix in long form, for any number of months: (provincia_nombre, mes, casos,
    total_casos, orden), where `orden` numbers the provinces by their total."""
    wide = province_month_matrix(layers)
    ids = ["provincia_nombre", "total_casos"]
    months = [c for c in wide.columns if c not in ids]
    heaviest = Window.orderBy(F.desc("total_casos"), "provincia_nombre")
    if not months:
        wide, months = wide.withColumn("-", F.lit(0).cast("long")), ["-"]
    numbered = wide.withColumn("orden", F.row_number().over(heaviest))
    return numbered.unpivot([*ids, "orden"], months, "mes", "casos")


def matrix_bounds(layers: Layers) -> DataFrame:
    """Colour scale of the matrix: its smallest positive and its largest cell."""
    cells = stored(layers, "casos_provincia_mes").dropna(subset=["mes", "provincia_nombre"])
    positive = F.when(F.col("total_casos") > 0, F.col("total_casos"))
    return cells.agg(F.min(positive).alias("minimo"), F.max("total_casos").alias("maximo"))


def pyramid(layers: Layers) -> DataFrame:
    """Decades up to the oldest one drawn, in numeric order."""
    bands = stored(layers, "piramide_edad").withColumn("edad_inicio", band_start("franja_etaria"))
    return bands.filter(F.col("edad_inicio") <= OLDEST_BAND).orderBy("edad_inicio")


def delay_vs_rate(layers: Layers) -> DataFrame:
    """Delays and rates side by side; the group without a province pairs with itself."""
    summary = stored(layers, "resumen_provincia").drop("promedio_dias_diagnostico")
    return merge_null_safe(stored(layers, "demoras_sistema_salud"), summary, "provincia_nombre")
