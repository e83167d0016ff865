"""Dimensions and the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casemart.functions import days_between
from casemart.operators import any_value_per_group, distinct_rows, with_surrogate_key
from casemart.schema import Flavour

ONSET = "fecha_inicio_sintomas"

# Delay column -> the date it runs to, from the onset of symptoms.
DELAYS = {
    "dias_a_notificacion": "fecha_apertura",
    "dias_a_diagnostico": "fecha_diagnostico",
    "dias_a_internacion": "fecha_internacion",
    "dias_a_uti": "fecha_cui_intensivo",
    "dias_a_fallecimiento": "fecha_fallecimiento",
}

# Fact columns before the delays, in order.
FACT_COLUMNS = {
    Flavour.CONFIRMED: [
        "id_caso",
        "sexo",
        "pais",
        "provincia_id",
        "departamento_sk",
        "edad_anios",
        "clasificacion",
        "origen_financiamiento",
        "requirio_uti",
        "requirio_arm",
        "fallecido",
        "fecha_inicio_sintomas",
        "fecha_apertura",
        "fecha_diagnostico",
        "fecha_internacion",
        "fecha_cui_intensivo",
        "fecha_fallecimiento",
    ],
    Flavour.ALLCASES: [
        "id_caso",
        "sexo",
        "edad_anios",
        "pais",
        "provincia_id",
        "departamento",
        "fecha_inicio_sintomas",
        "fecha_apertura",
        "fecha_internacion",
        "requirio_uti",
        "fecha_cui_intensivo",
        "fallecido",
        "fecha_fallecimiento",
        "requirio_arm",
        "origen_financiamiento",
        "clasificacion",
        "fecha_diagnostico",
    ],
}


def province_label(flavour: Flavour) -> str:
    return "provincia_nombre" if flavour == Flavour.CONFIRMED else "provincia"


def dim_provincia(silver: DataFrame, flavour: Flavour) -> DataFrame:
    """Distinct (id, name). A second spelling of a name repeats the id; a check reports it."""
    known = distinct_rows(
        silver, ["residencia_provincia_id", "provincia"], "residencia_provincia_id"
    )
    return known.select(
        F.col("residencia_provincia_id").alias("provincia_id"),
        F.col("provincia").alias(province_label(flavour)),
    )


def departments(silver: DataFrame, flavour: Flavour) -> DataFrame:
    """One row per (department name, province).

    The official code is ambiguous, so it is kept for information only: the smallest code of
    the group, where a plain "first" would depend on the order of the rows.
    """
    confirmed = flavour == Flavour.CONFIRMED
    named = silver.filter(F.col("departamento").isNotNull()).select(
        F.col("departamento").alias("departamento_nombre" if confirmed else "departamento"),
        F.col("residencia_provincia_id").alias("provincia_id"),
        F.col("residencia_departamento_id" if confirmed else "departamento_id_original").alias(
            "departamento_id_original"
        ),
    )
    return any_value_per_group(named, named.columns[:2], "departamento_id_original")


def dim_departamento(departments: DataFrame, flavour: Flavour) -> DataFrame:
    """The departments, numbered in the confirmed flavour."""
    if flavour == Flavour.ALLCASES:
        return departments
    order = ["provincia_id", departments.columns[0]]
    return with_surrogate_key(departments, order, "departamento_sk")


def fact_cases(
    silver: DataFrame, dim_departamento: DataFrame, dim_provincia: DataFrame, flavour: Flavour
) -> DataFrame:
    """One row per case with delays in days since onset.

    Both joins carry no broadcast hint. The dimensions are read as written tables, so Spark
    knows their size: it broadcasts them while they are under the threshold and otherwise falls
    back to a shuffled join, where AQE splits skewed keys.
    """
    delays = [days_between(end, ONSET).alias(name) for name, end in DELAYS.items()]
    confirmed = flavour == Flavour.CONFIRMED
    found = "departamento_sk" if confirmed else "departamento"
    departments = dim_departamento.select(
        F.col(dim_departamento.columns[0]).alias("_name"),
        F.col("provincia_id").alias("_province"),
        F.col(found).alias("_found"),
    )
    cases = silver.join(
        departments,
        (F.col("departamento") == F.col("_name"))
        & (F.col("residencia_provincia_id") == F.col("_province")),
        "left",
    ).drop(*([] if confirmed else ["departamento"]))
    if confirmed:
        cases = cases.withColumnRenamed("residencia_provincia_id", "provincia_id")
    else:
        provinces = dim_provincia.select("provincia_id")
        cases = cases.join(
            provinces, F.col("residencia_provincia_id") == F.col("provincia_id"), "left"
        )
    return cases.withColumnRenamed("_found", found).select(*FACT_COLUMNS[flavour], *delays)
