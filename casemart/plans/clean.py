"""Raw text to the cleaned, deduplicated case table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casemart.functions import (
    age_years,
    null_if,
    parse_date,
    parse_date_lenient,
    parse_int,
    yes_no,
    yes_no_nullable,
)
from casemart.operators import dedup_by_priority
from casemart.schema import FUNDING_PLACEHOLDER, FUNDING_PREFERRED, RAW_COLUMNS, Flavour

AGE, UNIT = "edad", "edad_años_meses"
DATES = [c for c in RAW_COLUMNS if c.startswith("fecha_")]
FLAGS = ["cuidado_intensivo", "fallecido", "asistencia_respiratoria_mecanica"]
FUNDING = "origen_financiamiento"
CASE_KEY = {Flavour.CONFIRMED: "id_evento_caso", Flavour.ALLCASES: "id_caso"}

# Analyst-facing names of the cleaned table, shared by both flavours.
RENAMES = {
    "id_evento_caso": "id_caso",
    "residencia_pais_nombre": "pais",
    "residencia_provincia_nombre": "provincia",
    "residencia_departamento_nombre": "departamento",
    "cuidado_intensivo": "requirio_uti",
    "asistencia_respiratoria_mecanica": "requirio_arm",
    "clasificacion": "clasificacion_detalle",
    "clasificacion_resumen": "clasificacion",
}

# Columns of the allcases cleaned table, in order.
ALLCASES_COLUMNS = [
    "id_caso",
    "sexo",
    "edad_anios",
    "pais",
    "provincia",
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
    "clasificacion_detalle",
    "clasificacion",
    "fecha_diagnostico",
    "residencia_provincia_id",
    "departamento_id_original",
]


def _typed(flavour: Flavour) -> dict[str, Column]:
    """The typed form of every raw column that is not plain text, plus the age."""
    strict = flavour == Flavour.CONFIRMED
    to_date, to_flag = (parse_date, yes_no) if strict else (parse_date_lenient, yes_no_nullable)
    return {
        **{c: to_date(c) for c in DATES},
        **{c: to_flag(c) for c in FLAGS},
        FUNDING: null_if(FUNDING, FUNDING_PLACEHOLDER),
        "edad_anios": age_years(AGE, UNIT),
    }


def clean_cases(raw: DataFrame, flavour: Flavour) -> DataFrame:
    """Type and clean every column in one projection; rows are neither dropped nor merged.

    The confirmed flavour keeps the raw names until `rename_cases`; the allcases flavour names
    its columns here.
    """
    typed = _typed(flavour)
    if flavour == Flavour.CONFIRMED:
        kept = [c for c in RAW_COLUMNS if c not in (AGE, UNIT, "ultima_actualizacion")]
        return raw.select(*(typed.get(c, F.col(c)).alias(c) for c in [*kept, "edad_anios"]))
    source = {new: old for old, new in RENAMES.items()}
    source["departamento_id_original"] = "residencia_departamento_id"
    origin = {c: source.get(c, c) for c in ALLCASES_COLUMNS}
    return raw.select(*(typed.get(o, F.col(o)).alias(c) for c, o in origin.items()))


def clean_ages(raw: DataFrame) -> DataFrame:
    """The inputs and the result of age cleaning side by side, for inspection."""
    return raw.select(
        "id_evento_caso", AGE, parse_int(AGE).alias("edad_original"), UNIT,
        age_years(AGE, UNIT).alias("edad_anios"),
    )


def dedup_cases(cleaned: DataFrame, flavour: Flavour) -> DataFrame:
    """One row per case id; the publicly funded report wins. NULL funding ranks with the rest."""
    preferred = F.coalesce(F.col(FUNDING) == F.lit(FUNDING_PREFERRED), F.lit(False))
    return dedup_by_priority(cleaned, CASE_KEY[flavour], [preferred.desc()])


def rename_cases(cases: DataFrame) -> DataFrame:
    """Analyst-facing names, all at once: `clasificacion` is both an old and a new name."""
    return cases.select(*(F.col(c).alias(RENAMES.get(c, c)) for c in cases.columns))


def best_reports(raw: DataFrame) -> DataFrame:
    """The raw report that stands for each case, in either flavour: the publicly funded one.

    Both flavours prefer the same report, so it is picked once on the raw text and cleaned twice:
    one wide shuffle instead of two.
    """
    preferred = F.coalesce(F.col(FUNDING) == F.lit(FUNDING_PREFERRED), F.lit(False))
    return dedup_by_priority(raw, "id_evento_caso", [preferred.desc()])


def typed_cases(reports: DataFrame, flavour: Flavour) -> DataFrame:
    """The cleaned table from one report per case."""
    cases = clean_cases(reports, flavour)
    return rename_cases(cases) if flavour == Flavour.CONFIRMED else cases


def silver_cases(raw: DataFrame, flavour: Flavour) -> DataFrame:
    return typed_cases(best_reports(raw), flavour)
