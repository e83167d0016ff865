"""Declared raw schema, the two flavours, and the domain values shared by the plans."""

from __future__ import annotations

from enum import Enum

from pyspark.sql import types as T


class Flavour(str, Enum):
    """Which of the two published readings of the case table a plan follows.

    CONFIRMED: marts count confirmed cases, yes/no columns are two-valued, dates are strict.
    ALLCASES: marts count every notification, yes/no columns are three-valued, dates are lenient.
    """

    CONFIRMED = "confirmed"
    ALLCASES = "allcases"


# The raw columns, in file order; all are text.
RAW_COLUMNS = [
    "id_evento_caso",
    "sexo",
    "edad",
    "edad_años_meses",
    "residencia_pais_nombre",
    "residencia_provincia_nombre",
    "residencia_departamento_nombre",
    "carga_provincia_nombre",
    "fecha_inicio_sintomas",
    "fecha_apertura",
    "sepi_apertura",
    "fecha_internacion",
    "cuidado_intensivo",
    "fecha_cui_intensivo",
    "fallecido",
    "fecha_fallecimiento",
    "asistencia_respiratoria_mecanica",
    "carga_provincia_id",
    "origen_financiamiento",
    "clasificacion",
    "clasificacion_resumen",
    "residencia_provincia_id",
    "fecha_diagnostico",
    "residencia_departamento_id",
    "ultima_actualizacion",
]

# Words and limits that occur in the data.
YES = "SI"
NO = "NO"
UNIT_YEARS = "Años"
UNIT_MONTHS = "Meses"
AGE_MIN = 0
AGE_MAX = 120
FUNDING_PLACEHOLDER = "*sin dato*"
FUNDING_PREFERRED = "Público"
CONFIRMED = "Confirmado"
DISCARDED = "Descartado"
NO_DATA = "Sin dato"
DATE_FORMAT = "yyyy-MM-dd"
AGE_BAND_STARTS = [0, 10, 20, 30, 40, 50, 60, 70, 80]

RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

# Columns whose values are counted.
CATEGORY_COLUMNS = [
    "sexo",
    "edad_años_meses",
    "cuidado_intensivo",
    "fallecido",
    "asistencia_respiratoria_mecanica",
    "origen_financiamiento",
    "clasificacion_resumen",
]
