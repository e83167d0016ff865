"""The application's data-quality suite and audits."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from casemart.operators import Check, check_unique, code_collisions, run_checks
from casemart.plans.layers import Layers

# The nine declared checks.
CHECKS = [
    Check("unique", "silver_casos", "id_caso"),
    Check("not_null", "silver_casos", "id_caso"),
    Check("unique", "dim_provincia", "provincia_id"),
    Check("not_null", "dim_provincia", "provincia_id"),
    Check("not_null", "dim_departamento", "departamento"),
    Check("unique", "fact_casos", "id_caso"),
    Check("not_null", "fact_casos", "id_caso"),
    Check("not_null", "fact_casos", "fallecido"),
    Check("not_null", "fact_casos", "requirio_uti"),
]


def named_as_checked(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables with the department name under the one name the checks use."""
    dim = tables["dim_departamento"].withColumnRenamed("departamento_nombre", "departamento")
    return {**tables, "dim_departamento": dim}


def quality_report(layers: Layers) -> DataFrame:
    return run_checks(named_as_checked(layers.tables()), CHECKS)


def dim_key_check(layers: Layers) -> DataFrame:
    """Department dimension rows that share a (name, province) key; none is expected."""
    dim = layers.dim_departamento
    return check_unique(dim, [dim.columns[0], "provincia_id"])


def department_code_collisions(layers: Layers) -> DataFrame:
    """Official department codes that stand for several department names in one province."""
    code = "residencia_departamento_id"
    if code not in layers.silver.columns:
        code = "departamento_id_original"
    return code_collisions(layers.silver, [code, "residencia_provincia_id"], "departamento")
