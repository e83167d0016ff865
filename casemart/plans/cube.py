"""The cells under all marts: sums and counts per key, folded from the fact in one scan.

Every measure is additive, so the cells of a table that grows are kept by signed changes: what a new
or replaced case adds, less what the replaced one had added before (`changed_cells`).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from casemart.functions import month_of
from casemart.operators import changed, fold
from casemart.plans.layers import Layers
from casemart.plans.star import DELAYS, ONSET, province_label
from casemart.schema import CONFIRMED, DISCARDED, Flavour

# Name of a grouping -> its keys.
GROUPINGS = {
    "sexo": ["sexo"],
    "pais": ["pais"],
    "dia": [ONSET],
    "provincia": ["provincia_id", "mes"],
    "edad": ["edad_anios"],
    "financiamiento": ["origen_financiamiento"],
    "uti": ["requirio_uti"],
    "arm": ["requirio_arm"],
}
# The names of provinces, where the cells are kept without the layers' own dimension.
NAMES = {"nombre": ["provincia_id", "provincia"]}
FLAGS = {"total_fallecidos": "fallecido", "total_uti": "requirio_uti", "total_arm": "requirio_arm"}


def measures(flavour: Flavour) -> dict[str, Column]:
    """Counts over all rows (`_rows`, `_deaths`, `_discarded`) and over the cases marts count."""
    scope = F.col("clasificacion") == CONFIRMED if flavour == Flavour.CONFIRMED else F.lit(True)
    out = {
        "_rows": F.count(F.lit(1)),
        "_deaths": F.count_if("fallecido"),
        "_discarded": F.count_if(F.col("clasificacion") == DISCARDED),
        "_total": F.count_if(scope),
    }
    out |= {name: F.count_if(scope & F.col(flag)) for name, flag in FLAGS.items()}
    for delay in DELAYS:
        value = F.when(scope, F.col(delay))
        out |= {f"_sum_{delay}": F.sum(value), f"_n_{delay}": F.count(value)}
    return out


def fold_cases(cases: DataFrame, flavour: Flavour) -> DataFrame:
    """The cells of fact rows, or of rows that also name their province."""
    groupings = GROUPINGS | (NAMES if "provincia" in cases.columns else {})
    return fold(cases.withColumn("mes", month_of(ONSET)), groupings, measures(flavour))


def changed_cells(
    cells: DataFrame, added: DataFrame, removed: DataFrame, flavour: Flavour
) -> DataFrame:
    """The cells after some cases came and some went; no other case is read."""
    folded = (fold_cases(df, flavour) for df in (added, removed))
    return changed(cells, *folded, measures=list(measures(flavour)), rows="_rows")


@dataclass(frozen=True)
class CellLayers:
    """What marts read in place of the fact."""

    flavour: Flavour
    folded: DataFrame
    dim_provincia: DataFrame

    def cells(self, by: str) -> DataFrame:
        """The cells of one grouping, with delays also under the names of their means."""
        means = {f"promedio_{delay.replace('dias_a_', 'dias_')}": delay for delay in DELAYS}
        return self.folded.filter(F.col("cell") == by).select(
            *(GROUPINGS | NAMES)[by],
            *measures(self.flavour),
            *(
                F.col(f"{part}_{delay}").alias(f"{part}_{mean}")
                for mean, delay in means.items()
                for part in ("_sum", "_n")
            ),
        )

    def totals(self, *names: str) -> DataFrame:
        """One row: measures over all cells of one grouping, and the provinces with a case."""
        every, by_province = F.col("cell") == "sexo", F.col("cell") == "provincia"
        sums = [F.sum(F.when(every, F.col(n))) for n in names]
        return self.folded.agg(
            *(
                (s if n.startswith("_sum") else F.coalesce(s, F.lit(0))).alias(n)
                for n, s in zip(names, sums)
            ),
            F.count_distinct(F.when(by_province, F.col("provincia_id"))).alias(
                "provincias_afectadas"
            ),
        )


def from_cells(layers: Layers) -> CellLayers:
    """The layers' cells, folded once and kept beside them."""
    folded = layers.keep("gold_cells", lambda: fold_cases(layers.fact, layers.flavour))
    return CellLayers(layers.flavour, folded, layers.dim_provincia)


def named_provinces(cells: DataFrame, flavour: Flavour) -> DataFrame:
    """The province dimension from cells that hold the names."""
    known = cells.filter((F.col("cell") == "nombre") & F.col("provincia_id").isNotNull())
    return known.select("provincia_id", F.col("provincia").alias(province_label(flavour)))
