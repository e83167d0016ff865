"""Summary marts M1-M15, for one or both flavours, and the registry that builds them.

Each mart is one narrow scan of the fact table followed by sums and counts per group, or the same
sums over the cells that one scan of the fact has folded for all marts (`cube`).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casemart.functions import (
    decade_band,
    fixed_band,
    label_null,
    mean_of,
    month_of,
    percent,
    round_half_even,
)
from casemart.operators import (
    Check,
    Summary,
    group_counts,
    summarise,
    summarise_by_dimension,
    with_share,
)
from casemart.plans import cube
from casemart.plans.layers import Layers, keep_as_published, keep_as_table, keep_as_view
from casemart.plans.star import ONSET, province_label
from casemart.schema import CONFIRMED, DISCARDED, NO_DATA, Flavour

BOTH = (Flavour.CONFIRMED, Flavour.ALLCASES)

# Count name -> flag it counts.
FLAGS = {
    "total_fallecidos": "fallecido",
    "total_uti": "requirio_uti",
    "total_arm": "requirio_arm",
}
DELAY_MEANS = {
    "promedio_dias_notificacion": "dias_a_notificacion",
    "promedio_dias_diagnostico": "dias_a_diagnostico",
    "promedio_dias_internacion": "dias_a_internacion",
}


def _confirmed(layers: Layers) -> bool:
    return layers.flavour == Flavour.CONFIRMED


def cases_in_scope(layers: Layers, by: str = "sexo") -> DataFrame:
    """The cases a mart counts: confirmed ones, or all notifications; or their cells `by` a key."""
    if layers.cells:
        return layers.cells(by).filter(F.col("_total") > 0)
    fact = layers.fact
    return fact.filter(F.col("clasificacion") == CONFIRMED) if _confirmed(layers) else fact


def _summary(layers: Layers, flags: Sequence[str], **options) -> Summary:
    """Counts of the named flags and the death rate, in the flavour's names and NULL rules."""
    picked = {name: FLAGS[name] for name in flags}
    rate = "tasa_mortalidad_pct" if _confirmed(layers) else "tasa_letalidad"
    options.setdefault("rates", {rate: "total_fallecidos"})
    return Summary(flags=picked, null_as_zero=not _confirmed(layers), **options)


def _all_cases(layers: Layers, by: str) -> DataFrame:
    """All notifications, whatever the flavour counts otherwise."""
    if not layers.cells:
        return layers.fact
    return layers.cells(by).withColumns(
        {"_total": F.col("_rows"), "total_fallecidos": F.col("_deaths")}
    )


def _death_counts(cases: DataFrame, key: str) -> DataFrame:
    name = "total_fallecidos"
    if "_total" in cases.columns:
        folded = cases.groupBy(key).agg(F.sum(name).alias(name))
        return folded.filter(F.col(name) > 0)
    return group_counts(cases.filter(F.col("fallecido")), [key], name)


def mortalidad_por_sexo(layers: Layers) -> DataFrame:
    flags = ["total_fallecidos", "total_uti", "total_arm"]
    counted = flags
    if _confirmed(layers):
        names = ["tasa_mortalidad_pct", "tasa_uti_pct", "tasa_arm_pct"]
        columns = None
    else:
        names = ["tasa_letalidad", "tasa_uti", "tasa_arm"]
        # Columns in order.
        columns = [
            "total_casos",
            "total_fallecidos",
            "tasa_letalidad",
            "total_uti",
            "tasa_uti",
            "total_arm",
            "tasa_arm",
        ]
    summary = _summary(layers, flags, rates=dict(zip(names, counted)), columns=columns)
    return summarise(cases_in_scope(layers, "sexo"), ["sexo"], summary)


def casos_por_pais(layers: Layers) -> DataFrame:
    """All notifications in both flavours; only the allcases flavour labels a missing country."""
    if not _confirmed(layers):
        # The label is put on after grouping: NULL and a literal label stay two rows.
        counts = summarise(_all_cases(layers, "pais"), ["pais"], Summary())
        labelled = counts.withColumn("pais", label_null("pais", NO_DATA))
        return labelled.orderBy(F.desc("total_casos"), "pais")
    deaths = _summary(layers, ["total_fallecidos"], rates={})
    counts = summarise(_all_cases(layers, "pais"), ["pais"], deaths)
    return with_share(counts, "total_casos", "pct_del_total", 4)


def _kpi_counts(layers: Layers, *delays: str) -> DataFrame:
    """The counts and sums under the confirmed flavour's indicators."""
    if layers.cells:
        sums = [f"{part}_{delay}" for delay in delays for part in ("_sum", "_n")]
        names = {"_rows": "total_casos_notificados", "_total": "total_confirmados",
                 "_discarded": "total_descartados", "total_arm": "total_requirio_arm",
                 "total_uti": "total_requirio_uti"}
        totals = layers.totals(*names, "total_fallecidos", *sums)
        return totals.withColumnsRenamed(names)
    confirmed = F.col("clasificacion") == CONFIRMED

    def count(condition: Column, name: str) -> Column:
        return F.count_if(condition).alias(name)

    def sum_and_n(column: str) -> list[Column]:
        value = F.when(confirmed, F.col(column))
        return [F.sum(value).alias(f"_sum_{column}"), F.count(value).alias(f"_n_{column}")]

    return layers.fact.agg(
        F.count(F.lit(1)).alias("total_casos_notificados"),
        count(confirmed, "total_confirmados"),
        count(F.col("clasificacion") == DISCARDED, "total_descartados"),
        count(confirmed & F.col("fallecido"), "total_fallecidos"),
        count(confirmed & F.col("requirio_arm"), "total_requirio_arm"),
        count(confirmed & F.col("requirio_uti"), "total_requirio_uti"),
        *(c for delay in delays for c in sum_and_n(delay)),
    )


def kpis_generales(layers: Layers) -> DataFrame:
    """One row, one pass; the reports' scattered counts become conditional aggregates."""
    if not _confirmed(layers):
        if layers.cells:
            counted = layers.totals("_rows", *FLAGS).withColumnRenamed("_rows", "total_casos")
        else:
            counted = layers.fact.agg(
                F.count(F.lit(1)).alias("total_casos"),
                *(F.count_if(flag).alias(name) for name, flag in FLAGS.items()),
                F.count_distinct("provincia_id").alias("provincias_afectadas"),
            )
        rate = percent("total_fallecidos", "total_casos").alias("tasa_letalidad")
        return counted.select(
            "total_casos", "total_fallecidos", rate, "total_uti", "total_arm",
            "provincias_afectadas",
        )

    to_diagnosis, to_death = "dias_a_diagnostico", "dias_a_fallecimiento"
    counted = _kpi_counts(layers, to_diagnosis, to_death)
    rate = percent("total_fallecidos", "total_confirmados", digits=None)
    return counted.select(
        mean_of(f"_sum_{to_diagnosis}", f"_n_{to_diagnosis}").alias("promedio_dias_a_diagnostico"),
        mean_of(f"_sum_{to_death}", f"_n_{to_death}").alias("promedio_dias_a_fallecimiento"),
        round_half_even(rate, 2).alias("tasa_mortalidad_pct"),
        "total_casos_notificados",
        "total_confirmados",
        "total_descartados",
        "total_fallecidos",
        "total_requirio_arm",
        "total_requirio_uti",
    )


def casos_por_dia(layers: Layers) -> DataFrame:
    """Days without a case have no row; cases without an onset date are left out."""
    dated = cases_in_scope(layers, "dia").filter(F.col(ONSET).isNotNull())
    if _confirmed(layers):
        summary = _summary(layers, ["total_fallecidos", "total_uti"], rates={})
        return summarise(dated, [ONSET], summary).orderBy(ONSET)
    days = summarise(dated, [ONSET], _summary(layers, ["total_fallecidos"], rates={}))
    return days.select(
        F.col(ONSET).alias("fecha"),
        F.col("total_casos").alias("casos"),
        F.col("total_fallecidos").alias("fallecidos"),
    ).orderBy("fecha")


def _by_province(layers: Layers, summary: Summary) -> DataFrame:
    """Cases without a province: a NULL group (confirmed) or left out (allcases)."""
    return summarise_by_dimension(
        cases_in_scope(layers, "provincia"),
        "provincia_id",
        layers.dim_provincia,
        province_label(layers.flavour),
        summary,
        how="left" if _confirmed(layers) else "inner",
    )


def resumen_provincia(layers: Layers) -> DataFrame:
    delay = "promedio_dias_diagnostico"
    means = {delay: DELAY_MEANS[delay]}
    if _confirmed(layers):
        flags = ["total_fallecidos", "total_uti", "total_arm"]
        return _by_province(layers, _summary(layers, flags, means=means, mean_digits=1))
    columns = ["total_casos", "total_fallecidos", "tasa_letalidad", "total_uti", delay]
    summary = _summary(layers, ["total_fallecidos", "total_uti"], means=means, columns=columns)
    return _by_province(layers, summary).orderBy(F.desc("total_casos"), "provincia")


def mortalidad_por_edad(layers: Layers) -> DataFrame:
    """Nine bands without unknown ages, or open decades with a label for them."""
    cases, flags = cases_in_scope(layers, "edad"), ["total_fallecidos", "total_uti"]
    if _confirmed(layers):
        band = "franja_etaria"
        cases = cases.filter(F.col("edad_anios").isNotNull())
        cases = cases.withColumn(band, fixed_band("edad_anios"))
        summary = _summary(layers, flags)
    else:
        band = "rango_edad"
        cases = cases.withColumn(band, decade_band("edad_anios", NO_DATA))
        columns = ["total_casos", "total_fallecidos", "tasa_letalidad", "total_uti"]
        summary = _summary(layers, flags, columns=columns)
    return summarise(cases, [band], summary).orderBy(band)


def demoras_sistema_salud(layers: Layers) -> DataFrame:
    digits = 1 if _confirmed(layers) else 2
    delays = _by_province(layers, Summary(total=None, means=DELAY_MEANS, mean_digits=digits))
    if _confirmed(layers):
        return delays.orderBy("provincia_nombre")
    return delays.orderBy(F.col("promedio_dias_diagnostico").desc(), "provincia")


def publico_vs_privado(layers: Layers) -> DataFrame:
    funding, flags = "origen_financiamiento", ["total_fallecidos", "total_uti"]
    cases = cases_in_scope(layers, "financiamiento")
    if _confirmed(layers):
        known = cases.filter(F.col(funding).isNotNull())
        return summarise(known, [funding], _summary(layers, flags))
    rates = {"tasa_letalidad": "total_fallecidos", "tasa_uti": "total_uti"}
    columns = ["total_casos", "total_fallecidos", "tasa_letalidad", "total_uti", "tasa_uti"]
    groups = summarise(cases, [funding], _summary(layers, flags, rates=rates, columns=columns))
    return groups.withColumn(funding, label_null(funding, NO_DATA))


def _by_care(layers: Layers, flag: str) -> DataFrame:
    cases = cases_in_scope(layers, flag.removeprefix("requirio_"))
    if not _confirmed(layers):
        cases = cases.filter(F.col(flag).isNotNull())
    return summarise(cases, [flag], _summary(layers, ["total_fallecidos"]))


def efectividad_uti(layers: Layers) -> DataFrame:
    return _by_care(layers, "requirio_uti")


def efectividad_arm(layers: Layers) -> DataFrame:
    return _by_care(layers, "requirio_arm")


def composicion_fallecidos_sexo(layers: Layers) -> DataFrame:
    groups = _death_counts(cases_in_scope(layers, "sexo"), "sexo")
    if not _confirmed(layers):
        return groups
    return with_share(groups, "total_fallecidos", "pct_del_total", 1)


def edad_fallecidos(layers: Layers) -> DataFrame:
    known = cases_in_scope(layers, "edad").filter(F.col("edad_anios").isNotNull())
    return _death_counts(known, "edad_anios").orderBy("edad_anios")


def letalidad_mensual(layers: Layers) -> DataFrame:
    """By month of onset; cases without a date form the NULL month."""
    cases = cases_in_scope(layers, "dia").withColumn("mes", month_of(ONSET))
    return summarise(cases, ["mes"], _summary(layers, ["total_fallecidos"])).orderBy("mes")


def casos_provincia_mes(layers: Layers) -> DataFrame:
    cases = cases_in_scope(layers, "provincia")
    return summarise_by_dimension(
        cases if layers.cells else cases.withColumn("mes", month_of(ONSET)),
        "provincia_id",
        layers.dim_provincia,
        province_label(layers.flavour),
        Summary(),
        extra_keys=["mes"],
    )


def piramide_edad(layers: Layers) -> DataFrame:
    """Share of cases and share of deaths per decade; a decade without deaths counts 0."""
    known = cases_in_scope(layers, "edad").filter(F.col("edad_anios").isNotNull())
    bands = summarise(
        known.withColumn("franja_etaria", decade_band("edad_anios")),
        ["franja_etaria"],
        Summary(flags={"total_fallecidos": "fallecido"}, null_as_zero=True),
    )
    bands = with_share(bands, "total_casos", "pct_casos", 2)
    return with_share(bands, "total_fallecidos", "pct_fallecidos", 2)


@dataclass(frozen=True)
class Mart:
    build: Callable[[Layers], DataFrame]
    flavours: tuple[Flavour, ...] = BOTH


MARTS: dict[str, Mart] = {
    "mortalidad_por_sexo": Mart(mortalidad_por_sexo),
    "casos_por_pais": Mart(casos_por_pais),
    "kpis_generales": Mart(kpis_generales),
    "casos_por_dia": Mart(casos_por_dia),
    "resumen_provincia": Mart(resumen_provincia),
    "mortalidad_por_edad": Mart(mortalidad_por_edad),
    "demoras_sistema_salud": Mart(demoras_sistema_salud),
    "publico_vs_privado": Mart(publico_vs_privado),
    "efectividad_uti": Mart(efectividad_uti),
    "efectividad_arm": Mart(efectividad_arm),
    "composicion_fallecidos_sexo": Mart(composicion_fallecidos_sexo),
    "edad_fallecidos": Mart(edad_fallecidos, (Flavour.ALLCASES,)),
    "letalidad_mensual": Mart(letalidad_mensual, (Flavour.CONFIRMED,)),
    "casos_provincia_mes": Mart(casos_provincia_mes, (Flavour.CONFIRMED,)),
    "piramide_edad": Mart(piramide_edad, (Flavour.CONFIRMED,)),
}


def stored(layers: Layers, name: str) -> DataFrame:
    """The mart `name`, computed once and kept with its layers, for whatever reads it next."""
    return layers.keep(f"gold_{name}", lambda: MARTS[name].build(layers))


def mart_names(flavour: Flavour) -> list[str]:
    return [name for name, mart in MARTS.items() if flavour in mart.flavours]


def build(
    spark: SparkSession,
    raw: DataFrame,
    flavour: Flavour,
    names: Iterable[str] | None = None,
    materialize: str = "table",
    database: str = "default",
    checks: Sequence[Check] = (),
) -> dict[str, DataFrame]:
    """Build the marts `names` (default: all of the flavour) and the layers under them.

    As tables, each layer is written once, and one scan of the fact folds the cells that all marts
    are made of; as views nothing runs now and every query goes back to `raw`. `published` is like
    tables, but each one becomes visible only if its `checks` pass, and replaced versions stay.
    """
    stores = {
        "table": keep_as_table(database),
        "published": keep_as_published(database, checks),
        "view": keep_as_view,
    }
    if materialize not in stores:
        raise ValueError(f"materialize must be one of {sorted(stores)}")
    names = list(mart_names(flavour) if names is None else names)
    for name in names:
        if flavour not in MARTS[name].flavours:
            raise ValueError(f"mart {name} does not exist in the {flavour.value} flavour")
    layers = Layers(raw, flavour, stores[materialize])
    built = layers.tables()
    source = layers if materialize == "view" else cube.from_cells(layers)
    built.update(
        {
            f"gold_{name}": layers.keep(f"gold_{name}", lambda: MARTS[name].build(source))
            for name in names
        }
    )
    return built
