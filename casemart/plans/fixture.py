"""Raw cases derived from the order tables: every order becomes one case notification.

All orders take part. The remainders of the order key only decide which defect a case carries
(unparsable age, impossible date, placeholder, missing place, second report of the same case),
so the derived table grows with the orders and has every edge the cleaning has to handle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casemart.schema import (
    CONFIRMED,
    DISCARDED,
    FUNDING_PLACEHOLDER,
    FUNDING_PREFERRED,
    NO,
    RAW_COLUMNS,
    UNIT_MONTHS,
    UNIT_YEARS,
    YES,
)

RAW_INPUTS = ("orders", "customer", "nation", "region")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_cases(spark: SparkSession, sf_dir: str, reports: str = "all") -> DataFrame:
    """The raw table. `reports`: `all`, or only the `first` or the `second` of each case.

    Second reports repeat a case with another funding source. They come out of the same scan
    as the first ones.
    """
    orders, customer, nation, region = (table(spark, sf_dir, n) for n in RAW_INPUTS)
    # A few narrow columns become a wide row of text: the orders are spread first, or a file with
    # one row group would be one task's, here and in every layer that reads the written rows.
    spread = orders.repartition("o_orderkey")
    base = (
        spread.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumn("d0", F.col("o_orderdate").cast("date"))
    )
    k = F.col("o_orderkey")

    def has(divisor: int, rest: int) -> Column:
        return k % divisor == rest

    def later(divisor: int) -> Column:
        return F.date_add("d0", (k % divisor).cast("int")).cast("string")

    def pick(*branches: tuple[Column, Column | str | None], other: Column | str | None) -> Column:
        lit = [(c, v if isinstance(v, Column) else F.lit(v)) for c, v in branches]
        out = F.when(*lit[0])
        for branch in lit[1:]:
            out = out.when(*branch)
        return out.otherwise(other if isinstance(other, Column) else F.lit(other))

    no_province, no_department = has(101, 7), has(103, 8)
    died = has(24, 0) | has(61, 12)
    unclear = "SIN ESPECIFICAR"
    private = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    first_funding = pick(
        (F.col("o_orderpriority") == "5-LOW", FUNDING_PLACEHOLDER),
        (private, "Privado"),
        other=FUNDING_PREFERRED,
    )
    second_funding = pick(
        (first_funding == FUNDING_PREFERRED, "Privado"), other=FUNDING_PREFERRED
    )
    province_code = F.lpad(F.col("n_nationkey").cast("string"), 2, "0")
    department_code = F.lpad(F.length("c_mktsegment").cast("string"), 3, "0")

    columns = {
        "id_evento_caso": k.cast("string"),
        "sexo": pick(
            (F.col("o_orderstatus") == "F", "F"), (F.col("o_orderstatus") == "O", "M"), other="NR"
        ),
        "edad": pick(
            (has(997, 1), "abc"), (has(499, 2), None), other=((k * 31) % 131 - 5).cast("string")
        ),
        "edad_años_meses": pick(
            (has(50, 3), UNIT_MONTHS), (has(503, 4), None), other=UNIT_YEARS
        ),
        "residencia_pais_nombre": pick(
            (has(211, 5), None), (has(23, 6), F.col("r_name")), other="Argentina"
        ),
        "residencia_provincia_nombre": pick((no_province, None), other=F.col("n_name")),
        "residencia_departamento_nombre": pick((no_department, None), other=F.col("c_mktsegment")),
        "carga_provincia_nombre": F.col("n_name"),
        "fecha_inicio_sintomas": pick(
            (has(19, 9), None), (has(991, 10), "2020-13-40"), other=F.col("d0").cast("string")
        ),
        # A short form of the date: only the lenient rule accepts it.
        "fecha_apertura": pick(
            (has(97, 16), F.date_format(later(9).cast("date"), "yyyy-M-d")), other=later(9)
        ),
        "sepi_apertura": (k % 53).cast("string"),
        "fecha_internacion": pick((has(6, 0), later(13)), other=None),
        "cuidado_intensivo": pick((has(12, 0), YES), (has(307, 11), unclear), other=NO),
        "fecha_cui_intensivo": pick((has(12, 0), later(17)), other=None),
        "fallecido": pick((died, YES), (has(311, 13), None), other=NO),
        "fecha_fallecimiento": pick((died, later(29)), other=None),
        "asistencia_respiratoria_mecanica": pick(
            (has(36, 0), YES), (has(313, 14), unclear), other=NO
        ),
        "carga_provincia_id": province_code,
        "origen_financiamiento": F.when(F.col("second"), second_funding).otherwise(first_funding),
        "clasificacion": F.col("o_orderpriority"),
        "clasificacion_resumen": pick(
            (k % 10 < 4, CONFIRMED),
            (k % 10 < 8, DISCARDED),
            (k % 10 == 8, "Sospechoso"),
            other="Sin Clasificar",
        ),
        "residencia_provincia_id": pick((no_province, None), other=province_code),
        "fecha_diagnostico": pick((has(5, 4), None), other=later(11)),
        "residencia_departamento_id": pick((no_department, None), other=department_code),
        "ultima_actualizacion": F.lit("2022-06-05"),
    }
    reported_again = has(47, 15)
    if reports == "first":
        base = base.withColumn("second", F.lit(False))
    elif reports == "second":
        base = base.filter(reported_again).withColumn("second", F.lit(True))
    else:
        once, twice = F.array(F.lit(False)), F.array(F.lit(False), F.lit(True))
        base = base.withColumn("second", F.explode(F.when(reported_again, twice).otherwise(once)))
    return base.select(
        *(columns[c].alias(c) for c in RAW_COLUMNS)
    )


def torn_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases with a line break inside a field: as CSV each is two lines that do not fit."""
    torn = table(spark, sf_dir, "orders").filter("o_orderkey % 1009 = 19")
    values = {
        "id_evento_caso": F.concat(F.lit("x"), F.col("o_orderkey").cast("string")),
        "sexo": F.lit("a\nb"),
    }
    return torn.select(
        *(values.get(c, F.lit(None).cast("string")).alias(c) for c in RAW_COLUMNS)
    )
