"""The same results in plain SQL for an independent engine, over the same input tables.

Each entry is one statement: the common table expressions it needs, then the query. The SQL
starts from the input tables, so it shares no intermediate result with the Spark plans.
"""

from __future__ import annotations

from casemart.schema import CATEGORY_COLUMNS, RAW_COLUMNS

RAW = """
base as (
  select o.o_orderkey as k, o.o_orderstatus as st, o.o_orderpriority as pr,
         cast(o.o_orderdate as date) as d0, c.c_mktsegment as seg,
         n.n_nationkey as nk, n.n_name as nn, r.r_name as rn
  from orders o join customer c on o.o_custkey = c.c_custkey
  join nation n on c.c_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey
),
first_reports as (
  select cast(k as varchar) as id_evento_caso,
    case st when 'F' then 'F' when 'O' then 'M' else 'NR' end as sexo,
    case when k % 997 = 1 then 'abc' when k % 499 = 2 then null
         else cast((k * 31) % 131 - 5 as varchar) end as edad,
    case when k % 50 = 3 then 'Meses' when k % 503 = 4 then null
         else 'Años' end as "edad_años_meses",
    case when k % 211 = 5 then null when k % 23 = 6 then rn else 'Argentina' end as residencia_pais_nombre,
    case when k % 101 = 7 then null else nn end as residencia_provincia_nombre,
    case when k % 103 = 8 then null else seg end as residencia_departamento_nombre,
    nn as carga_provincia_nombre,
    case when k % 19 = 9 then null when k % 991 = 10 then '2020-13-40'
         else cast(d0 as varchar) end as fecha_inicio_sintomas,
    case when k % 97 = 16 then strftime(d0 + cast(k % 9 as int), '%Y-%-m-%-d')
         else cast(d0 + cast(k % 9 as int) as varchar) end as fecha_apertura,
    cast(k % 53 as varchar) as sepi_apertura,
    case when k % 6 = 0 then cast(d0 + cast(k % 13 as int) as varchar) end as fecha_internacion,
    case when k % 12 = 0 then 'SI' when k % 307 = 11 then 'SIN ESPECIFICAR' else 'NO' end as cuidado_intensivo,
    case when k % 12 = 0 then cast(d0 + cast(k % 17 as int) as varchar) end as fecha_cui_intensivo,
    case when k % 24 = 0 or k % 61 = 12 then 'SI' when k % 311 = 13 then null else 'NO' end as fallecido,
    case when k % 24 = 0 or k % 61 = 12 then cast(d0 + cast(k % 29 as int) as varchar) end as fecha_fallecimiento,
    case when k % 36 = 0 then 'SI' when k % 313 = 14 then 'SIN ESPECIFICAR'
         else 'NO' end as asistencia_respiratoria_mecanica,
    lpad(cast(nk as varchar), 2, '0') as carga_provincia_id,
    case pr when '5-LOW' then '*sin dato*' when '1-URGENT' then 'Privado' when '2-HIGH' then 'Privado'
         else 'Público' end as origen_financiamiento,
    pr as clasificacion,
    case when k % 10 < 4 then 'Confirmado' when k % 10 < 8 then 'Descartado'
         when k % 10 = 8 then 'Sospechoso' else 'Sin Clasificar' end as clasificacion_resumen,
    case when k % 101 = 7 then null else lpad(cast(nk as varchar), 2, '0') end as residencia_provincia_id,
    case when k % 5 = 4 then null else cast(d0 + cast(k % 11 as int) as varchar) end as fecha_diagnostico,
    case when k % 103 = 8 then null
         else lpad(cast(length(seg) as varchar), 3, '0') end as residencia_departamento_id,
    '2022-06-05' as ultima_actualizacion
  from base
),
raw as (
  select * from first_reports
  union all
  select * replace (
    case origen_financiamiento when 'Público' then 'Privado' else 'Público' end as origen_financiamiento)
  from first_reports where cast(id_evento_caso as bigint) % 47 = 15
)
"""

def _strict(column: str) -> str:
    """A date only in its full form; `try_cast` alone is the lenient rule."""
    full = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
    return (
        f"case when regexp_matches({column}, '{full}') then try_cast({column} as date) end"
        f" as {column}"
    )


AGE = """case "edad_años_meses" when 'Meses' then 0
         when 'Años' then (case when try_cast(edad as int) >= 0 and try_cast(edad as int) <= 120
                           then try_cast(edad as int) end) end"""

CLEAN_C = f"""
clean_c as (
  select id_evento_caso, sexo, residencia_pais_nombre, residencia_provincia_nombre,
    residencia_departamento_nombre, carga_provincia_nombre,
    {_strict('fecha_inicio_sintomas')},
    {_strict('fecha_apertura')},
    sepi_apertura,
    {_strict('fecha_internacion')},
    cuidado_intensivo is not distinct from 'SI' as cuidado_intensivo,
    {_strict('fecha_cui_intensivo')},
    fallecido is not distinct from 'SI' as fallecido,
    {_strict('fecha_fallecimiento')},
    asistencia_respiratoria_mecanica is not distinct from 'SI' as asistencia_respiratoria_mecanica,
    carga_provincia_id,
    nullif(origen_financiamiento, '*sin dato*') as origen_financiamiento,
    clasificacion, clasificacion_resumen, residencia_provincia_id,
    {_strict('fecha_diagnostico')},
    residencia_departamento_id,
    {AGE} as edad_anios
  from raw
)
"""

DEDUP_C = """
dedup_c as (
  select * from clean_c
  qualify row_number() over (
    partition by id_evento_caso order by origen_financiamiento is not distinct from 'Público' desc) = 1
)
"""

SILVER_C = """
silver_c as (
  select id_evento_caso as id_caso, residencia_pais_nombre as pais,
    residencia_provincia_nombre as provincia, residencia_departamento_nombre as departamento,
    cuidado_intensivo as requirio_uti, asistencia_respiratoria_mecanica as requirio_arm,
    clasificacion as clasificacion_detalle, clasificacion_resumen as clasificacion,
    * exclude (id_evento_caso, residencia_pais_nombre, residencia_provincia_nombre,
      residencia_departamento_nombre, cuidado_intensivo, asistencia_respiratoria_mecanica,
      clasificacion, clasificacion_resumen)
  from dedup_c
)
"""

CLEAN_A = f"""
clean_a as (
  select id_evento_caso as id_caso, sexo, {AGE} as edad_anios, residencia_pais_nombre as pais,
    residencia_provincia_nombre as provincia, residencia_departamento_nombre as departamento,
    try_cast(fecha_inicio_sintomas as date) as fecha_inicio_sintomas,
    try_cast(fecha_apertura as date) as fecha_apertura,
    try_cast(fecha_internacion as date) as fecha_internacion,
    case cuidado_intensivo when 'SI' then true when 'NO' then false end as requirio_uti,
    try_cast(fecha_cui_intensivo as date) as fecha_cui_intensivo,
    case fallecido when 'SI' then true when 'NO' then false end as fallecido,
    try_cast(fecha_fallecimiento as date) as fecha_fallecimiento,
    case asistencia_respiratoria_mecanica when 'SI' then true when 'NO' then false end as requirio_arm,
    nullif(origen_financiamiento, '*sin dato*') as origen_financiamiento,
    clasificacion as clasificacion_detalle, clasificacion_resumen as clasificacion,
    try_cast(fecha_diagnostico as date) as fecha_diagnostico,
    residencia_provincia_id, residencia_departamento_id as departamento_id_original
  from raw
)
"""

SILVER_A = """
silver_a as (
  select * from clean_a
  qualify row_number() over (
    partition by id_caso order by origen_financiamiento is not distinct from 'Público' desc) = 1
)
"""

DIM_PROV = """
dim_prov_{f} as (
  select residencia_provincia_id as provincia_id, provincia
  from silver_{f} where residencia_provincia_id is not null group by all
)
"""

DIM_DEP_C = """
dim_dep_c as (
  select *, row_number() over (order by provincia_id nulls first, departamento_nombre) as departamento_sk
  from (
    select departamento as departamento_nombre, residencia_provincia_id as provincia_id,
      min(residencia_departamento_id) as departamento_id_original
    from silver_c where departamento is not null group by departamento, residencia_provincia_id)
)
"""

DIM_DEP_A = """
dim_dep_a as (
  select departamento, residencia_provincia_id as provincia_id,
    min(departamento_id_original) as departamento_id_original
  from silver_a where departamento is not null group by departamento, residencia_provincia_id
)
"""

FACT_SHARED = """sexo, pais, edad_anios, clasificacion, origen_financiamiento, requirio_uti,
    requirio_arm, fallecido, fecha_inicio_sintomas, fecha_apertura, fecha_diagnostico,
    fecha_internacion, fecha_cui_intensivo, fecha_fallecimiento,
    cast(fecha_apertura - fecha_inicio_sintomas as integer) as dias_a_notificacion,
    cast(fecha_diagnostico - fecha_inicio_sintomas as integer) as dias_a_diagnostico,
    cast(fecha_internacion - fecha_inicio_sintomas as integer) as dias_a_internacion,
    cast(fecha_cui_intensivo - fecha_inicio_sintomas as integer) as dias_a_uti,
    cast(fecha_fallecimiento - fecha_inicio_sintomas as integer) as dias_a_fallecimiento"""

FACT_C = f"""
fact_c as (
  select id_caso, residencia_provincia_id as provincia_id, departamento_sk, {FACT_SHARED}
  from silver_c s left join dim_dep_c d
    on d.departamento_nombre = s.departamento and d.provincia_id = s.residencia_provincia_id
),
conf as (select * from fact_c where clasificacion = 'Confirmado')
"""

FACT_A = f"""
fact_a as (
  select id_caso, p.provincia_id, d.departamento, {FACT_SHARED}
  from silver_a s
  left join dim_dep_a d
    on d.departamento = s.departamento and d.provincia_id = s.residencia_provincia_id
  left join dim_prov_a p on p.provincia_id = s.residencia_provincia_id
)
"""

_CHAINS = {
    "raw": [RAW],
    "clean_c": [RAW, CLEAN_C],
    "dedup_c": [RAW, CLEAN_C, DEDUP_C],
    "silver_c": [RAW, CLEAN_C, DEDUP_C, SILVER_C],
    "clean_a": [RAW, CLEAN_A],
    "silver_a": [RAW, CLEAN_A, SILVER_A],
}
_CHAINS["fact_c"] = [*_CHAINS["silver_c"], DIM_PROV.format(f="c"), DIM_DEP_C, FACT_C]
_CHAINS["fact_a"] = [*_CHAINS["silver_a"], DIM_PROV.format(f="a"), DIM_DEP_A, FACT_A]


def _with(chain: str, query: str) -> str:
    parts = ",\n".join(p.strip() for p in _CHAINS[chain])
    return f"with {parts}\n{query.strip()}"


def _n(flag: str) -> str:
    """Number of rows whose flag is true."""
    return f"count(*) filter (where {flag})"


def _pct(part: str, whole: str = "count(*)", digits: int = 2) -> str:
    return f"round(100.0::double * ({part}) / nullif({whole}, 0), {digits})"


DEAD, UTI, ARM = _n("fallecido"), _n("requirio_uti"), _n("requirio_arm")
MONTH = "cast(date_trunc('month', fecha_inicio_sintomas) as timestamp)"
DECADE = "(edad_anios // 10 * 10) || '-' || (edad_anios // 10 * 10 + 9)"
BAND = f"case when edad_anios >= 80 then '80+' else {DECADE} end"
MEANS_C = ", ".join(
    f"round(avg(dias_a_{d}), 1) as promedio_dias_{d}"
    for d in ("notificacion", "diagnostico", "internacion")
)
MEANS_A = MEANS_C.replace(", 1)", ", 2)")

CONFIRMED = {
    "mortalidad_por_sexo": f"""select sexo, count(*) as total_casos, {DEAD} as total_fallecidos,
        {UTI} as total_uti, {ARM} as total_arm, {_pct(DEAD)} as tasa_mortalidad_pct,
        {_pct(UTI)} as tasa_uti_pct, {_pct(ARM)} as tasa_arm_pct from conf group by sexo""",
    "casos_por_pais": f"""select pais, count(*) as total_casos, {DEAD} as total_fallecidos,
        {_pct("count(*)", "(select count(*) from fact_c)", 4)} as pct_del_total
        from fact_c group by pais""",
    "kpis_generales": f"""select count(*) as total_casos_notificados,
        {_n("clasificacion = 'Confirmado'")} as total_confirmados,
        {_n("clasificacion = 'Descartado'")} as total_descartados,
        {_n("clasificacion = 'Confirmado' and fallecido")} as total_fallecidos,
        {_n("clasificacion = 'Confirmado' and requirio_uti")} as total_requirio_uti,
        {_n("clasificacion = 'Confirmado' and requirio_arm")} as total_requirio_arm,
        {_pct(_n("clasificacion = 'Confirmado' and fallecido"), _n("clasificacion = 'Confirmado'"))}
          as tasa_mortalidad_pct,
        avg(dias_a_diagnostico) filter (where clasificacion = 'Confirmado') as promedio_dias_a_diagnostico,
        avg(dias_a_fallecimiento) filter (where clasificacion = 'Confirmado') as promedio_dias_a_fallecimiento
        from fact_c""",
    "casos_por_dia": f"""select fecha_inicio_sintomas, count(*) as total_casos,
        {DEAD} as total_fallecidos, {UTI} as total_uti
        from conf where fecha_inicio_sintomas is not null group by fecha_inicio_sintomas""",
    "resumen_provincia": f"""select provincia as provincia_nombre, count(*) as total_casos,
        {DEAD} as total_fallecidos, {UTI} as total_uti, {ARM} as total_arm,
        round(avg(dias_a_diagnostico), 1) as promedio_dias_diagnostico,
        {_pct(DEAD)} as tasa_mortalidad_pct
        from conf left join dim_prov_c using (provincia_id) group by provincia""",
    "mortalidad_por_edad": f"""select {BAND} as franja_etaria, count(*) as total_casos,
        {DEAD} as total_fallecidos, {UTI} as total_uti, {_pct(DEAD)} as tasa_mortalidad_pct
        from conf where edad_anios is not null group by 1""",
    "demoras_sistema_salud": f"""select provincia as provincia_nombre, {MEANS_C}
        from conf left join dim_prov_c using (provincia_id) group by provincia""",
    "publico_vs_privado": f"""select origen_financiamiento, count(*) as total_casos,
        {DEAD} as total_fallecidos, {UTI} as total_uti, {_pct(DEAD)} as tasa_mortalidad_pct
        from conf where origen_financiamiento is not null group by origen_financiamiento""",
    "efectividad_uti": f"""select requirio_uti, count(*) as total_casos,
        {DEAD} as total_fallecidos, {_pct(DEAD)} as tasa_mortalidad_pct
        from conf group by requirio_uti""",
    "efectividad_arm": f"""select requirio_arm, count(*) as total_casos,
        {DEAD} as total_fallecidos, {_pct(DEAD)} as tasa_mortalidad_pct
        from conf group by requirio_arm""",
    "composicion_fallecidos_sexo": f"""select sexo, count(*) as total_fallecidos,
        {_pct("count(*)", "(select count(*) from conf where fallecido)", 1)} as pct_del_total
        from conf where fallecido group by sexo""",
    "letalidad_mensual": f"""select {MONTH} as mes, count(*) as total_casos,
        {DEAD} as total_fallecidos, {_pct(DEAD)} as tasa_mortalidad_pct from conf group by 1""",
    "casos_provincia_mes": f"""select provincia as provincia_nombre, {MONTH} as mes,
        count(*) as total_casos
        from conf left join dim_prov_c using (provincia_id) group by all""",
    "piramide_edad": f"""select {DECADE} as franja_etaria, count(*) as total_casos,
        {DEAD} as total_fallecidos,
        {_pct("count(*)", "(select count(*) from conf where edad_anios is not null)")} as pct_casos,
        {_pct(DEAD, "(select count(*) from conf where edad_anios is not null and fallecido)")}
          as pct_fallecidos
        from conf where edad_anios is not null group by 1""",
}

ALLCASES = {
    "mortalidad_por_sexo": f"""select sexo, count(*) as total_casos, {DEAD} as total_fallecidos,
        {_pct(DEAD)} as tasa_letalidad, {UTI} as total_uti, {_pct(UTI)} as tasa_uti,
        {ARM} as total_arm, {_pct(ARM)} as tasa_arm from fact_a group by sexo""",
    "casos_por_pais": """select ifnull(g.pais, 'Sin dato') as pais, total_casos
        from (select pais, count(*) as total_casos from fact_a group by pais) g""",
    "kpis_generales": f"""select count(*) as total_casos, {DEAD} as total_fallecidos,
        {_pct(DEAD)} as tasa_letalidad, {UTI} as total_uti, {ARM} as total_arm,
        count(distinct provincia_id) as provincias_afectadas from fact_a""",
    "casos_por_dia": f"""select fecha_inicio_sintomas as fecha, count(*) as casos,
        {DEAD} as fallecidos
        from fact_a where fecha_inicio_sintomas is not null group by fecha_inicio_sintomas""",
    "resumen_provincia": f"""select provincia, count(*) as total_casos, {DEAD} as total_fallecidos,
        {_pct(DEAD)} as tasa_letalidad, {UTI} as total_uti,
        round(avg(dias_a_diagnostico), 2) as promedio_dias_diagnostico
        from fact_a join dim_prov_a using (provincia_id) group by provincia""",
    "mortalidad_por_edad": f"""select ifnull({DECADE}, 'Sin dato') as rango_edad,
        count(*) as total_casos, {DEAD} as total_fallecidos, {_pct(DEAD)} as tasa_letalidad,
        {UTI} as total_uti from fact_a group by 1""",
    "demoras_sistema_salud": f"""select provincia, {MEANS_A}
        from fact_a join dim_prov_a using (provincia_id) group by provincia""",
    "publico_vs_privado": f"""select ifnull(g.origen, 'Sin dato') as origen_financiamiento,
        g.* exclude (origen)
        from (select origen_financiamiento as origen, count(*) as total_casos,
          {DEAD} as total_fallecidos, {_pct(DEAD)} as tasa_letalidad,
          {UTI} as total_uti, {_pct(UTI)} as tasa_uti
          from fact_a group by origen_financiamiento) g""",
    "efectividad_uti": f"""select requirio_uti, count(*) as total_casos,
        {DEAD} as total_fallecidos, {_pct(DEAD)} as tasa_letalidad
        from fact_a where requirio_uti is not null group by requirio_uti""",
    "efectividad_arm": f"""select requirio_arm, count(*) as total_casos,
        {DEAD} as total_fallecidos, {_pct(DEAD)} as tasa_letalidad
        from fact_a where requirio_arm is not null group by requirio_arm""",
    "composicion_fallecidos_sexo": """select sexo, count(*) as total_fallecidos
        from fact_a where fallecido group by sexo""",
    "edad_fallecidos": """select edad_anios, count(*) as total_fallecidos
        from fact_a where fallecido and edad_anios is not null group by edad_anios""",
}


def _mart_c(name: str, query: str) -> str:
    """`query` over the result of a confirmed mart, named m."""
    return _with("fact_c", f"select * from ({query.format(m='(' + CONFIRMED[name] + ')')})")


def _profile(source: str, columns: list[str]) -> str:
    """One row per column; every column is read on its own."""
    return "\nunion all\n".join(
        f"""select '{c}' as "column",
          count(distinct "{c}") + max(case when "{c}" is null then 1 else 0 end) as n_distinct,
          count(*) filter (where "{c}" is null or cast("{c}" as varchar) = '') as n_missing,
          {_pct(f'''count(*) filter (where "{c}" is null or cast("{c}" as varchar) = '')''', digits=1)}
            as pct_missing
        from {source}"""
        for c in columns
    )


def _value_counts(source: str, columns: list[str]) -> str:
    return "\nunion all\n".join(
        f"""select '{c}' as "column", cast("{c}" as varchar) as "value", count(*) as n
        from {source} group by "{c}" """
        for c in columns
    )


def _null_audit(source: str, columns: list[str]) -> str:
    per_column = "\nunion all\n".join(
        f"""select '{c}' as "column", count(*) - count("{c}") as n_null,
          {_pct(f'count(*) - count("{c}")', digits=1)} as pct_null from {source}"""
        for c in columns
    )
    return f"select * from ({per_column}) where n_null > 0"


def _duplicate_audit(source: str, keys: list[str], columns: list[str]) -> str:
    """Distinct values per column, with NULL as one more value where it occurs."""
    differs = ", ".join(
        f"""case when count(distinct "{c}") + max(case when "{c}" is null then 1 else 0 end) > 1
            then '{c}' end"""
        for c in columns
    )
    return f"""select {", ".join(keys)}, count(*) as n_rows,
        concat_ws(',', {differs}) as differing_columns
        from {source} group by {", ".join(keys)} having count(*) > 1"""


def _quality(f: str) -> str:
    department = "departamento_nombre" if f == "c" else "departamento"

    def unique(table: str, source: str, column: str) -> str:
        return f"""select 'unique' as "check", '{table}' as "table", '{column}' as "column",
          count(*) as violations from (select {column} from {source}
          where {column} is not null group by {column} having count(*) > 1)"""

    def not_null(table: str, source: str, column: str, named: str | None = None) -> str:
        return f"""select 'not_null', '{table}', '{named or column}',
          count(*) from {source} where {column} is null"""

    rows = [
        unique("silver_casos", f"silver_{f}", "id_caso"),
        not_null("silver_casos", f"silver_{f}", "id_caso"),
        unique("dim_provincia", f"dim_prov_{f}", "provincia_id"),
        not_null("dim_provincia", f"dim_prov_{f}", "provincia_id"),
        not_null("dim_departamento", f"dim_dep_{f}", department, "departamento"),
        unique("fact_casos", f"fact_{f}", "id_caso"),
        not_null("fact_casos", f"fact_{f}", "id_caso"),
        not_null("fact_casos", f"fact_{f}", "fallecido"),
        not_null("fact_casos", f"fact_{f}", "requirio_uti"),
    ]
    union = "\nunion all\n".join(rows)
    return f"select *, violations = 0 as passed from ({union})"


SILVER_COLUMNS = """id_caso pais provincia departamento requirio_uti requirio_arm
    clasificacion_detalle clasificacion sexo carga_provincia_nombre fecha_inicio_sintomas
    fecha_apertura sepi_apertura fecha_internacion fecha_cui_intensivo fallecido
    fecha_fallecimiento carga_provincia_id origen_financiamiento residencia_provincia_id
    fecha_diagnostico residencia_departamento_id edad_anios"""

FACT_COLUMNS = """id_caso sexo pais provincia_id {dep} edad_anios clasificacion
    origen_financiamiento requirio_uti requirio_arm fallecido fecha_inicio_sintomas fecha_apertura
    fecha_diagnostico fecha_internacion fecha_cui_intensivo fecha_fallecimiento
    dias_a_notificacion dias_a_diagnostico dias_a_internacion dias_a_uti dias_a_fallecimiento"""

LINEITEM_VALUES = """l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax l_returnflag
    l_linestatus l_shipdate""".split()


def _matrix_cells() -> str:
    """Every province with every month that occurs."""
    mart = CONFIRMED["casos_provincia_mes"]
    cells = f"""(select provincia_nombre, strftime(mes, '%Y-%m') as mes, total_casos as casos
        from ({mart}) where mes is not null and provincia_nombre is not null)"""
    return _with(
        "fact_c",
        f"""select t.provincia_nombre, m.mes, cast(coalesce(c.casos, 0) as bigint) as casos,
          t.total_casos, t.orden
        from (select provincia_nombre, cast(sum(casos) as bigint) as total_casos,
                cast(row_number() over (order by sum(casos) desc, provincia_nombre) as integer)
                  as orden
              from {cells} group by provincia_nombre) t
        cross join (select distinct mes from {cells}) m
        left join {cells} c on c.provincia_nombre = t.provincia_nombre and c.mes = m.mes""",
    )


def _native() -> dict[str, str]:
    opened, discounted = _n("l_linestatus = 'O'"), _n("l_discount >= 0.05")
    return {
        "rate_lineitem_returnflag": f"""select l_returnflag, count(*) as n, {opened} as n_open,
            {discounted} as n_discounted, {_pct(opened, digits=4)} as n_open_pct,
            {_pct(discounted, digits=4)} as n_discounted_pct
            from lineitem group by l_returnflag""",
        "delay_orders_ship": """select o_orderpriority, count(*) as n_items,
            cast(sum(days) as bigint) as total_days, round(avg(days), 2) as mean_days
            from (select o_orderpriority,
                    cast(l_shipdate as date) - cast(o_orderdate as date) as days
                  from orders join lineitem on o_orderkey = l_orderkey)
            group by o_orderpriority""",
        "delay_items_by_flag": """select l_returnflag, l_linestatus,
            round(avg(dayofyear(l_shipdate) - 1), 2) as mean_day
            from lineitem group by l_returnflag, l_linestatus""",
        "events_per_day": f"""select cast(ts as date) as day, count(*) as n_events,
            {_n("event_type = 'purchase'")} as n_purchase, {_n("event_type = 'error'")} as n_error
            from events group by 1""",
        "dedup_lineitem_latest": f"""select * from lineitem qualify row_number() over (
            partition by l_orderkey, l_linenumber order by l_shipdate desc nulls last,
            {", ".join(f"{c} nulls first" for c in LINEITEM_VALUES)}) = 1""",
        "duplicate_lineitems": _duplicate_audit(
            "lineitem", ["l_orderkey", "l_linenumber"], LINEITEM_VALUES
        ),
        "profile_lineitem": _profile(
            "lineitem", ["l_orderkey", "l_linenumber", *LINEITEM_VALUES]
        ),
        "value_counts_lineitem": _value_counts(
            "lineitem", ["l_returnflag", "l_linestatus", "l_linenumber"]
        ),
        "share_orders_priority": f"""select o_orderpriority, count(*) as n,
            {_pct("count(*)", "(select count(*) from orders)", 4)} as pct_of_total
            from orders group by o_orderpriority""",
        "orders_per_customer": """select o_custkey, count(*) as n_orders
            from orders group by o_custkey""",
    }


def all_oracles() -> dict[str, str]:
    out = {
        "clean_ages": _with(
            "raw",
            f"""select id_evento_caso, edad, try_cast(edad as int) as edad_original,
            "edad_años_meses", {AGE} as edad_anios from raw""",
        ),
        "clean_cases_confirmed": _with("clean_c", "select * from clean_c"),
        "clean_cases_allcases": _with("clean_a", "select * from clean_a"),
        "dedup_cases": _with("dedup_c", "select * from dedup_c"),
        "silver_confirmed": _with("silver_c", "select * from silver_c"),
        "silver_allcases": _with("silver_a", "select * from silver_a"),
        "dim_provincia": _with("fact_a", "select * from dim_prov_a"),
        "dim_provincia_confirmed": _with(
            "fact_c", "select provincia_id, provincia as provincia_nombre from dim_prov_c"
        ),
        "dim_provincia_view": _with("fact_a", "select * from dim_prov_a"),
        "raw_table": _with("raw", "select * from raw"),
        "read_raw_csv": _with("raw", "select * from raw"),
        "read_raw_records": _with(
            "raw",
            f"""select * from raw union all
            select 'x' || o_orderkey, 'a' || chr(10) || 'b'{", null" * (len(RAW_COLUMNS) - 2)}
            from orders where o_orderkey % 1009 = 19""",
        ),
        "rejected_raw_lines": """
            select 'x' || o_orderkey || ',"a' as line from orders where o_orderkey % 1009 = 19
            union all
            select 'b"' || repeat(',', 23) from orders where o_orderkey % 1009 = 19""",
        "refreshed_mart": _with("fact_c", CONFIRMED["resumen_provincia"]),
        "published_mart": _with("fact_c", CONFIRMED["mortalidad_por_sexo"]),
        "ingest_by_content": _with("raw", "select * from raw"),
        "exported_mart": _with("fact_c", CONFIRMED["mortalidad_por_sexo"]),
        "profile_lineitem_approx": f"""
            select "column", n_missing, true as within_bound
            from ({_profile("lineitem", ["l_orderkey", "l_linenumber", *LINEITEM_VALUES])})""",
        "dim_departamento_confirmed": _with("fact_c", "select * from dim_dep_c"),
        "dim_departamento_allcases": _with("fact_a", "select * from dim_dep_a"),
        "fact_confirmed": _with("fact_c", "select * from fact_c"),
        "fact_allcases": _with("fact_a", "select * from fact_a"),
    }
    out |= {f"{name}_c": _with("fact_c", sql) for name, sql in CONFIRMED.items()}
    out |= {f"{name}_a": _with("fact_a", sql) for name, sql in ALLCASES.items()}
    # The same marts from the cells of one scan, and kept over deliveries.
    out |= {f"cube_{name}_c": out[f"{name}_c"] for name in CONFIRMED}
    out |= {f"cube_{name}_a": out[f"{name}_a"] for name in ALLCASES}
    kept = ["casos_por_dia", "resumen_provincia", "letalidad_mensual", "casos_provincia_mes"]
    out |= {f"delta_{name}_c": out[f"{name}_c"] for name in kept}
    out["delta_silver_confirmed"] = out["silver_confirmed"]
    funding = " union all ".join(
        f"""select origen_financiamiento, '{m}' as metrica, cast({m} as double) as valor
        from {{m}}"""
        for m in ("tasa_mortalidad_pct", "total_uti", "total_casos")
    )
    care = " union all ".join(
        f"""select '{label}' as intervencion, case when {flag} then 'True' else 'False' end as requirio,
        tasa_mortalidad_pct from ({CONFIRMED[mart]})"""
        for label, flag, mart in (
            ("UTI", "requirio_uti", "efectividad_uti"),
            ("ARM", "requirio_arm", "efectividad_arm"),
        )
    )
    out |= {
        "preview_provinces": _mart_c(
            "resumen_provincia",
            "select * from {m} order by total_casos desc, provincia_nombre nulls first limit 10",
        ),
        "profile_raw": _with("raw", _profile("raw", RAW_COLUMNS)),
        "value_counts_raw": _with("raw", _value_counts("raw", CATEGORY_COLUMNS)),
        "null_audit_fact_c": _with(
            "fact_c", _null_audit("fact_c", FACT_COLUMNS.format(dep="departamento_sk").split())
        ),
        "null_audit_fact_a": _with(
            "fact_a", _null_audit("fact_a", FACT_COLUMNS.format(dep="departamento").split())
        ),
        "check_unique_raw": _with(
            "raw",
            """select id_evento_caso, count(*) as n from raw
            where id_evento_caso is not null group by 1 having count(*) > 1""",
        ),
        "check_unique_silver": _with(
            "silver_c",
            "select id_caso, count(*) as n from silver_c group by 1 having count(*) > 1",
        ),
        "check_not_null_fallecido_a": _with(
            "fact_a", "select * from fact_a where fallecido is null"
        ),
        "check_not_null_uti_c": _with(
            "fact_c", "select * from fact_c where requirio_uti is null"
        ),
        "dim_key_check": _with(
            "fact_c",
            """select departamento_nombre, provincia_id, count(*) as n
            from dim_dep_c group by 1, 2 having count(*) > 1""",
        ),
        "quality_report_c": _with("fact_c", _quality("c")),
        "quality_report_a": _with("fact_a", _quality("a")),
        "duplicate_audit": _with(
            "raw", _duplicate_audit("raw", ["id_evento_caso"], RAW_COLUMNS[1:])
        ),
        "code_collisions": _with(
            "silver_c",
            """select residencia_departamento_id, residencia_provincia_id,
            count(distinct departamento) as n_names, count(*) as n_rows from silver_c
            where residencia_departamento_id is not null and residencia_provincia_id is not null
            group by 1, 2 having count(distinct departamento) > 1""",
        ),
        "dedup_step_counts": _with(
            "raw",
            """select count(*) as rows_before, count(distinct id_evento_caso) as rows_after,
            (select count(*) from (select 1 from raw group by id_evento_caso having count(*) > 1))
              as duplicated_keys from raw""",
        ),
        "feed_daily_curve": _mart_c(
            "casos_por_dia", "select fecha_inicio_sintomas, total_casos from {m}"
        ),
        "feed_age_rate": _mart_c(
            "mortalidad_por_edad", "select franja_etaria, tasa_mortalidad_pct from {m}"
        ),
        "feed_deaths_age": _with("fact_a", ALLCASES["edad_fallecidos"]),
        "feed_province_rate": _mart_c(
            "resumen_provincia", "select provincia_nombre, tasa_mortalidad_pct from {m}"
        ),
        "feed_province_delay": _mart_c(
            "demoras_sistema_salud", "select provincia_nombre, promedio_dias_diagnostico from {m}"
        ),
        "feed_province_volume": _mart_c(
            "resumen_provincia", "select provincia_nombre, total_casos from {m}"
        ),
        "feed_funding_long": _mart_c("publico_vs_privado", funding),
        "feed_uti_arm": _with("fact_c", care),
        "feed_died_survived": _with(
            "fact_c",
            f"""select 'Fallecidos' as grupo, {DEAD} as total_casos from conf
            union all select 'No fallecidos', {_n("not fallecido")} from conf""",
        ),
        "feed_deaths_sex": _mart_c(
            "composicion_fallecidos_sexo",
            r"""select *, printf('%.1f%%', pct_del_total) || chr(10) ||
            '(' || format('{{:,}}', total_fallecidos) || ')' as etiqueta from {m}""",
        ),
        "feed_monthly_rate": _mart_c(
            "letalidad_mensual", "select mes, tasa_mortalidad_pct from {m} where mes is not null"
        ),
        "feed_province_month_matrix": _matrix_cells(),
        "feed_matrix_bounds": _mart_c(
            "casos_provincia_mes",
            """select min(total_casos) as minimo, max(total_casos) as maximo from {m}
            where mes is not null and provincia_nombre is not null""",
        ),
        "feed_pyramid": _mart_c(
            "piramide_edad",
            """select *, cast(split_part(franja_etaria, '-', 1) as integer) as edad_inicio
            from {m} where cast(split_part(franja_etaria, '-', 1) as integer) <= 90""",
        ),
        "feed_delay_vs_rate": _with(
            "fact_c",
            f"""select d.*, r.* exclude (provincia_nombre, promedio_dias_diagnostico)
            from ({CONFIRMED["demoras_sistema_salud"]}) d join ({CONFIRMED["resumen_provincia"]}) r
              on d.provincia_nombre is not distinct from r.provincia_nombre""",
        ),
        "ingest_incremental": _with("raw", "select * from raw"),
    }
    # The same rows from tables laid out by key or by two columns, and counted by their writes.
    out |= {
        "bucketed_silver_confirmed": out["silver_confirmed"],
        "bucketed_duplicate_audit": out["duplicate_audit"],
        "bucketed_check_unique_silver": out["check_unique_silver"],
        "bucketed_fact_confirmed": out["fact_confirmed"],
        "clustered_fact_confirmed": out["fact_confirmed"],
        "clustered_casos_provincia_mes_c": out["casos_provincia_mes_c"],
        "written_null_audit_silver_c": _with(
            "silver_c", _null_audit("silver_c", SILVER_COLUMNS.split())
        ),
        "written_null_audit_fact_c": out["null_audit_fact_c"],
        "written_null_audit_fact_a": out["null_audit_fact_a"],
        "written_step_counts": _with(
            "raw",
            "select count(*) as rows_before, count(distinct id_evento_caso) as rows_after from raw",
        ),
        "loads_profile_raw": _with(
            "raw",
            f"""select "column", n_missing, pct_missing, true as within_bound
            from ({_profile("raw", RAW_COLUMNS)})""",
        ),
        "loads_value_counts_raw": out["value_counts_raw"],
    }
    return out | _native()
