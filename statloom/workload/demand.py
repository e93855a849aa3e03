"""Indicators and derived figures over the monthly demand relation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.functions.columns import month_text
from statloom.operators import indicators as ind
from statloom.operators import periods as per
from statloom.operators import reshape as res
from statloom.operators.staging import shared
from statloom.workload import query
from statloom.workload.tables import DEMAND_SQL, YEARS_SQL, demand, table

BASE_YEAR = 1996
WITH_YEARS = f"with {DEMAND_SQL}, {YEARS_SQL}"


def _cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month × segment cells, read by several branches of the queries below."""
    return shared(demand(spark, sf_dir))


def _years(df: DataFrame) -> DataFrame:
    return per.complete_years(df, "tipo", "anio", "mes", "pernoctaciones")


@query("complete_years", f"{WITH_YEARS} select anio from completos")
def complete_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _years(_cube(spark, sf_dir))


PROFILE_SQL = """
vivos as (select base.* from base semi join completos using (anio)),
totales as (select tipo, sum(pernoctaciones) as total from vivos group by tipo),
perfil as (
    select v.tipo, v.mes, sum(v.pernoctaciones) as p,
           100 * sum(v.pernoctaciones) / any_value(t.total) as pct
    from vivos v join totales t on t.tipo = v.tipo group by v.tipo, v.mes
)"""


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    cube = _cube(spark, sf_dir)
    return ind.seasonal_profile(cube, _years(cube), "tipo", "anio", "mes", "pernoctaciones")


@query("seasonal_profile", f"{WITH_YEARS}, {PROFILE_SQL} select tipo, mes, pct from perfil")
def seasonal_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(spark, sf_dir)


ANNUAL_SQL = f"""
sumas as (
    select tipo, anio, sum(pernoctaciones) as pernoctaciones
    from base semi join completos using (anio) group by tipo, anio
),
anual as (
    select s.tipo, s.anio, s.pernoctaciones,
           case when b.pernoctaciones <> 0 then 100 * s.pernoctaciones / b.pernoctaciones end as indice
    from sumas s left join sumas b on b.tipo = s.tipo and b.anio = {BASE_YEAR}
)"""


def _annual(spark: SparkSession, sf_dir: str) -> DataFrame:
    cube = _cube(spark, sf_dir)
    return ind.base_index(cube, _years(cube), "tipo", "anio", "pernoctaciones", BASE_YEAR)


@query(
    "annual_base_index",
    f"{WITH_YEARS}, {ANNUAL_SQL} select tipo, anio, pernoctaciones, indice from anual",
)
def annual_base_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _annual(spark, sf_dir)


@query(
    "group_ratio_profile",
    f"""{WITH_YEARS},
    vivos as (select base.* from base semi join completos using (anio)),
    todo as (select tipo, sum(pernoctaciones) as p, cast(sum(viajeros) as double) as v
             from vivos group by tipo),
    mes as (pivot (select tipo, mes, pernoctaciones from vivos where mes in (1, 8))
            on mes in (1, 8) using sum(pernoctaciones) group by tipo),
    fuera as (select tipo, sum(pernoctaciones) as x from vivos where residencia <> 'espana' group by tipo)
    select tipo, case when "1" <> 0 then "8" / "1" end as ratio_meses,
           case when v <> 0 then p / v end as estancia_media,
           case when p <> 0 then 100 * x / p end as pct_subconjunto
    from todo left join mes using (tipo) left join fuera using (tipo)""",
)
def group_ratio_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    cube = shared(demand(spark, sf_dir, by=["residencia"]))
    abroad = F.col("residencia") == "extranjero"
    return ind.ratio_profile(
        cube, _years(cube), "tipo", "anio", "mes", "pernoctaciones", "viajeros", 8, 1, abroad
    )


@query(
    "gap_preserving_series",
    f"""with {DEMAND_SQL},
    con_dato as (
        select tipo || '/' || nacion as tipo, fecha, sum(pernoctaciones) as pernoctaciones,
               count(*) filter (where es_provisional) > 0 as es_provisional
        from base group by 1, 2
    ),
    limites as (
        select date_trunc('month', min(o_orderdate))::date as lo, (select max(fecha) from base) as hi
        from orders
    ),
    sin_dato as (
        select tipo, unnest(range(lo, hi + interval 1 day, interval 1 month))::date as fecha
        from (select distinct tipo from con_dato), limites
        except
        select tipo, fecha from con_dato
    )
    select tipo, strftime(fecha, '%Y-%m') as mes, pernoctaciones, es_provisional from con_dato
    union all
    select tipo, strftime(fecha, '%Y-%m'), null, false from sin_dato""",
)
def gap_preserving_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    cube = demand(spark, sf_dir, by=["nacion", "es_provisional"])
    cube = shared(cube.withColumn("tipo", F.concat_ws("/", "tipo", "nacion")))
    dates = table(spark, sf_dir, "orders").select(
        F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("fecha")
    )
    series = per.gap_series(cube, dates, "tipo", "fecha", "pernoctaciones", "es_provisional")
    return series.select("tipo", month_text("fecha").alias("mes"), "pernoctaciones", "es_provisional")


@query(
    "last_complete_totals",
    f"""{WITH_YEARS}, {ANNUAL_SQL},
    ultimo as (select max(anio) as a from anual),
    t as (
        select sum(pernoctaciones) filter (where anio = a) as total,
               sum(pernoctaciones) filter (where anio = {BASE_YEAR}) as base
        from anual, ultimo
    )
    select tipo, anio, pernoctaciones, 100 * pernoctaciones / total as peso,
           100 * (total - pernoctaciones) / total as peso_resto, total,
           100 * (total - t.base) / t.base as cambio_total
    from anual, t, ultimo where anio = a""",
)
def last_complete_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    annual = _annual(spark, sf_dir)
    return ind.last_year_totals(annual, "tipo", "anio", "pernoctaciones", BASE_YEAR)


def _volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volumes per group and month over the complete years."""
    cube = _cube(spark, sf_dir)
    kept = per.in_years(cube, _years(cube), "anio")
    return ind.group_totals(kept, ["tipo", "mes"], {"p": "pernoctaciones"})


@query(
    "months_share",
    f"""{WITH_YEARS}, {PROFILE_SQL}
    select tipo, 100 * sum(p) filter (where mes in (6, 7, 8, 9)) / sum(p) as pct
    from perfil group by tipo""",
)
def months_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ind.months_share(_volumes(spark, sf_dir), "tipo", "mes", "p", (6, 7, 8, 9))


PEAK_SQL = """
picos as (
    select tipo,
           first(mes order by pct desc, mes) as peak, max(pct) as peak_value,
           first(mes order by pct, mes) as trough, min(pct) as trough_value
    from perfil group by tipo
)"""


@query("peak_trough", f"{WITH_YEARS}, {PROFILE_SQL}, {PEAK_SQL} select * from picos")
def peak_trough(spark: SparkSession, sf_dir: str) -> DataFrame:
    return res.peak_and_trough(_profile(spark, sf_dir), "tipo", "mes", "pct")


@query(
    "seasonality_rank",
    f"""{WITH_YEARS}, {PROFILE_SQL}, {PEAK_SQL}
    select a.*, (select count(*) + 1 from picos b where b.peak_value > a.peak_value
                 or (b.peak_value = a.peak_value and b.tipo < a.tipo))::integer as puesto
    from picos a""",
)
def seasonality_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ind.seasonality_order(_profile(spark, sf_dir), "tipo", "mes", "pct")


@query(
    "month_against_month",
    f"""{WITH_YEARS}, {PROFILE_SQL}
    select a.tipo, a.pct as pct_a, b.pct as pct_b, a.pct - b.pct as diferencia, a.pct > b.pct as supera
    from perfil a join perfil b on b.tipo = a.tipo and b.mes = 6 where a.mes = 1""",
)
def month_against_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ind.month_against_month(_profile(spark, sf_dir), "tipo", "mes", "pct", 1, 6)


@query(
    "change_against_base",
    f"""{WITH_YEARS}, {ANNUAL_SQL}
    select tipo, anio, pernoctaciones, indice, indice - 100 as frente_a_base
    from anual join (select max(anio) as anio from anual) using (anio)""",
)
def change_against_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ind.change_against_base(_annual(spark, sf_dir), "anio")


@query(
    "seasonality_extremes",
    f"""{WITH_YEARS}, {PROFILE_SQL}, {PEAK_SQL}
    select first(tipo order by peak_value desc, tipo) as mas_estacional,
           last(tipo order by peak_value desc, tipo) as mas_repartido
    from picos""",
)
def seasonality_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ind.seasonality_extremes(_profile(spark, sf_dir), "tipo", "mes", "pct")


@query(
    "two_month_swing",
    f"""with {DEMAND_SQL},
    m as (
        select tipo, anio, sum(pernoctaciones) filter (where mes = 8) as alto,
               sum(pernoctaciones) filter (where mes = 1) as bajo
        from base where mes in (1, 8) group by tipo, anio
    )
    select tipo, anio, alto, bajo, 100 * (alto - bajo) / nullif(bajo, 0) as cambio from m""",
)
def two_month_swing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ind.two_month_swing(demand(spark, sf_dir), "tipo", "anio", "mes", "pernoctaciones", 8, 1)


@query(
    "two_month_swing_total",
    f"""with {DEMAND_SQL},
    m as (
        select anio, cast(sum(viajeros) filter (where mes = 8) as bigint) as alto,
               cast(sum(viajeros) filter (where mes = 1) as bigint) as bajo
        from base where mes in (1, 8) group by anio
    )
    select anio, alto, bajo, 100 * cast(alto - bajo as double) / nullif(bajo, 0) as cambio from m""",
)
def two_month_swing_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ind.two_month_swing(demand(spark, sf_dir), None, "anio", "mes", "viajeros", 8, 1)


@query(
    "below_base",
    f"""{WITH_YEARS}, {ANNUAL_SQL}
    select tipo, anio, pernoctaciones, indice, indice - 100 as frente_a_base
    from anual where anio = (select max(anio) from anual) and indice < 100""",
)
def below_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ind.below_base(_annual(spark, sf_dir), "anio")


@query(
    "year_spine",
    f"""with {DEMAND_SQL},
    t as (
        select tipo || '/' || nacion as grupo, anio, sum(pernoctaciones) as pernoctaciones
        from base group by 1, 2
    ),
    anios as (
        select cast(unnest(generate_series((select min(anio) from t), (select max(anio) from t)))
                    as integer) as anio
    )
    select g.grupo, a.anio, t.pernoctaciones
    from anios a cross join (select distinct grupo from t) g
    left join t on t.grupo = g.grupo and t.anio = a.anio""",
)
def year_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    cube = demand(spark, sf_dir, by=["nacion"]).withColumn(
        "grupo", F.concat_ws("/", "tipo", "nacion")
    )
    totals = ind.group_totals(cube, ["grupo", "anio"], {"pernoctaciones": "pernoctaciones"})
    return per.year_spine(shared(totals), "grupo", "anio", "pernoctaciones")


@query(
    "group_totals",
    f"""with {DEMAND_SQL}
    select nacion, anio, sum(pernoctaciones) as noches, cast(sum(viajeros) as bigint) as personas
    from base group by all""",
)
def group_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    cube = demand(spark, sf_dir, by=["nacion"])
    totals = ind.group_totals(
        cube, ["nacion", "anio"], {"noches": "pernoctaciones", "personas": "viajeros"}
    )
    return totals.orderBy(F.desc("noches"), "nacion", "anio")


@query(
    "latest_per_group",
    """select o_custkey, o_orderkey, cast(o_orderdate as date) as fecha, o_orderstatus
    from orders
    qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1""",
)
def latest_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("fecha"), "o_orderstatus"
    )
    return res.latest_per_group(orders, ["o_custkey"], ["fecha", "o_orderkey"]).select(
        orders.columns
    )


@query(
    "latest_against_group",
    f"""with {DEMAND_SQL},
    m as (select nacion, fecha, sum(pernoctaciones) as p from base group by nacion, fecha),
    u as (select * from m qualify row_number() over (partition by nacion order by fecha desc) = 1),
    r as (select p as referencia from u where nacion = 0)
    select nacion, fecha, p, referencia, p - referencia as diferencia from u, r""",
)
def latest_against_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    cube = demand(spark, sf_dir, by=["nacion"])
    monthly = ind.group_totals(cube, ["nacion", "fecha"], {"p": "pernoctaciones"})
    return ind.against_group(shared(monthly), "nacion", "fecha", "p", 0).select(
        "nacion", "fecha", "p", "referencia", "diferencia"
    )
