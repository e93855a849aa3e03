"""The concrete silver, gold and indicator plans over two sources made from the given tables.

The «statistics office» publishes long series per segment, territory, measure and residence;
the «portal» publishes one table of destinations, zone totals and marks per month. Both come
from orders, lines, customers and nations, with hidden cells and an unpublished month.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.functions.columns import percent, ratio
from statloom.operators.periods import published_periods
from statloom.operators.quality import rules_report
from statloom.operators.staging import shared
from statloom.plans import checks, gold, indicators, silver
from statloom.plans import fixed_values as fx
from statloom.plans.tables import built_in
from statloom.workload import query
from statloom.workload.tables import complete_years_sql, demand, table

SEGMENTS = {"AUTOMOBILE": "hotel", "BUILDING": "hotel", "FURNITURE": "camping", "HOUSEHOLD": "rural"}
LABELS = [label for label, _, kind in fx.PUBLISHED_LABELS if kind == "destino"]
ZONE_OF = {label: zone for label, zone, kind in fx.PUBLISHED_LABELS if kind == "destino"}


def _choice(c: Column, options: dict, default: str | None) -> Column:
    out = F.lit(default)
    for k, v in options.items():
        out = F.when(c == k, v).otherwise(out)
    return out


# --- the two sources ------------------------------------------------------------------


def base_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and lines brought to months once; both sources start from these cells."""
    return shared(demand(spark, sf_dir, by=["nacion", "residencia", "es_provisional"]))


def office_cells(cells: DataFrame, nations: DataFrame) -> DataFrame:
    """Month × territory × type × residence: orders, quantity and orders under revision."""
    places = nations.select(
        F.col("n_nationkey").alias("nacion"),
        _choice(F.col("n_regionkey"), {3: "costa-calida", 4: "cartagena"}, fx.REGION).alias(
            "territorio"
        ),
    )
    kind = _choice(F.col("tipo"), SEGMENTS, "apartamento")
    return shared(
        cells.withColumn("tipo", kind)
        .join(places, "nacion")
        .groupBy("fecha", "territorio", "tipo", "residencia")
        .agg(
            F.sum("viajeros").alias("n"),
            F.sum("pernoctaciones").alias("q"),
            F.coalesce(F.sum(F.when(F.col("es_provisional"), F.col("viajeros"))), F.lit(0)).alias(
                "u"
            ),
        )
    )


def _long(cells: DataFrame, fact: str, measures: dict[str, Column], residence: bool) -> DataFrame:
    """Cells to one row per measure, in the shape of a loaded series table."""
    rows = [
        F.struct(F.lit(m).alias("medida"), v.cast("double").alias("valor"))
        for m, v in measures.items()
    ]
    res = F.col("residencia") if residence else F.lit("")
    long = cells.select(
        "fecha", "territorio", "tipo", res.alias("residencia"), "secreto", F.inline(F.array(*rows))
    )
    return long.filter(F.col("valor").isNotNull()).select(
        F.lit(fact).alias("hecho"), "territorio", "tipo", "residencia", "medida", "fecha", "secreto", "valor"
    )


def office_long(cells: DataFrame) -> DataFrame:
    n, q, u = F.col("n"), F.col("q"), F.col("u")
    people = cells.withColumn("secreto", n % 10 == 0)
    supply = (
        cells.groupBy("fecha", "territorio", "tipo")
        .agg(F.sum("n").alias("n"), F.sum("q").alias("q"), F.sum("u").alias("u"))
        .withColumn("secreto", n % 10 == 0)
    )
    prices = supply.filter(F.col("tipo") == fx.HOTEL).withColumn("secreto", F.lit(False))
    return (
        _long(people, "demanda", {"viajeros": n, "pernoctaciones": q}, True)
        .unionByName(
            _long(
                supply,
                "oferta",
                {
                    "establecimientos": n,
                    "plazas": q,
                    "personal_empleado": u,
                    "habitaciones": F.when(F.col("tipo") == fx.HOTEL, q * 2),
                    "parcelas": F.when(F.col("tipo") == "camping", q + 1),
                    "ocupacion_plazas": percent(u, n),
                },
                False,
            )
        )
        .unionByName(
            _long(
                prices,
                "precios",
                {"indice_precios": ratio(q, n), "variacion_interanual_precios": n % 21 - 10},
                False,
            )
        )
    )


def office_series(long: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Loaded series and their catalogue."""
    code = F.concat_ws("|", "hecho", "territorio", "tipo", "residencia", "medida")
    rows = long.withColumn("codigo", code)
    series = rows.select(
        "codigo",
        F.col("codigo").alias("nombre_serie"),
        F.year("fecha").cast("smallint").alias("anio"),
        F.month("fecha").cast("smallint").alias("periodo"),
        F.when(F.col("fecha") >= F.lit("2001-06-01").cast("date"), 2)
        .otherwise(1)
        .cast("smallint")
        .alias("fk_tipo_dato"),
        F.when(F.col("secreto"), 0.0).otherwise(F.col("valor")).alias("valor"),
        "secreto",
        F.lit(None).cast("string").alias("notas"),
        F.lit("orders").alias("_fichero_origen"),
        F.lit("2002-01-01").cast("date").alias("_ingestado_en"),
    )
    catalogue = rows.select(
        "codigo",
        "hecho",
        F.col("tipo").alias("tipo_alojamiento"),
        "territorio",
        F.col("territorio").alias("nivel_territorio"),
        "medida",
        "residencia",
    ).distinct()
    return series, catalogue


MEASURES = ["viajeros_residentes", "viajeros_no_residentes"]
MEASURES += ["pernoctaciones_residentes", "pernoctaciones_no_residentes"]


def portal_rows(cells: DataFrame) -> DataFrame:
    """Loaded portal table: destinations, zone totals and the grand total of every month."""
    labels = F.array(*[F.lit(x) for x in LABELS])
    zones = F.array(*[F.lit(ZONE_OF[x]) for x in LABELS])
    spot = (F.col("nacion") % len(LABELS) + 1).cast("int")
    home = F.col("residencia") == fx.RESIDENTS
    people, nights = F.col("viajeros"), F.col("pernoctaciones")
    sums = zip(MEASURES, [home, ~home] * 2, [people, people, nights, nights], strict=True)
    places = [F.element_at(zones, spot).alias("zona"), F.element_at(labels, spot).alias("destino")]
    volumes = [
        F.coalesce(F.sum(F.when(cond, v)), F.lit(0)).cast("bigint").alias(m) for m, cond, v in sums
    ]
    cells = shared(cells.groupBy("fecha", *places).agg(*volumes))
    hidden = (F.length("destino") + F.month("fecha")) % 4 == 0
    shown = cells.withColumns({m: F.when(hidden, 0).otherwise(F.col(m)) for m in MEASURES})

    def total(keys: list[str], label: Column) -> DataFrame:
        sums = [F.sum(m).alias(m) for m in MEASURES]
        return cells.groupBy(*keys).agg(*sums).withColumn("destino", label)

    mark = F.when(F.month("fecha") % 2 == 0, " *").otherwise("")
    zone = F.concat(F.lit("Total "), F.initcap("zona"), mark)
    parts = [shown.drop("zona"), total(["fecha", "zona"], zone).drop("zona"), total(["fecha"], F.lit("Totales"))]
    rows = reduce(DataFrame.unionByName, parts)
    silent = F.col("fecha") == F.lit("2000-12-01").cast("date")
    return rows.select(
        F.year("fecha").cast("smallint").alias("anio"),
        F.month("fecha").cast("smallint").alias("mes"),
        "destino",
        *[F.when(silent, 0).otherwise(F.col(m)).cast("bigint").alias(m) for m in MEASURES],
        F.lit("2002-01-01").cast("date").alias("_ingestado_en"),
    )


# --- silver and gold ------------------------------------------------------------------


def _observations(spark: SparkSession, sf_dir: str, cells: DataFrame | None = None) -> DataFrame:
    """Catalogued observations, written once: several facts read them."""
    cells = base_cells(spark, sf_dir) if cells is None else cells
    office = office_cells(cells, table(spark, sf_dir, "nation"))
    series, catalogue = office_series(office_long(office))
    return shared(silver.catalogued(silver.series_observations(series), catalogue))


def _portal(cells: DataFrame, stg: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Classified rows, residual and occupancy of the portal."""
    stg = silver.destination_rows(portal_rows(cells)) if stg is None else stg
    labels = built_in(cells.sparkSession)["destinos_murciaturistica"]
    rows = shared(silver.classified_rows(stg, labels))
    rest = silver.residual_by_zone(rows)
    return rows, rest, silver.destination_occupancy(rows, rest)


def star(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """Gold tables by name. What several of them read, or several indicators, is written once.

    The calendar needs the portal's published months only, not its occupancy.
    """
    ref = built_in(spark)
    cells = base_cells(spark, sf_dir)
    obs = _observations(spark, sf_dir, cells)
    portal = {"dim_fecha", "fct_demanda_mensual"} & set(names)
    stg = silver.destination_rows(portal_rows(cells)) if portal else None
    occupancy = shared(_portal(cells, stg)[2]) if "fct_demanda_mensual" in names else None
    months = published_periods(stg, "fecha", silver.OCCUPANCY) if portal else None
    make = {
        "dim_fecha": lambda: shared(gold.calendar(obs, months)),
        "dim_territorio": lambda: gold.territories(ref["territorios"]),
        "dim_tipo_alojamiento": lambda: gold.accommodation_types(ref["tipos_alojamiento"]),
        "dim_residencia": lambda: gold.residences(ref["residencias"]),
        "fct_demanda_mensual": lambda: gold.demand(obs, occupancy, ref["territorios"]),
        "fct_oferta_mensual": lambda: gold.supply(obs),
        "fct_precios_mensual": lambda: gold.prices(obs),
    }
    return {n: make[n]() for n in names}


# --- the same in SQL ------------------------------------------------------------------

_SEG = " ".join(f"when '{k}' then '{v}'" for k, v in SEGMENTS.items())
_SPOTS = ", ".join(f"({i}, '{x}', '{ZONE_OF[x]}')" for i, x in enumerate(LABELS))
_HOTEL = "tipo = 'hotel'"
OFFICE_SQL = f"""
lineas as (select l_orderkey, sum(l_quantity) as q from lineitem group by l_orderkey),
pedidos as (
    select cast(date_trunc('month', o_orderdate) as date) as fecha, o_custkey,
           case when o_orderstatus = 'F' then 'espana' else 'extranjero' end as residencia,
           o_orderstatus = 'P' as prov, l.q
    from orders join lineas l on l.l_orderkey = o_orderkey
),
celdas as (
    select fecha,
           case n_regionkey when 3 then 'costa-calida' when 4 then 'cartagena' else 'region-murcia' end
               as territorio,
           case c_mktsegment {_SEG} else 'apartamento' end as tipo, residencia,
           count(*) as n, sum(q) as q, count(*) filter (where prov) as u
    from pedidos join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey
    group by all
),
demanda_ine as (
    select fecha, territorio, tipo, residencia,
           case when n % 10 <> 0 then n end as viajeros,
           case when n % 10 <> 0 then cast(q as bigint) end as pernoctaciones,
           fecha >= date '2001-06-01' as es_provisional, n % 10 = 0 as tiene_secreto
    from celdas
),
oferta as (
    select fecha, territorio, tipo, cast(sum(n) as bigint) as n, sum(q) as q,
           cast(sum(u) as bigint) as u
    from celdas group by all
)"""
PORTAL_SQL = f"""
sitios(i, destino, zona) as (values {_SPOTS}),
visitas as (
    select fecha, zona, destino, count(*) filter (where residencia = 'espana') as vr,
           count(*) filter (where residencia <> 'espana') as vn,
           cast(coalesce(sum(q) filter (where residencia = 'espana'), 0) as bigint) as pr,
           cast(coalesce(sum(q) filter (where residencia <> 'espana'), 0) as bigint) as pn
    from pedidos join customer on c_custkey = o_custkey
    join sitios on i = c_nationkey % {len(LABELS)}
    where fecha <> date '2000-12-01' group by all
),
publicado as (
    select fecha, zona, destino, x * vr as vr, x * vn as vn, x * pr as pr, x * pn as pn
    from (select *, case when (length(destino) + month(fecha)) % 4 = 0 then 0 else 1 end as x
          from visitas)
),
resto as (
    select t.fecha, t.zona, t.vr - d.vr as vr, t.vn - d.vn as vn, t.pr - d.pr as pr, t.pn - d.pn as pn
    from (select fecha, zona, sum(vr) vr, sum(vn) vn, sum(pr) pr, sum(pn) pn from visitas group by all) t
    join (select fecha, zona, sum(vr) vr, sum(vn) vn, sum(pr) pr, sum(pn) pn
          from publicado group by all) d using (fecha, zona)
    where t.vr - d.vr + t.vn - d.vn + t.pr - d.pr + t.pn - d.pn > 0
),
ocupacion as (
    select fecha, destino, zona, true as desglosado, vr, vn, pr, pn from publicado
    union all
    select fecha, upper(zona[1]) || zona[2:] || ' (no desglosado)', zona, false, vr, vn, pr, pn
    from resto
)"""
_IDS = ", ".join(f"('{t[0]}', '{t[5]}', '{t[3]}')" for t in fx.TERRITORIES if t[5])
DEMAND_FACT_SQL = f"""
territorios(territorio_id, etiqueta, padre_id) as (values {_IDS}),
demanda as (
    select cast(year(fecha) * 100 + month(fecha) as integer) as fecha_id, territorio as territorio_id,
           tipo as tipo_alojamiento_id, residencia as residencia_id, viajeros, pernoctaciones,
           es_provisional, tiene_secreto, 'INE' as fuente
    from demanda_ine where viajeros is not null or pernoctaciones is not null
    union all
    select cast(year(fecha) * 100 + month(fecha) as integer), territorio_id, 'hotel', 'espana',
           cast(vr as bigint), cast(pr as bigint), false, false, 'murciaturistica'
    from ocupacion join territorios on etiqueta = destino
    union all
    select cast(year(fecha) * 100 + month(fecha) as integer), territorio_id, 'hotel', 'extranjero',
           cast(vn as bigint), cast(pn as bigint), false, false, 'murciaturistica'
    from ocupacion join territorios on etiqueta = destino
),
con_fecha as (
    select *, make_date(fecha_id // 100, fecha_id % 100, 1) as fecha,
           cast(fecha_id // 100 as smallint) as anio, cast(fecha_id % 100 as smallint) as mes
    from demanda
)"""
WITH_STAR = f"with {OFFICE_SQL}, {PORTAL_SQL}, {DEMAND_FACT_SQL}"
#: The office's region by kind and the portal's zones, each from its own source before any fact is made.
BASES_SQL = f"""
regional as (
    select tipo as grupo, residencia as residencia_id, fecha, year(fecha) * 100 + month(fecha) as fecha_id,
           cast(year(fecha) as smallint) as anio, cast(month(fecha) as smallint) as mes,
           viajeros, pernoctaciones, es_provisional
    from demanda_ine where territorio = '{fx.REGION}' and coalesce(viajeros, pernoctaciones) is not null
),
por_zona as (
    select zona as grupo, q.casa as residencia_id, fecha, year(fecha) * 100 + month(fecha) as fecha_id,
           cast(year(fecha) as smallint) as anio, cast(month(fecha) as smallint) as mes,
           cast(sum(q.v) as bigint) as viajeros, cast(sum(q.n) as bigint) as pernoctaciones
    from ocupacion, unnest([{{'casa': 'espana', 'v': vr, 'n': pr}}, {{'casa': 'extranjero', 'v': vn, 'n': pn}}]) as u(q)
    group by zona, q.casa, fecha
)"""
WITH_BASES = (
    f"with {OFFICE_SQL}, {PORTAL_SQL}, {BASES_SQL}, {complete_years_sql('regional', 'grupo', 'anios_ine')}, "
    f"{complete_years_sql('por_zona', 'grupo', 'anios_mt')}"
)
#: Rows of both bases in their complete years.
LIVE_SQL = """
vivos as (
    select 'tipo' as clase, grupo, mes, pernoctaciones, viajeros, residencia_id
    from regional semi join anios_ine using (anio)
    union all
    select 'zona', grupo, mes, pernoctaciones, viajeros, residencia_id
    from por_zona semi join anios_mt using (anio)
),
totales as (
    select clase, grupo, sum(pernoctaciones)::double as p, sum(viajeros)::double as v
    from vivos group by clase, grupo
)"""


@query(
    "star_residual",
    f"""with {OFFICE_SQL}, {PORTAL_SQL}
    select fecha, zona, cast(vr as bigint) as viajeros_residentes,
           cast(vn as bigint) as viajeros_no_residentes,
           cast(pr as bigint) as pernoctaciones_residentes,
           cast(pn as bigint) as pernoctaciones_no_residentes from resto""",
)
def star_residual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _portal(base_cells(spark, sf_dir))[1]


@query(
    "star_occupancy",
    f"""with {OFFICE_SQL}, {PORTAL_SQL}
    select fecha, destino, zona, desglosado, cast(vr as bigint) as viajeros_residentes,
           cast(vn as bigint) as viajeros_no_residentes,
           cast(pr as bigint) as pernoctaciones_residentes,
           cast(pn as bigint) as pernoctaciones_no_residentes from ocupacion""",
)
def star_occupancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _portal(base_cells(spark, sf_dir))[2]


@query("star_demand_fact", f"{WITH_STAR} select * from demanda")
def star_demand_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = base_cells(spark, sf_dir)
    obs, occupancy = _observations(spark, sf_dir, cells), _portal(cells)[2]
    return gold.demand(obs, occupancy, built_in(spark)["territorios"])


@query(
    "star_named_demand",
    f"""{WITH_STAR}
    select case tipo_alojamiento_id when 'hotel' then 'Hoteles' when 'camping' then 'Campings'
                when 'rural' then 'Alojamientos de turismo rural' else 'Apartamentos turísticos' end as tipo,
           case residencia_id when 'espana' then 'Residentes en España'
                else 'Residentes en el extranjero' end as residencia,
           cast(sum(pernoctaciones) as bigint) as pernoctaciones, count(*) as filas
    from demanda group by 1, 2""",
)
def star_named_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The demand fact with the names of two small dimensions, summed before the join."""
    t = star(spark, sf_dir, "fct_demanda_mensual", "dim_tipo_alojamiento", "dim_residencia")
    keys = ["tipo_alojamiento_id", "residencia_id"]
    sums = t["fct_demanda_mensual"].groupBy(*keys).agg(
        F.sum("pernoctaciones").alias("pernoctaciones"), F.count(F.lit(1)).alias("filas")
    )
    types = t["dim_tipo_alojamiento"].select(keys[0], F.col("nombre").alias("tipo"))
    homes = t["dim_residencia"].select(keys[1], F.col("nombre").alias("residencia"))
    return sums.join(types, keys[0]).join(homes, keys[1]).select(
        "tipo", "residencia", "pernoctaciones", "filas"
    )


_NONE = "cast(null as bigint)"
_NOPCT = "cast(null as double)"


@query(
    "star_supply_fact",
    f"""with {OFFICE_SQL}
    select cast(year(fecha) * 100 + month(fecha) as integer) as fecha_id, territorio as territorio_id,
           tipo as tipo_alojamiento_id, n as establecimientos, cast(q as bigint) as plazas,
           case when {_HOTEL} then cast(q * 2 as bigint) end as habitaciones,
           {_NONE} as apartamentos, case when tipo = 'camping' then cast(q + 1 as bigint) end as parcelas,
           {_NONE} as parcelas_ocupadas, u as personal_empleado,
           100 * cast(u as double) / n as ocupacion_plazas,
           {_NOPCT} as ocupacion_plazas_fin_semana, {_NOPCT} as ocupacion_habitaciones,
           {_NOPCT} as ocupacion_apartamentos, {_NOPCT} as ocupacion_apartamentos_fin_semana,
           {_NOPCT} as ocupacion_parcelas, {_NOPCT} as ocupacion_parcelas_fin_semana,
           fecha >= date '2001-06-01' as es_provisional, false as tiene_secreto, 'INE' as fuente
    from oferta where n % 10 <> 0""",
)
def star_supply_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.supply(_observations(spark, sf_dir))


@query(
    "star_price_fact",
    f"""with {OFFICE_SQL}
    select cast(year(fecha) * 100 + month(fecha) as integer) as fecha_id, territorio as territorio_id,
           tipo as tipo_alojamiento_id, q / n as indice_precios,
           cast(n % 21 - 10 as double) as variacion_interanual,
           fecha >= date '2001-06-01' as es_provisional, 'INE' as fuente
    from oferta where {_HOTEL}""",
)
def star_price_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.prices(_observations(spark, sf_dir))


@query(
    "star_complete_years",
    f"""{WITH_BASES}
    select 'ine' as base, anio from anios_ine union all select 'mt', anio from anios_mt""",
)
def star_complete_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = star(spark, sf_dir, "fct_demanda_mensual", "dim_fecha", "dim_territorio")
    base = shared(indicators.monthly_base(t))
    office = indicators.complete_years(indicators.region(base)).withColumn("base", F.lit("ine"))
    portal = indicators.complete_years(indicators.zones(base)).withColumn("base", F.lit("mt"))
    return office.unionByName(portal)


@query(
    "star_seasonal_profiles",
    f"""{WITH_BASES}, {LIVE_SQL}
    select clase, grupo, mes, 100 * sum(pernoctaciones)::double / any_value(p) as pct
    from vivos join totales using (clase, grupo) group by clase, grupo, mes""",
)
def star_seasonal_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = star(spark, sf_dir, "fct_demanda_mensual", "dim_fecha", "dim_territorio")
    cells, parts = shared(indicators.monthly_base(t)), []
    for kind, base in (("tipo", indicators.region(cells)), ("zona", indicators.zones(cells))):
        profile = indicators.seasonal_profile(base, indicators.complete_years(base))
        parts.append(profile.withColumn("clase", F.lit(kind)))
    return parts[0].unionByName(parts[1])


@query(
    "star_zone_profile",
    f"""{WITH_BASES}, {LIVE_SQL},
    mes as (pivot (select grupo, mes, pernoctaciones::double as n from vivos where clase = 'zona' and mes in (1, 8))
            on mes in (1, 8) using sum(n) group by grupo),
    fuera as (select grupo, sum(pernoctaciones)::double as x from vivos
              where clase = 'zona' and residencia_id <> 'espana' group by grupo)
    select grupo as zona, case when "1" <> 0 then "8" / "1" end as ratio_agosto_enero,
           case when v <> 0 then p / v end as estancia_media,
           case when p <> 0 then 100 * x / p end as pct_extranjero
    from (select * from totales where clase = 'zona') left join mes using (grupo) left join fuera using (grupo)""",
)
def star_zone_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = star(spark, sf_dir, "fct_demanda_mensual", "dim_fecha", "dim_territorio")
    base = shared(indicators.zones(indicators.monthly_base(t)))
    return indicators.zone_profile(base, indicators.complete_years(base))


@query(
    "star_monthly_series",
    f"""{WITH_BASES},
    con_dato as (
        select grupo, fecha, cast(sum(pernoctaciones) as bigint) as p,
               count(*) filter (where es_provisional) > 0 as prov
        from regional group by grupo, fecha
    ),
    limites as (
        select least((select min(fecha) from celdas), (select min(fecha) from ocupacion)) as lo,
               (select max(fecha) from con_dato) as hi
    ),
    sin_dato as (
        select grupo, unnest(range(lo, hi + interval 1 day, interval 1 month))::date as fecha
        from (select distinct grupo from con_dato), limites
        except
        select grupo, fecha from con_dato
    )
    select grupo as tipo, strftime(fecha, '%Y-%m') as fecha, p as pernoctaciones, prov as provisional from con_dato
    union all
    select grupo, strftime(fecha, '%Y-%m'), null, false from sin_dato""",
)
def star_monthly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = star(spark, sf_dir, "fct_demanda_mensual", "dim_fecha", "dim_territorio")
    base = indicators.monthly_base(t)
    return indicators.monthly_series(indicators.region(base), t["dim_fecha"])


@query(
    "star_employment",
    f"""with {OFFICE_SQL}
    select tipo, strftime(fecha, '%Y-%m') as fecha, cast(year(fecha) as smallint) as anio,
           cast(month(fecha) as smallint) as mes, u as personal
    from oferta where n % 10 <> 0 and territorio = 'region-murcia'""",
)
def star_employment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indicators.employment(star(spark, sf_dir, "fct_oferta_mensual", "dim_fecha"))


@query(
    "star_price_series",
    f"""with {OFFICE_SQL}
    select territorio, strftime(fecha, '%Y-%m') as fecha, q / n as indice,
           cast(n % 21 - 10 as double) as variacion from oferta where {_HOTEL}""",
)
def star_price_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return indicators.price_series(star(spark, sf_dir, "fct_precios_mensual", "dim_fecha"))


_SIDES_SQL = """
juntos as (
    select fecha_id, viajeros as va, pernoctaciones as pa, null::bigint as vb, null::bigint as pb
    from regional where grupo = 'hotel'
    union all
    select fecha_id, null, null, viajeros, pernoctaciones from por_zona
),
lados as (
    select fecha_id, sum(pa) as pa, abs(sum(pa) - sum(pb)) as dp, sum(va) as va, abs(sum(va) - sum(vb)) as dv
    from juntos group by fecha_id
    having count(*) filter (where pb is null and vb is null) < count(*) and count(pa) + count(va) > 0
)"""


@query(
    "star_reconciliation",
    f"""{WITH_BASES}, {_SIDES_SQL}
    select count(*) as meses, cast(max(dp) as bigint) as dif_max_pernoctaciones,
           sum(case when dp <= 10 or dp <= 0.0005::double * pa then 1 else 0 end)::bigint
               as meses_pernoctaciones_cuadran,
           sum(case when dv <= 10 or dv <= 0.0005::double * va then 1 else 0 end)::bigint
               as meses_viajeros_cuadran
    from lados""",
)
def star_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = star(spark, sf_dir, "fct_demanda_mensual", "dim_fecha", "dim_territorio")
    base = indicators.monthly_base(t)
    return indicators.reconciliation(indicators.region(base), indicators.zones(base))


@query(
    "star_coverage",
    f"""{WITH_STAR},
    mes as (select distinct fuente, es_provisional, strftime(fecha, '%Y-%m') as m from con_fecha)
    select (select m from mes order by m limit 1) as primer_mes,
           (select m from mes where fuente = 'INE' order by m desc limit 1) as ultimo_mes_ine,
           (select m from mes where fuente <> 'INE' order by m desc limit 1) as ultimo_mes_mt,
           (select m from mes where es_provisional order by m limit 1) as provisional_desde""",
)
def star_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = star(spark, sf_dir, "fct_demanda_mensual", "dim_fecha", "dim_territorio")
    return indicators.coverage(indicators.monthly_base(t))


@query(
    "star_fact_checks",
    f"""{WITH_STAR},
    r as (
        select 'accepted_values fct_demanda_mensual.fuente' as prueba, count(*) as fallos from demanda
        where fuente not in ('INE', 'murciaturistica')
        union all
        select 'no_negativo fct_demanda_mensual.viajeros', count(*) from demanda where viajeros < 0
        union all
        select 'no_negativo fct_demanda_mensual.pernoctaciones', count(*) from demanda
        where pernoctaciones < 0
    )
    select prueba, 'error' as gravedad, fallos, fallos = 0 as superada from r""",
)
def star_fact_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = star(spark, sf_dir, "fct_demanda_mensual")["fct_demanda_mensual"]
    return rules_report(fact, checks.row_rules("fct_demanda_mensual"))
