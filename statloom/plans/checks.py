"""Declared checks of every layer and the gates that use them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.operators import quality as q
from statloom.operators import reconcile as rec
from statloom.operators.residual import unbalanced_totals
from statloom.operators.staging import shared
from statloom.plans import fixed_values as fx
from statloom.plans.silver import OCCUPANCY
from statloom.sources.schemas import COUNTS, PERCENTAGES

Tables = Mapping[str, DataFrame]

PEOPLE = ("viajeros", "pernoctaciones")
TYPES = tuple(t[0] for t in fx.ACCOMMODATION_TYPES)
ZONE_NAMES = ("ciudad", "costa", "interior")

#: Fixed values down to RELATIONSHIPS: the declared checks.
#: Columns that must have a value.
NOT_NULL = {
    "ine_series": ("codigo", "anio", "periodo"),
    "murciaturistica_destinos": ("destino",),
    "stg_ine__series": ("codigo", "fecha"),
    "stg_mt__destinos": ("destino",),
    "int_mt__meses_publicados": ("fecha",),
    "int_mt__ocupacion_destino": OCCUPANCY,
    "series_ine": ("codigo", "territorio", "medida"),
    "destinos_murciaturistica": ("destino",),
    "territorios": ("territorio_id",),
    "tipos_alojamiento": ("tipo_alojamiento_id",),
    "residencias": ("residencia_id",),
    "excepciones_cuadre": ("motivo",),
}
#: Accepted values.
ACCEPTED = {
    "ine_series": {"periodo": tuple(range(1, 13)), "fk_tipo_dato": (1, 2)},
    "int_mt__ocupacion_destino": {"zona": ZONE_NAMES},
    "series_ine": {"hecho": fx.FACTS, "tipo_alojamiento": TYPES},
    "destinos_murciaturistica": {"tipo_fila": fx.ROW_TYPES},
    "excepciones_cuadre": {"medida": PEOPLE},
    "dim_territorio": {"nivel": fx.LEVELS},
    "fct_demanda_mensual": {"fuente": (fx.OFFICE, fx.PORTAL)},
}
#: Columns that are never negative.
NOT_NEGATIVE = {
    "int_mt__residual_por_zona": ("pernoctaciones_residentes", "pernoctaciones_no_residentes"),
    "int_mt__ocupacion_destino": OCCUPANCY,
    "int_ine__observaciones": ("valor",),
    "fct_demanda_mensual": PEOPLE,
    "fct_oferta_mensual": COUNTS,
    "fct_precios_mensual": ("indice_precios",),
}
#: Rows to which a rule of the table above applies.
ONLY = {("int_ine__observaciones", "valor"): "medida <> 'variacion_interanual_precios'"}
#: Grain of every table.
GRAIN = {
    "stg_ine__series": [("codigo", "fecha")],
    "stg_mt__destinos": [("fecha", "destino")],
    "int_mt__meses_publicados": [("fecha",)],
    "int_mt__filas_clasificadas": [("fecha", "destino")],
    "int_mt__residual_por_zona": [("fecha", "zona")],
    "int_mt__ocupacion_destino": [("fecha", "destino")],
    "int_ine__observaciones": [
        ("fecha", "hecho", "tipo_alojamiento", "territorio", "medida", "residencia")
    ],
    "series_ine": [("codigo",)],
    "destinos_murciaturistica": [("destino",)],
    "territorios": [("territorio_id",)],
    "tipos_alojamiento": [("tipo_alojamiento_id",)],
    "residencias": [("residencia_id",)],
    "excepciones_cuadre": [("fecha_id", "medida")],
    "dim_fecha": [("fecha_id",)],
    "dim_territorio": [("territorio_id",)],
    "dim_tipo_alojamiento": [("tipo_alojamiento_id",)],
    "dim_residencia": [("residencia_id",)],
    "fct_demanda_mensual": [("fecha_id", "territorio_id", "tipo_alojamiento_id", "residencia_id")],
    "fct_oferta_mensual": [("fecha_id", "territorio_id", "tipo_alojamiento_id")],
    "fct_precios_mensual": [("fecha_id", "territorio_id", "tipo_alojamiento_id")],
}
#: Foreign keys of the facts and the self reference of the hierarchy.
_STAR = {
    "fecha_id": ("dim_fecha", "fecha_id"),
    "territorio_id": ("dim_territorio", "territorio_id"),
    "tipo_alojamiento_id": ("dim_tipo_alojamiento", "tipo_alojamiento_id"),
}
RELATIONSHIPS = {
    "stg_mt__destinos": {"destino": ("destinos_murciaturistica", "destino")},
    "territorios": {"padre_id": ("territorios", "territorio_id")},
    "dim_territorio": {"padre_id": ("dim_territorio", "territorio_id")},
    "fct_demanda_mensual": {**_STAR, "residencia_id": ("dim_residencia", "residencia_id")},
    "fct_oferta_mensual": _STAR,
    "fct_precios_mensual": _STAR,
}


def row_rules(table: str) -> dict[str, Column]:
    """Declared rules on single rows of a table."""
    rules = {f"not_null {table}.{c}": q.is_missing(c) for c in NOT_NULL.get(table, ())}
    for c, values in ACCEPTED.get(table, {}).items():
        rules[f"accepted_values {table}.{c}"] = q.is_outside(c, values)
    for c in NOT_NEGATIVE.get(table, ()):
        where = ONLY.get((table, c))
        rules[f"no_negativo {table}.{c}"] = q.is_negative(c, F.expr(where) if where else None)
    if table == "fct_oferta_mensual":
        for c in PERCENTAGES:
            rules[f"porcentaje {table}.{c}"] = q.is_out_of_range(c, 0, 100)
    return rules


def key_checks(t: Tables, keep: Callable[[DataFrame], DataFrame] = shared) -> list[q.Check]:
    """Grain and foreign keys of the tables at hand. ``keep`` stores a relation that several checks read:
    in the workspace of the session, or in that of a run (``Workspace.keep``)."""
    checks = []
    for table in t:
        for cols in GRAIN.get(table, []):
            one = len(cols) == 1
            rows = q.check_unique_values(t[table], cols[0]) if one else q.check_unique(t[table], cols)
            kind = "unique" if one else "unique_combination"
            checks.append(q.Check(f"{kind} {table}({', '.join(cols)})", rows))
        keys = {c: to for c, to in RELATIONSHIPS.get(table, {}).items() if to[0] in t}
        # The key tuples in use are counted once; every parent is checked against these few rows.
        used = keep(t[table].groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))) if keys else None
        for col, (parent, field) in keys.items():
            rows = q.check_relationship(used, col, t[parent], field, "_n")
            checks.append(q.Check(f"relationships {table}.{col} -> {parent}", rows))
    return checks


def source_totals(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Regional hotel demand of the office and all demand of the portal."""
    demand = t["fct_demanda_mensual"]
    office = demand.filter(
        (F.col("fuente") == fx.OFFICE)
        & (F.col("territorio_id") == fx.REGION)
        & (F.col("tipo_alojamiento_id") == fx.HOTEL)
    )
    return office, demand.filter(F.col("fuente") == fx.PORTAL)


def unmapped_labels(t: Tables) -> DataFrame:
    """Destinations without a territory: the fact would lose them silently."""
    named = t["territorios"].filter(F.col("fuente") == fx.PORTAL)
    return q.missing_keys(t["int_mt__ocupacion_destino"], "destino", named, "nombre_en_fuente")


def silver_checks(t: Tables, complete_data: bool = True) -> list[q.Check]:
    """Checks between silver tables.

    ``complete_data`` is off for partial loads, where not every catalogued series has data.
    """
    balance = unbalanced_totals(
        t["int_mt__ocupacion_destino"],
        t["int_mt__filas_clasificadas"].filter(F.col("tipo_fila") == "total_zona"),
        ["fecha", "zona"],
        OCCUPANCY,
        fx.BALANCE_TOLERANCE,
    )
    checks = [
        q.Check("zonas_cuadran_con_totales", balance),
        q.Check("destinos_con_territorio", unmapped_labels(t)),
    ]
    if complete_data:
        missing = q.missing_keys(t["series_ine"], "codigo", t["stg_ine__series"])
        checks.append(q.Check("series_del_catalogo_con_datos", missing))
    return checks


def gold_checks(t: Tables, exceptions: DataFrame) -> list[q.Check]:
    """Agreement of the two sources in the demand fact."""
    office, portal = source_totals(t)
    agreement = rec.mismatches(
        office,
        portal,
        ["fecha_id"],
        PEOPLE,
        fx.ABSOLUTE_TOLERANCE,
        fx.RELATIVE_TOLERANCE,
        exceptions,
    )
    drift = rec.share_drift(
        office, portal, ["fecha_id", "residencia_id"], "pernoctaciones", fx.RESIDENCE_TOLERANCE
    )
    return [
        q.Check("fuentes_cuadran", agreement),
        q.Check("reparto_residencia_similar", drift, q.WARN),
    ]


def bronze_report(
    series: DataFrame, catalogue: DataFrame, today: str | None = None
) -> DataFrame:
    """Checks after the load: all catalogued series are there (blocking), data are recent.

    ``today`` is an ISO date; the default is the current date.
    """
    day = F.current_date() if today is None else F.lit(today).cast("date")
    missing = q.Check("catalogo_completo", q.missing_keys(catalogue, "codigo", series))
    dates = series.select(F.make_date("anio", "periodo", F.lit(1)).alias("fecha"))
    old = q.freshness(dates, "fecha", day, fx.MAX_MONTHS_OLD).filter(~F.col("vigente"))
    return q.quality_report([missing, q.Check("datos_recientes", old, q.WARN)])


def missing_sample(series: DataFrame, catalogue: DataFrame) -> DataFrame:
    """A few catalogued series without data, in order."""
    return q.sample_of(q.missing_keys(catalogue, "codigo", series), "codigo")


def layer_report(
    t: Tables,
    between: Sequence[q.Check] = (),
    keep: Callable[[DataFrame], DataFrame] = shared,
    observed: Mapping[str, Mapping[str, int]] | None = None,
) -> DataFrame:
    """Declared checks of the tables of a layer and those between them.

    ``observed`` has the failures of the row rules of tables that counted them while they were written;
    these are not read again for them. The row rules of other tables cost one scan per table.
    """
    observed = observed or {}
    parts = [q.rules_report(df, rules) for n, df in t.items() if n not in observed and (rules := row_rules(n))]
    counted = {rule: n for name, found in observed.items() if name in t for rule, n in found.items()}
    if counted:
        parts.append(q.observed_report(next(iter(t.values())).sparkSession, counted))
    parts.append(q.quality_report([*key_checks(t, keep), *between]))
    return reduce(DataFrame.unionByName, parts)
