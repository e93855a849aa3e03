"""Indicators of the report, over the gold tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.functions.columns import label_by, month_text
from statloom.operators import indicators as ind
from statloom.operators import periods as per
from statloom.operators import reconcile as rec
from statloom.operators.reshape import latest_per_group
from statloom.operators.staging import shared
from statloom.plans import fixed_values as fx

Tables = Mapping[str, DataFrame]


def monthly_base(t: Tables) -> DataFrame:
    """The demand fact brought to source × group × month × residence in one pass.

    The group is the zone of a destination of the portal, or the accommodation type of the region for the
    statistics office; other rows of the office have none and count for the coverage only. All sections
    over the demand fact start from these few cells.
    """
    parents = t["dim_territorio"].select(
        "territorio_id", label_by("padre_id", fx.ZONES, fx.OTHER_ZONE).alias("_zona")
    )
    regional = (F.col("fuente") == fx.OFFICE) & (F.col("territorio_id") == fx.REGION)
    group = F.when(regional, F.col("tipo_alojamiento_id")).when(F.col("fuente") == fx.PORTAL, F.col("_zona"))
    rows = t["fct_demanda_mensual"].join(parents, "territorio_id", "left").withColumn("grupo", group)
    cells = rows.groupBy("fuente", "grupo", "fecha_id", "residencia_id", "es_provisional").agg(
        F.sum("viajeros").alias("viajeros"), F.sum("pernoctaciones").alias("pernoctaciones")
    )
    dates = t["dim_fecha"].select("fecha_id", "fecha", "anio", "mes")
    return cells.join(dates, "fecha_id")


def zones(base: DataFrame) -> DataFrame:
    """Hotel demand of the portal by zone, from the monthly base."""
    return base.filter((F.col("fuente") == fx.PORTAL) & F.col("grupo").isNotNull())


def region(base: DataFrame) -> DataFrame:
    """Regional demand of the statistics office by accommodation type, from the monthly base."""
    return base.filter((F.col("fuente") == fx.OFFICE) & F.col("grupo").isNotNull())


def complete_years(base: DataFrame) -> DataFrame:
    return per.complete_years(base, "grupo", "anio", "mes", "pernoctaciones")


def seasonal_profile(base: DataFrame, years: DataFrame) -> DataFrame:
    return ind.seasonal_profile(base, years, "grupo", "anio", "mes", "pernoctaciones")


def annual(base: DataFrame, years: DataFrame) -> DataFrame:
    return ind.base_index(base, years, "grupo", "anio", "pernoctaciones", fx.BASE_YEAR)


def zone_profile(base: DataFrame, years: DataFrame) -> DataFrame:
    abroad = F.col("residencia_id") == fx.FOREIGNERS
    profile = ind.ratio_profile(
        base,
        years,
        "grupo",
        "anio",
        "mes",
        "pernoctaciones",
        "viajeros",
        fx.HIGH_MONTH,
        fx.LOW_MONTH,
        abroad,
    )
    return profile.select(
        F.col("grupo").alias("zona"),
        F.col("ratio_meses").alias("ratio_agosto_enero"),
        "estancia_media",
        F.col("pct_subconjunto").alias("pct_extranjero"),
    )


def monthly_series(base: DataFrame, calendar: DataFrame) -> DataFrame:
    series = per.gap_series(base, calendar, "grupo", "fecha", "pernoctaciones", "es_provisional")
    return series.select(
        F.col("grupo").alias("tipo"),
        month_text("fecha").alias("fecha"),
        "pernoctaciones",
        F.col("es_provisional").alias("provisional"),
    )


def employment(t: Tables) -> DataFrame:
    fact = t["fct_oferta_mensual"].select(
        "fecha_id",
        "territorio_id",
        F.col("tipo_alojamiento_id").alias("tipo"),
        F.col("personal_empleado").alias("personal"),
    )
    here = F.col("territorio_id") == fx.REGION
    return ind.measure_series(
        fact, t["dim_fecha"], "tipo", ["personal"], here, ["anio", "mes"]
    ).withColumnRenamed("mes_texto", "fecha")


def price_series(t: Tables) -> DataFrame:
    fact = t["fct_precios_mensual"].select(
        "fecha_id",
        F.col("territorio_id").alias("territorio"),
        F.col("indice_precios").alias("indice"),
        F.col("variacion_interanual").alias("variacion"),
    )
    return ind.measure_series(
        fact, t["dim_fecha"], "territorio", ["indice", "variacion"]
    ).withColumnRenamed("mes_texto", "fecha")


def reconciliation(office: DataFrame, portal: DataFrame) -> DataFrame:
    """Hotel totals of the office against the sum of destinations, as one row."""
    row = rec.summary(
        office.filter(F.col("grupo") == fx.HOTEL),
        portal,
        ["fecha_id"],
        ["pernoctaciones", "viajeros"],
        fx.ABSOLUTE_TOLERANCE,
        fx.RELATIVE_TOLERANCE,
    )
    return row.select(
        F.col("periodos").alias("meses"),
        F.col("dif_max_pernoctaciones"),
        F.col("cuadran_pernoctaciones").alias("meses_pernoctaciones_cuadran"),
        F.col("cuadran_viajeros").alias("meses_viajeros_cuadran"),
    )


def coverage(base: DataFrame) -> DataFrame:
    row = ind.coverage(base, "fecha", "fuente", [fx.OFFICE, fx.PORTAL], "es_provisional")
    return row.withColumnsRenamed(
        {f"ultimo_mes_{fx.OFFICE}": "ultimo_mes_ine", f"ultimo_mes_{fx.PORTAL}": "ultimo_mes_mt"}
    )


def exception_runs(exceptions: DataFrame) -> DataFrame:
    """Documented exceptions as runs of consecutive months of a year."""
    months = exceptions.select(
        "medida",
        F.floor(F.col("fecha_id") / 100).cast("int").alias("anio"),
        (F.col("fecha_id") % 100).alias("mes"),
    )
    return per.consecutive_runs(months, ["medida", "anio"], "mes")


def all_indicators(t: Tables, keep: Callable[[DataFrame], DataFrame] = shared) -> dict[str, DataFrame]:
    """Every section of the report as a DataFrame.

    ``t`` holds the written gold tables (small, already aggregated) and the documented
    exceptions under ``excepciones_cuadre``. The demand fact is read once: ``keep`` stores its monthly
    base and the relations that several sections share, for as long as the sections are read.
    """
    base = keep(monthly_base(t))
    portal, office = zones(base), region(base)
    years_portal, years_office = keep(complete_years(portal)), keep(complete_years(office))
    types_year, zones_year = keep(annual(office, years_office)), annual(portal, years_portal)
    types_month = keep(seasonal_profile(office, years_office))
    zones_month = keep(seasonal_profile(portal, years_portal))
    series, staff = keep(monthly_series(office, t["dim_fecha"])), keep(employment(t))
    price = keep(price_series(t))
    return {
        "meta": coverage(base),
        "anios_completos_mt": years_portal.orderBy("anio"),
        "anios_completos_ine": years_office.orderBy("anio"),
        "perfil_zonas_mes": zones_month.orderBy("grupo", "mes"),
        "anual_zonas": zones_year.orderBy("grupo", "anio"),
        "perfil_zonas": zone_profile(portal, years_portal).orderBy("zona"),
        "perfil_tipos_mes": types_month.orderBy("grupo", "mes"),
        "anual_tipos": types_year.orderBy("grupo", "anio"),
        "serie_tipos": series.orderBy("tipo", "fecha"),
        "empleo": staff.orderBy("tipo", "fecha"),
        "precios": price.orderBy("territorio", "fecha"),
        "cuadre": reconciliation(office, portal),
        "excepciones": t["excepciones_cuadre"].orderBy("fecha_id", "medida"),
        # Figures that the page derives from the sections above.
        "totales_tipos": ind.last_year_totals(
            types_year, "grupo", "anio", "pernoctaciones", fx.BASE_YEAR
        ),
        "verano_zonas": ind.months_share(zones_month, "grupo", "mes", "pct", fx.SUMMER),
        "picos_zonas": ind.seasonality_order(zones_month, "grupo", "mes", "pct"),
        "picos_tipos": ind.seasonality_order(types_month, "grupo", "mes", "pct"),
        "extremos_tipos": ind.seasonality_extremes(types_month, "grupo", "mes", "pct"),
        "empleo_total": ind.two_month_swing(
            staff, None, "anio", "mes", "personal", fx.HIGH_MONTH, fx.LOW_MONTH
        ),
        "empleo_tipos": ind.two_month_swing(
            staff, "tipo", "anio", "mes", "personal", fx.HIGH_MONTH, fx.LOW_MONTH
        ),
        "bajo_base_tipos": ind.below_base(types_year, "anio"),
        "ultimos_precios": latest_per_group(price, ["territorio"], ["fecha"]),
        "precios_frente_a_region": ind.against_group(
            price, "territorio", "fecha", "indice", fx.REGION
        ),
        "tramos_excepciones": exception_runs(t["excepciones_cuadre"]),
        "indice_por_anio": per.year_spine(types_year, "grupo", "anio", "indice"),
        "banda_provisional": per.provisional_band(
            series.withColumn("fecha", F.to_date("fecha", "yyyy-MM")), "fecha", "provisional"
        ),
    }
