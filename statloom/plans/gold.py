"""Gold: the star schema, with enforced contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.functions.columns import any_published, is_broken_down, month_key, to_count
from statloom.operators.periods import month_dimension
from statloom.operators.quality import enforce
from statloom.operators.reshape import pivot_measures, unpivot_breakdown
from statloom.plans import fixed_values as fx
from statloom.sources.schemas import COUNTS, GOLD, PERCENTAGES


def _contract(df: DataFrame, name: str) -> DataFrame:
    return enforce(df, GOLD[name])


def calendar(observations: DataFrame, occupancy: DataFrame) -> DataFrame:
    dates = [(observations, "fecha"), (occupancy, "fecha")]
    return _contract(month_dimension(dates, fx.MONTH_NAMES), "dim_fecha")


def territories(reference: DataFrame) -> DataFrame:
    detailed = is_broken_down("nivel", "nombre", fx.LEAF_LEVEL, fx.NOT_BROKEN_DOWN)
    return _contract(reference.withColumn("es_desglosado", detailed).drop("nombre_en_fuente"), "dim_territorio")


def accommodation_types(reference: DataFrame) -> DataFrame:
    return _contract(reference, "dim_tipo_alojamiento")


def residences(reference: DataFrame) -> DataFrame:
    return _contract(reference, "dim_residencia")


def _wide(observations: DataFrame, fact: str, names, by=(), published=None) -> DataFrame:
    """Measures of one fact as columns; only its own rows are read and shuffled."""
    keys = ["fecha", "territorio", "tipo_alojamiento", *by]
    flags = {"es_provisional": "es_provisional", "tiene_secreto": "es_secreto"}
    rows = observations.filter(F.col("hecho") == fact)
    wide = pivot_measures(rows, keys, "medida", "valor", names, flags, published)
    renamed = {"territorio": "territorio_id", "tipo_alojamiento": "tipo_alojamiento_id"}
    dated = wide.withColumns({"fecha_id": month_key("fecha"), "fuente": F.lit(fx.OFFICE)})
    return dated.withColumnsRenamed(renamed).drop("fecha")


def demand(observations: DataFrame, occupancy: DataFrame, territory: DataFrame) -> DataFrame:
    """People and nights per month, territory, accommodation type and residence."""
    office = _wide(observations, "demanda", ("viajeros", "pernoctaciones"), ["residencia"])
    office = office.withColumnRenamed("residencia", "residencia_id")
    names = territory.filter(F.col("fuente") == fx.PORTAL).select(
        "territorio_id", F.col("nombre_en_fuente").alias("destino")
    )
    breakdown = {
        member: {"viajeros": f"viajeros_{part}", "pernoctaciones": f"pernoctaciones_{part}"}
        for member, part in ((fx.RESIDENTS, "residentes"), (fx.FOREIGNERS, "no_residentes"))
    }
    portal = unpivot_breakdown(
        occupancy.join(names, "destino"), ["fecha", "territorio_id"], breakdown, "residencia_id"
    ).withColumns(
        {
            "fecha_id": month_key("fecha"),
            "tipo_alojamiento_id": F.lit(fx.HOTEL),
            "es_provisional": F.lit(False),
            "tiene_secreto": F.lit(False),
            "fuente": F.lit(fx.PORTAL),
        }
    )
    measures = ("viajeros", "pernoctaciones")
    office = office.withColumns({m: to_count(m) for m in measures})
    portal = portal.withColumns({m: F.col(m).cast("bigint") for m in measures}).drop("fecha")
    both = office.unionByName(portal).filter(any_published(*measures))
    return _contract(both, "fct_demanda_mensual")


def supply(observations: DataFrame) -> DataFrame:
    """Establishments, places, staff and occupancy rates per month, territory and type."""
    wide = _wide(observations, "oferta", (*COUNTS, *PERCENTAGES), published="_publicadas")
    rows = wide.filter("_publicadas > 0").withColumns({m: to_count(m) for m in COUNTS})
    rows = rows.drop("_publicadas")
    return _contract(rows, "fct_oferta_mensual")


def prices(observations: DataFrame) -> DataFrame:
    """Price index and its change on the same month of the previous year."""
    names = ("indice_precios", "variacion_interanual_precios")
    wide = _wide(observations, "precios", names).withColumnRenamed(names[1], "variacion_interanual")
    rows = wide.filter(any_published("indice_precios", "variacion_interanual")).drop("tiene_secreto")
    return _contract(rows, "fct_precios_mensual")
