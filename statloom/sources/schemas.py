"""Declared schemas: nothing is inferred from the data."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D = T.StringType(), T.LongType(), T.DoubleType()
I, H, B, DT = T.IntegerType(), T.ShortType(), T.BooleanType(), T.DateType()


def table(*fields: tuple, required: tuple[str, ...] = ()) -> T.StructType:
    """Struct from ``(type, name, name, ...)`` groups, keeping their order."""
    return T.StructType(
        [T.StructField(n, kind, n not in required) for kind, *names in fields for n in names]
    )


# --- raw documents --------------------------------------------------------------------

#: Names and types of the published documents, tables and contracts.
SERIES_DOCUMENT = table(
    (S, "COD", "Nombre"),
    (
        T.ArrayType(
            table(
                (L, "FK_TipoDato", "FK_Periodo", "Anyo"),
                (D, "Valor"),
                (B, "Secreto"),
                (T.ArrayType(table((S, "texto"))), "Notas"),
            )
        ),
        "Data",
    ),
)

METADATA_DOCUMENT = T.ArrayType(
    table(
        (S, "COD", "Nombre", "T3_Unidad"),
        (T.ArrayType(table((S, "T3_Variable", "Nombre"))), "MetaData"),
    )
)

DESTINATION_MEASURES = (
    "viajeros_total",
    "viajeros_residentes",
    "viajeros_no_residentes",
    "pernoctaciones_total",
    "pernoctaciones_residentes",
    "pernoctaciones_no_residentes",
)

# --- bronze ---------------------------------------------------------------------------

BRONZE_SERIES = table(
    (S, "codigo", "nombre_serie"),
    (H, "anio", "periodo", "fk_tipo_dato"),
    (D, "valor"),
    (B, "secreto"),
    (S, "notas", "_fichero_origen"),
    (DT, "_ingestado_en"),
)

BRONZE_DESTINATIONS = table(
    (H, "anio", "mes"),
    (S, "destino"),
    (L, *DESTINATION_MEASURES),
    (S, "_fichero_origen"),
    (DT, "_ingestado_en"),
)

LEDGER = table((S, "tabla"), (L, "filas"), (S, "origen"), (T.TimestampType(), "cargado_en"))

# --- reference tables -----------------------------------------------------------------

SERIES_CATALOGUE = table(
    (S, "codigo", "operacion"),
    (I, "tabla_id"),
    (S, "hecho", "tipo_alojamiento", "territorio", "nivel_territorio", "medida", "residencia"),
    (S, "unidad", "nombre_ine"),
)
TERRITORIES = table((S, "territorio_id", "nombre", "nivel", "padre_id", "fuente", "nombre_en_fuente"))
PUBLISHED_LABELS = table((S, "destino", "zona", "tipo_fila"))
ACCOMMODATION_TYPES = table((S, "tipo_alojamiento_id", "nombre", "encuesta_ine"))
RESIDENCES = table((S, "residencia_id", "nombre"))
EXCEPTIONS = table((I, "fecha_id"), (S, "medida", "motivo"))

# --- gold contracts -------------------------------------------------------------------

#: Measures of the supply fact.
COUNTS = (
    "establecimientos",
    "plazas",
    "habitaciones",
    "apartamentos",
    "parcelas",
    "parcelas_ocupadas",
    "personal_empleado",
)
PERCENTAGES = (
    "ocupacion_plazas",
    "ocupacion_plazas_fin_semana",
    "ocupacion_habitaciones",
    "ocupacion_apartamentos",
    "ocupacion_apartamentos_fin_semana",
    "ocupacion_parcelas",
    "ocupacion_parcelas_fin_semana",
)

#: The contracts of the star schema.
GOLD = {
    "dim_fecha": table(
        (I, "fecha_id"),
        (DT, "fecha"),
        (H, "anio", "mes", "trimestre"),
        (S, "nombre_mes"),
        required=("fecha_id", "fecha"),
    ),
    "dim_territorio": table(
        (S, "territorio_id", "nombre", "nivel", "padre_id", "fuente"),
        (B, "es_desglosado"),
        required=("territorio_id",),
    ),
    "dim_tipo_alojamiento": table(
        (S, "tipo_alojamiento_id", "nombre", "encuesta_ine"), required=("tipo_alojamiento_id",)
    ),
    "dim_residencia": table((S, "residencia_id", "nombre"), required=("residencia_id",)),
    "fct_demanda_mensual": table(
        (I, "fecha_id"),
        (S, "territorio_id", "tipo_alojamiento_id", "residencia_id"),
        (L, "viajeros", "pernoctaciones"),
        (B, "es_provisional", "tiene_secreto"),
        (S, "fuente"),
        required=("fecha_id", "territorio_id", "tipo_alojamiento_id", "residencia_id"),
    ),
    "fct_oferta_mensual": table(
        (I, "fecha_id"),
        (S, "territorio_id", "tipo_alojamiento_id"),
        (L, *COUNTS),
        (D, *PERCENTAGES),
        (B, "es_provisional", "tiene_secreto"),
        (S, "fuente"),
        required=("fecha_id", "territorio_id", "tipo_alojamiento_id"),
    ),
    "fct_precios_mensual": table(
        (I, "fecha_id"),
        (S, "territorio_id", "tipo_alojamiento_id"),
        (D, "indice_precios", "variacion_interanual"),
        (B, "es_provisional"),
        (S, "fuente"),
        required=("fecha_id", "territorio_id", "tipo_alojamiento_id"),
    ),
}
