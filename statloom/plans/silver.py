"""Silver: one clean relation per source, with secrecy and unpublished months told apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.functions.columns import (
    blank_to_null,
    is_code,
    mask_secret,
    month_start,
    split_marker,
)
from statloom.operators.periods import keep_published
from statloom.operators.residual import detail_and_residual, residual
from statloom.plans import fixed_values as fx

OCCUPANCY = (
    "viajeros_residentes",
    "viajeros_no_residentes",
    "pernoctaciones_residentes",
    "pernoctaciones_no_residentes",
)


def series_observations(bronze: DataFrame) -> DataFrame:
    """Monthly observations; a confidential value is NULL."""
    return bronze.select(
        "codigo",
        month_start("anio", "periodo").alias("fecha"),
        "anio",
        F.col("periodo").alias("mes"),
        mask_secret("valor", "secreto").alias("valor"),
        F.col("secreto").alias("es_secreto"),
        is_code("fk_tipo_dato", fx.PROVISIONAL).alias("es_provisional"),
        "notas",
        "_ingestado_en",
    )


def catalogued(observations: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Observations of catalogued series with their dimensions."""
    dims = catalogue.select(
        "codigo",
        "hecho",
        "tipo_alojamiento",
        "territorio",
        "nivel_territorio",
        "medida",
        blank_to_null("residencia").alias("residencia"),
    )
    return observations.join(dims, "codigo").select(
        "fecha",
        "anio",
        "mes",
        *dims.columns[1:],
        "valor",
        "es_secreto",
        "es_provisional",
        "notas",
        "codigo",
    )


def destination_rows(bronze: DataFrame) -> DataFrame:
    """Published rows with the footnote mark split from the label."""
    label, marked = split_marker("destino")
    return bronze.select(
        month_start("anio", "mes").alias("fecha"),
        "anio",
        "mes",
        label.alias("destino"),
        marked.alias("tiene_llamada"),
        *OCCUPANCY,
        "_ingestado_en",
    )


def classified_rows(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of published months with their zone and row type."""
    return (
        keep_published(rows, "fecha", OCCUPANCY)
        .join(labels, "destino")
        .select("fecha", "destino", "zona", "tipo_fila", "tiene_llamada", *OCCUPANCY)
    )


def residual_by_zone(rows: DataFrame) -> DataFrame:
    """What the zone total contains beyond its destinations."""
    return residual(rows, ["fecha", "zona"], "tipo_fila", "total_zona", "destino", OCCUPANCY)


def destination_occupancy(rows: DataFrame, rest: DataFrame) -> DataFrame:
    """Destinations plus one «not broken down» member per zone."""
    return detail_and_residual(
        rows.filter(F.col("tipo_fila") == "destino"),
        rest,
        ["fecha", "zona"],
        "destino",
        "zona",
        OCCUPANCY,
        fx.RESIDUAL_SUFFIX,
        "desglosado",
    )
