"""Reference tables of the statistics, as DataFrames of a fixed and tiny size."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from statloom.plans import fixed_values as fx
from statloom.sources import schemas
from statloom.sources.reference import fixed_table, read_reference

#: Schema of every reference table, by the name of its CSV file.
REFERENCE = {
    "series_ine": schemas.SERIES_CATALOGUE,
    "territorios": schemas.TERRITORIES,
    "destinos_murciaturistica": schemas.PUBLISHED_LABELS,
    "tipos_alojamiento": schemas.ACCOMMODATION_TYPES,
    "residencias": schemas.RESIDENCES,
    "excepciones_cuadre": schemas.EXCEPTIONS,
}


def built_in(spark: SparkSession) -> dict[str, DataFrame]:
    """Reference tables that do not change from run to run.

    The series catalogue comes from :mod:`statloom.plans.catalogue` or from a CSV file, and
    documented exceptions from a CSV file.
    """
    rows = {
        "territorios": fx.TERRITORIES,
        "destinos_murciaturistica": fx.PUBLISHED_LABELS,
        "tipos_alojamiento": fx.ACCOMMODATION_TYPES,
        "residencias": fx.RESIDENCES,
        "excepciones_cuadre": (),
    }
    return {n: fixed_table(spark, r, REFERENCE[n]) for n, r in rows.items()}


def from_csv(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Built-in reference tables, replaced by the CSV files that are given."""
    found = {n: read_reference(spark, p, REFERENCE[n]) for n, p in paths.items()}
    return {**built_in(spark), **found}
