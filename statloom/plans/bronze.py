"""Bronze: the sources as published, typed and with their origin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.functions.columns import to_count
from statloom.plans import fixed_values as fx
from statloom.sources.html import html_tables, read_pages, typed
from statloom.sources.schemas import BRONZE_DESTINATIONS, DESTINATION_MEASURES
from statloom.sources.series import latest_snapshot, observations, read_series
from statloom.sources.store import load_table


def series(spark: SparkSession, raw: str) -> tuple[DataFrame, str]:
    """Observations of the newest snapshot and the name of their origin."""
    date = latest_snapshot(spark, f"{raw}/ine")
    origin = f"ine/{date}"
    return observations(read_series(spark, f"{raw}/ine/{date}"), F.lit(origin), F.lit(date)), origin


def destinations(
    spark: SparkSession, raw: str, decimal: str = ".", thousands: str = ","
) -> DataFrame:
    """Rows of all monthly pages in one scan; the blank separator rows are left out."""
    pages = read_pages(spark, f"{raw}/murciaturistica", fx.PAGE_GLOB, fx.PAGE_NAME)
    if not pages.select("path").take(1):
        raise FileNotFoundError(f"no monthly pages in {raw}/murciaturistica")
    pages = pages.withColumn("_ingestado_en", F.to_date("modificationTime"))
    keys = ["fichero", "partes", "_ingestado_en"]
    cells = html_tables(pages, ["destino", *DESTINATION_MEASURES], fx.HEADER_ROWS, keys)
    return (
        typed(cells, DESTINATION_MEASURES, decimal, thousands)
        .filter(F.col("destino").isNotNull())
        .select(
            F.col("partes")[0].cast("smallint").alias("anio"),
            F.col("partes")[1].cast("smallint").alias("mes"),
            "destino",
            *[to_count(m).alias(m) for m in DESTINATION_MEASURES],
            F.concat(F.lit("murciaturistica/"), "fichero").alias("_fichero_origen"),
            "_ingestado_en",
        )
        .select(BRONZE_DESTINATIONS.names)
    )


def load_series(spark: SparkSession, raw: str, lake: str, load_id: str | None = None) -> int:
    df, origin = series(spark, raw)
    return load_table(df, lake, "bronze", "ine_series", origin, ["codigo", "anio", "periodo"], load_id)


def load_destinations(
    spark: SparkSession,
    raw: str,
    lake: str,
    decimal: str = ".",
    thousands: str = ",",
    load_id: str | None = None,
) -> int:
    df = destinations(spark, raw, decimal, thousands)
    order = ["anio", "mes", "_fichero_origen"]
    return load_table(df, lake, "bronze", "murciaturistica_destinos", "murciaturistica", order, load_id)
