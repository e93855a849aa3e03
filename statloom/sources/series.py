"""Series documents: one JSON object per file, one folder per ingestion date."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.functions.columns import join_texts
from statloom.sources import files
from statloom.sources.schemas import METADATA_DOCUMENT, SERIES_DOCUMENT

SNAPSHOT = re.compile(r"\d{4}-\d{2}-\d{2}")


def latest_snapshot(spark: SparkSession, folder: str) -> str:
    """Name of the newest ``YYYY-MM-DD`` folder.

    Only directory names are listed: older snapshots are never opened.
    """
    dates = [n for n in files.list_names(spark, folder, True) if SNAPSHOT.fullmatch(n)]
    if not dates:
        raise FileNotFoundError(f"no snapshot in {folder}")
    return dates[-1]


def read_series(spark: SparkSession, folder: str) -> DataFrame:
    """Series documents of a folder with their file name; a broken document fails the load."""
    return (
        spark.read.schema(SERIES_DOCUMENT)
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .option("pathGlobFilter", "*.json")
        .json(folder)
        .select("*", F.col("_metadata.file_name").alias("fichero"))
    )


def observations(documents: DataFrame, origin: Column, ingested: Column) -> DataFrame:
    """One typed row per series and period. A series without observations yields no row."""
    rows = documents.select("*", F.inline("Data"))
    return rows.select(
        F.col("COD").alias("codigo"),
        F.col("Nombre").alias("nombre_serie"),
        F.col("Anyo").cast("smallint").alias("anio"),
        F.col("FK_Periodo").cast("smallint").alias("periodo"),
        F.col("FK_TipoDato").cast("smallint").alias("fk_tipo_dato"),
        F.col("Valor").alias("valor"),
        F.coalesce("Secreto", F.lit(False)).alias("secreto"),
        join_texts("Notas", "texto").alias("notas"),
        F.concat(origin, F.lit("/"), F.col("fichero")).alias("_fichero_origen"),
        ingested.cast("date").alias("_ingestado_en"),
    )


def read_metadata(spark: SparkSession, folder: str, pattern: str = r"metadatos_(\d+)\.json") -> DataFrame:
    """Metadata documents: one array of series per file.

    The table number comes from the file name and the position of each series inside its
    file is kept, because the order of the source decides between repeated series.
    """
    whole = spark.read.text(folder, wholetext=True, pathGlobFilter="*.json").select(
        "value", F.col("_metadata.file_name").alias("fichero")
    )
    series = F.from_json("value", METADATA_DOCUMENT, {"mode": "FAILFAST"})
    return (
        whole.filter(F.col("fichero").rlike(f"^{pattern}$"))
        .select(
            F.regexp_extract("fichero", pattern, 1).cast("int").alias("tabla_id"),
            F.posexplode(series).alias("posicion", "s"),
        )
        .select("tabla_id", "posicion", "s.*")
    )
