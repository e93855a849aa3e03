"""Series catalogue: which published series matter and what each one measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.columns import entry_of
from statloom.operators.classify import Discard, Translate, classify, reject_unknown
from statloom.operators.reshape import first_occurrence
from statloom.plans import fixed_values as fx
from statloom.sources.reference import fixed_table
from statloom.sources.schemas import SERIES_CATALOGUE, I, S, table

class MissingTable(ValueError):
    """A declared source table has no metadata."""


KEY = ("hecho", "tipo_alojamiento", "territorio", "medida", "residencia")


VARIABLES = (fx.CATEGORY, fx.RESIDENCE, fx.DATA_TYPE, fx.CONCEPT)
PLACES = tuple(dict.fromkeys(t[0] for t in fx.METADATA_TERRITORIES))


def _read_entries(metadata: DataFrame) -> DataFrame:
    """Metadata variables as columns, each read once from the key/value list."""
    names = {f"_m_{v}": v for v in VARIABLES + PLACES}
    return metadata.withColumns(
        {out: entry_of("MetaData", v, "T3_Variable", "Nombre") for out, v in names.items()}
    )


def _entry(variable: str) -> Column:
    return F.col(f"`_m_{variable}`")


def _territories() -> Column:
    """Territories named by the metadata of a series, repeated names once."""
    named = [
        F.when(_entry(variable) == value, F.struct(F.lit(t).alias("id"), F.lit(n).alias("nivel")))
        for variable, value, t, n in fx.METADATA_TERRITORIES
    ]
    return F.array_distinct(F.array_compact(F.array(*named)))


def source_tables(df: DataFrame) -> DataFrame:
    rows = [(n, i, *rest) for i, (n, *rest) in enumerate(fx.SOURCE_TABLES)]
    schema = table((I, "tabla_id", "orden"), (S, "operacion", "tipo_alojamiento", "hecho"))
    return fixed_table(df.sparkSession, rows, schema)


def classify_series(metadata: DataFrame) -> DataFrame:
    """Every series with its classification, or the reason why it has none.

    A series whose metadata name several territories takes the first in the declared order.
    """
    known = _read_entries(metadata).join(source_tables(metadata), "tabla_id")
    known = known.withColumn("_t", _territories())
    prices = F.col("hecho") == "precios"
    first = F.try_element_at("_t", F.lit(1))
    data_type = _entry(fx.DATA_TYPE)
    steps = [
        Discard(F.size("_t") == 0),
        Discard((first["id"] == fx.PRICES_ONLY) & ~prices),
        Discard(_entry(fx.CATEGORY) != fx.ALL_CATEGORIES),
        Discard(_entry(fx.RESIDENCE) == fx.ALL_RESIDENCES),
        Translate("residencia", _entry(fx.RESIDENCE), fx.METADATA_RESIDENCES, "residence", absent=""),
        Translate("medida", data_type, fx.PRICE_MEASURES, "data type", when=prices),
        Discard(~prices & (data_type != fx.PLAIN_DATA)),
        Translate("medida", _entry(fx.CONCEPT), fx.MEASURES, "concept", when=~prices),
    ]
    return (
        classify(known, "COD", steps)
        .withColumn("territorio", first["id"])
        .withColumn("nivel_territorio", first["nivel"])
    )


def catalogue_rows(rows: DataFrame) -> DataFrame:
    """Catalogue of classified series, one row per combination of dimensions.

    The first appearance wins, in the order of the source tables and of the series in them.
    """
    named = rows.withColumns(
        {
            "codigo": F.col("COD"),
            "unidad": F.coalesce(F.trim("T3_Unidad"), F.lit("")),
            "nombre_ine": F.trim("Nombre"),
        }
    )
    kept = first_occurrence(named, KEY, ["orden", "posicion"])
    return kept.select(SERIES_CATALOGUE.names).orderBy(
        "hecho", "tipo_alojamiento", "nivel_territorio", "codigo"
    )


def reject_missing(metadata: DataFrame, tables: Sequence[int] | None = None) -> None:
    """Fail with the numbers of the source tables that have no metadata; at most one row per
    declared table is looked at."""
    wanted = source_tables(metadata).select("tabla_id")
    if tables is not None:
        wanted = wanted.filter(F.col("tabla_id").isin(list(tables)))
    absent = wanted.join(metadata.select("tabla_id").distinct(), "tabla_id", "left_anti")
    numbers = sorted(r[0] for r in absent.collect())
    if numbers:
        raise MissingTable(f"no metadata for the source tables {numbers}")


def series_catalogue(metadata: DataFrame, tables: Sequence[int] | None = None) -> DataFrame:
    """Catalogue of all series of the metadata documents of ``tables`` (None: all declared ones).

    Fails when one of these has no metadata, and with a sample when a value is not in the
    dictionaries: better to look at it than to classify a series wrongly.
    """
    reject_missing(metadata, tables)
    return catalogue_rows(reject_unknown(classify_series(metadata)))


def write_catalogue(catalogue: DataFrame, folder: str) -> None:
    """Catalogue as one CSV file with a header, to be reviewed and versioned."""
    order = ["hecho", "tipo_alojamiento", "nivel_territorio", "codigo"]
    writer = catalogue.repartition(1).sortWithinPartitions(*order).write.mode("overwrite").option("header", True)
    writer.option("escape", '"').option("emptyValue", "").csv(folder)
