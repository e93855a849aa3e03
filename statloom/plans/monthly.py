"""The monthly run: raw documents to gold tables, checks, indicators and package."""

from __future__ import annotations

import argparse
import datetime
import json
from collections.abc import Mapping
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.operators import quality as q
from statloom.operators.periods import published_periods
from statloom.plans import bronze, checks, gold, indicators, release, silver
from statloom.plans.tables import from_csv
from statloom.sources.schemas import GOLD
from statloom.session import cluster_settings
from statloom.sources import files
from statloom.sources.store import (
    observed_failures,
    read_ledger,
    read_table,
    replace_table,
    show_version,
    write_version,
)

#: Sort order inside the files of each written table.
ORDER = {
    "int_ine__observaciones": ["hecho", "territorio", "fecha"],
    "int_mt__filas_clasificadas": ["fecha", "zona"],
    "fct_demanda_mensual": ["fuente", "territorio_id", "fecha_id"],
    "fct_oferta_mensual": ["territorio_id", "fecha_id"],
    "fct_precios_mensual": ["territorio_id", "fecha_id"],
}


def _write(spark: SparkSession, lake: str, layer: str, name: str, df: DataFrame) -> DataFrame:
    """Replace a table and read it back: later steps start from the written files. The declared rules on
    its rows are counted on the way."""
    folder = f"{lake}/{layer}/{name}"
    replace_table(df, folder, ORDER.get(name, []), allow_empty=True, rules=checks.row_rules(name))
    return read_table(spark, folder)


def load(
    spark: SparkSession,
    raw: str,
    lake: str,
    decimal: str = ".",
    thousands: str = ",",
    load_id: str | None = None,
) -> dict[str, int]:
    """Bronze: both sources, with ledger entries. A load that is tried again with its ``load_id`` replaces
    its entries."""
    return {
        "bronze.ine_series": bronze.load_series(spark, raw, lake, load_id),
        "bronze.murciaturistica_destinos": bronze.load_destinations(
            spark, raw, lake, decimal, thousands, load_id
        ),
    }


def build_silver(
    spark: SparkSession, lake: str, reference: Mapping[str, DataFrame]
) -> dict[str, DataFrame]:
    """Silver from bronze, together with the tables it is made from.

    Staging stays lazy; relations with several readers are written, so that nothing upstream
    is computed twice.
    """
    series = read_table(spark, f"{lake}/bronze/ine_series")
    pages = read_table(spark, f"{lake}/bronze/murciaturistica_destinos")
    stg_series, stg_rows = silver.series_observations(series), silver.destination_rows(pages)
    write = partial(_write, spark, lake, "silver")
    observations = write(
        "int_ine__observaciones", silver.catalogued(stg_series, reference["series_ine"])
    )
    rows = write(
        "int_mt__filas_clasificadas",
        silver.classified_rows(stg_rows, reference["destinos_murciaturistica"]),
    )
    rest = silver.residual_by_zone(rows)
    occupancy = write("int_mt__ocupacion_destino", silver.destination_occupancy(rows, rest))
    return {
        **reference,
        "ine_series": series,
        "murciaturistica_destinos": pages,
        "stg_ine__series": stg_series,
        "stg_mt__destinos": stg_rows,
        "int_ine__observaciones": observations,
        "int_mt__meses_publicados": published_periods(stg_rows, "fecha", silver.OCCUPANCY),
        "int_mt__filas_clasificadas": rows,
        "int_mt__residual_por_zona": rest,
        "int_mt__ocupacion_destino": occupancy,
    }


def build_gold(
    spark: SparkSession, lake: str, t: Mapping[str, DataFrame]
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """The star schema from silver and the reference tables, every table written as a new version
    that readers do not see yet; the tables read back, and the versions by name."""
    observations, occupancy = t["int_ine__observaciones"], t["int_mt__ocupacion_destino"]
    star = {
        "dim_fecha": gold.calendar(observations, occupancy),
        "dim_territorio": gold.territories(t["territorios"]),
        "dim_tipo_alojamiento": gold.accommodation_types(t["tipos_alojamiento"]),
        "dim_residencia": gold.residences(t["residencias"]),
        "fct_demanda_mensual": gold.demand(observations, occupancy, t["territorios"]),
        "fct_oferta_mensual": gold.supply(observations),
        "fct_precios_mensual": gold.prices(observations),
    }
    versions = {
        n: write_version(df, f"{lake}/gold/{n}", ORDER.get(n, []), rules=checks.row_rules(n))[0]
        for n, df in star.items()
    }
    return {n: spark.read.parquet(f"{lake}/gold/{n}/{v}") for n, v in versions.items()}, versions


def run(
    spark: SparkSession,
    raw: str,
    lake: str,
    reference: Mapping[str, DataFrame],
    package: str | None = None,
    today: str | None = None,
    complete_data: bool = True,
    decimal: str = ".",
    thousands: str = ",",
    load_id: str | None = None,
) -> dict[str, DataFrame]:
    """One monthly run. Returns the indicators and the check reports.

    Every layer passes its gate before the next one is built: a failed blocking check stops
    the run, a warning only shows in the report.
    """
    load(spark, raw, lake, decimal, thousands, load_id)
    loaded = checks.bronze_report(
        read_table(spark, f"{lake}/bronze/ine_series"), reference["series_ine"], today
    )
    if not complete_data:
        loaded = loaded.filter(F.col("prueba") != "catalogo_completo")
    reports = [q.gate(spark, loaded)]
    clean = build_silver(spark, lake, reference)
    between = checks.silver_checks(clean, complete_data)
    written = ("int_ine__observaciones", "int_mt__filas_clasificadas", "int_mt__ocupacion_destino")
    counted = {n: observed_failures(spark, f"{lake}/silver/{n}") for n in written}
    reports.append(q.gate(spark, checks.layer_report(clean, between, observed=counted)))
    star, versions = build_gold(spark, lake, clean)
    between = checks.gold_checks(star, reference["excepciones_cuadre"])
    counted = {n: observed_failures(spark, f"{lake}/gold/{n}", v) for n, v in versions.items()}
    reports.append(q.gate(spark, checks.layer_report(star, between, observed=counted)))
    for name, version in versions.items():
        show_version(spark, f"{lake}/gold/{name}", version)
    out = {
        **indicators.all_indicators({**reference, **star}),
        "_cargas": read_ledger(spark, f"{lake}/bronze/_cargas"),
        "_pruebas": reduce(DataFrame.unionByName, reports),
    }
    if package is not None:
        release.publish(spark, {n: star[n] for n in GOLD}, package)
    return out


def write_indicators(sections: Mapping[str, DataFrame], folder: str) -> None:
    """Each section as JSON lines; part files keep the order of the section."""
    for name, df in sections.items():
        df.write.mode("overwrite").option("ignoreNullFields", False).json(
            f"{folder}/{name.lstrip('_')}"
        )


def document(sections: Mapping[str, DataFrame]) -> dict[str, list[dict]]:
    """The indicator sections as lists of plain rows.

    Only finished indicators are collected: groups × months, never facts.
    """

    def plain(v):
        return v.isoformat() if isinstance(v, datetime.date) else v

    return {
        name: [{k: plain(v) for k, v in r.asDict().items()} for r in df.collect()]
        for name, df in sections.items()
        if not name.startswith("_")
    }


def report_document(sections: Mapping[str, DataFrame], generated: str | None = None) -> dict:
    """All indicators as one document: ``meta`` with the complete years of both bases,
    ``cuadre`` with its documented exceptions, ``generado``, then the other sections."""
    rows = document(sections)
    meta, balance = rows.pop("meta")[0], rows.pop("cuadre")[0]
    for base in ("mt", "ine"):
        meta[f"anios_completos_{base}"] = [r["anio"] for r in rows.pop(f"anios_completos_{base}")]
    balance["excepciones"] = rows.pop("excepciones")
    return {
        "generado": generated or datetime.date.today().isoformat(), "meta": meta, "cuadre": balance, **rows
    }


def write_document(
    spark: SparkSession, sections: Mapping[str, DataFrame], path: str, generated: str | None = None
) -> dict:
    """Write the one document to storage and return it."""
    found = report_document(sections, generated)
    files.write_text(spark, path, json.dumps(found, ensure_ascii=False, indent=1) + "\n")
    return found


def main(argv: list[str] | None = None) -> None:
    """``spark-submit`` entry point: one monthly run on the session of the cluster."""
    parser = argparse.ArgumentParser(description="Monthly run from raw documents to the package")
    parser.add_argument("raw", help="folder with the raw documents of both sources")
    parser.add_argument("lake", help="folder of the bronze, silver and gold tables")
    parser.add_argument("--series", required=True, help="CSV file of the series catalogue")
    parser.add_argument("--exceptions", help="CSV file of documented differences")
    parser.add_argument("--package", help="folder of the data package")
    parser.add_argument("--indicators", help="folder of the indicator files")
    parser.add_argument("--today", help="ISO date used by the freshness check")
    parser.add_argument("--load-id", help="name of this run in the ledger; a retry with it adds no second line")
    parser.add_argument("--partial", action="store_true", help="not every series is loaded")
    parser.add_argument("--input-bytes", type=int, help="size of the raw data, to size shuffles and scans")
    parser.add_argument("--cores", type=int, help="executor cores of the run")
    args = parser.parse_args(argv)
    builder = SparkSession.builder.appName("monthly statistics").config("spark.sql.session.timeZone", "UTC")
    if args.input_bytes and args.cores:
        builder = builder.config(map=cluster_settings(args.input_bytes, args.cores))
    spark = builder.getOrCreate()
    paths = {"series_ine": args.series, "excepciones_cuadre": args.exceptions}
    reference = from_csv(spark, {n: p for n, p in paths.items() if p})
    out = run(
        spark, args.raw, args.lake, reference, args.package, args.today, not args.partial,
        load_id=args.load_id,
    )
    if args.indicators:
        write_indicators(out, args.indicators)
        write_document(spark, out, f"{args.indicators}/indicadores.json")


if __name__ == "__main__":
    main()
