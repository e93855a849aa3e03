"""Data package: gold tables as Parquet, their contract and checksums."""

from __future__ import annotations

import datetime
import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from statloom.operators.fingerprint import contract_rows
from statloom.operators.indicators import period_text
from statloom.plans import fixed_values as fx
from statloom.sources import files
from statloom.sources.store import checksums, current_path, export, new_version, show_version

CONTRACT_FILE = "contrato.json"
CHECKSUM_FILE = "SHA256SUMS"


def contract(
    tables: Mapping[str, DataFrame],
    version: str = fx.CONTRACT_VERSION,
    period_table: str = "fct_demanda_mensual",
    period_key: str = "fecha_id",
    generated: str | None = None,
) -> dict:
    """Contract of a set of tables: columns, types, row counts and covered period.

    Only table descriptions are collected: one line per column.
    """
    if not tables:
        raise ValueError("gold has no tables to publish")
    described: dict[str, dict] = {}
    for r in contract_rows(tables).orderBy("tabla", "posicion").collect():
        entry = described.setdefault(r.tabla, {"filas": r.filas, "columnas": []})
        entry["columnas"].append({"nombre": r.nombre, "tipo": r.tipo})
    period = period_text(tables[period_table], period_key).first()
    return {
        "version_contrato": version,
        "generado": generated or datetime.date.today().isoformat(),
        "periodo": {"desde": period.desde, "hasta": period.hasta},
        "fuentes": list(fx.CONTRACT_SOURCES),
        "tablas": described,
    }


def publish(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    folder: str,
    version: str = fx.CONTRACT_VERSION,
    keep: int = 2,
) -> dict:
    """Write the package and return its contract.

    Tables, contract and checksums go to a directory of their own, which becomes the package when one
    pointer file is renamed (:func:`package_path`): readers see the old package or the new one, whole, and
    a run that fails leaves the old one with the contract and the checksums that fit it. The last ``keep``
    packages stay. Other names in the folder are not touched.
    """
    if not tables:
        raise ValueError("gold has no tables to publish")
    name = new_version()
    out = f"{folder}/{name}"
    try:
        export(tables, out)
        written = {n: spark.read.parquet(f"{out}/{n}.parquet") for n in tables}
        document = contract(written, version)
        text = json.dumps(document, ensure_ascii=False, indent=2) + "\n"
        files.write_text(spark, f"{out}/{CONTRACT_FILE}", text)
        sums = [checksums(spark, f"{out}/{n}.parquet", "part-*").orderBy("fichero") for n in sorted(tables)]
        sums.append(checksums(spark, f"{out}/{CONTRACT_FILE}"))
        lines = [f"{r.sha256}  {r.fichero}" for part in sums for r in part.toLocalIterator()]
        files.write_text(spark, f"{out}/{CHECKSUM_FILE}", "\n".join(lines) + "\n")
    except BaseException:
        files.remove(spark, out)
        raise
    show_version(spark, folder, name, keep)
    return document


def package_path(spark: SparkSession, folder: str) -> str:
    """Directory of the current package: tables, contract and checksums that belong together."""
    return current_path(spark, folder)
