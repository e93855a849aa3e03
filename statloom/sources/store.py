"""Tables on storage: full replacement by version, load ledger, Parquet packages."""

from __future__ import annotations

import datetime
import json
import re
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.sources import files
from statloom.sources.schemas import LEDGER

POINTER = "_CURRENT"
#: File of a version with what was counted while it was written; its name hides it from readers.
OBSERVED = "_observed.json"
VERSION = re.compile(r"v\d{8}T\d{6}-[0-9a-f]{8}")
#: Size that no file of a package exceeds: each is hashed as one value.
MAX_FILE_BYTES = 512 << 20


class EmptyLoad(ValueError):
    """A load produced no rows; the previous version of the table stays in place."""


def new_version() -> str:
    """Name of a version directory; names sort by time."""
    now = datetime.datetime.now(datetime.UTC)
    return f"v{now:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"


def replace_table(
    df: DataFrame,
    folder: str,
    order: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    keep: int = 2,
    allow_empty: bool = False,
    rules: Mapping[str, Column] | None = None,
) -> int:
    """Replace a whole table and return its row count.

    The new version goes to its own directory and becomes visible when the pointer file is
    renamed, so readers never see half a table and a failed job leaves the old one.
    """
    version, rows = write_version(df, folder, order, partition_by, rules)
    if rows == 0 and not allow_empty:
        files.remove(df.sparkSession, f"{folder}/{version}")
        raise EmptyLoad(f"the load of {folder} produced no rows")
    show_version(df.sparkSession, folder, version, keep)
    return rows


def write_version(
    df: DataFrame,
    folder: str,
    order: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    rules: Mapping[str, Column] | None = None,
) -> tuple[str, int]:
    """Write a version that no reader sees yet; its name and its row count.

    Rows are counted while they are written, and so are the failures of ``rules``, conditions on single
    rows: :func:`observed_failures` reads them back without another scan. Rows are dealt out by ranges of
    the order key and sorted inside each file, so that files cover separate ranges and min/max pruning works.
    """
    version, rules = new_version(), rules or {}
    counted = Observation()
    out = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    # After the exchange: its sampling of the order key would count rows twice.
    failures = [F.count_if(rule).alias(f"_{i}") for i, rule in enumerate(rules.values())]
    out = out.observe(counted, F.count(F.lit(1)).alias("filas"), *failures)
    writer = out.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{folder}/{version}")
    found = {n: counted.get[f"_{i}"] for i, n in enumerate(rules)}
    files.write_text(df.sparkSession, f"{folder}/{version}/{OBSERVED}", json.dumps(found))
    return version, counted.get["filas"]


def observed_failures(spark: SparkSession, folder: str, version: str | None = None) -> dict[str, int]:
    """Failures of the row rules that were counted while a version (the current one) was written."""
    path = current_path(spark, folder) if version is None else f"{folder}/{version}"
    return json.loads(files.read_text(spark, f"{path}/{OBSERVED}"))


def show_version(spark: SparkSession, folder: str, version: str, keep: int = 2) -> None:
    """Make a written version the current one and remove all but the last ``keep`` versions."""
    files.write_text(spark, f"{folder}/{POINTER}", version)
    older = sorted(n for n in files.list_names(spark, folder, True) if VERSION.fullmatch(n) and n != version)
    for old in older[: max(len(older) - (keep - 1), 0)]:
        files.remove(spark, f"{folder}/{old}")


def current_path(spark: SparkSession, folder: str) -> str:
    return f"{folder}/{files.read_text(spark, f'{folder}/{POINTER}').strip()}"


def read_table(spark: SparkSession, folder: str) -> DataFrame:
    """Current version of a table written by :func:`replace_table`."""
    return spark.read.parquet(current_path(spark, folder))


def record_load(
    spark: SparkSession, ledger: str, table: str, rows: int, origin: str, load_id: str | None = None
) -> None:
    """Add one line to the load ledger.

    ``load_id`` names the load, so that a run that is tried again replaces its own line; without one every
    call is a load of its own. A load's line is a folder, written whole: loads do not wait for each other.
    """
    line = (table, rows, origin, datetime.datetime.now(datetime.UTC))
    name = re.sub(r"[^\w.-]", "_", f"{load_id or uuid.uuid4().hex}-{table}")
    spark.createDataFrame([line], LEDGER).coalesce(1).write.mode("overwrite").parquet(f"{ledger}/carga={name}")


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """Lines of the load ledger."""
    return spark.read.schema(LEDGER).parquet(ledger)


def load_table(
    df: DataFrame, lake: str, layer: str, name: str, origin: str, order: Sequence[str], load_id: str | None = None
) -> int:
    """Replace ``lake/layer/name`` and record the load once it is visible."""
    rows = replace_table(df, f"{lake}/{layer}/{name}", order)
    record_load(df.sparkSession, f"{lake}/{layer}/_cargas", f"{layer}.{name}", rows, origin, load_id)
    return rows


def register(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Parquet files as a temporary view."""
    df = spark.read.parquet(path)
    df.createOrReplaceTempView(name)
    return df


def register_layers(
    spark: SparkSession, lake: str, layers: Sequence[str] = ("bronze", "silver", "gold")
) -> list[str]:
    """Written tables under their layer names for SQL: ``SELECT … FROM gold.some_table``.

    Tables are external and point at the current version, so this is called after each run;
    nothing is copied and dropping them leaves the files alone. The databases stay in the
    warehouse folder of the session: one located in the lake would take it along when dropped.
    """
    names = []
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
        for name in files.list_names(spark, f"{lake}/{layer}", True):
            folder = f"{lake}/{layer}/{name}"
            if files.exists(spark, f"{folder}/{POINTER}"):
                path = current_path(spark, folder)
                spark.sql(f"DROP TABLE IF EXISTS `{layer}`.`{name}`")
                spark.sql(f"CREATE TABLE `{layer}`.`{name}` USING parquet LOCATION '{path}'")
                names.append(f"{layer}.{name}")
    return names


def _width(field: T.StructField) -> Column:
    """Bytes of a column in a row, at most: texts as they are, nested values as their JSON."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 8
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        # Numbers take up to eight bytes, whatever their text: eight bytes per character are enough.
        return 8 * F.coalesce(F.octet_length(F.to_json(F.array(c))), F.lit(0)) + 8
    return F.lit(16)


def rows_per_file(df: DataFrame, max_bytes: int) -> int:
    """Rows that a file of ``max_bytes`` holds whatever rows they are, from the widest one."""
    total = F.lit(0)
    for field in df.schema.fields:
        total = total + _width(field)
    widest = df.agg(F.max(total)).first()[0]
    return max(1, max_bytes // widest) if widest else 1


def export(tables: Mapping[str, DataFrame], folder: str, max_bytes: int = MAX_FILE_BYTES) -> None:
    """One zstd Parquet directory per table; only those directories are replaced.

    Files are bounded in bytes so that each can be checksummed as one value.
    """
    for name, df in tables.items():
        (
            df.write.mode("overwrite")
            .option("compression", "zstd")
            .option("maxRecordsPerFile", rows_per_file(df, max_bytes))
            .parquet(f"{folder}/{name}.parquet")
        )


def checksums(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """SHA-256 of every file below a folder, hashed where the file is read."""
    content = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(folder)
    )
    name = F.regexp_extract("path", r"([^/]+\.parquet/[^/]+|[^/]+)$", 1)
    return content.select(name.alias("fichero"), F.sha2("content", 256).alias("sha256"))
