"""Reference tables: CSV files with declared types, or fixed rows."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_reference(spark: SparkSession, path: str, schema: T.StructType, blanks: bool = False) -> DataFrame:
    """CSV with a header. Empty cells are NULL; with ``blanks`` they stay empty strings."""
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("escape", '"')
    )
    df = reader.csv(path)
    return df.fillna("", [f.name for f in schema.fields if f.dataType == T.StringType()]) if blanks else df


def fixed_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """Fixed rows as a local relation.

    Spark then knows how small the table is and broadcasts it by itself, instead of shuffling
    the facts that it is joined with.
    """
    kinds = {T.IntegerType(): pa.int32(), T.StringType(): pa.string()}
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    data = {f.name: pa.array(c, kinds[f.dataType]) for f, c in zip(schema, columns, strict=True)}
    return spark.createDataFrame(pa.table(data), schema)
