"""Fingerprints, parity and contract documents of table sets."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Type names used in contract documents.
TYPE_NAMES = {
    T.BooleanType: "BOOLEAN",
    T.ByteType: "TINYINT",
    T.ShortType: "SMALLINT",
    T.IntegerType: "INTEGER",
    T.LongType: "BIGINT",
    T.FloatType: "FLOAT",
    T.DoubleType: "DOUBLE",
    T.StringType: "VARCHAR",
    T.DateType: "DATE",
    T.TimestampType: "TIMESTAMP",
    T.TimestampNTZType: "TIMESTAMP",
}


def type_name(t: T.DataType) -> str:
    if isinstance(t, T.ArrayType):
        return type_name(t.elementType) + "[]"
    if isinstance(t, T.DecimalType):
        return f"DECIMAL({t.precision},{t.scale})"
    return TYPE_NAMES.get(type(t), t.simpleString().upper())


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


#: Beyond this a double has no fraction left and is added as it is.
WHOLE_FROM = float(1 << 53)


def _big(high: Column, low: Column, scale: int) -> Column:
    """``high * scale + low`` as an exact decimal, from two sums of whole numbers."""
    return high.cast("decimal(38,0)") * F.lit(scale).cast("decimal(20,0)") + low.cast("decimal(38,0)")


def _sums(field: T.StructField) -> tuple[dict[str, Column], Column, Column | None]:
    """Primitive sums of a column; the sum they make up, rounded to four places; values to count apart.

    Whole numbers are added in two halves of 32 bits, fractions as whole part, millionths and what
    is left in units of 1e-12: whole sums do not depend on how the rows are partitioned, and no
    decimal is built per row. NaN and infinity are not added but counted.
    """
    c, n = F.col(field.name), f"_{field.name}"
    if isinstance(field.dataType, T.IntegralType):
        parts = {f"{n}_h": F.sum(F.shiftright(c.cast("bigint"), 32)), f"{n}_l": F.sum(c.cast("bigint").bitwiseAND(0xFFFFFFFF))}
        return parts, _big(F.col(f"{n}_h"), F.col(f"{n}_l"), 1 << 32).cast("double"), None
    if isinstance(field.dataType, T.DecimalType):
        return {f"{n}_d": F.sum(c)}, F.round(F.col(f"{n}_d"), 4).cast("double"), None
    x = c.cast("double")
    finite = x.between(-1.7976931348623157e308, 1.7976931348623157e308)
    small = F.when(finite & (F.abs(x) < WHOLE_FROM), x)
    whole = F.floor(small)
    micro = F.floor((small - whole) * 1e6)
    rest = F.round(((small - whole) * 1e6 - micro) * 1e6).cast("bigint")
    parts = {
        f"{n}_w": F.sum(whole), f"{n}_m": F.sum(micro), f"{n}_r": F.sum(rest),
        f"{n}_b": F.sum(F.when(finite & (F.abs(x) >= WHOLE_FROM), x)), f"{n}_x": F.count_if(~finite),
    }
    unit = lambda p, s: F.coalesce(F.col(f"{n}_{p}"), F.lit(0)).cast("decimal(20,0)") * F.lit(s).cast("decimal(13,12)")
    exact = F.round(unit("w", "1") + unit("m", "0.000001") + unit("r", "0.000000000001"), 4).cast("double")
    any_value = F.coalesce(F.col(f"{n}_w").cast("double"), F.col(f"{n}_b"))
    return parts, F.when(any_value.isNotNull(), exact + F.coalesce(F.col(f"{n}_b"), F.lit(0.0))), F.col(f"{n}_x")


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and sum of every numeric column, rounded to four places, in one aggregate; for
    columns of floating point also how many values are NaN or infinite."""
    parts: dict[str, Column] = {}
    out = [F.col("filas")]
    for f in df.schema.fields:
        if isinstance(f.dataType, T.NumericType):
            mine, total, odd = _sums(f)
            parts |= mine
            out.append(total.alias(f"suma_{f.name}"))
            if odd is not None:
                out.append(odd.alias(f"no_finitos_{f.name}"))
    return df.agg(F.count(F.lit(1)).alias("filas"), *(c.alias(n) for n, c in parts.items())).select(*out)


def fingerprint_rows(table: str, df: DataFrame) -> DataFrame:
    """Fingerprint as ``(tabla, medida, valor)`` rows."""
    wide = fingerprint(df)
    cells = [
        F.struct(F.lit(c).alias("medida"), F.col(c).cast("double").alias("valor"))
        for c in wide.columns
    ]
    return wide.select(F.lit(table).alias("tabla"), F.inline(F.array(*cells)))


def fingerprints(tables: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [fingerprint_rows(t, df) for t, df in tables.items()])


def parity(a: Mapping[str, DataFrame], b: Mapping[str, DataFrame]) -> DataFrame:
    """Fingerprint entries that differ between two copies of a table set; empty means equal.

    A table or column that only one side has shows up with NULL on the other.
    """
    left = fingerprints(a).withColumnRenamed("valor", "valor_a").withColumn("_in_a", F.lit(True))
    right = fingerprints(b).withColumnRenamed("valor", "valor_b").withColumn("_in_b", F.lit(True))
    same = F.col("_in_a").eqNullSafe(F.col("_in_b")) & F.col("valor_a").eqNullSafe(F.col("valor_b"))
    return (
        left.join(right, ["tabla", "medida"], "full_outer")
        .filter(~same)
        .select("tabla", "medida", "valor_a", "valor_b")
    )


def contract_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Columns, types and row count of each table: ``(tabla, posicion, nombre, tipo, filas)``."""
    parts = []
    for name, df in tables.items():
        cells = [
            F.struct(
                F.lit(i).alias("posicion"),
                F.lit(f.name).alias("nombre"),
                F.lit(type_name(f.dataType)).alias("tipo"),
            )
            for i, f in enumerate(df.schema.fields, 1)
        ]
        counted = df.agg(F.count(F.lit(1)).alias("filas"))
        parts.append(
            counted.select(F.lit(name).alias("tabla"), F.inline(F.array(*cells)), "filas")
        )
    return reduce(DataFrame.unionByName, parts)
