"""Long to wide, wide to long, first and last row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pivot_measures(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    value: str,
    names: Sequence[str],
    flags: Mapping[str, str] | None = None,
    published: str | None = None,
) -> DataFrame:
    """Long measures to columns, one aggregate per measure in a single grouped pass.

    ``flags`` maps an output column to a boolean column that is true for the row when it is
    true for any of its measures; ``published`` names a count of non-null values.
    """
    cells: list[Column] = [
        F.max(F.when(F.col(name) == m, F.col(value))).alias(m) for m in names
    ]
    if published:
        cells.append(F.count(value).alias(published))
    cells += [F.bool_or(source).alias(out) for out, source in (flags or {}).items()]
    return df.groupBy(*keys).agg(*cells)


def unpivot_breakdown(
    df: DataFrame, ids: Sequence[str], breakdown: Mapping[str, Mapping[str, str]], member: str
) -> DataFrame:
    """Column groups to rows: ``{member: {measure: column}}``, one output row per member."""
    rows = [
        F.struct(F.lit(m).alias(member), *[F.col(c).alias(out) for out, c in measures.items()])
        for m, measures in breakdown.items()
    ]
    return df.select(*ids, F.inline(F.array(*rows)))


def first_occurrence(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each key in an explicit order.

    Spark trims every map task to one candidate per key before the exchange, so a frequent
    key does not gather its rows in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(window)).filter("_n = 1").drop("_n")


def _best(df: DataFrame, keys: Sequence[str], pick: Column) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(pick.alias("_row")).select(
        *keys, *[F.col("_row")[c].alias(c) for c in rest]
    )


def latest_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row with the greatest ``order`` of each key (later columns break ties)."""
    rest = [c for c in df.columns if c not in keys]
    return _best(df, keys, F.max_by(F.struct(*rest), F.struct(*order)))


def peak_and_trough(df: DataFrame, group: str, position: str, value: str) -> DataFrame:
    """Highest and lowest cell of each group; the lower position wins a tie."""
    p = F.col(position)
    high = F.max_by(F.struct(position, value), F.struct(F.col(value), -p))
    low = F.min_by(F.struct(position, value), F.struct(F.col(value), p))
    known = df.filter(F.col(value).isNotNull())
    return known.groupBy(group).agg(high.alias("_h"), low.alias("_l")).select(
        group,
        F.col(f"_h.{position}").alias("peak"),
        F.col(f"_h.{value}").alias("peak_value"),
        F.col(f"_l.{position}").alias("trough"),
        F.col(f"_l.{value}").alias("trough_value"),
    )


def with_parent(
    members: DataFrame, parents: DataFrame, key: str, parent: str, columns: Mapping[str, str]
) -> DataFrame:
    """Attributes of the parent of each member: ``{output: parent column}``.

    One call climbs one level of a hierarchy kept as ``(key, parent)`` pairs; members without
    a parent keep NULLs. ``parents`` may leave out members that are nobody's parent.
    """
    above = parents.select(
        F.col(key).alias(parent), *[F.col(c).alias(out) for out, c in columns.items()]
    )
    return members.join(above, parent, "left").select(*members.columns, *columns)
