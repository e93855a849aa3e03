"""What a published total contains beyond its published breakdown."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.functions.columns import capitalised


def residual(
    df: DataFrame,
    keys: Sequence[str],
    row_type: str,
    total: str,
    child: str,
    measures: Sequence[str],
) -> DataFrame:
    """``greatest(total − Σ children, 0)`` per measure, for keys that have a total row and
    something left over.

    Totals and children are summed side by side in one grouped pass: there is no self join,
    and a key with very many children is combined on the map side.
    """
    kind = F.col(row_type)
    sums = [F.max(F.when(kind == total, F.lit(True))).alias("_has_total")]
    for m in measures:
        sums.append(F.sum(F.when(kind == total, F.col(m))).alias(f"_t_{m}"))
        sums.append(F.sum(F.when(kind == child, F.col(m))).alias(f"_c_{m}"))
    left = [
        F.greatest(F.col(f"_t_{m}") - F.coalesce(F.col(f"_c_{m}"), F.lit(0)), F.lit(0)).alias(m)
        for m in measures
    ]
    rest = F.lit(0)
    for m in measures:
        rest = rest + F.col(m)
    return (
        df.filter(kind.isin(total, child))
        .groupBy(*keys)
        .agg(*sums)
        .filter("_has_total")
        .select(*keys, *left)
        .filter(rest > 0)
    )


def stack_levels(
    totals: DataFrame,
    details: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    row_type: str = "row_type",
    total: str = "total",
    child: str = "child",
) -> DataFrame:
    """Totals and details of two tables as one typed relation, ready for :func:`residual`."""
    columns = [*keys, *measures]
    return totals.select(*columns, F.lit(total).alias(row_type)).unionByName(
        details.select(*columns, F.lit(child).alias(row_type))
    )


def detail_and_residual(
    details: DataFrame,
    rest: DataFrame,
    keys: Sequence[str],
    label: str,
    parent: str,
    measures: Sequence[str],
    suffix: str,
    flag: str,
) -> DataFrame:
    """Detail rows plus one generated «not broken down» member per residual row."""
    columns = [c for c in keys if c != parent]
    shown = details.select(*columns, label, parent, F.lit(True).alias(flag), *measures)
    hidden = rest.select(
        *columns,
        capitalised(parent, suffix).alias(label),
        parent,
        F.lit(False).alias(flag),
        *measures,
    )
    return shown.unionByName(hidden)


def unbalanced_totals(
    members: DataFrame,
    published: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    allowed: float = 0.5,
) -> DataFrame:
    """Published totals that the sum of their members does not reproduce."""
    keys = list(keys)
    sums = members.groupBy(*keys).agg(*[F.sum(m).alias(f"_s_{m}") for m in measures])
    off = F.lit(False)
    for m in measures:
        gap = F.abs(F.coalesce(F.col(f"_s_{m}"), F.lit(0)) - F.col(m))
        off = off | F.coalesce(gap > allowed, F.lit(False))
    return published.select(*keys, *measures).join(sums, keys, "left").filter(off).select(*keys)
