"""Agreement of two sources on the same keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.functions.columns import beyond, tolerance


def _side(df: DataFrame, keys: Sequence[str], measures: Sequence[str], mark: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(m).alias(f"{m}_{mark}") for m in measures])


def compare(
    left: DataFrame, right: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Both sides summed to the keys first, then joined on them: the join sees aggregates only."""
    keys = list(keys)
    return _side(left, keys, measures, "a").join(_side(right, keys, measures, "b"), keys)


def summary(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    absolute: float,
    relative: float,
) -> DataFrame:
    """One row: periods compared and, per measure, the largest difference and the number of
    periods within the tolerance."""
    cells = [F.count(F.lit(1)).alias("periodos")]
    for m in measures:
        gap = F.abs(F.col(f"{m}_a") - F.col(f"{m}_b"))
        fits = gap <= tolerance(F.col(f"{m}_a"), absolute, relative)
        cells += [F.max(gap).alias(f"dif_max_{m}"), F.count_if(fits).alias(f"cuadran_{m}")]
    return compare(left, right, keys, measures).agg(*cells)


def mismatches(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    absolute: float,
    relative: float,
    exceptions: DataFrame | None = None,
    exception_measure: str = "medida",
) -> DataFrame:
    """Keys where some measure differs beyond both tolerances and is not a documented
    exception for that measure.

    Exceptions are turned into one flag per measure and key, so a NULL in the list cannot
    empty the result as it would with ``NOT IN``.
    """
    keys = list(keys)
    rows = compare(left, right, keys, measures)
    flags = {m: F.lit(False) for m in measures}
    if exceptions is not None:
        wide = exceptions.groupBy(*keys).agg(
            *[F.bool_or(F.col(exception_measure) == m).alias(f"_x_{m}") for m in measures]
        )
        rows = rows.join(wide, keys, "left")
        flags = {m: F.coalesce(F.col(f"_x_{m}"), F.lit(False)) for m in measures}
    bad = F.lit(False)
    for m in measures:
        off = beyond(F.col(f"{m}_a"), F.col(f"{m}_b"), absolute, relative)
        bad = bad | (F.coalesce(off, F.lit(False)) & ~flags[m])
    return rows.filter(bad).select(*keys, *[f"{m}_{s}" for m in measures for s in ("a", "b")])


def share_drift(
    left: DataFrame, right: DataFrame, keys: Sequence[str], measure: str, relative: float
) -> DataFrame:
    """Keys whose right-hand total is off by more than a share of the left-hand one."""
    rows = compare(left, right, keys, [measure])
    a, b = F.col(f"{measure}_a"), F.col(f"{measure}_b")
    return rows.filter(F.abs(a - b) > F.lit(relative) * a)
