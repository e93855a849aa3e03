"""Periods: which are published, which years are complete, continuous spines and runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.functions.columns import month_key, month_name


def _zero_filled_total(measures: Sequence[str]) -> Column:
    parts = [F.coalesce(F.col(m), F.lit(0)) for m in measures]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total


def published_periods(df: DataFrame, period: str | Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Periods whose measures add up to more than zero; an all-zero period was not published."""
    keys = [period] if isinstance(period, str) else list(period)
    volume = F.sum(_zero_filled_total(measures)).alias("_volume")
    return df.groupBy(*keys).agg(volume).filter("_volume > 0").select(*keys)


def keep_published(df: DataFrame, period: str | Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Rows of published periods only.

    The key list is aggregated first (combined on the map side), so a period with a large
    share of the rows never travels whole; the semi join is broadcast when the keys are few.
    """
    keys = [period] if isinstance(period, str) else list(period)
    return df.join(published_periods(df, keys, measures), keys, "left_semi")


def complete_years(
    df: DataFrame, group: str, year: str, month: str, value: str, periods: int = 12
) -> DataFrame:
    """Years in which every group of ``df`` has all its periods published.

    One row per group and year holds its periods as a set of bits. ``df`` is read twice, for these
    rows and for the number of groups: give it a kept relation (:func:`staging.shared`).
    """
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col(month).cast("int") - 1)
    cells = df.groupBy(group, year).agg(F.bit_or(F.when(F.col(value).isNotNull(), bit)).alias("_set"))
    groups = df.agg(F.count_distinct(group)).scalar()
    whole = F.bit_count(F.coalesce("_set", F.lit(0).cast("bigint"))) == periods
    return (
        cells.groupBy(year)
        .agg(F.count_if(whole).alias("_groups"))
        .filter(F.col("_groups") == groups)
        .select(year)
    )


def in_years(df: DataFrame, years: DataFrame, year: str) -> DataFrame:
    """Rows of the listed years; the list stays a DataFrame."""
    return df.join(years.select(year), year, "left_semi")


def month_spine(bounds: DataFrame, low: str, high: str, name: str) -> DataFrame:
    """One row per month between two date columns, both included."""
    months = F.sequence(F.col(low), F.col(high), F.expr("INTERVAL 1 MONTH"))
    return bounds.select(F.explode(months).alias(name))


def month_dimension(dates: Sequence[tuple[DataFrame, str]], names: Sequence[str]) -> DataFrame:
    """Continuous calendar that covers the date columns of several tables.

    Each table is reduced to its own bounds before they are put together: only one row per
    table is exchanged.
    """
    bounds = None
    for df, column in dates:
        part = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
        bounds = part if bounds is None else bounds.unionByName(part)
    limits = bounds.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    date = F.col("fecha")
    return month_spine(limits, "lo", "hi", "fecha").select(
        month_key(date).alias("fecha_id"),
        date,
        F.year(date).cast("smallint").alias("anio"),
        F.month(date).cast("smallint").alias("mes"),
        F.quarter(date).cast("smallint").alias("trimestre"),
        month_name(F.month(date), names).alias("nombre_mes"),
    )


def gap_series(
    df: DataFrame, calendar: DataFrame, group: str, period: str, value: str, flag: str
) -> DataFrame:
    """Totals per group and month with a row for every month of the calendar up to the last
    month of ``df``. A month without data has a NULL value, never zero.

    Each row lays out the months up to its successor in the group, the first one also those before it:
    only missing months are generated, without a spine that is joined back. Rows without a period or
    before the calendar count for nothing.
    """
    low, high = calendar.agg(F.min(period)).scalar(), df.agg(F.max(period)).scalar()
    totals = (
        df.filter(F.col(period) >= low)
        .groupBy(group, period)
        .agg(F.sum(value).alias(value), F.bool_or(flag).alias(flag))
    )
    month = F.expr("INTERVAL 1 MONTH")
    in_order = Window.partitionBy(group).orderBy(period)
    first = F.when(F.lag(period).over(in_order).isNull(), low).otherwise(F.col(period))
    last = F.add_months(F.coalesce(F.lead(period).over(in_order), F.add_months(high, 1)), -1)
    laid = totals.withColumns({"_first": first, "_last": last}).select(
        group, period, value, flag, F.explode(F.sequence("_first", "_last", month)).alias("_at")
    )
    here = F.col("_at") == F.col(period)
    return laid.select(
        group,
        F.col("_at").alias(period),
        F.when(here, F.col(value)).alias(value),
        F.coalesce(F.when(here, F.col(flag)), F.lit(False)).alias(flag),
    )


def year_spine(df: DataFrame, group: str, year: str, value: str) -> DataFrame:
    """Every year between the first and the last for every group, NULL where it is missing.

    ``df`` has one row per group and year; each lays out the years up to its successor. Rows without a
    year count for nothing.
    """
    low, high = df.agg(F.min(year)).scalar(), df.agg(F.max(year)).scalar()
    in_order = Window.partitionBy(group).orderBy(year)
    first = F.when(F.lag(year).over(in_order).isNull(), low).otherwise(F.col(year))
    last = F.coalesce(F.lead(year).over(in_order) - 1, high)
    laid = df.filter(F.col(year).isNotNull()).withColumns({"_first": first, "_last": last})
    rows = laid.select(
        group, F.col(year).alias("_of"), value, F.explode(F.sequence("_first", "_last")).alias(year)
    )
    return rows.select(group, year, F.when(F.col("_of") == F.col(year), F.col(value)).alias(value))


def provisional_band(df: DataFrame, period: str, flag: str) -> DataFrame:
    """First provisional period and the month after the last one (end exclusive)."""
    return (
        df.filter(F.col(flag))
        .agg(F.min(period).alias("desde"), F.max(period).alias("_last"))
        .select("desde", F.add_months("_last", 1).alias("hasta"))
    )


def consecutive_runs(
    df: DataFrame, keys: Sequence[str], position: str, block: int = 4096
) -> DataFrame:
    """Collapse consecutive integer positions of each key into runs ``(start, end, length)``.

    Positions are cut into blocks and the runs are found inside each block, so a key with a
    large share of the rows is spread over many tasks. Only runs that touch the edge of a
    block can continue in the next one; these, at most two per block, are put in order per
    key and joined. The others stay with their block.
    """
    keys = list(keys)
    pos = F.col(position).cast("bigint")
    cells = df.filter(pos.isNotNull()).select(*keys, pos.alias("_p")).distinct()
    cells = cells.withColumn("_b", F.floor(F.col("_p") / block).cast("bigint"))
    in_block = Window.partitionBy(*keys, "_b").orderBy("_p")
    runs = (
        cells.withColumn("_i", F.col("_p") - F.row_number().over(in_block))
        .groupBy(*keys, "_b", "_i")
        .agg(F.min("_p").alias("start"), F.max("_p").alias("end"))
    )
    at_edge = (F.pmod("start", F.lit(block)) == 0) | (F.pmod("end", F.lit(block)) == block - 1)
    runs = runs.withColumn("_b", F.when(~at_edge, F.col("_b")))
    by_start = Window.partitionBy(*keys, "_b").orderBy("start")
    starts = F.when(F.col("start") == F.lag("end").over(by_start) + 1, 0).otherwise(1)
    return (
        runs.withColumn("_new", starts)
        .withColumn("_run", F.sum("_new").over(by_start.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*keys, "_b", "_run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .select(*keys, "start", "end", (F.col("end") - F.col("start") + 1).alias("length"))
    )
