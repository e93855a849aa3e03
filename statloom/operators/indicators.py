"""Indicators over monthly relations: profiles, indices, ratios, series and coverage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.functions.columns import key_text, month_text, percent, ratio
from statloom.operators.periods import in_years
from statloom.operators.reshape import latest_per_group, peak_and_trough


def group_totals(df: DataFrame, keys: Sequence[str], measures: Mapping[str, str]) -> DataFrame:
    """Sums of several measures per key: ``{output: column}``."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(out) for out, c in measures.items()])


def share_of_group(df: DataFrame, group: str | Sequence[str], value: str, out: str) -> DataFrame:
    """Each row as a percentage of the total of its group."""
    keys = [group] if isinstance(group, str) else list(group)
    total = F.sum(value).over(Window.partitionBy(*keys))
    return df.withColumn(out, percent(F.col(value), total))


def seasonal_profile(
    df: DataFrame, years: DataFrame, group: str, year: str, month: str, value: str
) -> DataFrame:
    """Percentage of each group's volume per month of the year; 100 per group.

    The window runs over the aggregate: at most one row per group and month.
    """
    per_month = in_years(df, years, year).groupBy(group, month).agg(F.sum(value).alias("_p"))
    return share_of_group(per_month, group, "_p", "pct").select(group, month, "pct")


def base_index(
    df: DataFrame, years: DataFrame, group: str, year: str, value: str, base_year: int
) -> DataFrame:
    """Annual totals per group and their index with 100 in the base year."""
    per_year = in_years(df, years, year).groupBy(group, year).agg(F.sum(value).alias(value))
    base = F.max(F.when(F.col(year) == base_year, F.col(value))).over(Window.partitionBy(group))
    return per_year.withColumn("indice", percent(F.col(value), base))


def ratio_profile(
    df: DataFrame,
    years: DataFrame,
    group: str,
    year: str,
    month: str,
    volume: str,
    people: str,
    high_month: int,
    low_month: int,
    subset: Column,
) -> DataFrame:
    """Peak over low month, volume per person and share of a subset, per group."""
    v = F.col(volume)

    def part(condition: Column) -> Column:
        return F.sum(F.when(condition, v))

    return in_years(df, years, year).groupBy(group).agg(
        ratio(part(F.col(month) == high_month), part(F.col(month) == low_month)).alias(
            "ratio_meses"
        ),
        ratio(F.sum(v), F.sum(people)).alias("estancia_media"),
        percent(part(subset), F.sum(v)).alias("pct_subconjunto"),
    )


def measure_series(
    fact: DataFrame,
    dates: DataFrame,
    group: str,
    measures: Sequence[str],
    where: Column | None = None,
    parts: Sequence[str] = (),
) -> DataFrame:
    """Measures of a fact per group and month as text; rows without the first measure drop out."""
    rows = fact.filter(F.col(measures[0]).isNotNull())
    if where is not None:
        rows = rows.filter(where)
    return rows.join(dates, "fecha_id").select(
        group, month_text("fecha").alias("mes_texto"), *parts, *measures
    )


def coverage(df: DataFrame, date: str, source: str, sources: Sequence[str], flag: str) -> DataFrame:
    """First month, last month of each source and first provisional month, as one row.

    The table is first reduced to one row per source and flag, then the row is laid out.
    """
    d = F.col("_d")
    months = df.groupBy(source, flag).agg(F.min(date).alias("_a"), F.max(date).alias("_d"))
    last = [
        month_text(F.max(F.when(F.col(source) == s, d))).alias(f"ultimo_mes_{s}") for s in sources
    ]
    return months.agg(
        month_text(F.min("_a")).alias("primer_mes"),
        *last,
        month_text(F.min(F.when(F.col(flag), F.col("_a")))).alias("provisional_desde"),
    )


# --- figures derived from the indicators above ---------------------------------------


def last_year_totals(
    annual: DataFrame, group: str, year: str, value: str, base_year: int
) -> DataFrame:
    """Last year of an annual table: share of each group, grand total, change against the base
    year and share outside each group.

    The totals are one row, joined on the year itself: the join also keeps the last year only.
    """
    per_year = annual.groupBy(year).agg(F.sum(value).alias("_t"))
    totals = per_year.agg(
        F.max(year).alias(year),
        F.max_by("_t", year).alias("total"),
        F.max(F.when(F.col(year) == base_year, F.col("_t"))).alias("_base"),
    )
    total, base = F.col("total"), F.col("_base")
    return annual.join(totals, year).select(
        group,
        year,
        value,
        percent(F.col(value), total).alias("peso"),
        percent(total - F.col(value), total).alias("peso_resto"),
        "total",
        percent(total - base, base).alias("cambio_total"),
    )


def months_share(
    profile: DataFrame, group: str, month: str, value: str, months: Sequence[int]
) -> DataFrame:
    """Share of a set of months per group, from volumes per group and month."""
    chosen = F.sum(F.when(F.col(month).isin(*months), F.col(value)))
    return profile.groupBy(group).agg(percent(chosen, F.sum(value)).alias("pct"))


def seasonality_order(profile: DataFrame, group: str, month: str, value: str) -> DataFrame:
    """Peaks and troughs of the groups with their place, 1 for the most seasonal (highest peak).

    The window runs over one row per group.
    """
    peaks = peak_and_trough(profile, group, month, value)
    place = F.row_number().over(Window.orderBy(F.col("peak_value").desc(), F.col(group)))
    return peaks.withColumn("puesto", place).orderBy("puesto")


def month_against_month(
    profile: DataFrame, group: str, month: str, value: str, first: int, second: int
) -> DataFrame:
    """Shares of two months of each group, their difference and whether the first is above."""
    of = lambda m: F.max(F.when(F.col(month) == m, F.col(value)))
    both = profile.filter(F.col(month).isin(first, second)).groupBy(group)
    pair = both.agg(of(first).alias("pct_a"), of(second).alias("pct_b"))
    known = pair.filter(F.col("pct_a").isNotNull() & F.col("pct_b").isNotNull())
    return known.select(
        group, "pct_a", "pct_b", (F.col("pct_a") - F.col("pct_b")).alias("diferencia"),
        (F.col("pct_a") > F.col("pct_b")).alias("supera"),
    )


def seasonality_extremes(profile: DataFrame, group: str, month: str, value: str) -> DataFrame:
    """Most and least seasonal group as one row; the first group in order wins a tie."""
    peaks = peak_and_trough(profile, group, month, value)
    ends = peaks.agg(
        F.min(F.struct(-F.col("peak_value"), F.col(group).alias("g"))).alias("_top"),
        F.max(F.struct(-F.col("peak_value"), F.col(group).alias("g"))).alias("_bottom"),
    )
    return ends.select(
        F.col("_top.g").alias("mas_estacional"), F.col("_bottom.g").alias("mas_repartido")
    )


def two_month_swing(
    df: DataFrame, group: str | None, year: str, month: str, value: str, high: int, low: int
) -> DataFrame:
    """Volume of two months of each year and the change between them in percent."""
    keys = [year] if group is None else [group, year]
    a = F.sum(F.when(F.col(month) == high, F.col(value)))
    b = F.sum(F.when(F.col(month) == low, F.col(value)))
    return (
        df.filter(F.col(month).isin(high, low))
        .groupBy(*keys)
        .agg(a.alias("alto"), b.alias("bajo"))
        .withColumn("cambio", percent(F.col("alto") - F.col("bajo"), F.col("bajo")))
    )


def change_against_base(annual: DataFrame, year: str, index: str = "indice") -> DataFrame:
    """Every group in the last year with its change against the base year in percent."""
    last = annual.agg(F.max(year)).scalar()
    return annual.filter(F.col(year) == last).withColumn("frente_a_base", F.col(index) - 100)


def below_base(annual: DataFrame, year: str, index: str = "indice") -> DataFrame:
    """Groups of the last year still under the base, with their distance to it."""
    return change_against_base(annual, year, index).filter(F.col(index) < 100)


def against_group(df: DataFrame, group: str, order: str, value: str, other: str) -> DataFrame:
    """Latest value of each group next to the latest value of a reference group."""
    latest = latest_per_group(df, [group], [order])
    reference = latest.filter(F.col(group) == other).agg(F.max(value)).scalar()
    return latest.withColumn("referencia", reference).withColumn(
        "diferencia", F.col(value) - F.col("referencia")
    )


def period_text(df: DataFrame, key: str) -> DataFrame:
    """First and last ``YYYYMM`` key of a table as text."""
    return df.agg(F.min(key).alias("_a"), F.max(key).alias("_b")).select(
        key_text("_a").alias("desde"), key_text("_b").alias("hasta")
    )
