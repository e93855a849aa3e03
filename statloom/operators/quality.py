"""Quality checks. Every check is a DataFrame of offending rows: none means passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions.columns import month_gap

ERROR = "error"
WARN = "warn"


class QualityError(ValueError):
    """At least one blocking check failed."""


class ContractError(ValueError):
    """A table does not have the declared columns, types or required values."""


# --- rules on one row -----------------------------------------------------------------
# A rule is a boolean Column that is true for an offending row.


def is_missing(col: str) -> Column:
    return F.col(col).isNull()


def is_outside(col: str, values: Sequence) -> Column:
    return F.col(col).isNotNull() & ~F.col(col).isin(*values)


def is_negative(col: str, where: Column | None = None) -> Column:
    bad = F.col(col) < 0
    return bad if where is None else where & bad


def is_out_of_range(col: str, low: float, high: float) -> Column:
    return (F.col(col) < low) | (F.col(col) > high)


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(is_missing(col))


def check_accepted(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Unexpected values with their frequency."""
    return df.filter(is_outside(col, values)).groupBy(col).agg(F.count(F.lit(1)).alias("filas"))


def check_non_negative(df: DataFrame, col: str, where: Column | None = None) -> DataFrame:
    return df.filter(is_negative(col, where))


def check_range(df: DataFrame, col: str, low: float, high: float) -> DataFrame:
    return df.filter(is_out_of_range(col, low, high))


def rule_failures(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Failures of many row rules in one pass over the table: ``(prueba, fallos)``."""
    counts = df.agg(*[F.count_if(rule).alias(f"_{i}") for i, rule in enumerate(rules.values())])
    rows = [
        F.struct(F.lit(name).alias("prueba"), F.col(f"_{i}").alias("fallos"))
        for i, name in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*rows)))


# --- checks on keys -------------------------------------------------------------------


def check_unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once (the grain of the table)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("filas")).filter("filas > 1")


def check_unique_values(df: DataFrame, col: str) -> DataFrame:
    """Repeated values of one column; NULLs do not count."""
    return check_unique(df.filter(F.col(col).isNotNull()), [col])


def _keys(df: DataFrame, col: str, name: str) -> DataFrame:
    return df.select(F.col(col).alias(name)).distinct()


def check_relationship(
    df: DataFrame, col: str, to: DataFrame, field: str, rows: str | None = None
) -> DataFrame:
    """Keys without a row in the parent, with the number of rows that use them.

    ``rows`` is a column that says how many rows each row of ``df`` stands for.

    Both sides are reduced to their keys before the join, so a frequent key reaches it as one
    row on either side; the join reuses the partitioning of the two aggregates.
    """
    count = F.count(F.lit(1)) if rows is None else F.sum(rows)
    used = df.filter(F.col(col).isNotNull()).groupBy(col).agg(count.alias("filas"))
    return used.join(_keys(to, field, col), col, "left_anti")


def missing_keys(
    expected: DataFrame, col: str, found: DataFrame, field: str | None = None
) -> DataFrame:
    """Expected keys with no data."""
    return _keys(expected, col, col).join(_keys(found, field or col, col), col, "left_anti")


def sample_of(df: DataFrame, *order: str, limit: int = 10) -> DataFrame:
    """A short ordered sample of offending keys for a report."""
    return df.orderBy(*order).limit(limit)


def freshness(df: DataFrame, date: str, today: Column, max_months: int = 4) -> DataFrame:
    """Age in months of the latest date as one row ``(ultimo_mes, meses_de_retraso, vigente)``."""
    last = df.agg(F.max(date).cast("date").alias("ultimo_mes"))
    age = month_gap(today, F.col("ultimo_mes"))
    return last.select(
        "ultimo_mes",
        age.alias("meses_de_retraso"),
        F.coalesce(age <= max_months, F.lit(False)).alias("vigente"),
    )


# --- report and gate ------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """A named check: ``rows`` holds what offends, ``severity`` decides if it blocks."""

    name: str
    rows: DataFrame
    severity: str = ERROR


REPORT = T.StructType(
    [
        T.StructField("prueba", T.StringType()),
        T.StructField("gravedad", T.StringType()),
        T.StructField("fallos", T.LongType()),
        T.StructField("superada", T.BooleanType()),
    ]
)


def _verdict(counts: DataFrame, severity: Column) -> DataFrame:
    return counts.select(
        "prueba",
        severity.alias("gravedad"),
        "fallos",
        (F.col("fallos") == 0).alias("superada"),
    )


def rules_report(df: DataFrame, rules: Mapping[str, Column], severity: str = ERROR) -> DataFrame:
    """Report lines of the row rules of one table, from a single scan."""
    return _verdict(rule_failures(df, rules), F.lit(severity))


def observed_report(spark: SparkSession, failures: Mapping[str, int], severity: str = ERROR) -> DataFrame:
    """Report lines of row rules whose failures were counted while their table was written."""
    lines = [(name, severity, n, n == 0) for name, n in failures.items()]
    return spark.createDataFrame(lines, REPORT)


def quality_report(checks: Sequence[Check]) -> DataFrame:
    """One report line per check."""
    lines = [
        _verdict(
            c.rows.agg(F.count(F.lit(1)).alias("fallos")).select(
                F.lit(c.name).alias("prueba"), "fallos"
            ),
            F.lit(c.severity),
        )
        for c in checks
    ]
    return reduce(DataFrame.unionByName, lines)


def gate(spark: SparkSession, report: DataFrame) -> DataFrame:
    """Evaluate a report once and raise when a blocking check failed; warnings only show.

    The report has one row per declared check, whatever the size of the data.
    """
    rows = report.collect()
    failed = [f"{r.prueba} ({r.fallos})" for r in rows if r.gravedad == ERROR and not r.superada]
    if failed:
        raise QualityError("checks failed: " + ", ".join(sorted(failed)))
    return spark.createDataFrame(rows, REPORT)


# --- contracts ------------------------------------------------------------------------


def enforce(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Give a table its declared columns and order, or raise.

    Missing, extra or mistyped columns fail at once. NULLs in a required column fail when
    the row is read, so no separate pass over the data is needed.
    """
    found = {f.name: f.dataType for f in df.schema.fields}
    declared = {f.name: f.dataType for f in contract.fields}
    problems = [f"missing {n}" for n in declared if n not in found]
    problems += [f"unexpected {n}" for n in found if n not in declared]
    problems += [
        f"{n} is {found[n].simpleString()}, not {t.simpleString()}"
        for n, t in declared.items()
        if n in found and found[n] != t
    ]
    if problems:
        raise ContractError("; ".join(problems))
    required = F.raise_error(F.lit("contract: NULL in a required column"))
    return df.select(
        *[
            F.col(f.name)
            if f.nullable
            else F.when(F.col(f.name).isNull(), required.cast(f.dataType))
            .otherwise(F.col(f.name))
            .alias(f.name)
            for f in contract.fields
        ]
    )
