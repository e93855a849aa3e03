"""Classification of series by their metadata dictionaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.columns import lookup

OUTCOME = "_resultado"
DISCARDED = ""


class UnknownValue(ValueError):
    """The metadata carry a value that no dictionary can classify."""


@dataclass(frozen=True)
class Discard:
    """Leave out the rows that meet a condition."""

    condition: Column

    def outcome(self, code: str) -> Column:
        return F.when(self.condition, F.lit(DISCARDED))

    def value(self) -> Column | None:
        return None


@dataclass(frozen=True)
class Translate:
    """Translate a source value; a value outside the dictionary is an error.

    ``absent`` is the result for a missing value; without it a missing value is an error too.
    ``when`` limits the rule to some rows.
    """

    out: str
    source: Column
    values: Mapping[str, str]
    what: str
    absent: str | None = None
    when: Column | None = None

    def outcome(self, code: str) -> Column:
        unknown = lookup(self.source, self.values).isNull()
        if self.absent is not None:
            unknown = unknown & self.source.isNotNull()
        if self.when is not None:
            unknown = unknown & self.when
        shown = F.coalesce(self.source, F.lit("(none)"))
        return F.when(unknown, F.concat(F.lit(f"unknown {self.what} in "), F.col(code), F.lit(": "), shown))

    def value(self) -> Column:
        found = lookup(self.source, self.values)
        if self.absent is not None:
            found = F.coalesce(found, F.lit(self.absent))
        return found if self.when is None else F.when(self.when, found)


def classify(df: DataFrame, code: str, steps: Sequence[Discard | Translate]) -> DataFrame:
    """Apply the steps in order; the first one that objects decides what happens to a row.

    Works row by row with dictionary literals: no shuffle. The ``_resultado`` column is NULL
    for a classified row, empty for a discarded one and a message for an unknown value.
    Several translations into the same column complete each other.
    """
    values: dict[str, Column] = {}
    for step in steps:
        if isinstance(step, Translate):
            v = step.value()
            values[step.out] = F.coalesce(values[step.out], v) if step.out in values else v
    outcome = F.coalesce(*[s.outcome(code) for s in steps])
    return df.withColumns({**values, OUTCOME: outcome})


def classified(df: DataFrame) -> DataFrame:
    return df.filter(F.col(OUTCOME).isNull()).drop(OUTCOME)


def unknown_values(df: DataFrame) -> DataFrame:
    """Messages of the rows that could not be classified."""
    return df.filter(F.col(OUTCOME) != DISCARDED).select(OUTCOME)


def reject_unknown(df: DataFrame, sample: int = 10) -> DataFrame:
    """Classified rows, or an error with a short sample of the unknown values."""
    bad = unknown_values(df).orderBy(OUTCOME).limit(sample).collect()
    if bad:
        raise UnknownValue("; ".join(r[0] for r in bad))
    return classified(df)
