"""Column helpers shared by the operators.

All of them return plain ``Column`` expressions built from Spark functions, so they are
optimised and code-generated with the query that uses them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- dates and period keys -----------------------------------------------------------


def month_start(year: Column | str, month: Column | str) -> Column:
    """First day of a month given as two numbers."""
    return F.make_date(_col(year).cast("int"), _col(month).cast("int"), F.lit(1))


def month_of(date: Column | str) -> Column:
    """First day of the month that contains a date or timestamp."""
    return F.trunc(_col(date).cast("date"), "MM")


def month_key(date: Column | str) -> Column:
    """``YYYYMM`` as an integer."""
    return (F.year(_col(date)) * 100 + F.month(_col(date))).cast("int")


def month_text(date: Column | str) -> Column:
    """``YYYY-MM`` as text."""
    return F.date_format(_col(date).cast("date"), "yyyy-MM")


def key_text(key: Column | str) -> Column:
    """``YYYYMM`` integer to ``YYYY-MM`` text."""
    k = _col(key).cast("int")
    return F.format_string("%d-%02d", F.floor(k / 100).cast("int"), (k % 100).cast("int"))


def month_gap(later: Column | str, earlier: Column | str) -> Column:
    """Whole calendar months between the months of two dates."""
    a, b = _col(later), _col(earlier)
    return ((F.year(a) - F.year(b)) * 12 + F.month(a) - F.month(b)).cast("int")


def month_name(month: Column | str, names: Sequence[str]) -> Column:
    """Name of a month number; independent of any locale."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), _col(month).cast("int"))


# --- secrecy, provisional data, labels -----------------------------------------------


def mask_secret(value: Column | str, secret: Column | str) -> Column:
    """A confidential value is unknown, not zero. An unset flag does not hide the value."""
    return F.when(_col(secret), F.lit(None)).otherwise(_col(value))


def is_code(code: Column | str, expected: int) -> Column:
    return _col(code) == F.lit(expected)


def is_broken_down(level: Column | str, name: Column | str, leaf_level: str, suffix: str) -> Column:
    """False only for leaf members whose label carries the «not broken down» suffix."""
    return (_col(level) != F.lit(leaf_level)) | ~_col(name).endswith(suffix)


def split_marker(label: Column | str, chars: str = "*#") -> tuple[Column, Column]:
    """Split trailing footnote marks from a label: ``(clean label, has mark)``.

    The two patterns differ on purpose: a mark followed by blanks counts as a mark but is
    left in the label.
    """
    c = _col(label)
    clean = F.trim(F.regexp_replace(c, f" *[{chars}]+$", ""))
    return clean, c.rlike(f"[{chars}] *$")


def capitalised(label: Column | str, suffix: str = "") -> Column:
    """Upper-case the first letter only, then append a suffix."""
    c = _col(label)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substr(c, F.lit(2)), F.lit(suffix))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def lookup(key: Column | str, mapping: Mapping[str, str]) -> Column:
    """Value of a small fixed dictionary, NULL when the key is not in it."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), _col(key))


def label_by(key: Column | str, mapping: Mapping[str, str], default: str) -> Column:
    """Group label of a key with a default for the rest (NULL keys included)."""
    return F.coalesce(lookup(key, mapping), F.lit(default))


def entry_of(entries: Column | str, key: str, key_field: str, value_field: str) -> Column:
    """Value of a key in an array of key/value structs; the last one wins, as in a dictionary.

    Reversed arrays and a position instead of a lambda per element: generated code.
    """
    keys, values = F.reverse(_col(entries)[key_field]), F.reverse(_col(entries)[value_field])
    found = F.nullif(F.array_position(keys, F.lit(key)), F.lit(0).cast("bigint"))
    return F.try_element_at(values, found.cast("int"))


def join_texts(items: Column | str, field: str, separator: str = " | ") -> Column:
    """Texts of an array of structs in one string; NULL array gives NULL."""
    return F.array_join(F.transform(_col(items), lambda n: n[field]), separator)


# --- numbers -------------------------------------------------------------------------


def to_count(c: Column | str) -> Column:
    """Double to bigint, ties to even."""
    return F.bround(_col(c)).cast("bigint")


def cents(c: Column | str) -> Column:
    """Money as whole cents: sums are exact and do not depend on the order of rows."""
    return F.rint(_col(c) * 100).cast("bigint")


def ratio(a: Column, b: Column) -> Column:
    """``a / b`` as double, NULL when ``b`` is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def percent(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double") * 100, b.cast("double"))


def number(text: Column | str, decimal: str = ".", thousands: str = ",") -> Column:
    """Number from published text; anything that is not a number becomes NULL."""
    c = F.trim(_col(text))
    if thousands:
        c = F.replace(c, F.lit(thousands), F.lit(""))
    if decimal != ".":
        c = F.replace(c, F.lit(decimal), F.lit("."))
    return F.when(c.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), c.try_cast("double"))


def any_published(*measures: Column | str) -> Column:
    """True when at least one measure has a value."""
    return reduce(or_, [_col(m).isNotNull() for m in measures])


def tolerance(reference: Column, absolute: float, relative: float) -> Column:
    """Allowed difference: an absolute floor or a share of the reference, the larger."""
    return F.greatest(F.lit(float(absolute)), F.lit(float(relative)) * reference)


def beyond(left: Column, right: Column, absolute: float, relative: float) -> Column:
    """Difference above both the absolute and the relative tolerance."""
    gap = F.abs(left - right)
    return (gap > F.lit(absolute)) & (gap > F.lit(relative) * left)
