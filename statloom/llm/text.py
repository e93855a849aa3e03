"""Text expressions and row identity shared by the operators of this package (built-in functions only)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of all word rules: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"\x20\x09-\x0D"
_TRIM = " \t\n\x0b\f\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once per row, however often the body reads it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Words ``[^ws]+`` of a text; NULL and blank texts have none.

    All white space becomes a blank first: splitting at one fixed character needs no regular expression.
    """
    flat = F.coalesce(text, F.lit(""))
    for ch in _TRIM[1:]:
        flat = F.replace(flat, F.lit(ch), F.lit(" "))
    return F.array_remove(F.split(flat, " "), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def without_space(text: Column) -> Column:
    """The text without any white space; NULL counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for ch in _TRIM:
        out = F.replace(out, F.lit(ch), F.lit(""))
    return out


def hex32(column: Column, first: int = 1) -> Column:
    """Eight hexadecimal digits as a number below 2**32."""
    return F.conv(F.substring(column, first, 8), 16, 10).cast("long")


def text_key(text: Column) -> Column:
    """64-bit digest of a text that, with the id, identifies a row (repeated rows share it)."""
    return F.xxhash64(text)
