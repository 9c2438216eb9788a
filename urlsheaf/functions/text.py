"""Small text helpers shared by the column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only blanks.  Touches the ends only."""
    return F.btrim(text.cast("string"), F.lit(WHITE_SPACE))


def nonempty(text: Column) -> Column:
    """The text, or null when it is empty."""
    return F.nullif(text, F.lit(""))


def whole_quotient(value: Column, divisor: Column) -> Column:
    """Integer division that stays in 64-bit integers."""
    return F.call_function("div", value, divisor)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
