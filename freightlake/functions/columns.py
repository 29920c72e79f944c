"""Column helpers for the null and rounding rules the model relies on."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def is_in(column: Column | str, values: Iterable) -> Column:
    """Set membership that is false, never NULL, for a NULL value."""
    values = list(values)
    if not values:
        return F.lit(False)
    return F.coalesce(as_column(column).isin(values), F.lit(False))


def half_even(column: Column | str, places: int = 0) -> Column:
    """Round a double half to even.

    ``rint`` stays in generated code; ``bround`` with decimals goes through
    BigDecimal for every row.
    """
    column = as_column(column)
    if places == 0:
        return F.rint(column)
    scale = F.lit(float(10**places))
    return F.rint(column * scale) / scale


def settled(column: Column | str) -> Column:
    """Drop floating-point noise beyond the ninth decimal.

    Applied before a whole-number rounding or a threshold test, so that a
    value which is exactly on the edge in exact arithmetic is treated as such
    whatever the order in which its terms were added.
    """
    return half_even(column, 9)


def to_int(column: Column | str) -> Column:
    """Text or number to int: decimals are cut off, junk becomes NULL."""
    return as_column(column).try_cast("double").try_cast("int")


def sum_or_null(column: Column | str) -> Column:
    """Sum that is NULL when any input is NULL."""
    column = as_column(column)
    return F.when(F.count(column) == F.count(F.lit(1)), F.sum(column))


def _all_present(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])


def lowest(*columns: Column | str) -> Column:
    """Row minimum, NULL if any argument is NULL."""
    columns = [as_column(c) for c in columns]
    return F.when(_all_present(columns), F.least(*columns))


def highest(*columns: Column | str) -> Column:
    """Row maximum, NULL if any argument is NULL."""
    columns = [as_column(c) for c in columns]
    return F.when(_all_present(columns), F.greatest(*columns))
