"""Null-safe arithmetic and coercing casts (PRJ-05, PRJ-09, PRJ-10, SCA-05, SCA-07)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from isotherm.functions.text import ColumnOrName, _c


def safe_divide(num: ColumnOrName, den: ColumnOrName) -> Column:
    """NULL when the denominator is 0 or NULL (ANSI ``/`` would raise)."""
    return F.try_divide(_c(num), F.nullif(_c(den), F.lit(0)))


def negative_to_null(c: ColumnOrName) -> Column:
    return F.when(_c(c) >= 0, _c(c))


def inf_to_null(c: ColumnOrName) -> Column:
    v = _c(c)
    return F.when(v.isin(float("inf"), float("-inf")) | F.isnan(v), F.lit(None).cast("double")).otherwise(v)


def try_double(c: ColumnOrName) -> Column:
    return _c(c).try_cast("double")


def try_date(c: ColumnOrName, fmt: str = "yyyy-MM-dd") -> Column:
    return F.try_to_date(_c(c).cast("string"), fmt) if fmt else _c(c).try_cast("date")


def is_false(c: ColumnOrName) -> Column:
    """SQL ``IS FALSE``: NULL is not false."""
    return _c(c).eqNullSafe(F.lit(False))
