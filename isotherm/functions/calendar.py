"""Calendar parts and month arithmetic (PRJ-06, PRJ-07, SCA-03)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from isotherm.functions.text import ColumnOrName, _c


def month_start(c: ColumnOrName) -> Column:
    """First day of the month as a DATE (works for date, timestamp and timestamp_ntz)."""
    return F.trunc(F.to_date(_c(c)), "MM")


def decade(date_col: ColumnOrName) -> Column:
    """``year / 10 * 10`` with integer division, as bigint."""
    return (F.year(_c(date_col)).cast("long") / 10).cast("long") * 10


def calendar_parts(date_col: ColumnOrName) -> dict[str, Column]:
    d = _c(date_col)
    return {
        "year": F.year(d).cast("long"),
        "month": F.month(d).cast("long"),
        "quarter": F.quarter(d).cast("long"),
        "decade": decade(d),
    }


def month_index(date_col: ColumnOrName) -> Column:
    """Months since year 0: ``12 * year + month`` (bigint); consecutive months differ by 1."""
    d = _c(date_col)
    return F.year(d).cast("long") * 12 + F.month(d).cast("long")


def add_months_index(index_col: ColumnOrName, n: int | Column) -> Column:
    return _c(index_col) + (n if isinstance(n, Column) else F.lit(n))


def index_to_date(index_col: ColumnOrName) -> Column:
    """Inverse of :func:`month_index` (first of month)."""
    idx = _c(index_col) - 1
    return F.make_date((idx / 12).cast("int"), (F.pmod(idx, F.lit(12)) + 1).cast("int"), F.lit(1))
