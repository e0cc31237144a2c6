"""Coordinate text -> signed degrees (PRJ-03, PRJ-04)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from isotherm.functions.text import ColumnOrName, _c


def signed_coordinate(c: ColumnOrName, positive: str = "N", negative: str = "S") -> Column:
    """Strict parser: ``^[0-9]+(\\.[0-9]+)?[PN]$`` after BTRIM, case sensitive.

    Anything else (wrong letter, lower case, junk) becomes NULL.
    """
    text = F.trim(_c(c))
    pattern = rf"^[0-9]+(\.[0-9]+)?[{positive}{negative}]$"
    magnitude = F.substring(text, F.lit(1), F.length(text) - 1).try_cast("double")
    sign = F.when(F.substring(text, -1, 1) == negative, F.lit(-1.0)).otherwise(F.lit(1.0))
    return F.when(text.rlike(pattern), magnitude * sign)


def parse_coordinate(c: ColumnOrName, allowed: str = "NS", negative: str = "S") -> tuple[Column, Column]:
    """Lenient parser: strip all whitespace, upper-case, any of NSEW accepted by the
    pattern, but a letter outside ``allowed`` gives NULL.  Returns ``(value, invalid_format)``
    where ``invalid_format`` is true when text was present but did not parse."""
    raw = _c(c)
    text = F.upper(F.regexp_replace(raw, r"^\s+|\s+$", ""))
    pattern = r"^([0-9]+(?:\.[0-9]+)?)([NSEW])$"
    matched = text.rlike(pattern)
    magnitude = F.when(matched, F.regexp_extract(text, pattern, 1).try_cast("double"))
    direction = F.when(matched, F.regexp_extract(text, pattern, 2))
    valid_direction = F.coalesce(direction.isin(*list(allowed)), F.lit(False))
    signed = F.when(valid_direction,
                    F.when(direction.isin(*list(negative)), -magnitude).otherwise(magnitude))
    invalid = raw.isNotNull() & (magnitude.isNull() | ~valid_direction)
    return signed, invalid
