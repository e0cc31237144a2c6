"""Text normalisation (PRJ-01, PRJ-02, PRJ-16, SCA-01, SCA-02, SCA-10)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: ColumnOrName) -> Column:
    """SQL ``NULLIF(BTRIM(c), '')``: strips spaces only (not tabs)."""
    return F.nullif(F.trim(_c(c)), F.lit(""))


def squeeze_text(c: ColumnOrName) -> Column:
    """Strip all whitespace at both ends, collapse inner runs to one space, '' -> NULL."""
    squeezed = F.regexp_replace(_c(c), r"\s+", " ")
    return F.nullif(F.trim(squeezed), F.lit(""))


def compose_label(name: ColumnOrName, group: ColumnOrName) -> Column:
    """Display key ``"City (Country)"``."""
    return F.concat(_c(name), F.lit(" ("), _c(group), F.lit(")"))


def split_label(label: ColumnOrName) -> tuple[Column, Column]:
    """Inverse of :func:`compose_label`: split at the last ``" ("`` and drop ``")"``."""
    pattern = r"^(.*) \((.*)\)$"
    lab = _c(label)
    ok = lab.rlike(pattern)
    name = F.when(ok, F.regexp_extract(lab, pattern, 1))
    group = F.when(ok, F.regexp_extract(lab, pattern, 2))
    return name, group


def join_reasons(*conditions_and_reasons: tuple[Column, str], sep: str = "; ") -> Column:
    """``"; "``-joined reasons of the true conditions, in the given order ('' when none)."""
    parts = [F.when(F.coalesce(cond, F.lit(False)), F.lit(reason))
             for cond, reason in conditions_and_reasons]
    return F.concat_ws(sep, *parts)
