"""Query registry: Spark callables + DuckDB oracle SQL, kept side by side.

``register(name, sql, round_cols)`` records a ``(spark, sf_dir) -> DataFrame``
function.  The listed double columns are rounded identically on both sides
(floating sums are order-dependent in the last bits); integer-like columns are
widened to bigint and floats to double so both engines agree on types.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isotherm.plans.oracle_sources import rounded


@dataclass
class Entry:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    round_cols: Sequence[str] = field(default_factory=tuple)
    digits: int = 6
    ids: str = ""


REGISTRY: dict[str, Entry] = {}

# Rounded columns are snapped to a 2**-20 grid (about 1e-6).  Decimal-valued data
# (prices in cents) often averages to an exact decimal tie such as ``x.xxxxxx5``,
# where two engines that differ in the last bit round apart; such data cannot sit
# exactly on a binary half-step, so both engines land on the same grid point.
GRID_BITS = 20


def normalise_types(df: DataFrame, round_cols: Sequence[str] = (), digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.FloatType, T.DecimalType)):
            c = c.cast("double")
        if f.name in round_cols:
            scale = F.lit(float(2 ** GRID_BITS))
            c = F.round(c.cast("double") * scale) / scale + F.lit(0.0)  # + 0.0 turns -0.0 into 0.0
        cols.append(c.alias(f.name))
    return df.select(*cols)


def register(name: str, sql: str | None = None, round_cols: Sequence[str] = (), digits: int = 6,
             ids: str = ""):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql, tuple(round_cols), digits, ids)
        return fn
    return deco


def spark_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    e = REGISTRY[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return normalise_types(e.fn(spark, sf_dir), e.round_cols, e.digits)
    run.__name__ = name
    return run


def oracle(name: str) -> str | None:
    e = REGISTRY[name]
    if e.sql is None:
        return None
    return rounded(e.sql, e.round_cols, e.digits)
