"""Cleaning of the enriched view into the clean table (FLT-03, FLT-04, PRJ-08, PRJ-09,
WIN-14, AGG-21, DQ-15..23)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isotherm.functions.safe import negative_to_null
from isotherm.operators.quality import calendar_consistency
from isotherm.operators.quantiles import iqr_fences
from isotherm.session import written

BUSINESS_KEY = ["observation_date", "city_name", "country_name", "latitude", "longitude"]
MATCH_COLUMNS = ["country_matched", "global_matched", "major_city_matched"]
CRITICAL = [*BUSINESS_KEY, "is_major_city", "city_average_temperature", *MATCH_COLUMNS]
UNCERTAINTY = ["city_average_temperature_uncertainty", "country_average_temperature_uncertainty",
               "land_average_temperature_uncertainty", "land_max_temperature_uncertainty",
               "land_min_temperature_uncertainty", "land_and_ocean_average_temperature_uncertainty",
               "major_city_average_temperature_uncertainty"]
# Physical domain of the core columns.
DOMAIN = {"latitude": (-90.0, 90.0), "longitude": (-180.0, 180.0), "city_average_temperature": (-90.0, 60.0)}


@dataclass
class CleanSpec:
    target: str = "city_average_temperature"
    key: Sequence[str] = field(default_factory=lambda: list(BUSINESS_KEY))
    critical: Sequence[str] = field(default_factory=lambda: list(CRITICAL))
    uncertainty: Sequence[str] = field(default_factory=lambda: list(UNCERTAINTY))
    domain: Mapping[str, tuple[float, float]] = field(default_factory=lambda: dict(DOMAIN))
    iqr_k: float = 1.5


def availability_flags(df: DataFrame) -> DataFrame:
    """PRJ-08: matched AND value present (a matched row may carry a NULL value)."""
    return df.select(
        "*",
        F.col("city_average_temperature_uncertainty").isNotNull().alias("city_uncertainty_available"),
        (F.coalesce(F.col("country_matched"), F.lit(False)) & F.col("country_average_temperature").isNotNull())
        .alias("country_temperature_available"),
        (F.coalesce(F.col("global_matched"), F.lit(False)) & F.col("land_average_temperature").isNotNull())
        .alias("global_temperature_available"),
        (F.coalesce(F.col("major_city_matched"), F.lit(False)) & F.col("major_city_average_temperature").isNotNull())
        .alias("major_city_temperature_available"))


def keep_first(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """WIN-14: one row per key; among duplicates the smallest remaining row (a full, stable tie-break).

    ``min(struct)`` is a partial aggregate: duplicates of a hot key are reduced inside
    each task before the shuffle, unlike ``row_number`` over a key window.
    """
    rest = [c for c in df.columns if c not in key]
    return (df.groupBy(*key).agg(F.min(F.struct(*rest)).alias("__r"))
            .select(*key, *[F.col(f"__r.{c}").alias(c) for c in rest])
            .select(*df.columns))


def domain_ok(domain: Mapping[str, tuple[float, float]]) -> Column:
    conds = [F.coalesce(F.col(c).between(lo, hi), F.lit(False)) for c, (lo, hi) in domain.items()]
    return reduce(lambda a, b: a & b, conds) & F.coalesce(calendar_consistency(), F.lit(False))


def clean(enriched: DataFrame, spec: CleanSpec = CleanSpec()) -> DataFrame:
    """Critical NULLs dropped, availability flags, duplicates removed (keep first), core domain
    enforced, negative uncertainties -> NULL, IQR outlier flag (rows kept).  32 columns."""
    crit = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in spec.critical])
    df = enriched.where(crit)
    df = keep_first(df, spec.key)
    df = df.where(domain_ok(spec.domain))
    df = df.select(*[negative_to_null(c).alias(c) if c in spec.uncertainty else F.col(c) for c in df.columns])
    df = written(availability_flags(df), "clean-rows")  # read twice: the duplicates are found once
    fences = iqr_fences(df, spec.target, spec.iqr_k)  # one row: cross join is a broadcast
    t = F.col(spec.target)
    return (df.crossJoin(F.broadcast(fences.select("lower_fence", "upper_fence")))
            .withColumn("city_temperature_iqr_outlier", (t < F.col("lower_fence")) | (t > F.col("upper_fence")))
            .drop("lower_fence", "upper_fence"))


def cleaning_report(before: DataFrame, spec: CleanSpec = CleanSpec()) -> DataFrame:
    """DQ-19/DQ-20/DQ-21: counts of every cleaning step in one pass over the enriched view."""
    crit = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in spec.critical])
    neg = reduce(lambda a, b: a + b, [F.when(F.col(c) < 0, 1).otherwise(0) for c in spec.uncertainty])
    cells = reduce(lambda a, b: a + b, [F.col(f"`{c}`").isNull().cast("long") for c in before.columns])
    return before.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.lit(len(before.columns)).cast("long").alias("columns_before"),
        F.sum(cells).cast("long").alias("missing_cells_before"),
        F.count_if(crit).alias("critical_missing_rows"),
        (F.count(F.lit(1)) - F.count_distinct(F.struct(*spec.key))).alias("duplicate_key_rows"),
        F.count_if(~crit & ~domain_ok(spec.domain)).alias("invalid_core_rows"),
        F.sum(neg).cast("long").alias("negative_uncertainty_values"))
