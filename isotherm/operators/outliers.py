"""Outlier study on the clean table (AGG-33..38, PRJ-11..13)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.functions.labels import (hemisphere, internal_assessment, meteorological_season,
                                       outlier_side, seasonal_review_flag)
from isotherm.operators.quantiles import iqr_fences

LOCATION = ["country_name", "city_name", "latitude", "longitude"]


def label_outliers(clean: DataFrame, target: str = "city_average_temperature", k: float = 1.5) -> DataFrame:
    """Flagged rows with hemisphere, season, Low/High side, seasonal review flag and assessment."""
    fences = iqr_fences(clean, target, k).select("lower_fence")
    out = clean.where("city_temperature_iqr_outlier").crossJoin(F.broadcast(fences))
    coord_ok = (F.coalesce(F.col("latitude").between(-90, 90), F.lit(False))
                & F.coalesce(F.col("longitude").between(-180, 180), F.lit(False)))
    out = out.select(
        *LOCATION, "observation_date", "month", target,
        hemisphere("latitude").alias("hemisphere"),
        meteorological_season("month", "latitude").alias("season"),
        outlier_side(target, "lower_fence").alias("outlier_side"),
        coord_ok.alias("coordinate_valid"))
    out = out.withColumn("seasonal_review_flag", seasonal_review_flag("outlier_side", "season", "latitude"))
    return out.withColumn("internal_assessment", internal_assessment("coordinate_valid", "seasonal_review_flag"))


def location_summary(labelled: DataFrame, target: str = "city_average_temperature",
                     location: Sequence[str] = LOCATION) -> DataFrame:
    """count, min, max, mean, first/last date and most common month (ties: smaller month) (AGG-33).

    The month mode is ``min(struct(-count, month))`` over (location, month) counts: a
    partial aggregate, no per-location sort.
    """
    loc = list(location)
    per_month = labelled.groupBy(*loc, "month").agg(F.count(F.lit(1)).alias("n"))
    mode = per_month.groupBy(*loc).agg(F.min(F.struct((-F.col("n")).alias("neg"), F.col("month").alias("m")))
                                       .alias("__mode"))
    summ = labelled.groupBy(*loc).agg(
        F.count(F.lit(1)).alias("outlier_count"), F.min(target).alias("minimum_temperature"),
        F.max(target).alias("maximum_temperature"), F.avg(target).alias("mean_temperature"),
        F.min("observation_date").alias("first_outlier_date"), F.max("observation_date").alias("last_outlier_date"))
    return summ.join(mode, loc).select(
        *loc, "outlier_count", "minimum_temperature", "maximum_temperature", "mean_temperature",
        "first_outlier_date", "last_outlier_date", F.col("__mode.m").alias("most_common_outlier_month"),
        (-F.col("__mode.neg")).alias("outlier_count_in_month"))


def month_side_grid(labelled: DataFrame, sides: Sequence[str] = ("Low", "High")) -> DataFrame:
    """AGG-34 + AGG-36: counts per (month, side) pivoted to columns; all 12 months, zero-filled."""
    spark = labelled.sparkSession
    months = spark.range(1, 13).select(F.col("id").alias("month"))
    piv = labelled.groupBy("month").pivot("outlier_side", list(sides)).agg(F.count(F.lit(1)))
    out = months.join(piv, "month", "left").na.fill(0, list(sides))
    return out.select("month", *[F.col(s).cast("long").alias(s.lower()) for s in sides])


def coordinate_variants(df: DataFrame) -> DataFrame:
    """Distinct lat / lon per (country, city); flag more than one (AGG-37)."""
    v = df.groupBy("country_name", "city_name").agg(
        F.count_distinct("latitude").alias("latitude_variants"),
        F.count_distinct("longitude").alias("longitude_variants"))
    return v.withColumn("multiple_coordinates", (F.col("latitude_variants") > 1) | (F.col("longitude_variants") > 1))
