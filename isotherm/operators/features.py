"""Leakage-safe time-series features (WIN-03..11, WIN-17..21, FEA-04..17, JON-14..16).

Every per-location window is partitioned by the location key on the monthly
grain, so a partition holds at most one row per calendar month however many raw
readings a location has.  Zone- and global-level statistics are aggregated to
(zone, month index) first, windowed on that small frame and joined back.
Calendar lags use RANGE frames on an integer month index, so a missing month
yields NULL instead of silently taking an older row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isotherm.functions.calendar import month_index
from isotherm.functions.labels import climatic_month, latitude_zone, split_label_for_year

LOCATION = ["city_name", "country_name", "latitude", "longitude"]


def cyclic_features(df: DataFrame, month: str = "month", latitude: str = "latitude", year: str = "year",
                    start_year: int | None = None) -> DataFrame:
    """month sin/cos, climatic month + sin/cos, years since start, |lat|, hemisphere, interactions
    (FEA-04..08).  Interactions use the climatic (not calendar) angle.  Without ``start_year``
    the first year of the frame is used (a one-row aggregate, broadcast)."""
    ang = F.lit(2 * math.pi / 12)
    cm = climatic_month(month, latitude)
    if start_year is None:
        df = df.crossJoin(F.broadcast(df.agg(F.min(year).alias("__start"))))
        start = F.col("__start")
    else:
        start = F.lit(start_year)
    out = df.select(
        "*",
        F.sin(ang * F.col(month)).alias("month_sin"), F.cos(ang * F.col(month)).alias("month_cos"),
        cm.alias("climatic_month"),
        F.sin(ang * cm).alias("climatic_month_sin"), F.cos(ang * cm).alias("climatic_month_cos"),
        (F.col(year) - start).alias("years_since_start"),
        F.abs(latitude).alias("abs_latitude"), (F.col(latitude) >= 0).alias("hemisphere_north"))
    out = out.drop("__start")
    return out.select(
        "*", (F.col("abs_latitude") * F.col("climatic_month_sin")).alias("abslat_x_month_sin"),
        (F.col("abs_latitude") * F.col("climatic_month_cos")).alias("abslat_x_month_cos"),
        (F.col("abs_latitude") * F.col("years_since_start")).alias("abslat_x_years"))


def with_month_index(df: DataFrame, date_col: str = "observation_date") -> DataFrame:
    return df.withColumn("month_index", month_index(date_col))


def calendar_lag(value: str, k: int, key: Sequence[str], order: str = "month_index") -> Column:
    """Value at exactly ``order - k`` in the same series, NULL when that month is absent (WIN-07)."""
    w = Window.partitionBy(*key).orderBy(order).rangeBetween(-k, -k)
    return F.max(value).over(w)


def trailing_stats(value: str, key: Sequence[str], months: int = 12, min_obs: int = 6,
                   order: str = "month_index") -> tuple[Column, Column]:
    """Mean and sample std over months t-months .. t-1 (current excluded); NULL below ``min_obs`` (WIN-08)."""
    w = Window.partitionBy(*key).orderBy(order).rangeBetween(-months, -1)
    enough = F.count(value).over(w) >= min_obs
    return F.when(enough, F.avg(value).over(w)), F.when(enough, F.stddev_samp(value).over(w))


def past_only_stats(value: str, key: Sequence[str], order: str = "month_index") -> tuple[Column, Column, Column]:
    """Mean, sample std (NULL with < 2 past rows, variance clipped at 0) and count of strictly
    earlier rows (WIN-03, WIN-04).  Order values must be unique inside the key."""
    w = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    n = F.count(value).over(w)
    s = F.sum(value).over(w)
    ss = F.sum(F.col(value) * F.col(value)).over(w)
    mean = F.when(n > 0, s / n)
    var = (ss - s * s / n) / (n - 1)
    # greatest() skips NULL, so the n > 1 guard must wrap the sqrt, not the variance
    return mean, F.when(n > 1, F.sqrt(F.greatest(var, F.lit(0.0)))), n


def leave_one_out(value: str, key: Sequence[str]) -> tuple[Column, Column]:
    """(sum - x) / (n - 1) and the matching std from sums, NULL when n = 1 (WIN-05, WIN-06)."""
    w = Window.partitionBy(*key)
    x = F.col(value)
    n = F.count(value).over(w) - F.when(x.isNotNull(), 1).otherwise(0)
    s = F.sum(value).over(w) - F.coalesce(x, F.lit(0.0))
    ss = F.sum(x * x).over(w) - F.coalesce(x * x, F.lit(0.0))
    mean = F.when(n > 0, s / n)
    var = (ss - s * s / n) / (n - 1)
    return mean, F.when(n > 1, F.sqrt(F.greatest(var, F.lit(0.0))))


def split_columns(year: str, train_end: int, validation_end: int) -> list[Column]:
    lab = split_label_for_year(year, train_end, validation_end)
    return [lab.alias("data_split"), (F.col(year) <= train_end).alias("is_train_period")]


def _whole(cols: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def with_climatology(rows: DataFrame, levels_of: DataFrame, target: str, train_end: int, validation_end: int,
                     location: Sequence[str] = LOCATION) -> DataFrame:
    """``rows`` (location, year, month, month_index, target) with latitude_zone, data_split, is_train_period,
    loc_month_climatology and loc_climatology_imputed (see ``climatology``).

    The location's own train means are windows over its rows, not a join, so rows that lie by location
    are not shuffled again; zone and month means (48 and 12 rows) are aggregated from ``levels_of``, the
    same rows before any window."""
    loc = list(location)
    zone = latitude_zone(F.abs("latitude")).alias("latitude_zone")
    train = levels_of.where(F.col("year") <= train_end).select("month", target, zone)
    zm_fixed = train.groupBy("latitude_zone", "month").agg(F.avg(target).alias("__zmf"))
    gm_fixed = train.groupBy("month").agg(F.avg(target).alias("__gmf"))
    is_train = F.col("is_train_period")
    d = rows.select("*", zone, *split_columns("year", train_end, validation_end))
    lm_mean, _, _ = past_only_stats(target, loc + ["month"])
    l_mean, _, _ = past_only_stats(target, loc)
    lm_fixed = F.avg(F.when(is_train, F.col(target))).over(Window.partitionBy(*loc, "month"))
    # the windows by location come first: their exchange serves those by location and month as well
    d = (d.withColumn("__l", l_mean).withColumn("__lm", lm_mean).withColumn("__lmf", F.when(_whole([*loc, "month"]), lm_fixed))
         .join(F.broadcast(zm_fixed), ["latitude_zone", "month"], "left").join(F.broadcast(gm_fixed), ["month"], "left"))
    value = F.when(is_train, F.coalesce("__lm", "__l")).otherwise(
        F.coalesce("__lmf", "__zmf", "__gmf"))
    imputed = F.when(is_train, F.col("__lm").isNull()).otherwise(F.col("__lmf").isNull())
    return (d.withColumn("loc_month_climatology", value).withColumn("loc_climatology_imputed", imputed)
            .drop("__lm", "__lmf", "__l", "__zmf", "__gmf"))


def climatology(df: DataFrame, target: str, train_end: int, validation_end: int,
                location: Sequence[str] = LOCATION) -> DataFrame:
    """loc_month_climatology with two regimes (FEA-09, FEA-11, JON-16):

    * train rows: past-only mean of the same (location, month); else the location's
      past-only mean; else NULL;
    * later rows: the fixed train mean of (location, month); else zone-month; else
      global-month (train means).

    ``loc_climatology_imputed`` is true when the first level did not provide the value.  The rows are
    shuffled once, by location.
    """
    loc = list(location)
    d = with_month_index(df).select(*loc, "observation_date", "year", "month", "month_index", target)
    return with_climatology(d, d, target, train_end, validation_end, loc).select(
        *loc, "observation_date", "month_index", "data_split", "is_train_period", "latitude_zone",
        target, "loc_month_climatology", "loc_climatology_imputed")


def with_location_stats(rows: DataFrame, levels_of: DataFrame, target: str, train_end: int,
                        location: Sequence[str] = LOCATION) -> DataFrame:
    """``rows`` with loc_mean_temperature, loc_temperature_std (see ``location_stats``) and ``__n``, the past rows'
    count; windows over a location's rows, as in ``with_climatology``."""
    loc = list(location)
    zone = latitude_zone(F.abs("latitude")).alias("__zone")
    train = levels_of.where(F.col("year") <= train_end).select(target, zone)

    def level(suffix, *keys):
        return train.groupBy(*keys).agg(F.avg(target).alias(f"__m{suffix}"), F.stddev_samp(target).alias(f"__s{suffix}"))
    is_train = F.col("year") <= train_end
    m, s, n = past_only_stats(target, loc)
    own, known = F.when(is_train, F.col(target)), _whole(loc)
    whole = Window.partitionBy(*loc)
    j = (rows.select("*", zone, m.alias("__m"), s.alias("__s"), n.alias("__n"), F.when(known, F.avg(own).over(whole)).alias("__mf"),
                     F.when(known, F.stddev_samp(own).over(whole)).alias("__sf"))
         .join(F.broadcast(level("z", "__zone")), "__zone", "left")  # four zones
         .crossJoin(F.broadcast(level("g"))))
    return j.select(*rows.columns, "__n",
                    F.when(is_train, F.col("__m")).otherwise(F.coalesce("__mf", "__mz", "__mg")).alias("loc_mean_temperature"),
                    F.when(is_train, F.col("__s")).otherwise(F.coalesce("__sf", "__sz", "__sg")).alias("loc_temperature_std"))


def location_stats(df: DataFrame, target: str, train_end: int, location: Sequence[str] = LOCATION) -> DataFrame:
    """loc_mean_temperature / loc_temperature_std: past-only in train; later the location's train
    values, else its latitude zone's, else the train values of all rows, each on its own (FEA-12).
    The rows are shuffled once, by location."""
    loc = list(location)
    d = with_month_index(df).select(*loc, "observation_date", "year", "month_index", target)
    return with_location_stats(d, d, target, train_end, loc).select(
        *loc, "observation_date", "month_index", "__n", "loc_mean_temperature", "loc_temperature_std")


def leave_one_out_levels(df: DataFrame, target: str, train_end: int, location: Sequence[str] = LOCATION) -> DataFrame:
    """FEA-10, WIN-05, WIN-06: statistics of the train rows that leave a train row's own target out.

    The climatology falls from (location, month) to (zone, month) to month where a level has no other
    row; later rows take the fixed train statistics.  Mean and sample deviation are per location.  All
    levels are grouped sums joined back (zones and months are broadcast: 48 and 12 rows)."""
    loc = list(location)
    d = df.select(*loc, "observation_date", "year", "month", target, latitude_zone(F.abs("latitude")).alias("__zone"))
    t, fitted = F.col(target), F.col("year") <= train_end
    train = d.where(fitted)

    def sums(name, *keys):
        return train.groupBy(*keys).agg(F.count(t).alias(f"__n_{name}"), F.sum(t).alias(f"__s_{name}"), F.sum(t * t).alias(f"__q_{name}"))
    zone = sums("z", "__zone", "month").withColumnsRenamed({"__zone": "__kz", "month": "__kzm"})
    j = (d.join(sums("lm", *loc, "month"), [*loc, "month"], "left").join(sums("l", *loc), loc, "left")
         .join(F.broadcast(zone), F.col("__zone").eqNullSafe(F.col("__kz")) & (F.col("month") == F.col("__kzm")), "left")
         .join(F.broadcast(sums("m", "month")), "month", "left"))
    own = F.when(fitted & t.isNotNull(), 1).otherwise(0)
    left = lambda name: (F.coalesce(F.col(f"__n_{name}"), F.lit(0)) - own,                    # noqa: E731
                         F.col(f"__s_{name}") - F.when(own == 1, t).otherwise(0.0),
                         F.col(f"__q_{name}") - F.when(own == 1, t * t).otherwise(0.0))

    def mean(name):
        n, s, _ = left(name)
        return F.when(n > 0, s / n)
    n, s, q = left("l")
    spread = F.when(n > 1, F.sqrt(F.greatest((q - s * s / n) / (n - 1), F.lit(0.0))))
    return j.select(*loc, "observation_date", "month", F.coalesce(mean("lm"), mean("z"), mean("m")).alias("loo_climatology"),
                    F.when(mean("lm").isNotNull(), F.lit("location")).when(mean("z").isNotNull(), F.lit("zone"))
                    .when(mean("m").isNotNull(), F.lit("month")).alias("loo_level"),
                    mean("l").alias("loo_mean"), spread.alias("loo_std"))
