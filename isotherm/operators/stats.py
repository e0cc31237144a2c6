"""Correlation, rank, variance-ratio, trend and distribution operators
(AGG-22..32, AGG-39..44, FSEL-01..05, WIN-12, WIN-13, WIN-20).

Everything is an aggregate or a window over an *aggregated* frame (one row per
year / zone / bin); ranks and bins of raw values come from value counts
(``quantiles``), correlations from merged moments (``moments``).
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isotherm.operators.moments import CONSTANT, PairMoments, correlation_rows, pair_moments, redundancy_rows
from isotherm.operators.quantiles import average_ranks, exact_quantiles
from isotherm.session import cut_lineage


def pearson(x: Column, y: Column) -> Column:
    """Pairwise-complete Pearson r; NULL when either side is constant or < 2 pairs.

    Built from covariance and standard deviations with ``try_divide``: Spark's
    ``corr`` raises DIVIDE_BY_ZERO on a constant column under ANSI mode.
    """
    both = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    xs, ys = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_samp(xs, ys), F.stddev_samp(xs) * F.stddev_samp(ys))


def pair_correlations(df: DataFrame, pairs: Sequence[tuple[str, str]],
                      names: tuple[str, str] = ("feature_a", "feature_b"), moments: PairMoments | None = None) -> DataFrame:
    """Pairwise-complete r for many column pairs from one pass of mergeable moments; pairs without two
    complete rows, or with a constant side, get NULL.  ``moments``: those of ``df``, if they are there."""
    cols = list(dict.fromkeys(c for pair in pairs for c in pair))
    m = moments or pair_moments(df, cols)
    return df.sparkSession.createDataFrame(correlation_rows(m, pairs), f"{names[0]} string, {names[1]} string, r double")


def corr_matrix(df: DataFrame, cols: Sequence[str], moments: PairMoments | None = None) -> DataFrame:
    """Upper-triangle pairs (a < b in the given order) with r (AGG-22)."""
    return pair_correlations(df, list(combinations(cols, 2)), moments=moments)


def corr_with_target(df: DataFrame, cols: Sequence[str], target: str, moments: PairMoments | None = None) -> DataFrame:
    """r of each column with the target (AGG-23, FSEL-01 with r2)."""
    out = pair_correlations(df, [(c, target) for c in cols], ("feature", "__target"), moments).drop("__target")
    return out.withColumn("r2", F.col("r") * F.col("r"))


def redundant_pairs(matrix: DataFrame, threshold: float = 0.95) -> DataFrame:
    """|r| above the threshold (FSEL-05)."""
    return matrix.where(F.abs("r") > threshold).withColumn("abs_r", F.abs("r"))


def redundancy_windows(df: DataFrame, cols: Sequence[str], narrow: Column, wide: Column, threshold: float = 0.95) -> DataFrame:
    """FSEL-05: pairs with |r| above the threshold in the narrow (feature selection) or the wide window,
    both r and the verdict; both windows come from one pass."""
    m = pair_moments(df, cols, {"narrow": narrow, "wide": wide})
    return df.sparkSession.createDataFrame(redundancy_rows(m, "narrow", "wide", threshold),
                                           "feature_a string, feature_b string, r_narrow double, r_wide double, verdict string")


def _long(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """(feature, __x, __y) of the rows where both the feature and the target are there."""
    return (df.select(F.col(target).cast("double").alias("__y"), *cols)
            .selectExpr("__y", "stack({}, {}) AS (feature, __x)".format(
                len(cols), ", ".join(f"'{c}', CAST(`{c}` AS double)" for c in cols)))
            .where(F.col("__x").isNotNull() & F.col("__y").isNotNull() & ~F.isnan("__x") & ~F.isnan("__y")))


def spearman(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Pearson of average ranks over pairwise-complete rows, per feature (FSEL-02).

    Equal (feature, x, y) rows are counted first and ranks looked up by (feature, value), so no row
    identity is needed and repeated values travel once.  Ranks come centred: their sums are zero."""
    cells = cut_lineage(_long(df, cols, target).groupBy("feature", "__x", "__y").agg(F.count(F.lit(1)).alias("__n")))
    rx = average_ranks(cells, ["feature"], "__x", "__rx", weight="__n", centred=True)
    ry = average_ranks(cells, ["feature"], "__y", "__ry", weight="__n", centred=True)
    both = cells.join(rx, ["feature", "__x"]).join(ry, ["feature", "__y"])
    n, x, y = F.col("__n"), F.col("__rx"), F.col("__ry")
    return both.groupBy("feature").agg(
        F.try_divide(F.sum(n * x * y), F.sqrt(F.sum(n * x * x)) * F.sqrt(F.sum(n * y * y))).alias("spearman"))


def value_sums(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """One written row per (feature, value ``__x``), missing values among them: ``__all`` its rows, ``__n`` those
    where the target is there, ``__s`` and ``__q`` the sums of the target, less its mean, and of its square."""
    middle = df.agg(F.avg(F.col(target).cast("double"))).first()[0] or 0.0   # keeps the squares from cancelling
    y = F.col(target).cast("double")
    y = F.when(~F.isnan(y), y - F.lit(middle))
    long = df.select(y.alias("__y"), *cols).selectExpr("__y", "stack({}, {}) AS (feature, __x)".format(
        len(cols), ", ".join(f"'{c}', CAST(`{c}` AS double)" for c in cols)))
    return cut_lineage(long.groupBy("feature", "__x").agg(
        F.count(F.lit(1)).alias("__all"), F.count("__y").alias("__n"), F.sum("__y").alias("__s"),
        F.sum(F.col("__y") * F.col("__y")).alias("__q")))


def eta_squared(df: DataFrame, cols: Sequence[str], target: str, bins: int = 20, values: DataFrame | None = None) -> DataFrame:
    """Between-group / total variance of the target (FSEL-03).

    Groups are the feature's values when it has at most ``bins`` distinct values,
    else quantile bins: exact quantile edges at k/bins, duplicate edges dropped,
    right-closed intervals with the lowest edge included.  Everything derives from
    one written frame of (feature, value) -> count and sums of the target:
    ``values``, the ``value_sums`` of ``df``, if they are there.
    """
    values = value_sums(df, cols, target) if values is None else values
    values = values.where((F.col("__n") > 0) & F.col("__x").isNotNull() & ~F.isnan("__x")).drop("__all")
    probs = [k / bins for k in range(bins + 1)]
    names = [f"e{k}" for k in range(bins + 1)]
    edges = exact_quantiles(values, "__x", probs, ["feature"], names=names, weight="__n", counted=True).select(
        "feature", F.array_sort(F.array_distinct(F.array(*names))).alias("__edges"))
    totals = values.groupBy("feature").agg(
        F.count(F.lit(1)).alias("__nd"), F.sum("__n").alias("__all"), F.sum("__s").alias("__sum"), F.sum("__q").alias("__sq"))
    meta = totals.join(edges, "feature")
    slot = F.when(F.col("__nd") <= bins, F.col("__x")).otherwise(
        F.greatest(F.lit(1), F.size(F.filter("__edges", lambda e: e < F.col("__x")))).cast("double"))
    groups = (values.join(F.broadcast(meta.select("feature", "__nd", "__edges")), "feature")    # one row per feature
              .groupBy("feature", slot.alias("__g")).agg(F.sum("__n").alias("__ng"), F.sum("__s").alias("__sg")))
    between = groups.groupBy("feature").agg(F.sum(F.col("__sg") * F.col("__sg") / F.col("__ng")).alias("__b"),
                                            F.count(F.lit(1)).alias("groups"))
    mean_square = F.col("__sum") * F.col("__sum") / F.col("__all")
    total = F.col("__sq") - mean_square
    return between.join(totals, "feature").select(
        "feature", "groups",
        F.when((total > CONSTANT * F.col("__sq")) & (F.col("__nd") > 1), (F.col("__b") - mean_square) / total).alias("eta2"))


def categorical_eta_squared(df: DataFrame, group: str, target: str) -> DataFrame:
    """eta² of the target over the groups of a categorical column (FSEL-04)."""
    d = df.where(F.col(group).isNotNull() & F.col(target).isNotNull())
    grand = d.agg(F.avg(target).alias("__grand"))
    g = d.groupBy(group).agg(F.count(F.lit(1)).alias("__ng"), F.avg(target).alias("__mg")).crossJoin(grand)
    between = g.agg(F.sum(F.col("__ng") * (F.col("__mg") - F.col("__grand")) ** 2).alias("__b"),
                    F.count(F.lit(1)).alias("groups"))
    total = d.crossJoin(grand).agg(F.sum((F.col(target) - F.col("__grand")) ** 2).alias("__t"))
    return between.crossJoin(total).select(F.lit(group).alias("feature"), "groups",
                                           F.when(F.col("__t") > 0, F.col("__b") / F.col("__t")).alias("eta2"))


def yearly_trend(df: DataFrame, year: str, value: str) -> DataFrame:
    """Yearly mean, count, centred moving average (window min(10, n), min periods 1), least-squares
    line and residual (AGG-27, AGG-31, WIN-12).  Windows run on the yearly frame only."""
    yearly = df.groupBy(year).agg(F.avg(value).alias("mean_value"), F.count(value).alias("n"))
    every = Window.orderBy(year).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    at = F.row_number().over(Window.orderBy(year)).cast("int")
    years = F.count(F.lit(1)).over(every).cast("int")
    width = F.least(F.lit(10), years)
    after = F.floor((width - 1) / 2).cast("int")
    first, last = F.greatest(F.lit(1), at - (width - 1 - after)), F.least(years, at + after)
    near = F.filter(F.slice(F.collect_list(F.struct("mean_value")).over(every), first, last - first + 1)["mean_value"],
                    lambda v: v.isNotNull())
    ma = F.try_divide(F.aggregate(near, F.lit(0.0), lambda acc, v: acc + v), F.size(near).cast("double"))
    fit = yearly.agg(F.regr_slope("mean_value", year).alias("__slope"),
                     F.regr_intercept("mean_value", year).alias("__icpt"), F.count(F.lit(1)).alias("__k"))
    out = yearly.withColumn("moving_average", ma).crossJoin(F.broadcast(fit))
    fitted = F.when(F.col("__k") >= 2, F.col(year) * F.col("__slope") + F.col("__icpt")).otherwise(F.col("mean_value"))
    return out.select(year, "mean_value", "n", "moving_average", fitted.alias("linear_trend"),
                      (F.col("mean_value") - fitted).alias("residual"),
                      F.when(F.col("__k") >= 2, F.col("__slope")).otherwise(F.lit(0.0)).alias("slope"))


def trend_summary(yearly: DataFrame, year: str = "year", value: str = "mean_value") -> DataFrame:
    """first/last value, change, endpoint slope per year, coldest and warmest year (AGG-27/29, TOP-06).

    Ties on the extreme resolve to the earliest year, via ``min(struct)``.
    """
    return yearly.agg(
        F.min(F.struct(year, value)).alias("__first"), F.max(F.struct(year, value)).alias("__last"),
        F.min(F.struct(F.col(value), F.col(year))).alias("__cold"),
        F.min(F.struct((-F.col(value)).alias("neg"), F.col(year))).alias("__warm"),
    ).select(
        F.col(f"__first.{year}").alias("first_year"), F.col(f"__first.{value}").alias("first_value"),
        F.col(f"__last.{year}").alias("last_year"), F.col(f"__last.{value}").alias("last_value"),
        (F.col(f"__last.{value}") - F.col(f"__first.{value}")).alias("change"),
        F.try_divide(F.col(f"__last.{value}") - F.col(f"__first.{value}"),
                     (F.col(f"__last.{year}") - F.col(f"__first.{year}")).cast("double")).alias("endpoint_slope"),
        F.col(f"__cold.{year}").alias("coldest_year"), F.col(f"__cold.{value}").alias("coldest_value"),
        F.col(f"__warm.{year}").alias("warmest_year"), (-F.col("__warm.neg")).alias("warmest_value"))


def slope_by_group(df: DataFrame, group: str, x: str, y: str, min_points: int = 10) -> DataFrame:
    """Least-squares slope per group, NULL below ``min_points`` (AGG-32, UDF-04)."""
    return df.groupBy(group).agg(
        F.when(F.count(y) >= min_points, F.regr_slope(y, x)).alias("slope_per_year"),
        F.count(y).alias("points")).withColumn("slope_per_century", F.col("slope_per_year") * 100)


def trailing_mean(df: DataFrame, group: str, order: str, value: str, rows: int = 10, min_periods: int = 3) -> Column:
    """Trailing mean of the last ``rows`` rows, NULL with fewer than ``min_periods`` values (WIN-13)."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(-(rows - 1), 0)
    return F.when(F.count(value).over(w) >= min_periods, F.avg(value).over(w))


def histogram(df: DataFrame, value: str, n_bins: int | None = None) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed, empty bins kept (AGG-42).

    Default bin count: ``max(20, min(100, n // 100 + 30))``.
    """
    stats = df.agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"), F.count(value).alias("__n"))
    nb = (F.lit(n_bins) if n_bins else F.greatest(F.lit(20), F.least(F.lit(100), (F.col("__n") / 100).cast("long") + 30)))
    stats = stats.withColumn("__nb", nb.cast("long")).withColumn("__w", (F.col("__hi") - F.col("__lo")) / F.col("__nb"))
    at = F.coalesce(F.floor(F.try_divide(F.col(value) - F.col("__lo"), F.col("__w"))), F.lit(0))  # a constant column: bin 0
    b = F.least(at, F.col("__nb") - 1).cast("long")
    counts = (df.where(F.col(value).isNotNull()).crossJoin(F.broadcast(stats))
              .groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count")))
    grid = stats.select(F.explode(F.sequence(F.lit(0).cast("long"), F.col("__nb") - 1)).alias("bin"), "__lo", "__w")
    return grid.join(counts, "bin", "left").select(
        "bin", (F.col("__lo") + F.col("bin") * F.col("__w")).alias("lower_edge"),
        (F.col("__lo") + (F.col("bin") + 1) * F.col("__w")).alias("upper_edge"),
        F.coalesce("count", F.lit(0)).cast("long").alias("count"))


def density_grid(df: DataFrame, x: str, y: str, gridsize: int = 45) -> DataFrame:
    """2-D counts on a gridsize × gridsize square grid; empty cells dropped (AGG-43, re-aimed)."""
    s = df.agg(F.min(x).alias("__x0"), F.max(x).alias("__x1"), F.min(y).alias("__y0"), F.max(y).alias("__y1"))
    def cell(c, lo, hi):  # a constant column: cell 0
        at = F.floor(F.try_divide((F.col(c) - F.col(lo)) * gridsize, F.col(hi) - F.col(lo)))
        return F.least(F.coalesce(at, F.lit(0)), F.lit(gridsize - 1))
    bx, by = cell(x, "__x0", "__x1"), cell(y, "__y0", "__y1")
    d = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).crossJoin(F.broadcast(s))
    return d.groupBy(bx.cast("long").alias("x_bin"), by.cast("long").alias("y_bin")).agg(F.count(F.lit(1)).alias("count"))


def box_stats(df: DataFrame, group: str, value: str, k: float = 1.5) -> DataFrame:
    """Median, quartiles and whiskers (extreme values inside the fences) per group (AGG-44)."""
    q = exact_quantiles(df, value, [0.25, 0.5, 0.75], [group], names=["q1", "median", "q3"])
    iqr = F.col("q3") - F.col("q1")
    q = q.withColumn("__lo", F.col("q1") - k * iqr).withColumn("__hi", F.col("q3") + k * iqr)
    j = df.select(group, value).join(q, group)
    inside = (F.col(value) >= F.col("__lo")) & (F.col(value) <= F.col("__hi"))
    return j.groupBy(group, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.count_if(F.col(value).isNotNull() & ~inside).alias("outside"))
