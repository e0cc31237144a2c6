"""Queries: correlation, ranks, variance ratios, trends, distributions, group summaries."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from isotherm.functions.labels import climatic_month, latitude_zone
from isotherm.operators import aggregate as agg
from isotherm.operators import stats as stt
from isotherm.plans.q_clean import clean_frame, with_clean
from isotherm.plans.registry import register

TARGET = "city_average_temperature"
NUMERIC = ["year", "month", "quarter", "decade", "latitude", "longitude", TARGET,
           "city_average_temperature_uncertainty", "country_average_temperature",
           "country_average_temperature_uncertainty", "land_average_temperature",
           "land_average_temperature_uncertainty", "land_max_temperature", "land_max_temperature_uncertainty",
           "land_min_temperature", "land_min_temperature_uncertainty", "land_and_ocean_average_temperature",
           "land_and_ocean_average_temperature_uncertainty", "major_city_average_temperature",
           "major_city_average_temperature_uncertainty"]
RANK_FEATURES = ["latitude", "longitude", "month", "year", "city_average_temperature_uncertainty",
                 "land_average_temperature"]


def _r_sql(a: str, b: str) -> str:
    both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    return (f"CASE WHEN stddev_samp({a}) FILTER (WHERE {both}) > 0 AND stddev_samp({b}) FILTER (WHERE {both}) > 0 "
            f"THEN corr({a}, {b}) END")


_PAIRS = list(combinations(NUMERIC, 2))
CORR_SQL = with_clean(" UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {_r_sql(a, b)} AS r FROM clean" for a, b in _PAIRS))


def corr_matrix_frame(spark, sf):
    from isotherm.plans.materialize import stage
    return stage(spark, "corr_matrix", sf, lambda: stt.corr_matrix(clean_frame(spark, sf), NUMERIC))


@register("corr_matrix", CORR_SQL, round_cols=["r"], ids="AGG-22 FSEL-01")
def corr_matrix(spark, sf):
    return corr_matrix_frame(spark, sf)


_OTHERS = [c for c in NUMERIC if c != TARGET]
CORR_T_SQL = with_clean(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, r, r * r AS r2 FROM (SELECT {_r_sql(c, TARGET)} AS r FROM clean)" for c in _OTHERS))


@register("corr_target", CORR_T_SQL, round_cols=["r", "r2"], ids="AGG-23 FSEL-01")
def corr_target(spark, sf):
    return stt.corr_with_target(clean_frame(spark, sf), _OTHERS, TARGET)


REDUNDANT_SQL = f"SELECT *, abs(r) AS abs_r FROM ({CORR_SQL}) m WHERE abs(r) > 0.95"


@register("redundant_pairs", REDUNDANT_SQL, round_cols=["r", "abs_r"], ids="FSEL-05")
def redundant_pairs(spark, sf):
    return stt.redundant_pairs(corr_matrix_frame(spark, sf), 0.95)


# The two windows the redundancy is measured in: the last train year, and all train years.
NARROW_YEAR = 1998


def _windows_sql() -> str:
    inside = {"narrow": f"year = {NARROW_YEAR}", "wide": f"year <= {NARROW_YEAR}"}
    sides = {n: " UNION ALL ".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {_r_sql(a, b)} AS r FROM c_{n}" for a, b in _PAIRS)
             for n in inside}
    return with_clean("".join(f", c_{n} AS MATERIALIZED (SELECT * FROM clean WHERE {w}), m_{n} AS ({sides[n]})" for n, w in inside.items()) + """
SELECT feature_a, feature_b, n.r AS r_narrow, w.r AS r_wide, CASE WHEN abs(w.r) > 0.95 THEN 'lasting' ELSE 'narrow window' END AS verdict
FROM m_narrow n JOIN m_wide w USING (feature_a, feature_b) WHERE abs(n.r) > 0.95 OR abs(w.r) > 0.95""")


@register("redundancy_windows", _windows_sql(), round_cols=["r_narrow", "r_wide"], ids="FSEL-05")
def redundancy_windows(spark, sf):
    """Redundant column pairs in the last train year and over all train years, both from one pass; a pair
    that is redundant in the narrow window only is told apart."""
    return stt.redundancy_windows(clean_frame(spark, sf), NUMERIC, F.col("year") == NARROW_YEAR, F.col("year") <= NARROW_YEAR, 0.95)


def _long_sql() -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x, {TARGET} AS y FROM clean "
                              f"WHERE {c} IS NOT NULL AND {TARGET} IS NOT NULL" for c in RANK_FEATURES)


SPEARMAN_SQL = with_clean(f""", lg AS ({_long_sql()}),
rk AS (SELECT feature,
  rank() OVER (PARTITION BY feature ORDER BY x) + (count(*) OVER (PARTITION BY feature, x) - 1) / 2.0 AS rx,
  rank() OVER (PARTITION BY feature ORDER BY y) + (count(*) OVER (PARTITION BY feature, y) - 1) / 2.0 AS ry FROM lg)
SELECT feature, {_r_sql('rx', 'ry')} AS spearman FROM rk GROUP BY feature""")


@register("spearman", SPEARMAN_SQL, round_cols=["spearman"], ids="FSEL-02 WIN-20")
def spearman(spark, sf):
    return stt.spearman(clean_frame(spark, sf), RANK_FEATURES, TARGET)


_QS = ", ".join(str(k / 20) for k in range(21))
ETA_CTES = f"""meta AS (SELECT feature, count(DISTINCT x) AS nd, avg(y) AS grand,
  list_sort(list_distinct(quantile_cont(x, [{_QS}]))) AS edges FROM lg GROUP BY feature),
b AS (SELECT lg.feature, lg.y, meta.grand, meta.nd, CASE WHEN meta.nd <= 20 THEN lg.x
  ELSE CAST(greatest(1, len(list_filter(meta.edges, lambda e: e < lg.x))) AS DOUBLE) END AS g FROM lg JOIN meta USING (feature)),
grp AS (SELECT feature, g, grand, count(*) AS ng, avg(y) AS mg FROM b GROUP BY feature, g, grand),
bt AS (SELECT feature, sum(ng * (mg - grand) ^ 2) AS between_ss, count(*) AS groups FROM grp GROUP BY feature),
tt AS (SELECT feature, sum((y - grand) ^ 2) AS total_ss, any_value(nd) AS nd FROM b GROUP BY feature),
eta AS (SELECT bt.feature, bt.groups, CASE WHEN total_ss > 0 AND nd > 1 THEN between_ss / total_ss END AS eta2
FROM bt JOIN tt USING (feature))"""
ETA_SQL = with_clean(f", lg AS ({_long_sql()}), {ETA_CTES} SELECT * FROM eta")


@register("eta_squared", ETA_SQL, round_cols=["eta2"], ids="FSEL-03 UDF-02")
def eta_squared(spark, sf):
    return stt.eta_squared(clean_frame(spark, sf), RANK_FEATURES, TARGET)


CAT_ETA_SQL = with_clean(f""", d AS (SELECT country_name, {TARGET} AS y FROM clean
  WHERE country_name IS NOT NULL AND {TARGET} IS NOT NULL),
gm AS (SELECT avg(y) AS grand FROM d),
g AS (SELECT country_name, count(*) AS ng, avg(y) AS mg FROM d GROUP BY country_name)
SELECT 'country_name' AS feature, (SELECT count(*) FROM g) AS groups,
  CASE WHEN t > 0 THEN b / t END AS eta2
FROM (SELECT sum(ng * (mg - grand) ^ 2) AS b FROM g, gm) x, (SELECT sum((y - grand) ^ 2) AS t FROM d, gm) y""")


@register("categorical_eta", CAT_ETA_SQL, round_cols=["eta2"], ids="FSEL-04")
def categorical_eta(spark, sf):
    return stt.categorical_eta_squared(clean_frame(spark, sf), "country_name", TARGET)


def _trend_sql() -> str:
    return f""", y AS (SELECT year, avg({TARGET}) AS mean_value, count({TARGET}) AS n FROM clean GROUP BY year),
k AS (SELECT count(*) AS k, regr_slope(mean_value, year) AS slope, regr_intercept(mean_value, year) AS icpt FROM y),
t AS (SELECT y.year, y.mean_value, y.n,
  CASE WHEN k.k >= 2 THEN y.year * k.slope + k.icpt ELSE y.mean_value END AS linear_trend,
  CASE WHEN k.k >= 2 THEN k.slope ELSE 0.0 END AS slope, k.k FROM y, k)
"""


TREND_SQL = with_clean(_trend_sql() + f"""
, numbered AS (SELECT *, row_number() OVER (ORDER BY year) AS i, least(10, count(*) OVER ()) AS width FROM t)
SELECT a.year, a.mean_value, a.n, (SELECT avg(b.mean_value) FROM numbered b
    WHERE b.i - a.i BETWEEN (a.width - 1) // 2 + 1 - a.width AND (a.width - 1) // 2) AS moving_average,
  a.linear_trend, a.mean_value - a.linear_trend AS residual, CAST(a.slope AS DOUBLE) AS slope FROM numbered a""")


@register("yearly_trend", TREND_SQL, round_cols=["mean_value", "moving_average", "linear_trend", "residual", "slope"],
          ids="AGG-27 AGG-31 WIN-12 FLT-05")
def yearly_trend(spark, sf):
    return stt.yearly_trend(clean_frame(spark, sf), "year", TARGET)


TREND_SUMMARY_SQL = with_clean(f""", y AS (SELECT year, avg({TARGET}) AS mean_value FROM clean GROUP BY year)
SELECT f.year AS first_year, f.mean_value AS first_value, l.year AS last_year, l.mean_value AS last_value,
  l.mean_value - f.mean_value AS change, (l.mean_value - f.mean_value) / CAST(l.year - f.year AS DOUBLE) AS endpoint_slope,
  c.year AS coldest_year, c.mean_value AS coldest_value, w.year AS warmest_year, w.mean_value AS warmest_value
FROM (SELECT * FROM y ORDER BY year LIMIT 1) f, (SELECT * FROM y ORDER BY year DESC LIMIT 1) l,
     (SELECT * FROM y ORDER BY mean_value, year LIMIT 1) c, (SELECT * FROM y ORDER BY mean_value DESC, year LIMIT 1) w""")


@register("trend_summary", TREND_SUMMARY_SQL,
          round_cols=["first_value", "last_value", "change", "endpoint_slope", "coldest_value", "warmest_value"],
          ids="AGG-29 TOP-06")
def trend_summary(spark, sf):
    yearly = clean_frame(spark, sf).groupBy("year").agg(F.avg(TARGET).alias("mean_value"))
    return stt.trend_summary(yearly)


DECADE_SQL = with_clean(f""", y AS (SELECT year, avg({TARGET}) AS m FROM clean GROUP BY year)
SELECT (year // 10) * 10 AS decade, CAST((year // 10) * 10 AS VARCHAR) || 's' AS label,
  avg(m) AS mean_of_means, count(*) AS n_groups FROM y GROUP BY ALL""")


@register("decade_mean", DECADE_SQL, round_cols=["mean_of_means"], ids="AGG-30")
def decade_mean(spark, sf):
    out = agg.mean_of_means(clean_frame(spark, sf), "year", (F.col("year") / 10).cast("long") * 10, TARGET, "decade")
    return out.select("decade", F.concat(F.col("decade").cast("string"), F.lit("s")).alias("label"),
                      "mean_of_means", "n_groups")


HIST_SQL = with_clean(f""", s AS (SELECT min({TARGET}) AS lo, max({TARGET}) AS hi, count({TARGET}) AS n,
  CAST(greatest(20, least(100, count({TARGET}) // 100 + 30)) AS BIGINT) AS nb FROM clean),
s2 AS (SELECT *, (hi - lo) / nb AS w FROM s),
c AS (SELECT CAST(least(floor(({TARGET} - lo) / w), nb - 1) AS BIGINT) AS bin, count(*) AS cnt
      FROM clean, s2 WHERE {TARGET} IS NOT NULL GROUP BY 1)
SELECT g.bin, lo + g.bin * w AS lower_edge, lo + (g.bin + 1) * w AS upper_edge, coalesce(c.cnt, 0) AS count
FROM (SELECT CAST(unnest(range(0, nb)) AS BIGINT) AS bin, lo, w FROM s2) g LEFT JOIN c USING (bin)""")


@register("histogram", HIST_SQL, round_cols=["lower_edge", "upper_edge"], ids="AGG-42")
def histogram(spark, sf):
    return stt.histogram(clean_frame(spark, sf), TARGET)


DENSITY_SQL = with_clean(f""", s AS (SELECT min(latitude) AS x0, max(latitude) AS x1, min({TARGET}) AS y0,
  max({TARGET}) AS y1 FROM clean)
SELECT CAST(least(floor((latitude - x0) * 45 / (x1 - x0)), 44) AS BIGINT) AS x_bin,
  CAST(least(floor(({TARGET} - y0) * 45 / (y1 - y0)), 44) AS BIGINT) AS y_bin, count(*) AS count
FROM clean, s WHERE latitude IS NOT NULL AND {TARGET} IS NOT NULL GROUP BY 1, 2""")


@register("density_grid", DENSITY_SQL, ids="AGG-43")
def density_grid(spark, sf):
    return stt.density_grid(clean_frame(spark, sf), "latitude", TARGET, 45)


BOX_SQL = with_clean(f""", q AS (SELECT month, quantile_cont({TARGET}, 0.25) AS q1, quantile_cont({TARGET}, 0.5) AS median,
  quantile_cont({TARGET}, 0.75) AS q3 FROM clean GROUP BY month),
q2 AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT c.month, q2.q1, q2.median, q2.q3,
  min({TARGET}) FILTER (WHERE {TARGET} >= lo AND {TARGET} <= hi) AS whisker_low,
  max({TARGET}) FILTER (WHERE {TARGET} >= lo AND {TARGET} <= hi) AS whisker_high,
  count(*) FILTER (WHERE {TARGET} IS NOT NULL AND NOT ({TARGET} >= lo AND {TARGET} <= hi)) AS outside
FROM clean c JOIN q2 USING (month) GROUP BY c.month, q2.q1, q2.median, q2.q3""")


@register("box_stats", BOX_SQL, round_cols=["q1", "median", "q3", "whisker_low", "whisker_high"], ids="AGG-44")
def box_stats(spark, sf):
    return stt.box_stats(clean_frame(spark, sf), "month", TARGET)


_ZONE_SQL = ("CASE WHEN abs(latitude) >= 0 AND abs(latitude) <= 23.5 THEN 'Tropical' "
             "WHEN abs(latitude) > 23.5 AND abs(latitude) <= 35 THEN 'Subtropical' "
             "WHEN abs(latitude) > 35 AND abs(latitude) <= 55 THEN 'Temperate' "
             "WHEN abs(latitude) > 55 AND abs(latitude) <= 90 THEN 'Polar' END")
_CM_SQL = "CASE WHEN latitude < 0 THEN ((month + 5) % 12) + 1 ELSE month END"


def _zoned(df):
    return df.withColumn("latitude_zone", latitude_zone(F.abs("latitude"))) \
             .withColumn("climatic_month", climatic_month("month", "latitude"))


ZONE_SQL = with_clean(f""", z AS (SELECT *, {_ZONE_SQL} AS latitude_zone FROM clean)
SELECT latitude_zone, count(*) AS rows, count(DISTINCT row(city_name, country_name, latitude, longitude)) AS locations,
  avg({TARGET}) AS mean_value, avg(CASE WHEN latitude >= 0 THEN 1.0 ELSE 0.0 END) AS share_north
FROM z GROUP BY latitude_zone""")


@register("zone_summary", ZONE_SQL, round_cols=["mean_value", "share_north"], ids="AGG-39 PRJ-14")
def zone_summary(spark, sf):
    z = _zoned(clean_frame(spark, sf))
    return z.groupBy("latitude_zone").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(F.struct("city_name", "country_name", "latitude", "longitude")).alias("locations"),
        F.avg(TARGET).alias("mean_value"),
        F.avg(F.when(F.col("latitude") >= 0, 1.0).otherwise(0.0)).alias("share_north"))


AMPLITUDE_SQL = with_clean(f""", z AS (SELECT *, {_ZONE_SQL} AS latitude_zone, {_CM_SQL} AS climatic_month FROM clean),
m AS (SELECT latitude_zone, climatic_month, avg({TARGET}) AS mean_value FROM z GROUP BY ALL)
SELECT latitude_zone, max(mean_value) - min(mean_value) AS amplitude, max(mean_value) AS warmest_month_mean,
  min(mean_value) AS coldest_month_mean FROM m GROUP BY latitude_zone""")


@register("seasonal_amplitude", AMPLITUDE_SQL, round_cols=["amplitude", "warmest_month_mean", "coldest_month_mean"],
          ids="AGG-40 FEA-05")
def seasonal_amplitude(spark, sf):
    m = _zoned(clean_frame(spark, sf)).groupBy("latitude_zone", "climatic_month").agg(F.avg(TARGET).alias("m"))
    return m.groupBy("latitude_zone").agg((F.max("m") - F.min("m")).alias("amplitude"),
                                          F.max("m").alias("warmest_month_mean"), F.min("m").alias("coldest_month_mean"))


MONTHLY_SQL = with_clean(f""", m AS (SELECT month, avg({TARGET}) AS mean_value, count(*) AS n FROM clean GROUP BY month)
SELECT m.*, m.month = (SELECT month FROM m ORDER BY mean_value DESC, month LIMIT 1) AS hottest,
  m.month = (SELECT month FROM m ORDER BY mean_value, month LIMIT 1) AS coldest FROM m""")


@register("monthly_extremes", MONTHLY_SQL, round_cols=["mean_value"], ids="AGG-28 TOP-06")
def monthly_extremes(spark, sf):
    m = clean_frame(spark, sf).groupBy("month").agg(F.avg(TARGET).alias("mean_value"), F.count(F.lit(1)).alias("n"))
    ext = m.agg(F.min(F.struct((-F.col("mean_value")).alias("a"), F.col("month").alias("m"))).alias("__hot"),
                F.min(F.struct(F.col("mean_value").alias("a"), F.col("month").alias("m"))).alias("__cold"))
    return m.crossJoin(F.broadcast(ext)).select(
        "month", "mean_value", "n", (F.col("month") == F.col("__hot.m")).alias("hottest"),
        (F.col("month") == F.col("__cold.m")).alias("coldest"))


# The user's year slider and country selection (FLT-05, FLT-06).
YEAR_RANGE = (1996, 2000)
CHOSEN = ["NATION_0", "NATION_3", "NATION_7", "NATION_12", "NATION_18", "NATION_24"]
_CHOSEN_SQL = ", ".join(f"'{c}'" for c in CHOSEN)

COUNTRY_OVERALL_SQL = with_clean(f""", f AS (SELECT * FROM clean WHERE year BETWEEN {YEAR_RANGE[0]} AND {YEAR_RANGE[1]}
  AND country_name IN ({_CHOSEN_SQL}))
SELECT country_name, avg({TARGET}) AS mean_value, (SELECT avg({TARGET}) FROM f) AS overall_mean,
  avg({TARGET}) - (SELECT avg({TARGET}) FROM f) AS difference FROM f GROUP BY country_name""")


@register("country_vs_overall", COUNTRY_OVERALL_SQL, round_cols=["mean_value", "overall_mean", "difference"],
          ids="AGG-26 FLT-05 FLT-06")
def country_vs_overall(spark, sf):
    f = clean_frame(spark, sf).where(F.col("year").between(*YEAR_RANGE) & F.col("country_name").isin(CHOSEN))
    overall = f.agg(F.avg(TARGET).alias("overall_mean"))
    return (f.groupBy("country_name").agg(F.avg(TARGET).alias("mean_value")).crossJoin(F.broadcast(overall))
            .withColumn("difference", F.col("mean_value") - F.col("overall_mean")))


def _extreme_sql(group_sql: str, key: str, k: int) -> str:
    """k lowest ∪ k highest, de-duplicated by key (a key in both lists is kept as 'lowest')."""
    return f"""SELECT * FROM (
SELECT * FROM (SELECT *, 'lowest' AS extreme FROM ({group_sql}) ORDER BY mean_value, {key} LIMIT {k})
UNION ALL SELECT * FROM (SELECT *, 'highest' AS extreme FROM ({group_sql}) ORDER BY mean_value DESC, {key} LIMIT {k})
) u QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY extreme DESC) = 1"""


_LOC_GROUP = (f"SELECT city_name, country_name, latitude, longitude, avg({TARGET}) AS mean_value FROM clean "
              "GROUP BY ALL")
LOC_EXT_SQL = with_clean(_extreme_sql(_LOC_GROUP, "city_name, country_name, latitude, longitude", 10))


@register("location_extremes", LOC_EXT_SQL, round_cols=["mean_value"], ids="AGG-24 TOP-03 TOP-04")
def location_extremes(spark, sf):
    g = clean_frame(spark, sf).groupBy("city_name", "country_name", "latitude", "longitude").agg(
        F.avg(TARGET).alias("mean_value"))
    return agg.extremes(g, ["city_name", "country_name", "latitude", "longitude"], "mean_value", 10)


_COUNTRY_GROUP = (f"SELECT country_name, avg({TARGET}) AS mean_value, count(*) AS rows, "
                  "count(DISTINCT city_name) AS cities FROM clean GROUP BY ALL")
COUNTRY_EXT_SQL = with_clean(_extreme_sql(_COUNTRY_GROUP, "country_name", 10))


@register("country_extremes", COUNTRY_EXT_SQL, round_cols=["mean_value"], ids="AGG-25 TOP-04")
def country_extremes(spark, sf):
    g = clean_frame(spark, sf).groupBy("country_name").agg(
        F.avg(TARGET).alias("mean_value"), F.count(F.lit(1)).alias("rows"),
        F.count_distinct("city_name").alias("cities"))
    return agg.extremes(g, ["country_name"], "mean_value", 10)


UNC_SQL = with_clean("""SELECT decade, avg(city_average_temperature_uncertainty) AS mean_uncertainty, count(*) AS rows
FROM clean GROUP BY decade""")


@register("uncertainty_by_decade", UNC_SQL, round_cols=["mean_uncertainty"], ids="AGG-41")
def uncertainty_by_decade(spark, sf):
    return clean_frame(spark, sf).groupBy("decade").agg(
        F.avg("city_average_temperature_uncertainty").alias("mean_uncertainty"), F.count(F.lit(1)).alias("rows"))


# Fixed value: the driver tables span seven years, so slopes are NULL on them.
MIN_POINTS = 10
ZONE_TREND_SQL = with_clean(f""", z AS (SELECT *, {_ZONE_SQL} AS latitude_zone FROM clean),
zy AS (SELECT latitude_zone, year, avg({TARGET}) AS mean_value FROM z GROUP BY ALL)
SELECT latitude_zone, year, mean_value,
  CASE WHEN count(mean_value) OVER w >= 3 THEN avg(mean_value) OVER w END AS trailing_mean,
  CASE WHEN count(mean_value) OVER (PARTITION BY latitude_zone) >= {MIN_POINTS}
       THEN regr_slope(mean_value, year) OVER (PARTITION BY latitude_zone) END AS slope_per_year
FROM zy WINDOW w AS (PARTITION BY latitude_zone ORDER BY year ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""")


@register("zone_trend", ZONE_TREND_SQL, round_cols=["mean_value", "trailing_mean", "slope_per_year"],
          ids="AGG-32 WIN-13 UDF-04")
def zone_trend(spark, sf):
    z = _zoned(clean_frame(spark, sf))
    zy = z.groupBy("latitude_zone", "year").agg(F.avg(TARGET).alias("mean_value"))
    slopes = stt.slope_by_group(zy, "latitude_zone", "year", "mean_value", MIN_POINTS).select(
        "latitude_zone", "slope_per_year")
    return (zy.withColumn("trailing_mean", stt.trailing_mean(zy, "latitude_zone", "year", "mean_value", 10, 3))
            .join(slopes, "latitude_zone").select("latitude_zone", "year", "mean_value", "trailing_mean",
                                                  "slope_per_year"))
