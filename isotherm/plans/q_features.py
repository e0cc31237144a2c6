"""Queries: cyclic features, calendar lags with gaps, past-only / leave-one-out statistics,
fallback chain, the feature table, split summary, lag coverage and leakage tests."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isotherm.functions.calendar import month_index
from isotherm.functions.ids import dense_index
from isotherm.operators import features as fe
from isotherm.operators import quality as dq
from isotherm.plans import driver_sources as ds
from isotherm.plans.driver_star import build_star
from isotherm.plans.materialize import stage
from isotherm.plans.oracle_sources import with_sources, with_star
from isotherm.plans.q_clean import clean_frame, with_clean
from isotherm.plans.q_stats import _ZONE_SQL
from isotherm.plans.registry import register

TARGET = "city_average_temperature"
LOC = fe.LOCATION
LOC_SQL = ", ".join(LOC)
# Split years for the driver tables (1995-2001).
TRAIN_END, VALIDATION_END = 1998, 1999
_ANG = repr(2 * math.pi / 12)
_CM = "CASE WHEN latitude < 0 THEN ((month + 5) % 12) + 1 ELSE month END"

CYCLIC_DOUBLES = ["month_sin", "month_cos", "climatic_month_sin", "climatic_month_cos",
                  "abslat_x_month_sin", "abslat_x_month_cos", "abslat_x_years", "abs_latitude"]
CYCLIC_SQL = with_clean(f"""
, c AS (SELECT {LOC_SQL}, observation_date, year, month, {_CM} AS climatic_month,
  year - (SELECT min(year) FROM clean) AS years_since_start, abs(latitude) AS abs_latitude,
  latitude >= 0 AS hemisphere_north FROM clean)
SELECT {LOC_SQL}, observation_date, year, month, sin({_ANG} * month) AS month_sin, cos({_ANG} * month) AS month_cos,
  climatic_month, sin({_ANG} * climatic_month) AS climatic_month_sin, cos({_ANG} * climatic_month) AS climatic_month_cos,
  years_since_start, abs_latitude, hemisphere_north,
  abs_latitude * sin({_ANG} * climatic_month) AS abslat_x_month_sin,
  abs_latitude * cos({_ANG} * climatic_month) AS abslat_x_month_cos,
  abs_latitude * years_since_start AS abslat_x_years FROM c""")


@register("cyclic_features", CYCLIC_SQL, round_cols=CYCLIC_DOUBLES, ids="FEA-04 FEA-05 FEA-06 FEA-07 FEA-08 SCA-04")
def cyclic_features(spark, sf):
    c = clean_frame(spark, sf).select(*LOC, "observation_date", "year", "month")
    return fe.cyclic_features(c)


# ---------------------------------------------------------------- calendar lags on a gappy series

def part_series(spark, sf) -> DataFrame:
    """(part, month) series from lineitem: most parts miss most months, so gaps are real."""
    rows = ds.observation_rows(spark, sf)
    return (rows.groupBy("l_partkey", "dt").agg(F.avg("v").alias("value"), F.avg("u").alias("uncertainty"))
            .withColumn("month_index", month_index("dt")))


LAGS_SQL = with_sources("""
, s AS (SELECT l_partkey, dt, avg(v) AS value, avg(u) AS uncertainty, year(dt) * 12 + month(dt) AS month_index
        FROM obs_rows GROUP BY l_partkey, dt)
SELECT l_partkey, dt, month_index, value,
  max(value) OVER (PARTITION BY l_partkey ORDER BY month_index RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS lag_1,
  max(value) OVER (PARTITION BY l_partkey ORDER BY month_index RANGE BETWEEN 12 PRECEDING AND 12 PRECEDING) AS lag_12,
  max(uncertainty) OVER (PARTITION BY l_partkey ORDER BY month_index RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING)
    AS uncertainty_lag_1,
  CASE WHEN count(value) OVER w >= 6 THEN avg(value) OVER w END AS roll_mean_12,
  CASE WHEN count(value) OVER w >= 6 THEN stddev_samp(value) OVER w END AS roll_std_12
FROM s WINDOW w AS (PARTITION BY l_partkey ORDER BY month_index RANGE BETWEEN 12 PRECEDING AND 1 PRECEDING)""")


@register("calendar_lags", LAGS_SQL, round_cols=["value", "lag_1", "lag_12", "uncertainty_lag_1", "roll_mean_12",
                                                 "roll_std_12"], ids="WIN-07 WIN-08 WIN-11 JON-14 FEA-13 FEA-15")
def calendar_lags(spark, sf):
    s = part_series(spark, sf)
    key = ["l_partkey"]
    mean12, std12 = fe.trailing_stats("value", key, 12, 6)
    return s.select("l_partkey", "dt", "month_index", "value",
                    fe.calendar_lag("value", 1, key).alias("lag_1"), fe.calendar_lag("value", 12, key).alias("lag_12"),
                    fe.calendar_lag("uncertainty", 1, key).alias("uncertainty_lag_1"),
                    mean12.alias("roll_mean_12"), std12.alias("roll_std_12"))


# ---------------------------------------------------------------- climatology and location statistics

_LOCW = f"PARTITION BY {LOC_SQL}"
CLIM_CTES = f"""
, d AS (SELECT {LOC_SQL}, observation_date, year, month, year(observation_date) * 12 + month(observation_date)
    AS month_index, {_ZONE_SQL} AS latitude_zone, {TARGET} AS t,
    CASE WHEN year <= {TRAIN_END} THEN 'train' WHEN year <= {VALIDATION_END} THEN 'validation'
         WHEN year IS NOT NULL THEN 'test' END AS data_split, year <= {TRAIN_END} AS is_train_period FROM clean),
d2 AS (SELECT *,
    CASE WHEN count(t) OVER lmw > 0 THEN sum(t) OVER lmw / count(t) OVER lmw END AS lm,
    CASE WHEN count(t) OVER lw > 0 THEN sum(t) OVER lw / count(t) OVER lw END AS l
  FROM d WINDOW lmw AS ({_LOCW}, month ORDER BY month_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                lw AS ({_LOCW} ORDER BY month_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
zmf AS (SELECT latitude_zone, month, avg(t) AS zmf FROM d WHERE is_train_period GROUP BY ALL),
gmf AS (SELECT month, avg(t) AS gmf FROM d WHERE is_train_period GROUP BY ALL),
lmf AS (SELECT {LOC_SQL}, month, avg(t) AS lmf FROM d WHERE is_train_period GROUP BY ALL),
clim AS (SELECT d2.{LOC.__getitem__(0)}, d2.country_name, d2.latitude, d2.longitude, d2.observation_date, d2.month_index,
    d2.data_split, d2.is_train_period, d2.latitude_zone, d2.t AS {TARGET},
    CASE WHEN d2.is_train_period THEN coalesce(lm, l) ELSE coalesce(lmf, zmf, gmf) END AS loc_month_climatology,
    CASE WHEN d2.is_train_period THEN lm IS NULL ELSE lmf IS NULL END AS loc_climatology_imputed
  FROM d2 LEFT JOIN zmf USING (latitude_zone, month) LEFT JOIN gmf USING (month) LEFT JOIN lmf USING ({LOC_SQL}, month))
"""


def climatology_frame(spark, sf):
    return stage(spark, "climatology", sf,
                 lambda: fe.climatology(clean_frame(spark, sf), TARGET, TRAIN_END, VALIDATION_END))


@register("past_only_climatology", with_clean(CLIM_CTES + "SELECT * FROM clim"),
          round_cols=[TARGET, "loc_month_climatology"], ids="WIN-03 FEA-09 FEA-11 JON-16 JON-15 FEA-16")
def past_only_climatology(spark, sf):
    return climatology_frame(spark, sf)


LOCSTATS_CTES = f"""
, ls AS (SELECT {LOC_SQL}, observation_date, year, year(observation_date) * 12 + month(observation_date) AS month_index,
    {TARGET} AS t, {_ZONE_SQL} AS zone FROM clean),
ls2 AS (SELECT *, count(t) OVER w AS n, sum(t) OVER w AS s, sum(t * t) OVER w AS ss FROM ls
  WINDOW w AS ({_LOCW} ORDER BY month_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lsf AS (SELECT {LOC_SQL}, avg(t) AS mf, stddev_samp(t) AS sf FROM ls WHERE year <= {TRAIN_END} GROUP BY ALL),
lsz AS (SELECT zone, avg(t) AS mz, stddev_samp(t) AS sz FROM ls WHERE year <= {TRAIN_END} GROUP BY zone),
lsg AS (SELECT avg(t) AS mg, stddev_samp(t) AS sg FROM ls WHERE year <= {TRAIN_END}),
locstats AS (SELECT {LOC_SQL}, observation_date, month_index, n AS __n,
    CASE WHEN year <= {TRAIN_END} THEN CASE WHEN n > 0 THEN s / n END ELSE coalesce(mf, mz, mg) END AS loc_mean_temperature,
    CASE WHEN year <= {TRAIN_END} THEN CASE WHEN n > 1 THEN sqrt(greatest((ss - s * s / n) / (n - 1), 0.0)) END
         ELSE coalesce(sf, sz, sg) END AS loc_temperature_std
  FROM ls2 LEFT JOIN lsf USING ({LOC_SQL}) LEFT JOIN lsz USING (zone), lsg)
"""


@register("past_only_location_stats", with_clean(LOCSTATS_CTES + "SELECT * FROM locstats"),
          round_cols=["loc_mean_temperature", "loc_temperature_std"], ids="WIN-04 FEA-12")
def past_only_location_stats(spark, sf):
    return fe.location_stats(clean_frame(spark, sf), TARGET, TRAIN_END)


LOO_SQL = with_clean(f"""
, x AS (SELECT {LOC_SQL}, observation_date, month, {TARGET} AS t,
  count(t) OVER w - CASE WHEN t IS NOT NULL THEN 1 ELSE 0 END AS n,
  sum(t) OVER w - coalesce(t, 0.0) AS s, sum(t * t) OVER w - coalesce(t * t, 0.0) AS ss
  FROM clean WINDOW w AS ({_LOCW}, month))
SELECT {LOC_SQL}, observation_date, month, CASE WHEN n > 0 THEN s / n END AS loo_mean,
  CASE WHEN n > 1 THEN sqrt(greatest((ss - s * s / n) / (n - 1), 0.0)) END AS loo_std FROM x""")


@register("leave_one_out", LOO_SQL, round_cols=["loo_mean", "loo_std"], ids="WIN-05 WIN-06 FEA-10")
def leave_one_out(spark, sf):
    c = clean_frame(spark, sf)
    m, s = fe.leave_one_out(TARGET, LOC + ["month"])
    return c.select(*LOC, "observation_date", "month", m.alias("loo_mean"), s.alias("loo_std"))


GLOBAL_CTES = f"""
, g AS (SELECT observation_date, year, month, year(observation_date) * 12 + month(observation_date) AS month_index,
  land_average_temperature AS v FROM global_view),
base AS (SELECT g.*, CASE WHEN year <= {TRAIN_END}
    THEN avg(v) OVER (PARTITION BY month ORDER BY month_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ELSE (SELECT avg(v) FROM g g2 WHERE g2.month = g.month AND g2.year <= {TRAIN_END}) END AS baseline FROM g),
an AS (SELECT *, v - baseline AS land_anomaly FROM base),
global_lags AS (SELECT observation_date, v AS land_temperature,
  max(v) OVER (ORDER BY month_index RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS land_temperature_lag_1,
  land_anomaly,
  max(land_anomaly) OVER (ORDER BY month_index RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS land_anomaly_lag_1
FROM an)"""
GLOBAL_LAG_SQL = with_star(GLOBAL_CTES + "SELECT * FROM global_lags")


@register("global_lag", GLOBAL_LAG_SQL,
          round_cols=["land_temperature", "land_temperature_lag_1", "land_anomaly", "land_anomaly_lag_1"],
          ids="WIN-10 FEA-14")
def global_lag(spark, sf):
    """The global series has one value per month, so its windows run on ~12 rows per year.  The
    same-month baseline is past-only on train years and the fixed train mean afterwards; the
    temperature and the anomaly are lagged by one calendar month."""
    g = build_star(spark, sf).global_view().select(
        "observation_date", "year", "month", month_index("observation_date").alias("month_index"),
        F.col("land_average_temperature").alias("v"))
    past = F.avg("v").over(Window.partitionBy("month").orderBy("month_index")
                           .rowsBetween(Window.unboundedPreceding, -1))
    fixed = g.where(F.col("year") <= TRAIN_END).groupBy("month").agg(F.avg("v").alias("__fixed"))
    an = (g.join(F.broadcast(fixed), "month", "left")  # 12 rows
          .withColumn("land_anomaly", F.col("v") - F.when(F.col("year") <= TRAIN_END, past).otherwise(F.col("__fixed"))))
    lag = Window.orderBy("month_index").rangeBetween(-1, -1)
    return an.select("observation_date", F.col("v").alias("land_temperature"),
                     F.max("v").over(lag).alias("land_temperature_lag_1"), "land_anomaly",
                     F.max("land_anomaly").over(lag).alias("land_anomaly_lag_1"))


# ---------------------------------------------------------------- feature table

FEATURE_COLUMNS = ["month_sin", "month_cos", "climatic_month_sin", "climatic_month_cos", "years_since_start",
                   "abs_latitude", "hemisphere_north", "abslat_x_month_sin", "abslat_x_month_cos",
                   "loc_month_climatology", "loc_climatology_imputed", "loc_mean_temperature",
                   "loc_temperature_std", "temp_lag_1", "temp_lag_12", "temp_roll_mean_12", "temp_roll_std_12",
                   "temp_anomaly_lag_12"]
FEATURE_DOUBLES = [TARGET, "month_sin", "month_cos", "climatic_month_sin", "climatic_month_cos", "abs_latitude",
                   "abslat_x_month_sin", "abslat_x_month_cos", "loc_month_climatology", "loc_mean_temperature",
                   "loc_temperature_std", "temp_lag_1", "temp_lag_12", "temp_roll_mean_12", "temp_roll_std_12",
                   "temp_anomaly_lag_12", "latitude", "longitude"]


def feature_frame(spark, sf) -> DataFrame:
    """Every clean row with its features: one shuffle by location, all statistics are windows after it."""
    def build():
        c = fe.with_month_index(clean_frame(spark, sf)).select(*LOC, "observation_date", "year", "month", "month_index", TARGET)
        start = c.agg(F.min("year")).first()[0]
        mean12, std12 = fe.trailing_stats(TARGET, LOC, 12, 6)
        base = c.select("*", fe.calendar_lag(TARGET, 1, LOC).alias("temp_lag_1"),
                        fe.calendar_lag(TARGET, 12, LOC).alias("temp_lag_12"),
                        mean12.alias("temp_roll_mean_12"), std12.alias("temp_roll_std_12"))
        base = fe.with_location_stats(base, c, TARGET, TRAIN_END)
        base = fe.with_climatology(base, c, TARGET, TRAIN_END, VALIDATION_END)
        out = fe.cyclic_features(base, start_year=start)
        out = out.withColumn("temp_anomaly_lag_12", F.col("temp_lag_12") - F.col("loc_month_climatology"))
        return out.select(*LOC, "observation_date", "year", "month", TARGET, *FEATURE_COLUMNS, "data_split",
                          "is_train_period")
    return stage(spark, "features", sf, build)


_LAGW = f"{_LOCW} ORDER BY month_index"
FEATURE_CTES = CLIM_CTES + LOCSTATS_CTES + f"""
, fb AS (SELECT {LOC_SQL}, observation_date, year, month, year(observation_date) * 12 + month(observation_date)
    AS month_index, {TARGET}, {_CM} AS climatic_month, year - (SELECT min(year) FROM clean) AS years_since_start,
    abs(latitude) AS abs_latitude, latitude >= 0 AS hemisphere_north FROM clean),
fb2 AS (SELECT *, sin({_ANG} * month) AS month_sin, cos({_ANG} * month) AS month_cos,
    sin({_ANG} * climatic_month) AS climatic_month_sin, cos({_ANG} * climatic_month) AS climatic_month_cos,
    abs_latitude * sin({_ANG} * climatic_month) AS abslat_x_month_sin,
    abs_latitude * cos({_ANG} * climatic_month) AS abslat_x_month_cos,
    max({TARGET}) OVER ({_LAGW} RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING) AS temp_lag_1,
    max({TARGET}) OVER ({_LAGW} RANGE BETWEEN 12 PRECEDING AND 12 PRECEDING) AS temp_lag_12,
    CASE WHEN count({TARGET}) OVER w12 >= 6 THEN avg({TARGET}) OVER w12 END AS temp_roll_mean_12,
    CASE WHEN count({TARGET}) OVER w12 >= 6 THEN stddev_samp({TARGET}) OVER w12 END AS temp_roll_std_12
  FROM fb WINDOW w12 AS ({_LAGW} RANGE BETWEEN 12 PRECEDING AND 1 PRECEDING)),
features AS (SELECT fb2.{LOC[0]}, fb2.country_name, fb2.latitude, fb2.longitude, fb2.observation_date, fb2.year,
    fb2.month, fb2.{TARGET}, month_sin, month_cos, climatic_month_sin, climatic_month_cos, years_since_start,
    abs_latitude, hemisphere_north, abslat_x_month_sin, abslat_x_month_cos, loc_month_climatology,
    loc_climatology_imputed, loc_mean_temperature, loc_temperature_std, temp_lag_1, temp_lag_12, temp_roll_mean_12,
    temp_roll_std_12, temp_lag_12 - loc_month_climatology AS temp_anomaly_lag_12, clim.data_split,
    clim.is_train_period
  FROM fb2 JOIN clim USING ({LOC_SQL}, observation_date) JOIN locstats USING ({LOC_SQL}, observation_date))
"""


def with_features(body: str) -> str:
    return with_clean(FEATURE_CTES + body)


@register("feature_table", with_features("SELECT * FROM features"), round_cols=FEATURE_DOUBLES,
          ids="FEA-13 FEA-16 PRJ-17 WIN-09 SNK-03")
def feature_table(spark, sf):
    return feature_frame(spark, sf)


SPLIT_SQL = with_features(f"""
SELECT data_split, count(*) AS rows, min(observation_date) AS min_date, max(observation_date) AS max_date,
  avg({TARGET}) AS target_mean, count(*) * 100.0 / (SELECT count(*) FROM features) AS share_percent
FROM features GROUP BY data_split""")


@register("split_summary", SPLIT_SQL, round_cols=["target_mean", "share_percent"], ids="AGG-46 DQ-28")
def split_summary(spark, sf):
    f = feature_frame(spark, sf)
    total = f.agg(F.count(F.lit(1)).alias("__total"))
    return (f.groupBy("data_split").agg(F.count(F.lit(1)).alias("rows"), F.min("observation_date").alias("min_date"),
                                        F.max("observation_date").alias("max_date"), F.avg(TARGET).alias("target_mean"))
            .crossJoin(F.broadcast(total))
            .select("data_split", "rows", "min_date", "max_date", "target_mean",
                    F.try_divide(F.col("rows") * 100.0, F.col("__total")).alias("share_percent")))


_LAG_COLS = ["temp_lag_1", "temp_lag_12", "temp_roll_mean_12", "temp_roll_std_12", "temp_anomaly_lag_12"]
LAGCOV_SQL = with_features(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS non_null, count({c}) * 1.0 / count(*) AS rate FROM features"
    for c in _LAG_COLS))


@register("lag_coverage", LAGCOV_SQL, round_cols=["rate"], ids="AGG-47")
def lag_coverage(spark, sf):
    f = feature_frame(spark, sf)
    row = f.agg(F.count(F.lit(1)).alias("__n"), *[F.count(c).alias(c) for c in _LAG_COLS])
    spec = ", ".join(f"'{c}', `{c}`" for c in _LAG_COLS)
    return row.selectExpr("__n", f"stack({len(_LAG_COLS)}, {spec}) AS (feature, non_null)").select(
        "feature", "non_null", F.try_divide(F.col("non_null").cast("double"), F.col("__n")).alias("rate"))


LEAK_SQL = with_features(f"""
, prev AS (SELECT {LOC_SQL}, observation_date + INTERVAL 12 MONTH AS observation_date, {TARGET} AS t12 FROM features),
firsts AS (SELECT * FROM features QUALIFY row_number() OVER ({_LOCW} ORDER BY observation_date) = 1)
SELECT 'lag_12_equals_target_12_months_earlier' AS check_name,
  (SELECT count(*) FROM features f JOIN prev p USING ({LOC_SQL}, observation_date)
   WHERE f.temp_lag_12 IS DISTINCT FROM p.t12) = 0 AS passed
UNION ALL SELECT 'lag_12_null_without_history',
  (SELECT count(*) FROM features f ANTI JOIN prev p USING ({LOC_SQL}, observation_date)
   WHERE f.temp_lag_12 IS NOT NULL) = 0
UNION ALL SELECT 'first_past_only_value_null',
  (SELECT count(*) FROM firsts WHERE data_split = 'train' AND loc_mean_temperature IS NOT NULL) = 0
UNION ALL SELECT 'no_feature_near_copy_of_target',
  (SELECT coalesce(greatest(abs(corr(temp_lag_1, {TARGET})), abs(corr(temp_lag_12, {TARGET})),
     abs(corr(loc_month_climatology, {TARGET})), abs(corr(loc_mean_temperature, {TARGET}))), 0.0) FROM features) < 0.999
UNION ALL SELECT 'splits_disjoint_and_ordered',
  (SELECT count(*) FROM features WHERE data_split IS NULL) = 0
  AND (SELECT max(observation_date) FROM features WHERE data_split = 'train')
      < (SELECT min(observation_date) FROM features WHERE data_split = 'validation')
  AND (SELECT max(observation_date) FROM features WHERE data_split = 'validation')
      < (SELECT min(observation_date) FROM features WHERE data_split = 'test')""")


LEAK_FEATURES = ["temp_lag_1", "temp_lag_12", "loc_month_climatology", "loc_mean_temperature"]


@register("leakage_tests", LEAK_SQL, ids="DQ-27 DQ-28 DQ-25")
def leakage_tests(spark, sf):
    """Whole-table leakage checks (no sampling): every lag equals the target 12 calendar months
    earlier or is NULL without history, the first past-only value is NULL, no feature is a near
    copy of the target, and the splits are disjoint and ordered in time."""
    from functools import reduce

    from isotherm.operators.stats import pearson
    f = feature_frame(spark, sf)
    key = LOC + ["observation_date"]
    prev = f.select(*LOC, F.add_months("observation_date", 12).alias("observation_date"), F.col(TARGET).alias("__t12"))
    j = f.join(prev, key, "left")
    c1 = j.agg((F.count_if(F.col("__t12").isNotNull() & ~F.col("temp_lag_12").eqNullSafe(F.col("__t12"))) == 0)
               .alias("passed")).select(F.lit("lag_12_equals_target_12_months_earlier").alias("check_name"), "passed")
    c2 = j.agg((F.count_if(F.col("__t12").isNull() & F.col("temp_lag_12").isNotNull()) == 0).alias("passed")) \
        .select(F.lit("lag_12_null_without_history").alias("check_name"), "passed")
    first = f.groupBy(*LOC).agg(F.min(F.struct("observation_date", "data_split", "loc_mean_temperature")).alias("__f"))
    c3 = first.agg((F.count_if((F.col("__f.data_split") == "train") & F.col("__f.loc_mean_temperature").isNotNull())
                    == 0).alias("passed")).select(F.lit("first_past_only_value_null").alias("check_name"), "passed")
    r = f.agg(F.coalesce(F.greatest(*[F.abs(pearson(F.col(c), F.col(TARGET))) for c in LEAK_FEATURES]),
                         F.lit(0.0)).alias("__r"))
    c4 = r.select(F.lit("no_feature_near_copy_of_target").alias("check_name"), (F.col("__r") < 0.999).alias("passed"))
    sp = f.groupBy("data_split").agg(F.min("observation_date").alias("lo"), F.max("observation_date").alias("hi"),
                                     F.count(F.lit(1)).alias("n"))
    piv = sp.agg(F.sum(F.when(F.col("data_split").isNull(), F.col("n")).otherwise(0)).alias("nulls"),
                 F.max(F.when(F.col("data_split") == "train", F.col("hi"))).alias("tr_hi"),
                 F.min(F.when(F.col("data_split") == "validation", F.col("lo"))).alias("va_lo"),
                 F.max(F.when(F.col("data_split") == "validation", F.col("hi"))).alias("va_hi"),
                 F.min(F.when(F.col("data_split") == "test", F.col("lo"))).alias("te_lo"))
    c5 = piv.select(F.lit("splits_disjoint_and_ordered").alias("check_name"),
                    F.coalesce((F.col("nulls") == 0) & (F.col("tr_hi") < F.col("va_lo")) & (F.col("va_hi") < F.col("te_lo")),
                               F.lit(False)).alias("passed"))
    return reduce(DataFrame.unionByName, [c1, c2, c3, c4, c5])


COMPOSITE_SQL = with_clean(f"""
, ids AS (SELECT {LOC_SQL}, CAST(row_number() OVER (ORDER BY {LOC_SQL}) AS BIGINT) AS location_id
          FROM (SELECT DISTINCT {LOC_SQL} FROM clean) x),
k AS (SELECT i.location_id * 30000 + year(c.observation_date) * 12 + month(c.observation_date) AS composite_key
      FROM clean c JOIN ids i USING ({LOC_SQL}))
SELECT (SELECT count(*) FROM ids) AS locations, count(*) AS rows, count(DISTINCT composite_key) AS distinct_keys,
  CASE WHEN count(*) = count(DISTINCT composite_key) THEN 'PASS' ELSE 'FAIL' END AS status FROM k""")


@register("composite_key_check", COMPOSITE_SQL, ids="WIN-19 WIN-21 SRC-05")
def composite_key_check(spark, sf):
    """Dense location id (distributed, on the distinct locations only) joined back; the
    composite key location_id * 30000 + month_index must be unique."""
    c = clean_frame(spark, sf)
    ids = dense_index(c.select(*LOC).distinct(), LOC, "location_id")
    k = c.join(ids, LOC).select((F.col("location_id") * 30000 + month_index("observation_date")).alias("ck"))
    n_loc = ids.agg(F.count(F.lit(1)).alias("locations"))
    st = k.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("ck").alias("distinct_keys"))
    return n_loc.crossJoin(st).withColumn("status", dq.status(F.col("rows") == F.col("distinct_keys")))


STEP_SQL = with_clean(f"""
, y AS (SELECT year, avg({TARGET}) AS mean_value FROM clean GROUP BY year)
SELECT year, mean_value, lag(mean_value) OVER (ORDER BY year) - mean_value AS step_difference FROM y""")


@register("step_difference", STEP_SQL, round_cols=["mean_value", "step_difference"], ids="WIN-18")
def step_difference(spark, sf):
    """Previous step minus this one, on the yearly frame (one row per year)."""
    y = clean_frame(spark, sf).groupBy("year").agg(F.avg(TARGET).alias("mean_value"))
    return y.withColumn("step_difference", F.lag("mean_value").over(Window.orderBy("year")) - F.col("mean_value"))


# ---------------------------------------------------------------- anomaly-based warming rate

WARMING_SQL = with_clean(CLIM_CTES + f"""
, an AS (SELECT latitude_zone, year(observation_date) AS year, avg({TARGET} - loc_month_climatology) AS anomaly
         FROM clim WHERE is_train_period GROUP BY ALL)
SELECT latitude_zone, CASE WHEN count(anomaly) >= 10 THEN regr_slope(anomaly, year) END AS slope_per_year,
  count(anomaly) AS points,
  CASE WHEN count(anomaly) >= 10 THEN regr_slope(anomaly, year) END * 100 AS slope_per_century
FROM an GROUP BY latitude_zone""")


@register("warming_rate", WARMING_SQL, round_cols=["slope_per_year", "slope_per_century"],
          ids="AGG-32 FEA-17 UDF-04")
def warming_rate(spark, sf):
    """Slope of the yearly mean anomaly (target - past-only climatology) per latitude zone on train
    rows; NULL below ten years."""
    from isotherm.operators.stats import slope_by_group
    c = climatology_frame(spark, sf).where("is_train_period")
    an = c.groupBy("latitude_zone", F.year("observation_date").cast("long").alias("year")).agg(
        F.avg(F.col(TARGET) - F.col("loc_month_climatology")).alias("anomaly"))
    return slope_by_group(an, "latitude_zone", "year", "anomaly")
