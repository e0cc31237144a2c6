"""Queries: model fits, comparison, ablation, rolling backtest, refit, artifacts and batch scoring."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isotherm.functions.labels import climatic_month, latitude_zone, split_label_for_year
from isotherm.functions.text import compose_label
from isotherm.operators import boosting as bo
from isotherm.operators import joins as jn
from isotherm.operators import modeling as ml
from isotherm.operators import moments as mo
from isotherm.plans.driver_star import build_star
from isotherm.plans.materialize import app_key, stage
from isotherm.plans.q_clean import clean_frame, with_clean
from isotherm.plans.q_features import FEATURE_CTES, TRAIN_END, VALIDATION_END, feature_frame, with_features
from isotherm.plans.registry import register
from isotherm.session import scratch_path

TARGET = "city_average_temperature"
NUMERIC = ["month_sin", "month_cos", "climatic_month_sin", "climatic_month_cos", "years_since_start", "abs_latitude",
           "hemisphere_north", "latitude", "longitude", "abslat_x_month_sin", "abslat_x_month_cos",
           "loc_month_climatology", "loc_mean_temperature", "loc_temperature_std"]
CATEGORICAL = ["country_name"]
# Model sizes; boosting stops after 20 rounds without a better validation error.
FOREST = {"numTrees": 100, "maxDepth": 18, "minLeaf": 5, "featureSubsetStrategy": "0.6"}
GBT = {"rounds": 500, "patience": 20, "step": 0.08, "depth": 8, "row_share": 0.8, "feature_share": 0.8}
KEY = ["city_name", "country_name", "latitude", "longitude", "observation_date"]


def _train(spark, sf):
    return feature_frame(spark, sf).where("data_split = 'train'")


def _boosted(spark, sf) -> bo.Boosted:
    """Boosting on the train rows, ended by the validation rows; preprocessing is fitted on train."""
    key = (app_key(spark), "boosted", sf)
    if key not in _MODELS:
        f = feature_frame(spark, sf).where("data_split in ('train', 'validation')")
        prep = ml.fit_preprocessing(f.where("data_split = 'train'"), NUMERIC, CATEGORICAL)
        vectors = stage(spark, "boosting_vectors", sf, lambda: ml.predict(prep, f, NUMERIC).select("data_split", TARGET, "features"))
        _MODELS[key] = bo.boost(vectors.where("data_split = 'train'"), TARGET, vectors.where("data_split = 'validation'"),
                                before=prep.stages, **GBT)
    return _MODELS[key]


def _model(spark, sf, kind):
    if kind == "gbt":
        return _boosted(spark, sf).model
    key = (app_key(spark), kind, sf)
    if key not in _MODELS:
        _MODELS[key] = ml.fit(_train(spark, sf), NUMERIC, CATEGORICAL, TARGET, kind, **(FOREST if kind == "forest" else {}))
    return _MODELS[key]


_MODELS: dict = {}


def _scored(spark, sf, kind):
    return ml.predict(_model(spark, sf, kind), feature_frame(spark, sf), NUMERIC)


def _metrics_by_split(pred: DataFrame, method: str) -> DataFrame:
    return ml.metrics(pred, TARGET, "prediction", ["data_split"]).withColumn("method", F.lit(method))


BASELINE_SQL = with_features("""
, p AS (SELECT data_split, city_average_temperature AS y, loc_month_climatology AS yhat,
  avg(city_average_temperature) OVER (PARTITION BY data_split) AS m FROM features
  WHERE city_average_temperature IS NOT NULL AND loc_month_climatology IS NOT NULL)
SELECT data_split, count(*) AS n, avg(abs(y - yhat)) AS mae, sqrt(avg((y - yhat) * (y - yhat))) AS rmse,
  1 - sum((y - yhat) * (y - yhat)) / sum((y - m) * (y - m)) AS r2, avg(y - yhat) AS bias, 'climatology' AS method
FROM p GROUP BY data_split""")


@register("baseline_metrics", BASELINE_SQL, round_cols=["mae", "rmse", "r2", "bias"], ids="ML-07 ML-08")
def baseline_metrics(spark, sf):
    f = feature_frame(spark, sf).withColumn("prediction", F.col("loc_month_climatology"))
    return _metrics_by_split(f, "climatology")


@register("model_linear", None, ids="ML-01 ML-02 ML-07 PRJ-10")
def model_linear(spark, sf):
    return _metrics_by_split(_scored(spark, sf, "linear"), "linear_regression")


@register("model_forest", None, ids="ML-04 ML-07")
def model_forest(spark, sf):
    return _metrics_by_split(_scored(spark, sf, "forest"), "random_forest")


@register("model_gbt", None, ids="ML-05 ML-07")
def model_gbt(spark, sf):
    return _metrics_by_split(_scored(spark, sf, "gbt"), "gradient_boosting")


@register("boosting_curve", None, ids="ML-05")
def boosting_curve(spark, sf):
    """Train and validation error of every boosting round, and the round that is kept."""
    b = _boosted(spark, sf)
    return spark.createDataFrame([(k, t, v, k == b.rounds) for k, t, v in b.curve],
                                 "round long, train_rmse double, validation_rmse double, kept boolean")


@register("model_compare", None, ids="ML-09 TOP-06")
def model_compare(spark, sf):
    """All methods' train / validation metrics; sorted by validation RMSE; the winner, its
    train-validation gap and margin to the runner-up (a frame of a few rows)."""
    rows = reduce(DataFrame.unionByName, [
        baseline_metrics(spark, sf), model_linear(spark, sf), model_forest(spark, sf), model_gbt(spark, sf)])
    val = rows.where("data_split = 'validation'").select("method", F.col("rmse").alias("validation_rmse"),
                                                        F.col("mae").alias("validation_mae"), F.col("r2").alias("validation_r2"))
    tr = rows.where("data_split = 'train'").select("method", F.col("rmse").alias("train_rmse"))
    w = Window.orderBy("validation_rmse", "method")
    out = val.join(tr, "method", "left").withColumn("rank", F.row_number().over(w))  # <= 4 rows
    second = F.lead("validation_rmse").over(w)
    return out.select("*", (F.col("validation_rmse") - F.col("train_rmse")).alias("generalisation_gap"),
                      F.when(F.col("rank") == 1, second - F.col("validation_rmse")).alias("margin_to_second"))


@register("model_coefficients", None, ids="ML-03 ML-06")
def model_coefficients(spark, sf):
    """Linear coefficients and both ensembles' importances, every slot by its feature's name."""
    rows = [("linear_regression", n, v) for n, v in ml.coefficients(_model(spark, sf, "linear"), NUMERIC)]
    rows += [("random_forest", n, v) for n, v in ml.importances(_model(spark, sf, "forest"), NUMERIC)]
    rows += [("gradient_boosting", n, v) for n, v in ml.importances(_model(spark, sf, "gbt"), NUMERIC)]
    return spark.createDataFrame(rows, "method string, feature string, value double")


@register("exploratory_importance", None, ids="FSEL-08")
def exploratory_importance(spark, sf):
    """Importances of a 60-tree forest on a repeatable sample of the complete validation rows."""
    f = feature_frame(spark, sf).where("data_split = 'validation'")
    return ml.exploratory_importance(f, NUMERIC, TARGET, KEY, max_rows=120_000)


RESIDUAL_SHARE = 0.25
RESIDUAL_SQL = with_features(f"""
SELECT city_name, country_name, latitude, longitude, observation_date, {TARGET} AS actual, loc_month_climatology AS predicted,
  {TARGET} - loc_month_climatology AS residual, abs({TARGET} - loc_month_climatology) AS abs_residual FROM features
WHERE data_split = 'validation' AND {TARGET} IS NOT NULL AND loc_month_climatology IS NOT NULL
  AND CAST('0x' || substr(md5(concat_ws('|', coalesce(city_name, ''), coalesce(country_name, ''),
    coalesce(CAST(observation_date AS VARCHAR), ''))), 1, 8) AS BIGINT) % 10000 < {round(RESIDUAL_SHARE * 10000)}""")


@register("residual_frame", RESIDUAL_SQL, round_cols=["latitude", "longitude", "actual", "predicted", "residual", "abs_residual"], ids="ML-13")
def residual_frame(spark, sf):
    """Keyed residuals of the climatology predictor on a repeatable quarter of the validation rows."""
    f = feature_frame(spark, sf).where("data_split = 'validation'").withColumn("prediction", F.col("loc_month_climatology"))
    return ml.diagnostic_sample(ml.residuals(f, KEY, TARGET), ["city_name", "country_name", "observation_date"], RESIDUAL_SHARE)


@register("model_residuals", None, ids="ML-13")
def model_residuals(spark, sf):
    """Residual summary of every fitted model per split: rows, mean, deviation, largest error."""
    out = []
    for kind in ("linear", "forest", "gbt"):
        r = ml.residuals(_scored(spark, sf, kind), [*KEY, "data_split"], TARGET)
        out.append(r.groupBy("data_split").agg(
            F.count(F.lit(1)).alias("n"), F.avg("residual").alias("mean_residual"), F.stddev_samp("residual").alias("std_residual"),
            F.max("abs_residual").alias("largest_residual")).select(F.lit(kind).alias("method"), "*"))
    return reduce(DataFrame.unionByName, out)


ABLATION_SETS = [
    ["month_sin", "month_cos"],
    ["climatic_month_sin", "climatic_month_cos", "abs_latitude", "hemisphere_north"],
    ["abslat_x_month_sin", "abslat_x_month_cos", "years_since_start"],
    ["loc_month_climatology", "loc_climatology_imputed"],
    ["loc_mean_temperature", "loc_temperature_std"],
    ["temp_lag_12"],
]


@register("ablation", None, ids="ML-10 WIN-18")
def ablation(spark, sf):
    """Six cumulative feature sets, one least-squares fit each; RMSE and improvement over the previous set.

    The train and validation rows are read once each (after a pass for the train means) into cross
    products of all columns; every set is a part of the same matrix, and its validation error follows
    from the validation products."""
    f = feature_frame(spark, sf)
    every = [c for extra in ABLATION_SETS for c in extra]
    columns = mo.present(every, mo.centres(f.where("data_split = 'train'"), every))
    train = mo.cross_products(f.where("data_split = 'train'"), columns, F.col(TARGET))
    val = mo.cross_products(f.where("data_split = 'validation'"), columns, F.col(TARGET))
    rows, cols = [], []
    for step, extra in enumerate(ABLATION_SETS, start=1):
        cols = cols + extra
        fitted = train.solve([n for c in cols for n in (c, f"{c}__missing")])
        rows.append((step, len(cols), val.rmse(fitted)))
    before = [None, *[r[2] for r in rows]]
    return spark.createDataFrame([(*r, None if b is None else b - r[2]) for r, b in zip(rows, before, strict=False)],
                                 "step int, n_features int, rmse double, rmse_improvement double")


# Rolling origins from the end of the train years on: the climatology of later rows is fitted on train only.
ORIGINS = ["1998-12-01", "1999-03-01", "1999-06-01", "1999-09-01"]


def _horizon(origin: str):
    o = F.lit(origin).cast("date")
    d = F.col("observation_date")
    return (F.col("data_split") == "validation") & (d > o) & (d <= F.add_months(o, 12)), F.months_between(d, o).cast("long")


@register("backtest", None, ids="ML-11 FLT-08")
def backtest(spark, sf):
    """Rolling-origin backtest: for each origin, fit on rows up to the origin, score the validation
    rows of the next 12 months (linear model and climatology); metrics by origin, method and horizon.

    The rows between two origins are added up once; an origin's fit solves the sum of the products up
    to it.  All origins score in one scan of the validation rows."""
    f = feature_frame(spark, sf)
    middle = mo.centres(f.where(F.col("observation_date") <= F.lit(ORIGINS[0]).cast("date")), NUMERIC)
    columns = {**mo.present(NUMERIC, middle), **mo.one_hot("country_name", mo.levels(f, "country_name"))}
    d, total, cases = F.col("observation_date"), None, []
    for before, origin in zip([None, *ORIGINS], ORIGINS, strict=False):
        part = f.where(d <= F.lit(origin).cast("date"))
        part = part if before is None else part.where(d > F.lit(before).cast("date"))
        products = mo.cross_products(part, columns, F.col(TARGET))
        total = products if total is None else total + products
        inside, horizon = _horizon(origin)
        for method, prediction in (("linear_regression", mo.linear_prediction(total.solve(list(columns)), columns)),
                                   ("climatology", F.col("loc_month_climatology"))):
            cases.append(F.when(inside, F.struct(F.lit(origin).cast("date").alias("origin"), F.lit(method).alias("method"),
                                                 horizon.alias("horizon"), prediction.alias("prediction"))))
    scored = (f.where("data_split = 'validation'").select(TARGET, F.explode(F.array(*cases)).alias("c"))
              .where("c IS NOT NULL").select(TARGET, "c.*"))
    return ml.metrics(scored, TARGET, "prediction", ["origin", "method", "horizon"])


KINDS = {"linear_regression": "linear", "random_forest": "forest", "gradient_boosting": "gbt"}


def refit(spark, sf, kind: str):
    """The chosen kind of model on train + validation; a boosted one with the rounds its search kept."""
    f = feature_frame(spark, sf).where("data_split in ('train', 'validation')")
    if kind != "gbt":
        return ml.fit(f, NUMERIC, CATEGORICAL, TARGET, kind, **(FOREST if kind == "forest" else {}))
    prep = ml.fit_preprocessing(f, NUMERIC, CATEGORICAL)
    params = {**GBT, "rounds": _boosted(spark, sf).rounds}
    return bo.boost(stage(spark, "refit_vectors", sf, lambda: ml.predict(prep, f, NUMERIC).select(TARGET, "features")),
                    TARGET, before=prep.stages, **params).model


@register("refit_test", None, ids="ML-12 ML-14")
def refit_test(spark, sf):
    """Refit the fitted model of least validation error on train + validation, evaluate once on test; plus
    one held-out example row."""
    best = model_compare(spark, sf).where(F.col("method").isin(*KINDS)).orderBy("rank").first()["method"]
    pred = ml.predict(refit(spark, sf, KINDS[best]), feature_frame(spark, sf).where("data_split = 'test'"), NUMERIC)
    pred = stage(spark, f"refit_{KINDS[best]}", sf, lambda: pred.select(*KEY, TARGET, "prediction"))
    met = ml.metrics(pred, TARGET).withColumn("method", F.lit(f"{best}_refit"))
    example = pred.orderBy("observation_date", "city_name").limit(1).select(
        F.abs(F.col(TARGET) - F.col("prediction")).alias("example_abs_error"))
    return met.crossJoin(example)


@register("model_reload_check", None, ids="SNK-07 DQ-29")
def model_reload_check(spark, sf):
    m = _model(spark, sf, "linear")
    path = scratch_path(spark, f"model_linear_{uuid.uuid4().hex}")
    reloaded = ml.save_and_reload(m, path)
    f = feature_frame(spark, sf)
    return ml.max_abs_diff(ml.predict(m, f, NUMERIC), ml.predict(reloaded, f, NUMERIC), KEY) \
        .withColumn("passed", F.col("max_abs_diff") <= 1e-5)


# ---------------------------------------------------------------- statistics artifact and batch scoring

LOC = ["city_name", "country_name", "latitude", "longitude"]


def statistics_table(spark, sf) -> DataFrame:
    """SNK-06: (location, month) train climatology + location mean / std + geography (train only)."""
    def build():
        f = feature_frame(spark, sf).where("data_split = 'train'")
        lm = f.groupBy(*LOC, "month").agg(F.avg(TARGET).alias("loc_month_climatology"))
        loc = f.groupBy(*LOC).agg(F.avg(TARGET).alias("loc_mean_temperature"),
                                  F.stddev_samp(TARGET).alias("loc_temperature_std"))
        return lm.join(loc, LOC).withColumn("latitude_zone", latitude_zone(F.abs("latitude")))
    return stage(spark, "statistics", sf, build)


STATS_CTE = f""", stats AS (
  SELECT lm.*, loc.loc_mean_temperature, loc.loc_temperature_std,
    CASE WHEN abs(lm.latitude) >= 0 AND abs(lm.latitude) <= 23.5 THEN 'Tropical'
         WHEN abs(lm.latitude) > 23.5 AND abs(lm.latitude) <= 35 THEN 'Subtropical'
         WHEN abs(lm.latitude) > 35 AND abs(lm.latitude) <= 55 THEN 'Temperate'
         WHEN abs(lm.latitude) > 55 AND abs(lm.latitude) <= 90 THEN 'Polar' END AS latitude_zone
  FROM (SELECT city_name, country_name, latitude, longitude, month, avg({TARGET}) AS loc_month_climatology
        FROM features WHERE data_split = 'train' GROUP BY ALL) lm
  JOIN (SELECT city_name, country_name, latitude, longitude, avg({TARGET}) AS loc_mean_temperature,
          stddev_samp({TARGET}) AS loc_temperature_std FROM features WHERE data_split = 'train' GROUP BY ALL) loc
  USING (city_name, country_name, latitude, longitude))
"""


@register("feature_statistics", with_features(STATS_CTE + "SELECT * FROM stats"),
          round_cols=["loc_month_climatology", "loc_mean_temperature", "loc_temperature_std"], ids="SNK-06 JON-13")
def feature_statistics(spark, sf):
    return statistics_table(spark, sf)


# The request horizon rule (this month .. December of year + 100) and "today".
AS_OF = "2001-12-01"
START_YEAR = 1995


def requests(spark, sf) -> DataFrame:
    """Every known location asked for every month of the year after the data, plus invalid asks
    derived from the same rows (month 13, year + 101, a past month)."""
    locs = statistics_table(spark, sf).select(*LOC).distinct()
    months = spark.range(1, 13).select(F.col("id").cast("int").alias("month"))
    label = compose_label("city_name", "country_name").alias("city_label")
    ok = locs.crossJoin(months).select(label, *LOC, F.lit(2002).alias("year"), "month")
    bad = locs.select(
        label, *LOC, F.explode(F.array(F.struct(F.lit(2002).alias("year"), F.lit(13).alias("month")),
                                        F.struct(F.lit(2102).alias("year"), F.lit(1).alias("month")),
                                        F.struct(F.lit(2000).alias("year"), F.lit(5).alias("month")))).alias("r")) \
        .select("city_label", *LOC, "r.year", "r.month")
    return ok.unionByName(bad)


def validate_requests(req: DataFrame, as_of: str) -> DataFrame:
    """SCO-02: month 1..12, target month not before ``as_of`` and not after December of year+100."""
    a = F.lit(as_of).cast("date")
    valid_month = F.col("month").between(1, 12)
    target = F.when(valid_month, F.make_date(F.col("year"), F.col("month"), F.lit(1)))
    reason = (F.when(~valid_month, F.lit("invalid month"))
              .when(target < F.trunc(a, "MM"), F.lit("month is in the past"))
              .when(F.col("year") > F.year(a) + 100, F.lit("beyond the 100-year horizon")))
    return req.withColumn("target_date", target).withColumn("rejection_reason", reason)


def batch_features(spark, sf) -> DataFrame:
    """SCO-01: requests ⋈ statistics on the full location key + month; the deployed features
    (14 numbers, of which none needs history, and the country) are expressions of the statistics row (no UDF, no per-request lookup)."""
    req = validate_requests(requests(spark, sf), AS_OF).where(F.col("rejection_reason").isNull())
    statistics = statistics_table(spark, sf)
    jn.assert_unique(statistics, [*LOC, "month"], "statistics")   # many requests to one row
    j = req.join(statistics, [*LOC, "month"])
    cm = climatic_month("month", "latitude")
    import math
    ang = F.lit(2 * math.pi / 12)
    horizon = F.months_between("target_date", F.lit(AS_OF).cast("date")).cast("long")
    return j.select(
        "city_label", "city_name", "country_name", "latitude", "longitude", "year", "month", "target_date",
        F.sin(ang * F.col("month")).alias("month_sin"), F.cos(ang * F.col("month")).alias("month_cos"),
        F.sin(ang * cm).alias("climatic_month_sin"), F.cos(ang * cm).alias("climatic_month_cos"),
        (F.col("year") - START_YEAR).alias("years_since_start"), F.abs("latitude").alias("abs_latitude"),
        (F.col("latitude") >= 0).alias("hemisphere_north"),
        (F.abs("latitude") * F.sin(ang * cm)).alias("abslat_x_month_sin"),
        (F.abs("latitude") * F.cos(ang * cm)).alias("abslat_x_month_cos"),
        "loc_month_climatology", "loc_mean_temperature", "loc_temperature_std",
        horizon.alias("validated_horizon_months"), (horizon > 12).alias("is_long_term_reference"))


_ANG = "0.5235987755982988"
BATCH_SQL = with_features(STATS_CTE + f"""
, req AS (SELECT DISTINCT city_name, country_name, latitude, longitude,
          city_name || ' (' || country_name || ')' AS city_label, 2002 AS year, m AS month
        FROM stats, range(1, 13) t(m)),
r2 AS (SELECT *, make_date(year, month, 1) AS target_date FROM req WHERE month BETWEEN 1 AND 12
       AND make_date(year, month, 1) >= DATE '{AS_OF}' AND year <= 2001 + 100),
j AS (SELECT *, CASE WHEN latitude < 0 THEN ((month + 5) % 12) + 1 ELSE month END AS cm
      FROM r2 JOIN stats USING (city_name, country_name, latitude, longitude, month))
SELECT city_label, city_name, country_name, latitude, longitude, CAST(year AS BIGINT) AS year,
  CAST(month AS BIGINT) AS month, target_date,
  sin({_ANG} * month) AS month_sin, cos({_ANG} * month) AS month_cos, sin({_ANG} * cm) AS climatic_month_sin,
  cos({_ANG} * cm) AS climatic_month_cos, CAST(year - {START_YEAR} AS BIGINT) AS years_since_start,
  abs(latitude) AS abs_latitude, latitude >= 0 AS hemisphere_north,
  abs(latitude) * sin({_ANG} * cm) AS abslat_x_month_sin, abs(latitude) * cos({_ANG} * cm) AS abslat_x_month_cos,
  loc_month_climatology, loc_mean_temperature, loc_temperature_std,
  CAST(datediff('month', DATE '{AS_OF}', target_date) AS BIGINT) AS validated_horizon_months,
  datediff('month', DATE '{AS_OF}', target_date) > 12 AS is_long_term_reference FROM j""")

_BATCH_DOUBLES = ["month_sin", "month_cos", "climatic_month_sin", "climatic_month_cos", "abs_latitude",
                  "abslat_x_month_sin", "abslat_x_month_cos", "loc_month_climatology", "loc_mean_temperature",
                  "loc_temperature_std"]


@register("batch_features", BATCH_SQL, round_cols=_BATCH_DOUBLES, ids="SCO-01 SCO-02 PRJ-16 FEA-07")
def batch_features_q(spark, sf):
    return batch_features(spark, sf)


REQUEST_SQL = with_features(STATS_CTE + f"""
, locs AS (SELECT DISTINCT city_name, country_name, latitude, longitude FROM stats),
req AS (SELECT locs.*, city_name || ' (' || country_name || ')' AS city_label, 2002 AS year, m AS month
        FROM locs, range(1, 13) t(m)
        UNION ALL SELECT locs.*, city_name || ' (' || country_name || ')', y, m FROM locs,
          (VALUES (2002, 13), (2102, 1), (2000, 5)) v(y, m))
SELECT city_label, city_name, country_name, latitude, longitude, CAST(year AS BIGINT) AS year, CAST(month AS BIGINT) AS month,
  CASE WHEN month BETWEEN 1 AND 12 THEN make_date(year, month, 1) END AS target_date,
  CASE WHEN NOT (month BETWEEN 1 AND 12) THEN 'invalid month'
       WHEN make_date(year, month, 1) < DATE '{AS_OF}' THEN 'month is in the past'
       WHEN year > 2001 + 100 THEN 'beyond the 100-year horizon' END AS rejection_reason
FROM req""")


@register("request_validation", REQUEST_SQL, ids="SCO-02")
def request_validation(spark, sf):
    return validate_requests(requests(spark, sf), AS_OF)


@register("batch_score", None, ids="SCO-03 PRJ-15")
def batch_score(spark, sf):
    """SCO-03: score the request features with the linear pipeline; rounded prediction + class."""
    from isotherm.functions.labels import temperature_class
    feats = batch_features(spark, sf)
    pred = ml.predict(_model(spark, sf, "linear"), feats, NUMERIC)
    return pred.select("city_label", "year", "month", "target_date",
                       F.round("prediction", 2).alias("predicted_temperature"),
                       temperature_class("prediction").alias("temperature_class"),
                       F.when(F.col("is_long_term_reference"), F.lit("long_term_reference"))
                       .otherwise(F.lit("short_term")).alias("forecast_type"),
                       "validated_horizon_months", "is_long_term_reference")


SCENARIO_SQL = with_clean(f"""
, complete_locs AS (SELECT city_name, country_name, latitude, longitude FROM clean GROUP BY ALL HAVING count(DISTINCT month) = 12),
latest AS (SELECT c.* FROM clean c JOIN complete_locs USING (city_name, country_name, latitude, longitude)
  QUALIFY row_number() OVER (PARTITION BY city_name, country_name, latitude, longitude, month
                             ORDER BY observation_date DESC) = 1)
SELECT city_name, country_name, latitude, longitude, month, observation_date AS latest_observation,
  {TARGET} AS latest_value, {_ANG.join(['sin(', ' * month)'])} AS month_sin,
  sin({_ANG} * CASE WHEN latitude < 0 THEN ((month + 5) % 12) + 1 ELSE month END) AS climatic_month_sin
FROM latest""")


@register("scenario_12", SCENARIO_SQL, round_cols=["latest_value", "month_sin", "climatic_month_sin"],
          ids="SCO-04 WIN-17")
def scenario_12(spark, sf):
    """Locations with all 12 calendar months; the latest row per (location, month) via
    ``max(struct(date, ...))`` (a partial aggregate); calendar features recomputed."""
    import math
    c = clean_frame(spark, sf)
    full = c.groupBy(*LOC).agg(F.count_distinct("month").alias("__m")).where("__m = 12").drop("__m")
    latest = (c.join(full, LOC).groupBy(*LOC, "month")
              .agg(F.max(F.struct("observation_date", TARGET)).alias("__l")))
    ang = F.lit(2 * math.pi / 12)
    return latest.select(*LOC, "month", F.col("__l.observation_date").alias("latest_observation"),
                         F.col(f"__l.{TARGET}").alias("latest_value"), F.sin(ang * F.col("month")).alias("month_sin"),
                         F.sin(ang * climatic_month("month", "latitude")).alias("climatic_month_sin"))


LOCATIONS_SQL = with_clean("""SELECT DISTINCT city_name || ' (' || country_name || ')' AS city_label FROM clean""")


@register("requestable_locations", LOCATIONS_SQL, ids="SCO-06 PRJ-16 SET-04")
def requestable_locations(spark, sf):
    return clean_frame(spark, sf).select(compose_label("city_name", "country_name").alias("city_label")).distinct()


@register("city_comparison", None, ids="SCO-05")
def city_comparison(spark, sf):
    """The requested cities (here every listed major city), scored for the same month; kept when at
    least two are valid."""
    asked = build_star(spark, sf).dim_city.where("is_major_city").join(build_star(spark, sf).dim_country, "country_id") \
        .select(compose_label("city_name", "country_name").alias("city_label")).distinct()
    scored = batch_score(spark, sf).where("month = 7").join(asked, "city_label")
    n_valid = scored.agg(F.count(F.lit(1)).alias("__n"))
    return scored.crossJoin(n_valid).where("__n >= 2").drop("__n")
