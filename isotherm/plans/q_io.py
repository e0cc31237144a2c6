"""Queries: CSV round trip with a declared schema, file catalog, staged load checks, FAST_MODE scan,
sinks with read-back, scalar battery, funnel and feature selection."""

from __future__ import annotations

import math
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isotherm.functions.ids import dense_index
from isotherm.functions.labels import climatic_season, latitude_zone, temperature_class
from isotherm.functions.safe import is_false, safe_divide
from isotherm.functions.text import compose_label, split_label
from isotherm.operators import quality as dq
from isotherm.operators import sampling as sm
from isotherm.plans import driver_sources as ds
from isotherm.plans.oracle_sources import with_sources
from isotherm.plans.registry import register
from isotherm.session import scratch_path
from isotherm.sources import files as io
from isotherm.sources.tables import TABLES, table

CITY_SCHEMA = T.StructType([
    T.StructField("dt", T.DateType()), T.StructField("average_temperature", T.DoubleType()),
    T.StructField("average_temperature_uncertainty", T.DoubleType()), T.StructField("city", T.StringType()),
    T.StructField("country", T.StringType()), T.StructField("latitude", T.StringType()),
    T.StructField("longitude", T.StringType())])


def _tag() -> str:
    return uuid.uuid4().hex


@register("scan_csv_roundtrip", with_sources("SELECT * FROM city_src"),
          round_cols=["average_temperature", "average_temperature_uncertainty"], ids="SRC-01 SRC-02 SRC-03 SRC-07 SNK-01")
def scan_csv_roundtrip(spark, sf):
    """Export the raw city source as CSV (shared scratch folder), check the files exist, and scan
    them back with the declared schema in FAILFAST mode."""
    path = scratch_path(spark, f"raw_city_csv_{_tag()}")
    src = ds.city_source(spark, sf)
    io.write_csv(src, path, [f.name for f in CITY_SCHEMA.fields])
    io.require_files(spark, {"city": path})
    return io.scan_csv(spark, path, CITY_SCHEMA)


@register("file_catalog", None, ids="SRC-06 AGG-19")
def file_catalog(spark, sf):
    return reduce(DataFrame.unionByName, [io.file_catalog(table(spark, sf, t), t) for t in TABLES])


LOAD_SQL = with_sources("""
SELECT count(*) AS rows, count(*) AS expected_rows, CAST(1 AS BIGINT) AS min_id, count(*) AS max_id,
  CAST(0 AS BIGINT) AS null_loaded_at, 'PASS' AS status FROM city_src""")


@register("staged_load_check", LOAD_SQL, ids="SRC-04 SRC-05 DQ-01")
def staged_load_check(spark, sf):
    """Stage rows get a sequential id 1..N in business-key order (distributed dense index) and a
    load timestamp; the check compares rows, min / max id and NULL timestamps."""
    src = ds.city_source(spark, sf)
    expected = src.agg(F.count(F.lit(1)).alias("expected_rows"))
    staged = dense_index(src, ["dt", "city", "country", "latitude", "longitude"], "staging_id") \
        .withColumn("loaded_at", F.current_timestamp())
    st = staged.agg(F.count(F.lit(1)).alias("rows"), F.min("staging_id").alias("min_id"),
                    F.max("staging_id").alias("max_id"), F.count_if(F.col("loaded_at").isNull()).alias("null_loaded_at"))
    j = st.crossJoin(expected)
    ok = ((F.col("rows") == F.col("expected_rows")) & (F.col("min_id") == 1) & (F.col("max_id") == F.col("rows"))
          & (F.col("null_loaded_at") == 0))
    return j.select("rows", "expected_rows", "min_id", "max_id", "null_loaded_at", dq.status(ok).alias("status"))


SCAN_COLUMNS = ["l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"]
SCAN_START, SCAN_END = "1995-01-01", "1998-01-01"
LIMITED_SQL = f"""SELECT {', '.join(SCAN_COLUMNS)} FROM lineitem
WHERE l_shipdate >= DATE '{SCAN_START}' AND l_shipdate < DATE '{SCAN_END}'"""


@register("limited_scan", LIMITED_SQL, ids="SRC-09 SRC-08")
def limited_scan(spark, sf):
    """A quick partial run reads few columns of a range of whole periods; both are pushed to the scan."""
    return sm.range_scan(table(spark, sf, "lineitem"), SCAN_COLUMNS, "l_shipdate", SCAN_START, SCAN_END)


@register("sink_roundtrip", None, ids="SNK-02 SNK-03 SNK-05 SRC-11 SRC-12 PRJ-17")
def sink_roundtrip(spark, sf):
    """Feature table -> gzip CSV with 4-digit floats (header read back and compared), Parquet table
    with count and key checks, JSON contract written and read back with required keys."""
    from isotherm.plans.q_features import FEATURE_COLUMNS, TRAIN_END, VALIDATION_END, feature_frame
    f = feature_frame(spark, sf)
    order = ["city_name", "country_name", "latitude", "longitude", "observation_date", "year", "month",
             "city_average_temperature", *FEATURE_COLUMNS, "data_split", "is_train_period"]
    tag = _tag()
    csv_path = scratch_path(spark, f"features_csv_{tag}")
    io.write_csv(f, csv_path, order, gzip=True, float_digits=4)
    header_ok = io.read_back_header(spark, csv_path) == order
    table_path = scratch_path(spark, f"features_table_{tag}")
    tbl = io.write_table(f, table_path, ["city_name", "country_name", "latitude", "longitude", "observation_date"])
    read_ok = io.contract_read(spark, table_path, order).columns == order
    counts = {r["data_split"]: r["n"] for r in f.groupBy("data_split").agg(F.count(F.lit(1)).alias("n")).collect()}
    doc = {"target": "city_average_temperature", "features": FEATURE_COLUMNS, "train_end": TRAIN_END,
           "validation_end": VALIDATION_END, "split_counts": counts}
    jpath = scratch_path(spark, f"features_meta_{tag}")
    io.write_json_document(spark, doc, jpath)
    back = io.read_json_contract(spark, jpath, ["target", "features", "split_counts"])
    return tbl.select("expected_rows", "written_rows", "distinct_keys", "passed",
                      F.lit(header_ok).alias("csv_header_ok"),
                      F.lit(back["split_counts"] == counts).alias("json_contract_ok"),
                      F.lit(read_ok).alias("contract_read_ok"))


# ---------------------------------------------------------------- scalar battery and funnel

LABELLED_SQL = """
SELECT s_suppkey,
  CASE WHEN s_acctbal / 300 < 0 THEN 'Very cold' WHEN s_acctbal / 300 < 12 THEN 'Cool' WHEN s_acctbal / 300 < 22 THEN 'Mild'
       WHEN s_acctbal / 300 < 30 THEN 'Warm' WHEN s_acctbal IS NOT NULL THEN 'Hot' END AS temperature_class,
  CASE WHEN s_suppkey % 13 BETWEEN 0 AND 2 AND s_suppkey % 13 > 0 THEN 'Winter' WHEN s_suppkey % 13 > 2 AND s_suppkey % 13 <= 5 THEN 'Spring'
       WHEN s_suppkey % 13 > 5 AND s_suppkey % 13 <= 8 THEN 'Summer' WHEN s_suppkey % 13 > 8 AND s_suppkey % 13 <= 11 THEN 'Autumn'
       WHEN s_suppkey % 13 > 11 AND s_suppkey % 13 <= 12 THEN 'Winter' END AS climatic_season,
  s_name || ' (' || n.n_name || ')' AS display_key,
  regexp_extract(s_name || ' (' || n.n_name || ')', '^(.*) \\((.*)\\)$', 1) AS display_name,
  s_acctbal / NULLIF(s_nationkey, 0) AS acctbal_per_nation_key,
  (s_acctbal < 0) IS FALSE AS not_negative_or_unknown,
  CASE WHEN s_nationkey % 4 = 0 THEN NULL ELSE s_acctbal > 5000 END IS FALSE AS is_false_test
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey"""


@register("labelled_rows", LABELLED_SQL, round_cols=["acctbal_per_nation_key"],
          ids="PRJ-14 PRJ-15 PRJ-16 SCA-05 SCA-06 SCA-07 UDF-01")
def labelled_rows(spark, sf):
    s = table(spark, sf, "supplier")
    n = table(spark, sf, "nation")
    j = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)
    label = compose_label("s_name", "n_name")
    name, _ = split_label(label)
    maybe = F.when(F.col("s_nationkey") % 4 == 0, F.lit(None).cast("boolean")).otherwise(F.col("s_acctbal") > 5000)
    return j.select("s_suppkey", temperature_class(F.col("s_acctbal") / 300).alias("temperature_class"),
                    climatic_season(F.col("s_suppkey") % 13).alias("climatic_season"), label.alias("display_key"),
                    F.coalesce(name, F.lit("")).alias("display_name"),
                    safe_divide("s_acctbal", "s_nationkey").alias("acctbal_per_nation_key"),
                    is_false(F.col("s_acctbal") < 0).alias("not_negative_or_unknown"),
                    is_false(maybe).alias("is_false_test"))


FUNNEL_SQL = with_sources("""
, top AS (SELECT n_nationkey FROM (SELECT s.s_nationkey AS n_nationkey, count(*) AS c FROM obs_rows o
          JOIN supplier s ON o.l_suppkey = s.s_suppkey GROUP BY 1) ORDER BY c DESC, n_nationkey LIMIT 10),
f AS (SELECT o.* FROM obs_rows o JOIN supplier s ON o.l_suppkey = s.s_suppkey WHERE s.s_nationkey IN (SELECT * FROM top)),
steps AS (SELECT 1 AS step, 'raw' AS stage, count(*) AS rows FROM obs_rows
  UNION ALL SELECT 2, 'top_10_countries', count(*) FROM f
  UNION ALL SELECT 3, 'date_window', count(*) FROM f WHERE dt >= DATE '1996-01-01' AND dt < DATE '2001-01-01')
SELECT step, stage, rows, rows * 100.0 / (SELECT rows FROM steps WHERE step = 1) AS percent_of_first FROM steps""")


@register("funnel", FUNNEL_SQL, round_cols=["percent_of_first"], ids="AGG-45 FLT-01 FLT-02")
def funnel(spark, sf):
    rows = ds.observation_rows(spark, sf).select("l_suppkey", "dt")
    s = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    r = rows.join(s, rows.l_suppkey == s.s_suppkey)
    top = (r.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("c"))
           .orderBy(F.desc("c"), "s_nationkey").limit(10).select("s_nationkey"))
    f = r.join(F.broadcast(top), "s_nationkey", "left_semi")  # at most 10 rows
    window = f.where((F.col("dt") >= F.lit("1996-01-01").cast("date")) & (F.col("dt") < F.lit("2001-01-01").cast("date")))
    steps = [rows.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(1).alias("step"), F.lit("raw").alias("stage"), "rows"),
             f.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(2).alias("step"), F.lit("top_10_countries").alias("stage"), "rows"),
             window.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(3).alias("step"), F.lit("date_window").alias("stage"), "rows")]
    u = reduce(DataFrame.unionByName, steps)
    first = u.where("step = 1").select(F.col("rows").alias("__first"))
    return u.crossJoin(F.broadcast(first)).select(
        "step", "stage", "rows", F.try_divide(F.col("rows") * 100.0, F.col("__first")).alias("percent_of_first"))


# ---------------------------------------------------------------- feature selection

# Feature catalogue (group, availability, force_keep) for the deployed candidates.
CATALOG = {
    "month_sin": ("calendar", "static", False), "month_cos": ("calendar", "static", False),
    "climatic_month_sin": ("calendar", "static", True), "climatic_month_cos": ("calendar", "static", True),
    "years_since_start": ("trend", "static", False), "abs_latitude": ("geography", "static", True),
    "hemisphere_north": ("geography", "static", False), "latitude": ("geography", "static", False),
    "longitude": ("geography", "static", False), "abslat_x_month_sin": ("interaction", "static", False),
    "abslat_x_month_cos": ("interaction", "static", False),
    "loc_month_climatology": ("climatology", "fit_stat", True),
    "loc_climatology_imputed": ("climatology", "fit_stat", False),
    "loc_mean_temperature": ("location", "fit_stat", False), "loc_temperature_std": ("location", "fit_stat", False),
    "temp_lag_1": ("history", "history", False), "temp_lag_12": ("history", "history", False),
    "temp_roll_mean_12": ("history", "history", False), "temp_roll_std_12": ("history", "history", False),
    "temp_anomaly_lag_12": ("history", "history", False),
}
WEAK_ETA2, WEAK_R, REDUNDANT_R = 0.005, 0.05, 0.95


def select_features_rules(metrics: list[dict], redundant: list[tuple[str, str, float]],
                          allowed_availability: tuple[str, ...] = ("static", "fit_stat")) -> list[tuple]:
    """FSEL-06/07 on a metric-sized list: availability gate (v1) -> force keep -> constant -> weak ->
    redundant loser (lower eta2).  Returns (feature, group, decision, reason) rows."""
    m = {r["feature"]: r for r in metrics}
    decisions = {}
    for feat, (group, avail, force) in CATALOG.items():
        r = m.get(feat, {})
        if avail not in allowed_availability:
            decisions[feat] = ("drop", "availability")
        elif force:
            decisions[feat] = ("keep", "force_keep")
        elif r.get("distinct", 0) <= 1:
            decisions[feat] = ("drop", "constant")
        elif (r.get("eta2") or 0.0) < WEAK_ETA2 and abs(r.get("r") or 0.0) < WEAK_R:
            decisions[feat] = ("drop", "weak")
        else:
            decisions[feat] = ("keep", "signal")
    for a, b, _ in sorted(redundant, key=lambda t: -abs(t[2])):
        if decisions.get(a, ("drop",))[0] == "keep" and decisions.get(b, ("drop",))[0] == "keep":
            ea, eb = (m.get(a, {}).get("eta2") or 0.0), (m.get(b, {}).get("eta2") or 0.0)
            loser = b if ea >= eb else a
            if decisions[loser][1] != "force_keep":
                decisions[loser] = ("drop", "redundant")
    return [(f, CATALOG[f][0], CATALOG[f][1], d, why) for f, (d, why) in decisions.items()]


@register("select_features", None, ids="FSEL-06 FSEL-07 FEA-18 AGG-48 TOP-05 DQ-26")
def select_features(spark, sf):
    """Metrics computed on the train rows in Spark (r, eta2, distinct values, nonlinearity); the
    rules run on the driver over that ~20-row frame, as in the reference.  Materialised once."""
    from isotherm.plans.materialize import stage
    return stage(spark, "feature_selection", sf, lambda: _select_features(spark, sf))


def _select_features(spark, sf):
    from isotherm.operators import moments as mo
    from isotherm.operators import stats as stt
    from isotherm.plans.q_features import feature_frame
    feats = list(CATALOG)
    f = feature_frame(spark, sf).where("data_split = 'train'").select(
        "city_average_temperature", *[F.col(c).cast("double").alias(c) for c in feats])
    # the moments of all pairs and the values' counts are each taken once, for two operators
    moments = mo.pair_moments(f, [*feats, "city_average_temperature"])
    values = stt.value_sums(f, feats, "city_average_temperature")
    r = stt.corr_with_target(f, feats, "city_average_temperature", moments)
    eta = stt.eta_squared(f, feats, "city_average_temperature", values=values)
    distinct = {r["feature"]: r["distinct_values"] for r in dq.feature_problems(f, feats, values).collect()}
    metrics = [dict(row.asDict(), distinct=distinct[row["feature"]]) for row in r.join(eta, "feature", "left").collect()]
    red = [(x["feature_a"], x["feature_b"], x["r"]) for x in
           stt.redundant_pairs(stt.corr_matrix(f, feats, moments), REDUNDANT_R).collect()]
    rows = select_features_rules(metrics, red)
    dec = spark.createDataFrame(rows, "feature string, feature_group string, availability string, decision string, "
                                      "reason string")
    met = spark.createDataFrame([(x["feature"], x.get("r"), x.get("eta2"), int(x["distinct"])) for x in metrics],
                                "feature string, r double, eta2 double, distinct_values long")
    out = dec.join(met, "feature", "left").withColumn(
        "nonlinearity", F.col("eta2") - F.col("r") * F.col("r"))
    return out


PROBLEM_FEATURES = ["month_sin", "month_cos", "climatic_month_sin", "climatic_month_cos", "years_since_start",
                    "abs_latitude", "loc_month_climatology", "loc_mean_temperature", "loc_temperature_std",
                    "temp_lag_1", "temp_lag_12", "temp_roll_mean_12", "temp_roll_std_12", "temp_anomaly_lag_12"]


def _problems_sql() -> str:
    from isotherm.plans.q_features import with_features
    parts = [f"""SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL OR isnan({c})) AS missing,
  count(*) FILTER (WHERE isinf({c})) AS infinite, count(DISTINCT {c}) AS distinct_values,
  count(DISTINCT {c}) <= 1 AS constant FROM features""" for c in PROBLEM_FEATURES]
    return with_features(" UNION ALL ".join(parts))


@register("feature_problems", _problems_sql(), ids="DQ-26 DQ-25 PRJ-10")
def feature_problems(spark, sf):
    """Missing / infinite / distinct / constant per feature; the feature contract is checked on the
    driver first (names, target, order, availability) and the query fails if it is broken."""
    from isotherm.plans.q_features import feature_frame
    from isotherm.plans.q_model import CATEGORICAL, NUMERIC
    checks = dq.feature_contract(NUMERIC + CATEGORICAL, "city_average_temperature", NUMERIC, CATEGORICAL,
                                 {f: CATALOG[f][1] for f in CATALOG}, ("static", "fit_stat"))
    broken = [name for name, ok in checks if not ok]
    if broken:
        raise ValueError(f"feature contract broken: {broken}")
    return dq.feature_problems(feature_frame(spark, sf), PROBLEM_FEATURES)


@register("selection_crosstab", None, ids="AGG-48")
def selection_crosstab(spark, sf):
    """Feature group × keep / drop counts of the selection decisions (a ~20-row frame)."""
    d = select_features(spark, sf)
    return d.groupBy("feature_group").pivot("decision", ["keep", "drop"]).agg(F.count(F.lit(1))).na.fill(0)


@register("nonlinear_top5", None, ids="TOP-05")
def nonlinear_top5(spark, sf):
    """The five features with the largest eta2 - r2 (non-linear signal)."""
    return select_features(spark, sf).where(F.col("nonlinearity").isNotNull()) \
        .orderBy(F.desc("nonlinearity"), "feature").limit(5)
