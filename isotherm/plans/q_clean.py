"""Queries: profiles, cleaning, quality reports and the outlier study."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.operators import aggregate as agg
from isotherm.operators import clean as cl
from isotherm.operators import outliers as ol
from isotherm.operators import profile as pf
from isotherm.operators import quality as dq
from isotherm.plans import driver_sources as ds
from isotherm.plans.driver_star import build_star
from isotherm.plans.oracle_sources import with_sources, with_star
from isotherm.plans.q_star import ENRICHED_DOUBLES
from isotherm.plans.registry import register
from isotherm.sources.tables import table


def clean_frame(spark, sf) -> DataFrame:
    from isotherm.plans.materialize import stage
    return stage(spark, "clean", sf, lambda: cl.clean(build_star(spark, sf).enriched()))


_NOTNULL = " AND ".join(f"{c} IS NOT NULL" for c in cl.CRITICAL)
_KEY = ", ".join(cl.BUSINESS_KEY)
_NEG = ", ".join(f"CASE WHEN {c} >= 0 THEN {c} END AS {c}" for c in cl.UNCERTAINTY)
_DOMAIN_SQL = ("coalesce(latitude BETWEEN -90 AND 90, FALSE) AND coalesce(longitude BETWEEN -180 AND 180, FALSE) "
               "AND coalesce(city_average_temperature BETWEEN -90 AND 60, FALSE) AND coalesce(year = year(observation_date) "
               "AND month = month(observation_date) AND quarter = quarter(observation_date) "
               "AND decade = (year(observation_date) // 10) * 10, FALSE)")

CLEAN_CTES = f""", crit AS (SELECT * FROM enriched WHERE {_NOTNULL}),
dedup AS (SELECT * FROM crit QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY city_average_temperature) = 1),
dom AS (SELECT * FROM dedup WHERE {_DOMAIN_SQL}),
neg AS (SELECT * REPLACE ({_NEG}) FROM dom),
flags AS (SELECT *, city_average_temperature_uncertainty IS NOT NULL AS city_uncertainty_available,
  coalesce(country_matched, FALSE) AND country_average_temperature IS NOT NULL AS country_temperature_available,
  coalesce(global_matched, FALSE) AND land_average_temperature IS NOT NULL AS global_temperature_available,
  coalesce(major_city_matched, FALSE) AND major_city_average_temperature IS NOT NULL
    AS major_city_temperature_available FROM neg),
fences AS (SELECT q1, q3, q1 - CAST(1.5 AS DOUBLE) * (q3 - q1) AS lower_fence,
  q3 + CAST(1.5 AS DOUBLE) * (q3 - q1) AS upper_fence FROM (
  SELECT quantile_cont(city_average_temperature, 0.25) AS q1, quantile_cont(city_average_temperature, 0.75) AS q3
  FROM flags) z),
clean AS (SELECT flags.*, (city_average_temperature < lower_fence OR city_average_temperature > upper_fence)
  AS city_temperature_iqr_outlier FROM flags, fences)
"""


def with_clean(body: str) -> str:
    return with_star(CLEAN_CTES + body)


@register("clean_table", with_clean("SELECT * FROM clean"), round_cols=ENRICHED_DOUBLES,
          ids="FLT-03 FLT-04 PRJ-08 PRJ-09 WIN-14 AGG-21 SNK-04 TOP-07")
def clean_table(spark, sf):
    return clean_frame(spark, sf)


_CELLS = " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in
                    __import__("isotherm.operators.star", fromlist=["x"]).ENRICHED_COLUMNS)
_CRIT_ANY = " OR ".join(f"{c} IS NULL" for c in cl.CRITICAL)
_NEGSUM = " + ".join(f"CASE WHEN {c} < 0 THEN 1 ELSE 0 END" for c in cl.UNCERTAINTY)

REPORT_SQL = with_clean(f"""
, b AS (SELECT count(*) AS rows_before, CAST(27 AS BIGINT) AS columns_before,
  CAST(sum({_CELLS}) AS BIGINT) AS missing_cells_before,
  count(*) FILTER (WHERE {_CRIT_ANY}) AS critical_missing_rows,
  count(*) - count(DISTINCT row({_KEY})) AS duplicate_key_rows,
  count(*) FILTER (WHERE NOT ({_CRIT_ANY}) AND NOT ({_DOMAIN_SQL})) AS invalid_core_rows,
  CAST(sum({_NEGSUM}) AS BIGINT) AS negative_uncertainty_values FROM enriched),
a AS (SELECT count(*) AS rows_after, count(*) FILTER (WHERE city_temperature_iqr_outlier) AS iqr_outliers_kept
  FROM clean)
SELECT b.*, a.*, b.rows_before - a.rows_after AS rows_removed FROM b, a""")


@register("cleaning_report", REPORT_SQL, ids="DQ-19 DQ-20 DQ-21 DQ-23 AGG-11")
def cleaning_report(spark, sf):
    enriched = build_star(spark, sf).enriched()
    before = cl.cleaning_report(enriched)
    c = clean_frame(spark, sf)
    after = c.agg(F.count(F.lit(1)).alias("rows_after"),
                  F.count_if("city_temperature_iqr_outlier").alias("iqr_outliers_kept"))
    return before.crossJoin(after).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


_TEMP_COLS = ["city_average_temperature", "country_average_temperature", "land_average_temperature",
              "land_max_temperature", "land_min_temperature", "land_and_ocean_average_temperature",
              "major_city_average_temperature"]
_RANGES = {"latitude": (-90.0, 90.0), "longitude": (-180.0, 180.0), "month": (1, 12), "quarter": (1, 4),
           **{c: (-90.0, 60.0) for c in _TEMP_COLS}}


def _domain_sql() -> str:
    parts = []
    for c, (lo, hi) in _RANGES.items():
        req = c in ("latitude", "longitude", "month", "quarter", "city_average_temperature")
        parts.append(f"count(*) FILTER (WHERE NOT coalesce({c} BETWEEN {lo} AND {hi}, {'FALSE' if req else 'TRUE'}))"
                     f" AS {c}_out_of_range")
    parts += [f"count(*) FILTER (WHERE {c} < 0) AS {c}_negative" for c in cl.UNCERTAINTY]
    parts += [f"count(*) FILTER (WHERE {c} IS NULL OR trim({c}) = '') AS {c}_blank"
              for c in ("city_name", "country_name")]
    parts += ["count(*) FILTER (WHERE (year, month, quarter, decade) <> (year(observation_date), month(observation_date), "
              "quarter(observation_date), year(observation_date) - year(observation_date) % 10)) AS calendar_mismatch_rows",
              "count(*) FILTER (WHERE land_min_temperature > land_average_temperature AND land_max_temperature IS NOT NULL "
              "OR land_average_temperature > land_max_temperature AND land_min_temperature IS NOT NULL) AS land_order_rows",
              "count(*) FILTER (WHERE is_major_city AND NOT major_city_matched) AS major_without_match_rows",
              "count(*) FILTER (WHERE major_city_matched AND NOT is_major_city) AS match_without_major_rows"]
    return "SELECT " + ",\n  ".join(parts) + " FROM enriched"


@register("domain_checks", with_star(_domain_sql()), ids="DQ-15 DQ-16 DQ-17 DQ-18 FLT-04")
def domain_checks(spark, sf):
    e = build_star(spark, sf).enriched()
    required = ["latitude", "longitude", "month", "quarter", "city_average_temperature"]
    major, matched = F.col("is_major_city"), F.col("major_city_matched")
    return dq.domain_checks(
        e, _RANGES, non_negative=cl.UNCERTAINTY, not_blank=["city_name", "country_name"], null_is_outside=required,
        broken={"calendar_mismatch_rows": ~dq.calendar_consistency(),
                "land_order_rows": ~dq.order_consistency("land_min_temperature", "land_average_temperature",
                                                         "land_max_temperature"),
                "major_without_match_rows": major & ~matched, "match_without_major_rows": matched & ~major})


LINEAGE_SQL = with_clean(f"""
SELECT count(*) FILTER (WHERE {' OR '.join(f'c.{k} IS NULL' for k in cl.BUSINESS_KEY)}) AS null_key_rows,
  count(*) - count(DISTINCT row({', '.join('c.' + k for k in cl.BUSINESS_KEY)})) AS duplicate_key_rows,
  count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM enriched e WHERE {' AND '.join(f'e.{k} = c.{k}' for k in cl.BUSINESS_KEY)}))
    AS rows_not_in_source,
  min(c.observation_date) AS min_date, max(c.observation_date) AS max_date,
  count(*) FILTER (WHERE c.is_major_city <> c.major_city_matched) AS flag_mismatch_rows,
  count(*) FILTER (WHERE c.country_temperature_available AND c.country_average_temperature IS NULL) AS availability_errors
FROM clean c""")


@register("clean_lineage_check", LINEAGE_SQL, ids="DQ-22 DQ-18 JON-08")
def clean_lineage_check(spark, sf):
    e = build_star(spark, sf).enriched()
    c = clean_frame(spark, sf)
    key = cl.BUSINESS_KEY
    orphans = c.select(*key).join(e.select(*key), key, "left_anti").agg(F.count(F.lit(1)).alias("rows_not_in_source"))
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    stats = c.agg(F.count_if(any_null).alias("null_key_rows"),
                  (F.count(F.lit(1)) - F.count_distinct(F.struct(*key))).alias("duplicate_key_rows"),
                  F.min("observation_date").alias("min_date"), F.max("observation_date").alias("max_date"),
                  F.count_if(F.col("is_major_city") != F.col("major_city_matched"))
                  .alias("flag_mismatch_rows"),
                  F.count_if(F.col("country_temperature_available") & F.col("country_average_temperature").isNull())
                  .alias("availability_errors"))
    return stats.crossJoin(orphans).select("null_key_rows", "duplicate_key_rows", "rows_not_in_source", "min_date",
                                           "max_date", "flag_mismatch_rows", "availability_errors")


# ---------------------------------------------------------------- profiles

# Missing-value policy per enriched column.
MISSING_POLICY = {
    "Critical": [*cl.BUSINESS_KEY, "is_major_city", "city_average_temperature"],
    "Join status": cl.MATCH_COLUMNS,
    "Structural": ["year", "month", "quarter", "decade"],
    "Metadata": ["city_average_temperature_uncertainty"],
}


def _policy_sql(col: str) -> str:
    whens = " ".join(f"WHEN {col} IN ({', '.join(repr(c) for c in cs)}) THEN '{label}'"
                     for label, cs in MISSING_POLICY.items())
    return f"CASE {whens} ELSE 'Enrichment' END"


def _missing_sql() -> str:
    from isotherm.operators.star import ENRICHED_COLUMNS
    cols = ENRICHED_COLUMNS
    aggs = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in cols)
    return with_star(f"""
, m AS (SELECT count(*) AS __n, {aggs} FROM enriched),
u AS (UNPIVOT (SELECT * EXCLUDE (__n) FROM m) ON COLUMNS(*) INTO NAME column_name VALUE missing_count)
SELECT column_name, missing_count, round(missing_count * 100.0 / (SELECT __n FROM m), 2) AS missing_percent,
       {_policy_sql('column_name')} AS policy FROM u""")


@register("profile_missing", _missing_sql(), round_cols=["missing_percent"], ids="AGG-11 PRJ-18")
def profile_missing(spark, sf):
    e = build_star(spark, sf).enriched()
    pol = pf.policy_classifier(MISSING_POLICY)
    pol.update({c: "Enrichment" for c in e.columns if c not in pol})
    return dq.missing_profile(e, pol)


_LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DESCRIBE_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std,
  CAST(min({c}) AS DOUBLE) AS min, quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50,
  quantile_cont({c}, 0.75) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM lineitem""" for c in _LI_NUM)


@register("profile_describe", DESCRIBE_SQL, round_cols=["mean", "std", "min", "q25", "q50", "q75", "max"],
          ids="AGG-10 AGG-44")
def profile_describe(spark, sf):
    return pf.describe(table(spark, sf, "lineitem"), _LI_NUM)


_CUST = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
UNIQUE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values, "
    f"round(count(DISTINCT {c}) * 100.0 / count(*), 2) AS unique_percent FROM customer" for c in _CUST)


@register("profile_unique", UNIQUE_SQL, round_cols=["unique_percent"], ids="AGG-12")
def profile_unique(spark, sf):
    return pf.unique_profile(table(spark, sf, "customer"), _CUST)


_CAT = ["o_orderstatus", "o_orderpriority"]
CATEGORICAL_SQL = " UNION ALL ".join(f"""SELECT '{c}' AS column_name,
  (SELECT count(DISTINCT {c}) FROM orders) AS groups,
  (SELECT count(*) FILTER (WHERE {c} IS NULL) FROM orders) AS missing,
  (SELECT round(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 2) FROM orders) AS missing_percent,
  t.v AS top_value, t.n AS top_count
FROM (SELECT {c} AS v, count(*) AS n FROM orders WHERE {c} IS NOT NULL GROUP BY {c}
      ORDER BY n DESC, v LIMIT 1) t""" for c in _CAT)


@register("profile_categorical", CATEGORICAL_SQL, round_cols=["missing_percent"], ids="AGG-13")
def profile_categorical(spark, sf):
    return pf.categorical_profile(table(spark, sf, "orders"), _CAT)


_SCHEMA_FAM = {"l_orderkey": "integer", "l_partkey": "integer", "l_suppkey": "integer", "l_linenumber": "integer",
               "l_quantity": "float", "l_extendedprice": "float", "l_discount": "float", "l_tax": "float",
               "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp"}
SCHEMA_SQL = f"""
WITH d AS (SELECT column_name, CASE
    WHEN column_type IN ('BIGINT', 'INTEGER', 'SMALLINT', 'TINYINT', 'HUGEINT') THEN 'integer'
    WHEN column_type IN ('DOUBLE', 'FLOAT') OR column_type LIKE 'DECIMAL%' THEN 'float'
    WHEN column_type = 'VARCHAR' THEN 'string' WHEN column_type = 'BOOLEAN' THEN 'boolean'
    WHEN column_type = 'DATE' THEN 'date' WHEN column_type LIKE 'TIMESTAMP%' THEN 'timestamp'
    ELSE lower(column_type) END AS dtype FROM (DESCRIBE lineitem)),
n AS (UNPIVOT (SELECT {', '.join(f'count({c}) AS {c}' for c in _SCHEMA_FAM)} FROM lineitem)
      ON COLUMNS(*) INTO NAME column_name VALUE non_null)
SELECT d.column_name, d.dtype, n.non_null FROM d JOIN n USING (column_name)"""


@register("profile_schema", SCHEMA_SQL, ids="AGG-14")
def profile_schema(spark, sf):
    return pf.schema_profile(table(spark, sf, "lineitem"))


VALUE_COUNTS_SQL = """
SELECT o_orderpriority, n, round(n * 100.0 / sum(n) OVER (), 2) AS percent
FROM (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority) c"""


@register("value_counts", VALUE_COUNTS_SQL, round_cols=["percent"], ids="AGG-15 AGG-38")
def value_counts(spark, sf):
    return agg.value_counts(table(spark, sf, "orders"), "o_orderpriority")


DATE_PROFILE_SQL = """
SELECT CAST(min(o_orderdate) AS DATE) AS min_date, CAST(max(o_orderdate) AS DATE) AS max_date,
  CAST(datediff('day', CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE)) AS BIGINT) AS span_days,
  count(DISTINCT date_trunc('month', o_orderdate)) AS distinct_months,
  count(DISTINCT year(o_orderdate)) AS distinct_years, count(*) FILTER (WHERE o_orderdate IS NULL) AS null_dates
FROM orders"""


@register("date_profile", DATE_PROFILE_SQL, ids="AGG-18")
def date_profile(spark, sf):
    o = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("d"))
    return agg.date_profile(o, "d")


MISSING_BY_YEAR_SQL = with_sources("""
SELECT year(dt) AS year, count(*) AS rows, count(*) FILTER (WHERE v IS NULL) AS missing,
  round(count(*) FILTER (WHERE v IS NULL) * 100.0 / count(*), 2) AS missing_percent
FROM obs_rows GROUP BY year(dt)""")


@register("missing_by_year", MISSING_BY_YEAR_SQL, round_cols=["missing_percent"], ids="AGG-16 AGG-17")
def missing_by_year(spark, sf):
    rows = ds.observation_rows(spark, sf).withColumn("year", F.year("dt").cast("long"))
    return agg.missing_by(rows, "year", "v")


def _overview_sql(name, cols, key, date_col):
    cells = " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in cols)
    d = (f"CAST(min({date_col}) AS DATE) AS min_date, CAST(max({date_col}) AS DATE) AS max_date" if date_col
         else "CAST(NULL AS DATE) AS min_date, CAST(NULL AS DATE) AS max_date")
    return f"""SELECT '{name}' AS table_name, count(*) AS rows, CAST({len(cols)} AS BIGINT) AS columns,
  CAST(coalesce(sum({cells}), 0) AS BIGINT) AS missing_cells,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {name}) x) AS full_duplicates,
  count(*) - count(DISTINCT row({', '.join(key)})) AS key_duplicates, {d} FROM {name}"""


_OVERVIEW = [
    ("lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                  "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
     ["l_orderkey", "l_linenumber"], "l_shipdate"),
    ("orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
     ["o_orderkey"], "o_orderdate"),
    ("customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"], ["c_custkey"], None),
    ("supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"], ["s_suppkey"], None),
]


@register("table_overview", " UNION ALL ".join(_overview_sql(*x) for x in _OVERVIEW), ids="AGG-19 DQ-02 DQ-03")
def table_overview(spark, sf):
    return reduce(DataFrame.unionByName, [pf.overview(n, table(spark, sf, n), key, d) for n, _, key, d in _OVERVIEW])


TARGET_SQL = with_clean("""
SELECT count(city_average_temperature) AS count, avg(city_average_temperature) AS mean,
  quantile_cont(city_average_temperature, 0.5) AS median, stddev_samp(city_average_temperature) AS std,
  min(city_average_temperature) AS min, max(city_average_temperature) AS max,
  max(city_average_temperature) - min(city_average_temperature) AS range FROM clean""")


@register("target_summary", TARGET_SQL, round_cols=["mean", "median", "std", "min", "max", "range"], ids="AGG-20")
def target_summary(spark, sf):
    return pf.target_summary(clean_frame(spark, sf), "city_average_temperature")


# ---------------------------------------------------------------- outlier study

_LABEL_SQL = """, lab AS (
  SELECT country_name, city_name, latitude, longitude, observation_date, month, city_average_temperature,
    CASE WHEN latitude >= 0 THEN 'Northern' WHEN latitude < 0 THEN 'Southern' END AS hemisphere,
    CASE WHEN latitude >= 0 THEN CASE WHEN month IN (12, 1, 2) THEN 'Winter' WHEN month IN (3, 4, 5) THEN 'Spring'
           WHEN month IN (6, 7, 8) THEN 'Summer' WHEN month IN (9, 10, 11) THEN 'Autumn' END
         WHEN latitude < 0 THEN CASE WHEN month IN (12, 1, 2) THEN 'Summer' WHEN month IN (3, 4, 5) THEN 'Autumn'
           WHEN month IN (6, 7, 8) THEN 'Winter' WHEN month IN (9, 10, 11) THEN 'Spring' END END AS season,
    CASE WHEN city_average_temperature < (SELECT lower_fence FROM fences) THEN 'Low' ELSE 'High' END AS outlier_side,
    coalesce(latitude BETWEEN -90 AND 90, FALSE) AND coalesce(longitude BETWEEN -180 AND 180, FALSE)
      AS coordinate_valid
  FROM clean WHERE city_temperature_iqr_outlier),
lab2 AS (SELECT *, coalesce(abs(latitude) >= 23.5 AND ((outlier_side = 'Low' AND season = 'Summer')
    OR (outlier_side = 'High' AND season = 'Winter')), FALSE) AS seasonal_review_flag FROM lab),
labelled AS (SELECT *, CASE WHEN NOT coalesce(coordinate_valid, FALSE) THEN 'Invalid coordinate'
    WHEN seasonal_review_flag THEN 'Review seasonal context' ELSE 'Plausible internal evidence' END
    AS internal_assessment FROM lab2)
"""


def labelled_frame(spark, sf):
    return ol.label_outliers(clean_frame(spark, sf))


@register("iqr_outliers", with_clean(_LABEL_SQL + "SELECT * FROM labelled"), round_cols=["city_average_temperature"],
          ids="AGG-21 PRJ-11 PRJ-12 PRJ-13 UDF-01")
def iqr_outliers(spark, sf):
    return labelled_frame(spark, sf)


OUTLIER_SUMMARY_SQL = with_clean(_LABEL_SQL + """
, pm AS (SELECT country_name, city_name, latitude, longitude, month, count(*) AS n FROM labelled
         GROUP BY ALL),
mode AS (SELECT country_name, city_name, latitude, longitude, month AS most_common_outlier_month,
         n AS outlier_count_in_month FROM pm
         QUALIFY row_number() OVER (PARTITION BY country_name, city_name, latitude, longitude
                                    ORDER BY n DESC, month) = 1)
SELECT s.*, mode.most_common_outlier_month, mode.outlier_count_in_month FROM (
  SELECT country_name, city_name, latitude, longitude, count(*) AS outlier_count,
    min(city_average_temperature) AS minimum_temperature, max(city_average_temperature) AS maximum_temperature,
    avg(city_average_temperature) AS mean_temperature, min(observation_date) AS first_outlier_date,
    max(observation_date) AS last_outlier_date FROM labelled GROUP BY ALL) s
JOIN mode USING (country_name, city_name, latitude, longitude)""")


@register("outlier_summary", OUTLIER_SUMMARY_SQL,
          round_cols=["minimum_temperature", "maximum_temperature", "mean_temperature"], ids="AGG-33")
def outlier_summary(spark, sf):
    return ol.location_summary(labelled_frame(spark, sf))


OUTLIER_MONTH_SQL = with_clean(_LABEL_SQL + """
SELECT m.month, CAST(coalesce(count(l.month) FILTER (WHERE l.outlier_side = 'Low'), 0) AS BIGINT) AS low,
  CAST(coalesce(count(l.month) FILTER (WHERE l.outlier_side = 'High'), 0) AS BIGINT) AS high
FROM range(1, 13) m(month) LEFT JOIN labelled l ON l.month = m.month GROUP BY m.month""")


@register("outliers_by_month", OUTLIER_MONTH_SQL, ids="AGG-34 AGG-36")
def outliers_by_month(spark, sf):
    return ol.month_side_grid(labelled_frame(spark, sf))


OUTLIER_SEASON_SQL = with_clean(_LABEL_SQL + """
SELECT outlier_side, hemisphere, season, count(*) AS n FROM labelled GROUP BY ALL""")


@register("outliers_by_season", OUTLIER_SEASON_SQL, ids="AGG-35")
def outliers_by_season(spark, sf):
    return labelled_frame(spark, sf).groupBy("outlier_side", "hemisphere", "season").agg(
        F.count(F.lit(1)).alias("n"))


ASSESS_SQL = with_clean(_LABEL_SQL + """
SELECT internal_assessment, n, round(n * 100.0 / sum(n) OVER (), 2) AS percent
FROM (SELECT internal_assessment, count(*) AS n FROM labelled GROUP BY ALL) c""")


@register("assessment_summary", ASSESS_SQL, round_cols=["percent"], ids="AGG-38 PRJ-12")
def assessment_summary(spark, sf):
    return agg.value_counts(labelled_frame(spark, sf), "internal_assessment")


VARIANTS_SQL = with_clean("""
SELECT country_name, city_name, count(DISTINCT latitude) AS latitude_variants,
  count(DISTINCT longitude) AS longitude_variants,
  count(DISTINCT latitude) > 1 OR count(DISTINCT longitude) > 1 AS multiple_coordinates
FROM clean GROUP BY ALL""")


@register("coordinate_variants", VARIANTS_SQL, ids="AGG-37")
def coordinate_variants(spark, sf):
    return ol.coordinate_variants(clean_frame(spark, sf))


SLICE_MONTH = 7
SLICE_SQL = with_clean(f"""
SELECT city_name, country_name, latitude, longitude, observation_date, city_average_temperature FROM clean
WHERE month = {SLICE_MONTH}
QUALIFY row_number() OVER (PARTITION BY city_name, country_name, latitude, longitude ORDER BY observation_date) = 1""")


@register("month_slice", SLICE_SQL, round_cols=["city_average_temperature"], ids="FLT-07")
def month_slice(spark, sf):
    """month = m, then the first row per location: ``min(struct(date, value))`` per location."""
    loc = ["city_name", "country_name", "latitude", "longitude"]
    c = clean_frame(spark, sf).where(F.col("month") == SLICE_MONTH)
    first = c.groupBy(*loc).agg(F.min(F.struct("observation_date", "city_average_temperature")).alias("__f"))
    return first.select(*loc, "__f.observation_date", "__f.city_average_temperature")


SAMPLE_SQL = with_star("""SELECT * FROM enriched
ORDER BY observation_date, country_name, city_name, latitude, longitude LIMIT 10""")


@register("enriched_sample", SAMPLE_SQL, round_cols=ENRICHED_DOUBLES, ids="TOP-01")
def enriched_sample(spark, sf):
    """Multi-key ORDER BY + LIMIT 10 (a TakeOrderedAndProject: per-task top 10, no global sort)."""
    return build_star(spark, sf).enriched().orderBy(
        "observation_date", "country_name", "city_name", "latitude", "longitude").limit(10)


CONTRACT_SQL = with_clean("""
, actual AS (
  SELECT 'rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM clean
  UNION ALL SELECT 'countries', CAST(count(DISTINCT country_name) AS DOUBLE) FROM clean
  UNION ALL SELECT 'dates', CAST(count(DISTINCT observation_date) AS DOUBLE) FROM clean),
expected AS (
  SELECT 'rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM enriched WHERE city_average_temperature IS NOT NULL
  UNION ALL SELECT 'countries', CAST(count(*) AS DOUBLE) FROM dim_country
  UNION ALL SELECT 'dates', CAST(count(DISTINCT d.full_date) AS DOUBLE) FROM dim_date d
    WHERE d.date_id IN (SELECT date_id FROM fact_city))
SELECT metric, e.value AS expected, a.value AS actual, coalesce(e.value = a.value, FALSE) AS match
FROM expected e FULL JOIN actual a USING (metric)""")


@register("source_contract", CONTRACT_SQL, ids="DQ-24 DQ-04")
def source_contract(spark, sf):
    """Expected / Actual / Match: the clean table against the contract derived from the star."""
    from functools import reduce

    from pyspark.sql import DataFrame
    s = build_star(spark, sf)
    c = clean_frame(spark, sf)

    def m(name, df, expr):
        return df.agg(expr.cast("double").alias("value")).select(F.lit(name).alias("metric"), "value")
    actual = reduce(DataFrame.unionByName, [m("rows", c, F.count(F.lit(1))),
                                            m("countries", c, F.count_distinct("country_name")),
                                            m("dates", c, F.count_distinct("observation_date"))])
    used_dates = s.dim_date.join(s.fact_city.select("date_id").distinct(), "date_id", "left_semi")
    expected = reduce(DataFrame.unionByName, [
        m("rows", s.enriched().where(F.col("city_average_temperature").isNotNull()), F.count(F.lit(1))),
        m("countries", s.dim_country, F.count(F.lit(1))),
        m("dates", used_dates, F.count_distinct("full_date"))])
    return dq.compare_contract(actual, expected)
