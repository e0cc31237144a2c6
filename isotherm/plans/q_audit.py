"""Queries: coordinate normalisation, join validation, match-rate audit, manifest filter,
stage profiles, grain checks and the final audit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.functions.coords import parse_coordinate, signed_coordinate
from isotherm.functions.safe import try_date, try_double
from isotherm.functions.text import blank_to_null, squeeze_text
from isotherm.operators import aggregate as agg
from isotherm.operators import joins as jn
from isotherm.operators import quality as dq
from isotherm.plans import driver_sources as ds
from isotherm.plans.driver_star import build_star
from isotherm.plans.oracle_sources import with_star
from isotherm.plans.registry import register
from isotherm.sources.tables import table

# ---------------------------------------------------------------- coordinate_normalise


def _raw_variants(loc: DataFrame) -> DataFrame:
    k = F.col("suppkey")
    v6 = F.pmod(k, F.lit(6))
    lat, lon = F.col("latitude"), F.col("longitude")
    raw_lat = (F.when(v6 == 0, F.lower(lat)).when(v6 == 1, F.concat(F.lit("\t"), lat, F.lit("  ")))
               .when(v6 == 2, F.lit("abc")).when(v6 == 3, F.regexp_replace(lat, "[NS]$", "X"))
               .when(v6 == 4, F.lit("")).otherwise(lat))
    raw_lon = (F.when(v6 == 0, F.concat(F.lit(" "), lon, F.lit(" ")))
               .when(v6 == 3, F.regexp_replace(lon, "[EW]$", "N")).otherwise(lon))
    v3 = F.pmod(k, F.lit(3))
    raw_name = (F.when(v3 == 0, F.concat(F.lit("  "), F.col("city"), F.lit("\t")))
                .when(v3 == 1, F.concat(F.col("city"), F.lit("   extra \t words "))).otherwise(F.lit("   ")))
    num_text = F.when(F.pmod(k, F.lit(4)) == 0, F.lit("n/a")).otherwise(
        F.concat((k * 7).cast("string"), F.lit(".5")))
    date_text = F.when(F.pmod(k, F.lit(5)) == 0, F.lit("2001-02-30")).otherwise(
        F.concat(F.lit("2001-0"), (F.pmod(k, F.lit(9)) + 1).cast("string"), F.lit("-15")))
    return loc.select(k.alias("s_suppkey"), raw_lat.alias("raw_latitude"), raw_lon.alias("raw_longitude"),
                      raw_name.alias("raw_name"), num_text.alias("raw_number"), date_text.alias("raw_date"))


COORD_SQL = f"""
WITH {ds.__name__ and ''}loc AS (
  SELECT suppkey, city,
    CASE suppkey % 6 WHEN 0 THEN lower(latitude) WHEN 1 THEN chr(9) || latitude || '  ' WHEN 2 THEN 'abc'
      WHEN 3 THEN regexp_replace(latitude, '[NS]$', 'X') WHEN 4 THEN '' ELSE latitude END AS raw_latitude,
    CASE suppkey % 6 WHEN 0 THEN ' ' || longitude || ' ' WHEN 3 THEN regexp_replace(longitude, '[EW]$', 'N')
      ELSE longitude END AS raw_longitude,
    CASE suppkey % 3 WHEN 0 THEN '  ' || city || chr(9) WHEN 1 THEN city || '   extra ' || chr(9) || ' words '
      ELSE '   ' END AS raw_name,
    CASE WHEN suppkey % 4 = 0 THEN 'n/a' ELSE CAST(suppkey * 7 AS VARCHAR) || '.5' END AS raw_number,
    CASE WHEN suppkey % 5 = 0 THEN '2001-02-30' ELSE '2001-0' || CAST(suppkey % 9 + 1 AS VARCHAR) || '-15' END AS raw_date
  FROM (SELECT {'{LOC}'}) z),
p AS (SELECT *, upper(regexp_replace(raw_latitude, '^\\s+|\\s+$', '', 'g')) AS tlat,
             upper(regexp_replace(raw_longitude, '^\\s+|\\s+$', '', 'g')) AS tlon FROM loc)
SELECT suppkey AS s_suppkey, raw_latitude, raw_longitude, raw_name, raw_number, raw_date,
  {{STRICT_LAT}} AS latitude_strict, {{STRICT_LON}} AS longitude_strict,
  {{LEN_LAT}} AS latitude_lenient, {{INV_LAT}} AS latitude_invalid,
  {{LEN_LON}} AS longitude_lenient, {{INV_LON}} AS longitude_invalid,
  NULLIF(trim(raw_name), '') AS name_blank_to_null,
  NULLIF(trim(regexp_replace(raw_name, '\\s+', ' ', 'g')), '') AS name_squeezed,
  TRY_CAST(raw_number AS DOUBLE) AS number_value, TRY_CAST(raw_date AS DATE) AS date_value
FROM p"""


def _strict_sql(col, pos, neg):
    t = f"trim({col})"
    return (f"CASE WHEN regexp_matches({t}, '^[0-9]+([.][0-9]+)?[{pos}{neg}]$') THEN "
            f"CAST(substring({t}, 1, length({t}) - 1) AS DOUBLE) * CASE WHEN right({t}, 1) = '{neg}' "
            f"THEN -1.0 ELSE 1.0 END END")


def _lenient_sql(t, raw, allowed, neg):
    pat = "'^([0-9]+(?:[.][0-9]+)?)([NSEW])$'"
    mag = f"CASE WHEN regexp_matches({t}, {pat}) THEN TRY_CAST(regexp_extract({t}, {pat}, 1) AS DOUBLE) END"
    d = f"CASE WHEN regexp_matches({t}, {pat}) THEN regexp_extract({t}, {pat}, 2) END"
    ok = f"coalesce({d} IN ({', '.join(repr(a) for a in allowed)}), FALSE)"
    val = f"CASE WHEN {ok} THEN CASE WHEN {d} = '{neg}' THEN -({mag}) ELSE {mag} END END"
    inv = f"({raw} IS NOT NULL AND (({mag}) IS NULL OR NOT {ok}))"
    return val, inv


def _coord_sql() -> str:
    from isotherm.plans.oracle_sources import LOCATIONS
    lat_v, lat_i = _lenient_sql("tlat", "raw_latitude", "NS", "S")
    lon_v, lon_i = _lenient_sql("tlon", "raw_longitude", "EW", "W")
    body = (COORD_SQL.replace("WITH loc AS", f"WITH {LOCATIONS},\nloc AS")
            .replace("FROM (SELECT {LOC}) z", "FROM locations")
            .replace("{STRICT_LAT}", _strict_sql("raw_latitude", "N", "S"))
            .replace("{STRICT_LON}", _strict_sql("raw_longitude", "E", "W"))
            .replace("{LEN_LAT}", lat_v).replace("{INV_LAT}", lat_i)
            .replace("{LEN_LON}", lon_v).replace("{INV_LON}", lon_i))
    return body


@register("coordinate_normalise", _coord_sql(), ids="PRJ-01 PRJ-02 PRJ-03 PRJ-04 PRJ-05 SCA-01 SCA-02 SCA-08")
def coordinate_normalise(spark, sf):
    raw = _raw_variants(ds.supplier_locations(spark, sf))
    lat_v, lat_i = parse_coordinate("raw_latitude", "NS", "S")
    lon_v, lon_i = parse_coordinate("raw_longitude", "EW", "W")
    return raw.select(
        "*",
        signed_coordinate("raw_latitude", "N", "S").alias("latitude_strict"),
        signed_coordinate("raw_longitude", "E", "W").alias("longitude_strict"),
        lat_v.alias("latitude_lenient"), lat_i.alias("latitude_invalid"),
        lon_v.alias("longitude_lenient"), lon_i.alias("longitude_invalid"),
        blank_to_null("raw_name").alias("name_blank_to_null"),
        squeeze_text("raw_name").alias("name_squeezed"),
        try_double("raw_number").alias("number_value"),
        try_date("raw_date").alias("date_value"))


# ---------------------------------------------------------------- enrichment audits

ROW_CHECK_SQL = with_star("""
SELECT v.n AS view_row_count, f.n AS fact_row_count, v.n - f.n AS difference,
       CASE WHEN v.n = f.n THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT count(*) AS n FROM enriched) v, (SELECT count(*) AS n FROM fact_city) f""")


@register("enriched_row_check", ROW_CHECK_SQL, ids="DQ-09 JON-17")
def enriched_row_check(spark, sf):
    s = build_star(spark, sf)
    return dq.row_preservation(s.enriched(), s.fact_city)


def _match_sql(name: str, hit: str, value: str, known: str) -> str:
    """One enrichment's report: rows counted by (matched, key known to the source, value empty)."""
    return f"""SELECT '{name}' AS enrichment, *, round(matched_rows * 100.0 / nullif(source_rows, 0), 4) AS match_rate_percent,
  CASE WHEN source_rows = fact_city_rows AND unexpected_unmatched = 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS source_rows, (SELECT count(*) FROM fact_city) AS fact_city_rows,
    CAST(coalesce(sum(n * hit), 0) AS BIGINT) AS matched_rows,
    CAST(coalesce(sum(n * (1 - hit)), 0) AS BIGINT) AS unmatched_rows,
    CAST(coalesce(sum(n * (1 - hit) * (1 - known)), 0) AS BIGINT) AS expected_unmatched,
    CAST(coalesce(sum(n * (1 - hit) * known), 0) AS BIGINT) AS unexpected_unmatched,
    CAST(coalesce(sum(n * hit * blank), 0) AS BIGINT) AS source_temperature_nulls
  FROM (SELECT CAST({hit} AS INT) AS hit, CAST(coalesce({known}, FALSE) AS INT) AS known,
          CAST({value} IS NULL AS INT) AS blank, count(*) AS n FROM enriched GROUP BY ALL))"""


MATCH_SQL = with_star("SELECT * FROM (" + " UNION ALL ".join([
    _match_sql("city_to_country", "country_matched", "country_average_temperature",
               "(observation_date, country_name) IN (SELECT (dt, trim(country)) FROM country_src)"),
    _match_sql("city_to_global", "global_matched", "land_average_temperature",
               "observation_date IN (SELECT dt FROM global_src)"),
    _match_sql("city_to_major_city", "major_city_matched", "major_city_average_temperature", "is_major_city"),
]) + ")")


@register("match_rate_audit", MATCH_SQL, round_cols=["match_rate_percent"], ids="DQ-10 JON-07 JON-08 AGG-06 SCA-07")
def match_rate_audit(spark, sf):
    s = build_star(spark, sf)
    rows = dq.mark_known(s.enriched(), s.country_src.select("dt", blank_to_null("country").alias("country")),
                         {"observation_date": "dt", "country_name": "country"}, "in_country_source")
    rows = dq.mark_known(rows, s.global_src.select("dt"), {"observation_date": "dt"}, "in_global_source")
    return dq.match_rate_audit(rows, s.fact_city.agg(F.count(F.lit(1)).alias("fact_city_rows")), [
        dq.Enrichment("city_to_country", "country_matched", "in_country_source", "country_average_temperature"),
        dq.Enrichment("city_to_global", "global_matched", "in_global_source", "land_average_temperature"),
        dq.Enrichment("city_to_major_city", "major_city_matched", "is_major_city", "major_city_average_temperature")])


# ---------------------------------------------------------------- validate_key_join

def _vkj_sql(name: str, left: str, right: str, keys: list[str], expected: str) -> str:
    k = ", ".join(keys)
    on = " AND ".join(f"l.{c} IS NOT DISTINCT FROM r.{c}" for c in keys)
    return f"""SELECT '{name}' AS check_name, s.source_keys, j.rows_after_join, j.matched_keys, j.unmatched_keys,
  e.expected_unmatched, j.rows_after_join - s.source_keys AS row_multiplication,
  CAST(j.matched_keys AS DOUBLE) * 100 / NULLIF(s.source_keys, 0) AS match_percent,
  CASE WHEN j.rows_after_join - s.source_keys = 0 AND j.unmatched_keys = e.expected_unmatched
       THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT count(*) AS source_keys FROM (SELECT DISTINCT {k} FROM ({left}) x) y) s,
     (SELECT count(*) AS rows_after_join, count(*) FILTER (WHERE r.m IS NOT NULL) AS matched_keys,
             count(*) FILTER (WHERE r.m IS NULL) AS unmatched_keys
      FROM (SELECT DISTINCT {k} FROM ({left}) x) l
      LEFT JOIN (SELECT DISTINCT {k}, TRUE AS m FROM ({right}) x) r ON {on}) j,
     ({expected}) e"""


_CITY_COUNTRY_EXP = """SELECT count(*) FILTER (WHERE NOT coalesce(k.dt BETWEEN c.s AND c.e, FALSE)) AS expected_unmatched
FROM (SELECT DISTINCT dt, country FROM city_src) k
LEFT JOIN (SELECT country, min(dt) AS s, max(dt) AS e FROM country_src GROUP BY country) c ON c.country = k.country"""
_CITY_GLOBAL_EXP = """SELECT count(*) FILTER (WHERE dt < (SELECT min(dt) FROM global_src)) AS expected_unmatched
FROM (SELECT DISTINCT dt FROM city_src) k"""
_LOC = ["city", "country", "latitude", "longitude"]

VKJ_SQL = with_star("SELECT * FROM (" + " UNION ALL ".join([
    _vkj_sql("city_to_country", "SELECT dt, country FROM city_src", "SELECT dt, country FROM country_src",
             ["dt", "country"], _CITY_COUNTRY_EXP),
    _vkj_sql("city_to_global", "SELECT dt FROM city_src", "SELECT dt FROM global_src", ["dt"], _CITY_GLOBAL_EXP),
    _vkj_sql("major_to_city", "SELECT city, country, latitude, longitude FROM major_src",
             "SELECT city, country, latitude, longitude FROM city_src", _LOC, "SELECT 0 AS expected_unmatched"),
    _vkj_sql("orders_to_customer", "SELECT o_custkey AS custkey FROM orders",
             "SELECT c_custkey AS custkey FROM customer", ["custkey"], "SELECT 0 AS expected_unmatched"),
]) + ") t")


@register("validate_key_join", VKJ_SQL, round_cols=["match_percent"], ids="JON-11 JON-12 JON-13 SET-04 UDF-03")
def validate_key_join(spark, sf):
    s = build_star(spark, sf)
    city, country, glob, major = s.city_src, s.country_src, s.global_src, s.major_src
    exp_country = jn.coverage_expected_unmatched(city, country, "country", "dt")
    gmin = glob.agg(F.min("dt").alias("__gmin"))
    exp_global = (city.select("dt").distinct().crossJoin(F.broadcast(gmin))
                  .agg(F.count_if(F.col("dt") < F.col("__gmin")).alias("expected_unmatched")))
    checks = [
        jn.validate_key_join("city_to_country", city, country, ["dt", "country"], exp_country),
        jn.validate_key_join("city_to_global", city, glob, ["dt"], exp_global),
        jn.validate_key_join("major_to_city", major, city, _LOC, 0),
        jn.validate_key_join("orders_to_customer",
                             table(spark, sf, "orders").select(F.col("o_custkey").alias("custkey")),
                             table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey")),
                             ["custkey"], 0),
    ]
    return reduce(DataFrame.unionByName, checks)


# ---------------------------------------------------------------- manifest, stage filters

TOP_N = 10
WINDOW_START, WINDOW_END = "1996-01-01", "2001-01-01"

MANIFEST_SQL = with_star(f"""
SELECT country, row_count, row_rank, row_rank <= {TOP_N} AS in_top FROM (
  SELECT country, row_count, CAST(row_number() OVER (ORDER BY row_count DESC, country) AS BIGINT) AS row_rank
  FROM (SELECT NULLIF(trim(country), '') AS country, count(*) AS row_count FROM city_src
        GROUP BY NULLIF(trim(country), '')) a) b""")


def _city_rows(spark, sf):
    return ds.city_source(spark, sf).withColumn("country", blank_to_null("country"))


@register("top_entities_manifest", MANIFEST_SQL, ids="TOP-02 WIN-01 DQ-06")
def top_entities_manifest(spark, sf):
    m = agg.ranked_counts(_city_rows(spark, sf), "country", TOP_N)
    return m.select("country", "row_count", "row_rank", "in_top")


FILTER_SQL = with_star(f"""
, manifest AS (
  SELECT country FROM (SELECT NULLIF(trim(country), '') AS country, count(*) AS n FROM city_src
                       GROUP BY NULLIF(trim(country), '')) a
  ORDER BY n DESC, country LIMIT {TOP_N})
SELECT dt, city, NULLIF(trim(country), '') AS country, latitude, longitude, average_temperature
FROM city_src c
WHERE EXISTS (SELECT 1 FROM manifest m WHERE m.country = NULLIF(trim(c.country), ''))
  AND dt >= DATE '{WINDOW_START}' AND dt < DATE '{WINDOW_END}'""")


def manifest_filter(rows: DataFrame, key: str, top_n: int, date_col: str, start: str, end: str) -> DataFrame:
    """FLT-02 + FLT-01: keep rows of the top-N entities (semi join on a top-N frame, bounded by
    ``top_n`` so the broadcast is safe) and inside the half-open date window."""
    manifest = agg.ranked_counts(rows, key, top_n).where("in_top").select(key)
    d = F.col(date_col)
    return (rows.join(F.broadcast(manifest), key, "left_semi")
            .where((d >= F.lit(start).cast("date")) & (d < F.lit(end).cast("date"))))


@register("top_entities_filter", FILTER_SQL, round_cols=["average_temperature"], ids="FLT-01 FLT-02 JON-08")
def top_entities_filter(spark, sf):
    out = manifest_filter(_city_rows(spark, sf), "country", TOP_N, "dt", WINDOW_START, WINDOW_END)
    return out.select("dt", "city", "country", "latitude", "longitude", "average_temperature")


STAGE_SQL = with_star(f"""
, ranked AS (SELECT NULLIF(trim(country), '') AS country, count(*) AS n FROM city_src GROUP BY 1),
manifest AS (SELECT country FROM ranked ORDER BY n DESC, country LIMIT {TOP_N}),
pre AS (SELECT count(*) AS rows_before, count(DISTINCT NULLIF(trim(country), '')) AS countries_before,
  count(*) FILTER (WHERE NULLIF(trim(country), '') IS NULL) AS invalid_country_rows FROM city_src),
top AS (SELECT CAST(sum(n) AS BIGINT) AS top_rows, min(n) AS top_min_rows, max(n) AS top_max_rows FROM ranked
  WHERE country IN (SELECT country FROM manifest)),
post AS (SELECT count(*) AS rows_after, min(dt) AS min_date, max(dt) AS max_date,
  count(DISTINCT dt) AS distinct_dates, count(*) FILTER (WHERE average_temperature IS NULL) AS null_targets
  FROM city_src c WHERE NULLIF(trim(c.country), '') IN (SELECT country FROM manifest)
  AND dt >= DATE '{WINDOW_START}' AND dt < DATE '{WINDOW_END}')
SELECT pre.*, top.*, post.*,
  CASE WHEN post.rows_after > 0 AND post.rows_after <= top.top_rows THEN 'PASS' ELSE 'FAIL' END AS status
FROM pre, top, post""")


@register("stage_profile", STAGE_SQL, ids="DQ-04 DQ-05 DQ-07 DQ-08 AGG-06 JON-17")
def stage_profile(spark, sf):
    rows = _city_rows(spark, sf)
    ranked = agg.ranked_counts(rows, "country", TOP_N)
    pre = rows.agg(F.count(F.lit(1)).alias("rows_before"), F.count_distinct("country").alias("countries_before"),
                   F.count_if(F.col("country").isNull()).alias("invalid_country_rows"))
    top = ranked.where("in_top").agg(F.sum("row_count").alias("top_rows"), F.min("row_count").alias("top_min_rows"),
                                     F.max("row_count").alias("top_max_rows"))
    post = manifest_filter(rows, "country", TOP_N, "dt", WINDOW_START, WINDOW_END).agg(
        F.count(F.lit(1)).alias("rows_after"), F.min("dt").alias("min_date"), F.max("dt").alias("max_date"),
        F.count_distinct("dt").alias("distinct_dates"),
        F.count_if(F.col("average_temperature").isNull()).alias("null_targets"))
    j = pre.crossJoin(top).crossJoin(post)
    return j.withColumn("status", dq.status((F.col("rows_after") > 0) & (F.col("rows_after") <= F.col("top_rows"))))


# ---------------------------------------------------------------- grain checks and final audit

def _aggregates(s):
    from isotherm.plans.q_star import CITY_KEYS, _GLOBAL_AVGS, _UNC
    return {
        "global_yearly": (agg.coverage(s.global_view(), ["year"], "land_average_temperature", _GLOBAL_AVGS), ["year"]),
        "global_decadal": (agg.coverage(s.global_view(), ["decade"], "land_average_temperature", _GLOBAL_AVGS,
                                        first_last="year"), ["decade"]),
        "country_yearly": (agg.coverage(s.country_view(), ["country_id", "country_name", "year"],
                                        "average_temperature", _UNC), ["country_id", "year"]),
        "city_yearly": (agg.coverage(s.city_view(), CITY_KEYS, "average_temperature", _UNC), ["city_id", "year"]),
        "major_city_yearly": (agg.coverage(s.major_view(), CITY_KEYS, "average_temperature", _UNC),
                              ["city_id", "year"]),
    }


def _grain_sql(name: str, cte: str, grain: list[str]) -> str:
    g = ", ".join(grain)
    nulls = " OR ".join(f"{c} IS NULL" for c in grain)
    return f"""SELECT '{name}' AS aggregate_name, count(*) AS row_count,
  count(*) - count(DISTINCT row({g})) AS duplicate_grain_rows,
  count(*) FILTER (WHERE {nulls}) AS null_grain_rows,
  count(*) FILTER (WHERE valid_temperature_months + missing_temperature_months <> observation_months)
    AS coverage_mismatch_rows FROM {cte}"""


def _agg_ctes() -> str:
    from isotherm.plans.q_star import COUNTRY_YEARLY_BODY, DECADAL_BODY, YEARLY_GLOBAL_BODY, city_yearly_body
    return (f", a_gy AS ({YEARLY_GLOBAL_BODY}), a_gd AS ({DECADAL_BODY}), a_cy AS ({COUNTRY_YEARLY_BODY}), "
            f"a_ci AS ({city_yearly_body('city_view')}), a_mc AS ({city_yearly_body('major_view')})\n")


_GRAINS = [("global_yearly", "a_gy", ["year"]), ("global_decadal", "a_gd", ["decade"]),
           ("country_yearly", "a_cy", ["country_id", "year"]), ("city_yearly", "a_ci", ["city_id", "year"]),
           ("major_city_yearly", "a_mc", ["city_id", "year"])]

GRAIN_SQL = with_star(_agg_ctes() + """, g AS (""" + " UNION ALL ".join(_grain_sql(*x) for x in _GRAINS) + """)
SELECT *, CASE WHEN row_count > 0 AND duplicate_grain_rows = 0 AND null_grain_rows = 0
  AND coverage_mismatch_rows = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM g""")


@register("aggregate_grain_check", GRAIN_SQL, ids="DQ-11 AGG-07 SCA-09")
def aggregate_grain_check(spark, sf):
    s = build_star(spark, sf)
    return reduce(DataFrame.unionByName,
                  [dq.grain_check(df, name, grain) for name, (df, grain) in _aggregates(s).items()])


FINAL_SQL = with_star(_agg_ctes() + """, g AS (""" + " UNION ALL ".join(_grain_sql(*x) for x in _GRAINS) + """),
checks AS (
  SELECT 'enriched_rows_preserved' AS check_name,
         (SELECT count(*) FROM enriched) = (SELECT count(*) FROM fact_city) AS passed
  UNION ALL SELECT 'aggregates_grain_ok', bool_and(row_count > 0 AND duplicate_grain_rows = 0
         AND null_grain_rows = 0 AND coverage_mismatch_rows = 0) FROM g
  UNION ALL SELECT 'country_names_unique', count(*) = count(DISTINCT country_name) FROM dim_country
  UNION ALL SELECT 'city_keys_unique', count(*) = count(DISTINCT row(city_name, country_id, latitude, longitude))
         FROM dim_city
  UNION ALL SELECT 'dates_cover_facts', NOT EXISTS (SELECT 1 FROM fact_city f WHERE f.date_id NOT IN
         (SELECT date_id FROM dim_date)))
SELECT check_name, passed, CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END AS status,
       CASE WHEN bool_and(passed) OVER () THEN 'READY' ELSE 'NOT READY' END AS overall FROM checks""")


@register("final_audit", FINAL_SQL, ids="DQ-12 DQ-13 DQ-14 WIN-02 AGG-09 JON-19")
def final_audit(spark, sf):
    s = build_star(spark, sf)
    aggs = _aggregates(s)
    grains = reduce(DataFrame.unionByName, [dq.grain_check(df, n, g) for n, (df, g) in aggs.items()])
    ev, fc = s.enriched().agg(F.count(F.lit(1)).alias("a")), s.fact_city.agg(F.count(F.lit(1)).alias("b"))
    c1 = ev.crossJoin(fc).select(F.lit("enriched_rows_preserved").alias("check_name"),
                                 (F.col("a") == F.col("b")).alias("passed"))
    c2 = grains.agg(F.bool_and(F.col("status") == "PASS").alias("passed")) \
        .select(F.lit("aggregates_grain_ok").alias("check_name"), "passed")
    c3 = s.dim_country.agg((F.count(F.lit(1)) == F.count_distinct("country_name")).alias("passed")) \
        .select(F.lit("country_names_unique").alias("check_name"), "passed")
    c4 = s.dim_city.agg((F.count(F.lit(1)) == F.count_distinct(
        F.struct("city_name", "country_id", "latitude", "longitude"))).alias("passed")) \
        .select(F.lit("city_keys_unique").alias("check_name"), "passed")
    orphans = s.fact_city.join(s.dim_date, "date_id", "left_anti").agg(F.count(F.lit(1)).alias("n"))
    c5 = orphans.select(F.lit("dates_cover_facts").alias("check_name"), (F.col("n") == 0).alias("passed"))
    return dq.final_audit(reduce(DataFrame.unionByName, [c1, c2, c3, c4, c5]))


# ---------------------------------------------------------------- look-ups and set checks

BUSIEST_SQL = with_star("""
, busiest AS (SELECT country_id FROM fact_country GROUP BY country_id ORDER BY count(*) DESC, country_id LIMIT 1)
SELECT v.country_id, v.country_name, v.observation_date, v.average_temperature
FROM country_view v JOIN busiest b ON b.country_id = v.country_id""")


@register("busiest_entity_history", BUSIEST_SQL, round_cols=["average_temperature"], ids="JON-18 TOP-06")
def busiest_entity_history(spark, sf):
    """History of the country with the most rows (ties: smallest id): a one-row top-1 frame,
    broadcast into an inner join (JON-18)."""
    s = build_star(spark, sf)
    busiest = (s.fact_country.groupBy("country_id").agg(F.count(F.lit(1)).alias("n"))
               .orderBy(F.desc("n"), F.asc("country_id")).limit(1).select("country_id"))
    v = s.country_view()
    return v.join(F.broadcast(busiest), "country_id").select(
        "country_id", "country_name", "observation_date", "average_temperature")


EXPECTED_SQL = with_star("""
, expected AS (
  SELECT 'city' AS dataset, count(*) AS expected_rows FROM city_src
  UNION ALL SELECT 'country', count(*) FROM country_src
  UNION ALL SELECT 'global', count(*) FROM global_src
  UNION ALL SELECT 'major_city', count(*) FROM major_src),
actual AS (
  SELECT 'city' AS dataset, count(*) AS actual_rows FROM fact_city
  UNION ALL SELECT 'country', count(*) FROM fact_country
  UNION ALL SELECT 'global', count(*) FROM fact_global
  UNION ALL SELECT 'major_city', count(*) FROM fact_major)
SELECT dataset, expected_rows, coalesce(actual_rows, 0) AS actual_rows,
       coalesce(actual_rows, 0) - expected_rows AS difference,
       CASE WHEN expected_rows = coalesce(actual_rows, 0) THEN 'PASS' ELSE 'FAIL' END AS status
FROM expected LEFT JOIN actual USING (dataset)""")


@register("expected_vs_actual", EXPECTED_SQL, ids="JON-09 DQ-01 DQ-14 SET-02")
def expected_vs_actual(spark, sf):
    """Every staged row must reach its fact (JON-09 / DQ-14): staged counts are the expectation."""
    s = build_star(spark, sf)

    def counts(pairs, col):
        return reduce(DataFrame.unionByName,
                      [df.agg(F.count(F.lit(1)).alias(col)).select(F.lit(n).alias("dataset"), col)
                       for n, df in pairs])
    exp = counts([("city", s.city_src), ("country", s.country_src), ("global", s.global_src),
                  ("major_city", s.major_src)], "expected_rows")
    act = counts([("city", s.fact_city), ("country", s.fact_country), ("global", s.fact_global),
                  ("major_city", s.fact_major)], "actual_rows")
    return dq.expected_vs_actual(spark, exp, act)


KEYSET_SQL = """
SELECT count(*) FILTER (WHERE o.k IS NULL) AS inserted, count(*) FILTER (WHERE o.k IS NOT NULL) AS replaced
FROM (SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_orderdate >= TIMESTAMP '1999-07-01') n
LEFT JOIN (SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01') o ON o.k = n.k"""


@register("key_set_diff", KEYSET_SQL, ids="JON-20 SET-05")
def key_set_diff(spark, sf):
    o = table(spark, sf, "orders")
    old = o.where(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    new = o.where(F.col("o_orderdate") >= F.lit("1999-07-01").cast("timestamp_ntz"))
    return jn.key_set_diff(old, new, ["o_orderkey"])
