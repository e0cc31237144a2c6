"""Queries: observation base, dimensions, star views, enriched view, coverage aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from isotherm.functions.calendar import calendar_parts, month_index, month_start
from isotherm.operators import aggregate as agg
from isotherm.plans import driver_sources as ds
from isotherm.plans.driver_star import build_star
from isotherm.plans.oracle_sources import with_sources, with_star
from isotherm.plans.registry import register
from isotherm.sources.tables import table

GLOBAL_DOUBLES = ["land_average_temperature", "land_average_temperature_uncertainty", "land_max_temperature",
                  "land_max_temperature_uncertainty", "land_min_temperature", "land_min_temperature_uncertainty",
                  "land_and_ocean_average_temperature", "land_and_ocean_average_temperature_uncertainty"]

OBS_MONTHLY_SQL = with_sources("""
SELECT l_suppkey, dt AS observation_date, year(dt) AS year, month(dt) AS month, quarter(dt) AS quarter,
       (year(dt) // 10) * 10 AS decade, year(dt) * 12 + month(dt) AS month_index,
       count(*) AS n_rows, count(v) AS n_valid, avg(v) AS avg_value
FROM obs_rows GROUP BY l_suppkey, dt""")


@register("obs_monthly", OBS_MONTHLY_SQL, round_cols=["avg_value"], ids="AGG-01 PRJ-06 PRJ-07")
def obs_monthly(spark, sf):
    rows = ds.observation_rows(spark, sf)
    parts = calendar_parts("dt")
    return (rows.groupBy("l_suppkey", "dt")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.count("v").alias("n_valid"), F.avg("v").alias("avg_value"))
            .select("l_suppkey", F.col("dt").alias("observation_date"), *[v.alias(k) for k, v in parts.items()],
                    month_index("dt").alias("month_index"), "n_rows", "n_valid", "avg_value"))


CALENDAR_SQL = """
SELECT CAST(row_number() OVER (ORDER BY full_date) AS BIGINT) AS date_id, full_date,
       year(full_date) AS year, month(full_date) AS month, quarter(full_date) AS quarter,
       (year(full_date) // 10) * 10 AS decade
FROM (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS full_date FROM lineitem
      UNION SELECT CAST(date_trunc('month', o_orderdate) AS DATE) FROM orders) x"""


@register("calendar_dim", CALENDAR_SQL, ids="FEA-01 SET-01 WIN-19")
def calendar_dim(spark, sf):
    from isotherm.operators.star import build_dim_date
    li = table(spark, sf, "lineitem").select(month_start("l_shipdate").alias("dt"))
    od = table(spark, sf, "orders").select(month_start("o_orderdate").alias("dt"))
    return build_dim_date(li, od)


@register("entity_dim", with_star("SELECT * FROM dim_country"), ids="FEA-02 PRJ-01 SET-01")
def entity_dim(spark, sf):
    return build_star(spark, sf).dim_country


@register("nested_dim", with_star("SELECT * FROM dim_city"), ids="FEA-03 AGG-08 PRJ-03 SET-02 WIN-19")
def nested_dim(spark, sf):
    return build_star(spark, sf).dim_city


@register("star_city_view", with_star("SELECT * FROM city_view"),
          round_cols=["average_temperature", "average_temperature_uncertainty"], ids="JON-01 JON-02 JON-05")
def star_city_view(spark, sf):
    return build_star(spark, sf).city_view()


@register("star_major_view", with_star("SELECT * FROM major_view"),
          round_cols=["average_temperature", "average_temperature_uncertainty"], ids="JON-06")
def star_major_view(spark, sf):
    return build_star(spark, sf).major_view()


@register("star_country_view", with_star("SELECT * FROM country_view"),
          round_cols=["average_temperature", "average_temperature_uncertainty"], ids="JON-04")
def star_country_view(spark, sf):
    return build_star(spark, sf).country_view()


@register("star_global_view", with_star("SELECT * FROM global_view"), round_cols=GLOBAL_DOUBLES,
          ids="JON-03")
def star_global_view(spark, sf):
    return build_star(spark, sf).global_view()


ENRICHED_DOUBLES = ["city_average_temperature", "city_average_temperature_uncertainty",
                    "country_average_temperature", "country_average_temperature_uncertainty",
                    *GLOBAL_DOUBLES, "major_city_average_temperature",
                    "major_city_average_temperature_uncertainty"]


@register("enriched_view", with_star("SELECT * FROM enriched"), round_cols=ENRICHED_DOUBLES,
          ids="JON-07")
def enriched_view(spark, sf):
    return build_star(spark, sf).enriched()


COV_DOUBLES = ["average_temperature", "minimum_temperature", "maximum_temperature"]

_COV = """count(*) AS observation_months, count({v}) AS valid_temperature_months,
       count(*) FILTER (WHERE {v} IS NULL) AS missing_temperature_months,
       avg({v}) AS average_temperature, min({v}) AS minimum_temperature, max({v}) AS maximum_temperature"""

YEARLY_GLOBAL_BODY = (f"""
SELECT year, {_COV.format(v='land_average_temperature')},
       avg(land_average_temperature_uncertainty) AS average_land_uncertainty,
       avg(land_and_ocean_average_temperature) AS average_land_ocean_temperature,
       avg(land_and_ocean_average_temperature_uncertainty) AS average_land_ocean_uncertainty
FROM global_view GROUP BY year""")
YEARLY_GLOBAL_SQL = with_star(YEARLY_GLOBAL_BODY)

_GLOBAL_AVGS = {"average_land_uncertainty": "land_average_temperature_uncertainty",
                "average_land_ocean_temperature": "land_and_ocean_average_temperature",
                "average_land_ocean_uncertainty": "land_and_ocean_average_temperature_uncertainty"}


@register("yearly_coverage_global", YEARLY_GLOBAL_SQL, round_cols=COV_DOUBLES + list(_GLOBAL_AVGS),
          ids="AGG-01 AGG-06")
def yearly_coverage_global(spark, sf):
    return agg.coverage(build_star(spark, sf).global_view(), ["year"], "land_average_temperature", _GLOBAL_AVGS)


DECADAL_BODY = (f"""
SELECT decade, min(year) AS first_year, max(year) AS last_year, {_COV.format(v='land_average_temperature')},
       avg(land_average_temperature_uncertainty) AS average_land_uncertainty,
       avg(land_and_ocean_average_temperature) AS average_land_ocean_temperature,
       avg(land_and_ocean_average_temperature_uncertainty) AS average_land_ocean_uncertainty
FROM global_view GROUP BY decade""")
DECADAL_SQL = with_star(DECADAL_BODY)


@register("decadal_coverage", DECADAL_SQL, round_cols=COV_DOUBLES + list(_GLOBAL_AVGS), ids="AGG-02")
def decadal_coverage(spark, sf):
    return agg.coverage(build_star(spark, sf).global_view(), ["decade"], "land_average_temperature",
                        _GLOBAL_AVGS, first_last="year")


COUNTRY_YEARLY_BODY = (f"""
SELECT country_id, country_name, year, {_COV.format(v='average_temperature')},
       avg(average_temperature_uncertainty) AS average_temperature_uncertainty
FROM country_view GROUP BY country_id, country_name, year""")
COUNTRY_YEARLY_SQL = with_star(COUNTRY_YEARLY_BODY)
_UNC = {"average_temperature_uncertainty": "average_temperature_uncertainty"}


@register("yearly_coverage_country", COUNTRY_YEARLY_SQL,
          round_cols=COV_DOUBLES + ["average_temperature_uncertainty"], ids="AGG-03")
def yearly_coverage_country(spark, sf):
    return agg.coverage(build_star(spark, sf).country_view(), ["country_id", "country_name", "year"],
                        "average_temperature", _UNC)


CITY_KEYS = ["city_id", "city_name", "country_id", "country_name", "latitude", "longitude",
             "is_major_city", "year"]


def city_yearly_body(view: str) -> str:
    return (f"""
SELECT {', '.join(CITY_KEYS)}, {_COV.format(v='average_temperature')},
       avg(average_temperature_uncertainty) AS average_temperature_uncertainty
FROM {view} GROUP BY {', '.join(CITY_KEYS)}""")


def _city_yearly_sql(view: str) -> str:
    return with_star(city_yearly_body(view))


@register("yearly_coverage_city", _city_yearly_sql("city_view"),
          round_cols=COV_DOUBLES + ["average_temperature_uncertainty"], ids="AGG-04")
def yearly_coverage_city(spark, sf):
    return agg.coverage(build_star(spark, sf).city_view(), CITY_KEYS, "average_temperature", _UNC)


@register("yearly_coverage_major", _city_yearly_sql("major_view"),
          round_cols=COV_DOUBLES + ["average_temperature_uncertainty"], ids="AGG-05")
def yearly_coverage_major(spark, sf):
    return agg.coverage(build_star(spark, sf).major_view(), CITY_KEYS, "average_temperature", _UNC)
