"""DuckDB SQL twins of ``driver_sources`` and ``driver_star`` (CTE fragments).

The oracle re-derives everything from the driver tables independently of the
Spark code, so a mistake in one engine's derivation shows up as a mismatch.
"""

from __future__ import annotations


def _coord(key: str, mult: int, mod: int, shift: int, pos: str, neg: str) -> str:
    t = f"((({key} * {mult}) % {mod}) - {shift})"
    return (f"(CAST(abs({t}) // 10 AS VARCHAR) || '.' || CAST(abs({t}) % 10 AS VARCHAR) || "
            f"CASE WHEN {t} < 0 THEN '{neg}' ELSE '{pos}' END)")


OBS_ROWS = """obs_rows AS (
  SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_returnflag,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS dt,
         CASE WHEN l_discount <> 0 THEN l_extendedprice / CAST(2000 AS DOUBLE) - CAST(10 AS DOUBLE) END AS v,
         l_extendedprice / CAST(2000 AS DOUBLE) - CAST(10 AS DOUBLE) AS v_all,
         l_tax AS u, l_discount AS d
  FROM lineitem)"""

COUNTRY_TEXT = "CASE WHEN n.n_nationkey % 5 = 0 THEN '  ' || n.n_name || ' ' ELSE n.n_name END"

LOCATIONS = f"""locations AS (
  SELECT s.s_suppkey AS suppkey, s.s_name AS city, {COUNTRY_TEXT} AS country,
         {_coord('s.s_suppkey', 37, 1801, 900, 'N', 'S')} AS latitude,
         {_coord('s.s_suppkey', 53, 3601, 1800, 'E', 'W')} AS longitude,
         s.s_acctbal >= 9000 AS is_major, n.n_nationkey, n.n_regionkey
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey)"""

CITY_SRC = """city_src AS (
  SELECT m.dt, m.average_temperature, m.average_temperature_uncertainty,
         l.city, l.country, l.latitude, l.longitude
  FROM (SELECT l_suppkey, dt, avg(v) AS average_temperature, avg(u) AS average_temperature_uncertainty
        FROM obs_rows GROUP BY l_suppkey, dt) m
  JOIN locations l ON m.l_suppkey = l.suppkey)"""

MAJOR_SRC = """major_src AS (
  SELECT m.dt, m.average_temperature, m.average_temperature_uncertainty,
         l.city, l.country, l.latitude, l.longitude
  FROM (SELECT l_suppkey, dt, avg(v) FILTER (WHERE l_returnflag <> 'R') AS average_temperature,
               avg(u) FILTER (WHERE l_returnflag <> 'R') AS average_temperature_uncertainty
        FROM obs_rows GROUP BY l_suppkey, dt HAVING count(*) FILTER (WHERE l_returnflag <> 'R') > 0) m
  JOIN locations l ON m.l_suppkey = l.suppkey
  WHERE l.is_major)"""

COUNTRY_SRC = f"""country_src AS (
  SELECT o.dt, avg(o.v) AS average_temperature, avg(o.u) AS average_temperature_uncertainty,
         {COUNTRY_TEXT} AS country
  FROM obs_rows o JOIN supplier s ON o.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  WHERE o.dt < DATE '2001-01-01'
  GROUP BY o.dt, n.n_nationkey, n.n_name)"""

GLOBAL_SRC = """global_src AS (
  SELECT dt,
         avg(v) AS land_average_temperature, avg(u) AS land_average_temperature_uncertainty,
         max(v) AS land_max_temperature, stddev_samp(u) AS land_max_temperature_uncertainty,
         min(v) AS land_min_temperature, avg(d) AS land_min_temperature_uncertainty,
         avg(v_all) AS land_and_ocean_average_temperature,
         stddev_samp(d) AS land_and_ocean_average_temperature_uncertainty
  FROM obs_rows GROUP BY dt)"""

SOURCES = ",\n".join([OBS_ROWS, LOCATIONS, CITY_SRC, MAJOR_SRC, COUNTRY_SRC, GLOBAL_SRC])


def _degrees(key: str, mult: int, mod: int, shift: int) -> str:
    """A coordinate straight from the place's key, so that nothing is parsed back from text."""
    return f"({key} * {mult} % {mod} - {shift}) / CAST(10 AS DOUBLE)"


# One row per (place, month): over all readings, and over those that were not returned.
MONTHLY = """monthly AS (
  SELECT l_suppkey AS suppkey, dt, avg(v) AS v_mean, avg(u) AS u_mean, avg(v) FILTER (WHERE l_returnflag <> 'R') AS v_kept,
         avg(u) FILTER (WHERE l_returnflag <> 'R') AS u_kept, count(*) FILTER (WHERE l_returnflag <> 'R') AS kept
  FROM obs_rows GROUP BY ALL)"""

# Places that have a reading; equal places share their numbers, which follow the sort order.
SITES = f"""sites AS (
  SELECT *, bool_or(listed AND kept_ever > 0) OVER (PARTITION BY city_name, country_name, latitude, longitude) AS is_major_city,
         dense_rank() OVER (ORDER BY country_name) AS country_id,
         dense_rank() OVER (ORDER BY city_name, country_name, latitude, longitude) AS city_id
  FROM (SELECT suppkey, is_major AS listed, trim(city) AS city_name, trim(country) AS country_name,
               {_degrees('suppkey', 37, 1801, 900)} AS latitude, {_degrees('suppkey', 53, 3601, 1800)} AS longitude,
               sum(kept) AS kept_ever
        FROM monthly JOIN locations USING (suppkey) GROUP BY ALL)
  WHERE city_name <> '' AND country_name <> '')"""

DIMS = """dim_date AS (
  SELECT dense_rank() OVER (ORDER BY dt) AS date_id, dt AS full_date, year(dt) AS year, month(dt) AS month,
         quarter(dt) AS quarter, year(dt) - year(dt) % 10 AS decade
  FROM (SELECT DISTINCT dt FROM obs_rows WHERE dt IS NOT NULL)),
dim_country AS (SELECT DISTINCT country_id, country_name FROM sites),
dim_city AS (SELECT DISTINCT city_id, city_name, country_id, latitude, longitude, is_major_city FROM sites)"""

# Every (place, month) with its numbers, names and both means; facts and views are cuts of it.
SIGHTINGS = """sightings AS (
  SELECT date_id, full_date AS observation_date, year, month, quarter, decade, city_id, city_name, country_id, country_name,
         latitude, longitude, is_major_city, v_mean, u_mean, v_kept, u_kept, listed AND kept > 0 AS in_major
  FROM monthly JOIN sites USING (suppkey) JOIN dim_date ON full_date = dt)"""

FACTS = """fact_city AS (
  SELECT date_id, city_id, v_mean AS average_temperature, u_mean AS average_temperature_uncertainty FROM sightings),
fact_major AS (
  SELECT date_id, city_id, v_kept AS average_temperature, u_kept AS average_temperature_uncertainty
  FROM sightings WHERE in_major),
fact_country AS (
  SELECT date_id, country_id, avg(v) AS average_temperature, avg(u) AS average_temperature_uncertainty
  FROM obs_rows JOIN sites ON suppkey = l_suppkey JOIN dim_date ON full_date = dt
  WHERE dt < DATE '2001-01-01' GROUP BY ALL),
fact_global AS (SELECT date_id, global_src.* EXCLUDE (dt) FROM global_src JOIN dim_date ON full_date = dt)"""

_MONTH_COLS = "date_id, full_date AS observation_date, year, month, quarter, decade"
_PLACE_COLS = ("date_id, observation_date, year, month, quarter, decade, city_id, city_name, country_id, country_name, "
               "latitude, longitude, is_major_city")

VIEWS = f"""city_view AS (
  SELECT {_PLACE_COLS}, v_mean AS average_temperature, u_mean AS average_temperature_uncertainty FROM sightings),
major_view AS (
  SELECT {_PLACE_COLS}, v_kept AS average_temperature, u_kept AS average_temperature_uncertainty
  FROM sightings WHERE in_major),
country_view AS (
  SELECT {_MONTH_COLS}, country_id, country_name, average_temperature, average_temperature_uncertainty
  FROM fact_country JOIN dim_country USING (country_id) JOIN dim_date USING (date_id)),
global_view AS (
  SELECT {_MONTH_COLS}, fact_global.* EXCLUDE (date_id) FROM fact_global JOIN dim_date USING (date_id)),
nation_months AS (
  SELECT date_id, country_id, TRUE AS country_matched, average_temperature AS country_average_temperature,
         average_temperature_uncertainty AS country_average_temperature_uncertainty FROM fact_country),
world_months AS (SELECT *, TRUE AS global_matched FROM fact_global),
enriched AS (
  SELECT * EXCLUDE (date_id, city_id, country_id, v_mean, u_mean, v_kept, u_kept, in_major)
           REPLACE (coalesce(country_matched, FALSE) AS country_matched, coalesce(global_matched, FALSE) AS global_matched),
         v_mean AS city_average_temperature, u_mean AS city_average_temperature_uncertainty,
         in_major AS major_city_matched, CASE WHEN in_major THEN v_kept END AS major_city_average_temperature,
         CASE WHEN in_major THEN u_kept END AS major_city_average_temperature_uncertainty
  FROM sightings LEFT JOIN nation_months USING (date_id, country_id) LEFT JOIN world_months USING (date_id))"""

STAR = ",\n".join([SOURCES, MONTHLY, SITES, DIMS, SIGHTINGS, FACTS, VIEWS])


def with_star(body: str) -> str:
    """Prefix a query body with every source / dimension / fact / view CTE."""
    return f"WITH {STAR}\n{body}"


def with_sources(body: str) -> str:
    return f"WITH {SOURCES}\n{body}"


def rounded(sql: str, cols: list[str] | tuple[str, ...], digits: int = 6) -> str:
    """Wrap ``sql`` and round the named double columns (the Spark side rounds the same ones)."""
    if not cols:
        return sql
    scale = f"CAST({2 ** 20} AS DOUBLE)"
    repl = ", ".join(f"round(CAST({c} AS DOUBLE) * {scale}) / {scale} + CAST(0 AS DOUBLE) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) AS _r"
