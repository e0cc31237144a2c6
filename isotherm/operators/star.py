"""Star schema: dimensions, facts, star views and the enriched view.

Inventory: FEA-01..03, SET-01, SET-02, JON-01..07, AGG-08, WIN-19, PRJ-01, PRJ-03, PRJ-06.

Broadcast policy: ``dim_date`` (one row per calendar month) and ``dim_country``
(one row per country name) have a size bound that does not grow with the
observation volume, so they are broadcast explicitly.  ``dim_city`` and the
side facts grow with the data; their joins carry no hint and AQE converts them
to broadcast joins only when runtime statistics show they are small.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isotherm.functions.calendar import calendar_parts
from isotherm.functions.coords import signed_coordinate
from isotherm.functions.ids import dense_index
from isotherm.functions.text import blank_to_null


def bounded_index(df: DataFrame, order_cols: list[str], id_col: str) -> DataFrame:
    """``row_number`` in key order for a frame whose size has a fixed bound (calendar months,
    country names): the un-partitioned window then runs on a few thousand rows at most."""
    return df.withColumn(id_col, F.row_number().over(Window.orderBy(*order_cols)).cast("long"))


def build_dim_date(*sources: DataFrame, date_col: str = "dt") -> DataFrame:
    """Distinct non-NULL dates of all sources (UNION) with calendar parts; ``date_id`` in date order.

    One row per calendar month: bounded (12 per year), so the id uses a plain ordered row number.
    """
    dates = reduce(DataFrame.union,
                   [s.select(F.col(date_col).alias("full_date")).where(F.col("full_date").isNotNull())
                    for s in sources]).distinct()
    parts = calendar_parts("full_date")
    dim = dates.select("full_date", *[v.alias(k) for k, v in parts.items()])
    return bounded_index(dim, ["full_date"], "date_id").select(
        "date_id", "full_date", "year", "month", "quarter", "decade")


def build_dim_country(*sources: DataFrame, country_col: str = "country") -> DataFrame:
    names = reduce(DataFrame.union,
                   [s.select(blank_to_null(country_col).alias("country_name")) for s in sources])
    names = names.where(F.col("country_name").isNotNull()).distinct()
    # country names are a bounded domain (a few hundred), unlike cities
    return bounded_index(names, ["country_name"], "country_id").select("country_id", "country_name")


def normalised_city_rows(src: DataFrame, is_major: bool, city_col: str = "city",
                         country_col: str = "country", lat_col: str = "latitude",
                         lon_col: str = "longitude") -> DataFrame:
    return src.select(
        blank_to_null(city_col).alias("city_name"),
        blank_to_null(country_col).alias("country_name"),
        signed_coordinate(lat_col, "N", "S").alias("latitude"),
        signed_coordinate(lon_col, "E", "W").alias("longitude"),
        F.lit(is_major).alias("is_major_city"))


def build_dim_city(city_src: DataFrame, major_src: DataFrame, dim_country: DataFrame) -> DataFrame:
    """Distinct (city, country, lat, lon) over both city sources; BOOL_OR of the major flag.

    The major flag is OR-ed inside a partial aggregation, so one hot location
    does not land in a single task un-combined.
    """
    rows = normalised_city_rows(city_src, False).union(normalised_city_rows(major_src, True))
    rows = rows.where(F.col("city_name").isNotNull() & F.col("country_name").isNotNull()
                      & F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    keyed = rows.join(dim_country, "country_name")
    grouped = keyed.groupBy("city_name", "country_id", "latitude", "longitude").agg(
        F.bool_or("is_major_city").alias("is_major_city"))
    return dense_index(grouped, ["city_name", "country_id", "latitude", "longitude"], "city_id").select(
        "city_id", "city_name", "country_id", "latitude", "longitude", "is_major_city")


def build_fact_city(src: DataFrame, dim_date: DataFrame, dim_city: DataFrame, dim_country: DataFrame,
                    value_cols=("average_temperature", "average_temperature_uncertainty")) -> DataFrame:
    """Inner lookups on date, trimmed country and the four-part city key; misses vanish (JON-01/02)."""
    norm = src.select(
        F.col("dt"), *value_cols,
        blank_to_null("city").alias("city_name"),
        blank_to_null("country").alias("country_name"),
        signed_coordinate("latitude", "N", "S").alias("latitude"),
        signed_coordinate("longitude", "E", "W").alias("longitude"))
    dd = F.broadcast(dim_date.select("date_id", F.col("full_date").alias("dt")))
    dc = dim_country
    return (norm.join(dd, "dt").join(dc, "country_name")
            .join(dim_city.select("city_id", "city_name", "country_id", "latitude", "longitude"),
                  ["city_name", "country_id", "latitude", "longitude"])
            .select("date_id", "city_id", *value_cols))


def build_fact_country(src: DataFrame, dim_date: DataFrame, dim_country: DataFrame,
                       value_cols=("average_temperature", "average_temperature_uncertainty")) -> DataFrame:
    dd = F.broadcast(dim_date.select("date_id", F.col("full_date").alias("dt")))
    norm = src.select("dt", *value_cols, blank_to_null("country").alias("country_name"))
    return (norm.join(dd, "dt").join(dim_country, "country_name")
            .select("date_id", "country_id", *value_cols))


GLOBAL_VALUES = ("land_average_temperature", "land_average_temperature_uncertainty",
                 "land_max_temperature", "land_max_temperature_uncertainty",
                 "land_min_temperature", "land_min_temperature_uncertainty",
                 "land_and_ocean_average_temperature", "land_and_ocean_average_temperature_uncertainty")


def build_fact_global(src: DataFrame, dim_date: DataFrame, value_cols=GLOBAL_VALUES) -> DataFrame:
    dd = F.broadcast(dim_date.select("date_id", F.col("full_date").alias("dt")))
    return src.join(dd, "dt").select("date_id", *value_cols)


def _date_cols(prefix: str = "d") -> list:
    return [F.col(f"{prefix}.full_date").alias("observation_date"), f"{prefix}.year", f"{prefix}.month",
            f"{prefix}.quarter", f"{prefix}.decade"]


def star_view_global(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return (fact.alias("f").join(F.broadcast(dim_date).alias("d"), "date_id")
            .select("date_id", *_date_cols(), *[f"f.{c}" for c in GLOBAL_VALUES]))


def star_view_country(fact: DataFrame, dim_date: DataFrame, dim_country: DataFrame) -> DataFrame:
    return (fact.alias("f").join(F.broadcast(dim_date).alias("d"), "date_id")
            .join(dim_country.alias("c"), "country_id")
            .select("date_id", *_date_cols(), "country_id", "c.country_name",
                    "f.average_temperature", "f.average_temperature_uncertainty"))


def star_view_city(fact: DataFrame, dim_date: DataFrame, dim_city: DataFrame,
                   dim_country: DataFrame) -> DataFrame:
    """fact ⋈ date ⋈ city ⋈ country (JON-05; JON-06 is the same shape on the major fact)."""
    return (fact.alias("f").join(F.broadcast(dim_date).alias("d"), "date_id")
            .join(dim_city.alias("ci"), "city_id")
            .join(dim_country.alias("c"), F.col("ci.country_id") == F.col("c.country_id"))
            .select("date_id", *_date_cols(), "city_id", "ci.city_name", F.col("c.country_id"),
                    "c.country_name", "ci.latitude", "ci.longitude", "ci.is_major_city",
                    "f.average_temperature", "f.average_temperature_uncertainty"))


def enrich_left(fact_city: DataFrame, dim_date: DataFrame, dim_city: DataFrame, dim_country: DataFrame,
                fact_country: DataFrame, fact_global: DataFrame, fact_major: DataFrame) -> DataFrame:
    """City grain kept; LEFT JOIN country (date, country), global (date), major city (date, city).

    Each side fact is unique on its join key, so the city grain is preserved.  A
    ``matched`` flag comes from a marker column on the right side, so it is separate
    from a NULL value on a matched row.
    """
    co = fact_country.select(F.col("date_id").alias("co_date_id"), F.col("country_id").alias("co_country_id"),
                             F.lit(True).alias("country_matched"),
                             F.col("average_temperature").alias("country_average_temperature"),
                             F.col("average_temperature_uncertainty").alias("country_average_temperature_uncertainty"))
    g = fact_global.select(F.col("date_id").alias("g_date_id"), F.lit(True).alias("global_matched"),
                           *GLOBAL_VALUES)
    mc = fact_major.select(F.col("date_id").alias("mc_date_id"), F.col("city_id").alias("mc_city_id"),
                           F.lit(True).alias("major_city_matched"),
                           F.col("average_temperature").alias("major_city_average_temperature"),
                           F.col("average_temperature_uncertainty").alias("major_city_average_temperature_uncertainty"))
    base = (fact_city.alias("ci").join(F.broadcast(dim_date).alias("d"), "date_id")
            .join(dim_city.alias("city"), "city_id")
            .join(dim_country.alias("country"),
                  F.col("city.country_id") == F.col("country.country_id")))
    out = (base
           .join(co, (F.col("co_date_id") == F.col("date_id")) & (F.col("co_country_id") == F.col("city.country_id")), "left")
           .join(F.broadcast(g), F.col("g_date_id") == F.col("date_id"), "left")  # one row per month
           .join(mc, (F.col("mc_date_id") == F.col("date_id")) & (F.col("mc_city_id") == F.col("city_id")), "left"))
    return out.select(
        *_date_cols(),
        "city.city_name", "country.country_name", "city.latitude", "city.longitude", "city.is_major_city",
        F.col("ci.average_temperature").alias("city_average_temperature"),
        F.col("ci.average_temperature_uncertainty").alias("city_average_temperature_uncertainty"),
        F.coalesce("country_matched", F.lit(False)).alias("country_matched"),
        "country_average_temperature", "country_average_temperature_uncertainty",
        F.coalesce("global_matched", F.lit(False)).alias("global_matched"),
        *GLOBAL_VALUES,
        F.coalesce("major_city_matched", F.lit(False)).alias("major_city_matched"),
        "major_city_average_temperature", "major_city_average_temperature_uncertainty")


ENRICHED_COLUMNS = [
    "observation_date", "year", "month", "quarter", "decade", "city_name", "country_name", "latitude",
    "longitude", "is_major_city", "city_average_temperature", "city_average_temperature_uncertainty",
    "country_matched", "country_average_temperature", "country_average_temperature_uncertainty",
    "global_matched", *GLOBAL_VALUES, "major_city_matched", "major_city_average_temperature",
    "major_city_average_temperature_uncertainty"]
