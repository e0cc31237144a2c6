"""The star schema and enriched view built over the driver-derived sources."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from isotherm.operators import star as st
from isotherm.plans import driver_sources as ds
from isotherm.plans.materialize import stage


@dataclass
class Star:
    city_src: DataFrame
    major_src: DataFrame
    country_src: DataFrame
    global_src: DataFrame
    dim_date: DataFrame
    dim_country: DataFrame
    dim_city: DataFrame
    fact_city: DataFrame
    fact_major: DataFrame
    fact_country: DataFrame
    fact_global: DataFrame

    def city_view(self) -> DataFrame:
        return st.star_view_city(self.fact_city, self.dim_date, self.dim_city, self.dim_country)

    def major_view(self) -> DataFrame:
        return st.star_view_city(self.fact_major, self.dim_date, self.dim_city, self.dim_country)

    def country_view(self) -> DataFrame:
        return st.star_view_country(self.fact_country, self.dim_date, self.dim_country)

    def global_view(self) -> DataFrame:
        return st.star_view_global(self.fact_global, self.dim_date)

    spark: SparkSession = None
    sf_dir: str = ""

    def enriched(self) -> DataFrame:
        return stage(self.spark, "enriched", self.sf_dir,
                     lambda: st.enrich_left(self.fact_city, self.dim_date, self.dim_city, self.dim_country,
                                            self.fact_country, self.fact_global, self.fact_major))


def build_star(spark: SparkSession, sf_dir: str) -> Star:
    """Sources, dimensions and facts, each materialised once per application (see ``materialize``)."""
    def st_(name, fn):
        return stage(spark, name, sf_dir, fn)

    partials = st_("partials", lambda: ds.monthly_partials(spark, sf_dir))
    city = st_("city_src", lambda: ds.city_source(spark, sf_dir, partials))
    major = st_("major_src", lambda: ds.major_city_source(spark, sf_dir, partials))
    country = st_("country_src", lambda: ds.country_source(spark, sf_dir, partials))
    glob = st_("global_src", lambda: ds.global_source(spark, sf_dir, partials))
    dim_date = st_("dim_date", lambda: st.build_dim_date(glob, country, city, major))
    dim_country = st_("dim_country", lambda: st.build_dim_country(country, city, major))
    dim_city = st_("dim_city", lambda: st.build_dim_city(city, major, dim_country))
    return Star(
        city_src=city, major_src=major, country_src=country, global_src=glob,
        dim_date=dim_date, dim_country=dim_country, dim_city=dim_city,
        fact_city=st_("fact_city", lambda: st.build_fact_city(city, dim_date, dim_city, dim_country)),
        fact_major=st_("fact_major", lambda: st.build_fact_city(major, dim_date, dim_city, dim_country)),
        fact_country=st_("fact_country", lambda: st.build_fact_country(country, dim_date, dim_country)),
        fact_global=st_("fact_global", lambda: st.build_fact_global(glob, dim_date)),
        spark=spark, sf_dir=sf_dir,
    )
