"""Monthly observation sources derived from the driver tables.

The observation model maps onto the TPC-H-like tables as follows:

* location (city)  = supplier; city name = ``s_name``
* country          = nation of the supplier; the country text is space-padded
                     for every fifth nation so that name normalisation matters
* zone             = region
* observation month = month of ``l_shipdate``
* value (temperature) = ``l_extendedprice / 2000 - 10``; NULL where ``l_discount = 0``
* uncertainty      = ``l_tax``
* coordinates      = text such as ``"57.3N"`` / ``"10.4W"`` derived from ``s_suppkey``
* major cities     = suppliers with ``s_acctbal >= 9000``; their own source leaves
                     out returned items (``l_returnflag = 'R'``)
* the country source stops at 2000-12 so that later city months have no country match

Each source is aggregated to (key, month) *before* it is joined to the small
supplier / nation tables, so the shuffle carries partial aggregates, not rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.functions.calendar import month_start
from isotherm.sources.tables import table

# Fixed values of the driver mapping (the oracle SQL repeats them).
VALUE_DIVISOR = 2000.0
VALUE_OFFSET = 10.0
LAT_MULT, LAT_MOD, LAT_SHIFT = 37, 1801, 900
LON_MULT, LON_MOD, LON_SHIFT = 53, 3601, 1800
MAJOR_ACCTBAL = 9000.0
COUNTRY_SOURCE_END = "2001-01-01"
PADDED_NATION_EVERY = 5


def value_expr(price: str = "l_extendedprice") -> F.Column:
    return F.col(price) / F.lit(VALUE_DIVISOR) - F.lit(VALUE_OFFSET)


def observation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row grain: one lineitem = one reading (value NULL where discount is 0)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_returnflag",
        month_start("l_shipdate").alias("dt"),
        F.when(F.col("l_discount") != 0, value_expr()).alias("v"),
        value_expr().alias("v_all"),
        F.col("l_tax").alias("u"),
        F.col("l_discount").alias("d"),
    )


def _coordinate_text(key: F.Column, mult: int, mod: int, shift: int, pos: str, neg: str) -> F.Column:
    tenths = F.pmod(key * mult, F.lit(mod)) - shift
    mag = F.abs(tenths)
    return F.concat((mag / 10).cast("long").cast("string"), F.lit("."),
                    F.pmod(mag, F.lit(10)).cast("string"),
                    F.when(tenths < 0, F.lit(neg)).otherwise(F.lit(pos)))


def supplier_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier as a location with raw (text) country and coordinates."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    country_text = F.when(F.pmod(F.col("n_nationkey"), F.lit(PADDED_NATION_EVERY)) == 0,
                          F.concat(F.lit("  "), F.col("n_name"), F.lit(" "))).otherwise(F.col("n_name"))
    key = F.col("s_suppkey")
    return (s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)  # nation: fixed 25 rows
            .select(key.alias("suppkey"),
                    F.col("s_name").alias("city"),
                    country_text.alias("country"),
                    _coordinate_text(key, LAT_MULT, LAT_MOD, LAT_SHIFT, "N", "S").alias("latitude"),
                    _coordinate_text(key, LON_MULT, LON_MOD, LON_SHIFT, "E", "W").alias("longitude"),
                    (F.col("s_acctbal") >= MAJOR_ACCTBAL).alias("is_major"),
                    "n_nationkey", "n_regionkey"))


#: A supplier with more readings than this is hot: its readings of a month are spread over ``SPREAD`` tasks.
HOT_READINGS = 1_000_000
SPREAD = 64


def _sums(rows: DataFrame, *keys: str) -> DataFrame:
    keep = F.col("l_returnflag") != "R"
    vk = F.when(keep, F.col("v"))
    uk = F.when(keep, F.col("u"))
    return rows.groupBy(*keys).agg(
        F.sum("v").alias("sv"), F.count("v").alias("nv"), F.min("v").alias("minv"), F.max("v").alias("maxv"),
        F.sum("u").alias("su"), F.count("u").alias("nu"), F.sum(F.col("u") * F.col("u")).alias("suu"),
        F.sum("d").alias("sd"), F.count("d").alias("nd"), F.sum(F.col("d") * F.col("d")).alias("sdd"),
        F.sum("v_all").alias("sva"), F.count("v_all").alias("nva"),
        F.sum(vk).alias("sv_k"), F.count(vk).alias("nv_k"), F.sum(uk).alias("su_k"), F.count(uk).alias("nu_k"),
        F.count(F.when(keep, F.lit(1))).alias("n_k"))


def monthly_partials(spark: SparkSession, sf_dir: str, hot_readings: int = HOT_READINGS) -> DataFrame:
    """lineitem -> (supplier, month) partial sums, counts, min and max.

    Every source below is derived from this frame, so lineitem is shuffled once.  A supplier has few
    readings a month, so sums before the shuffle would hold about as many groups as rows, each four
    times as wide, and spill; the readings' own columns are shuffled instead and summed where they
    arrive.  The readings of a hot supplier (one column's count tells) are spread over tasks and their
    sums added up, so none is a single task's work."""
    li = table(spark, sf_dir, "lineitem")
    hot = li.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > hot_readings).select(
        F.col("l_suppkey").alias("__hot"))
    slim = ["l_suppkey", "dt", "l_returnflag", "price", "d", "u"]
    rows = li.select("l_suppkey", month_start("l_shipdate").alias("dt"), "l_returnflag", F.col("l_extendedprice").alias("price"),
                     F.col("l_discount").alias("d"), F.col("l_tax").alias("u"), "l_orderkey", "l_linenumber")

    def readings(placed: DataFrame) -> DataFrame:
        return placed.withColumn("v_all", value_expr("price")).withColumn("v", F.when(F.col("d") != 0, F.col("v_all")))
    if hot.isEmpty():
        return _sums(readings(rows.select(*slim).repartition("l_suppkey", "dt")), "l_suppkey", "dt")
    spread = F.when(F.col("__hot").isNotNull(), F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(SPREAD))).otherwise(0)
    # hot suppliers: fewer than the readings / hot_readings
    placed = (rows.join(F.broadcast(hot), F.col("l_suppkey").eqNullSafe(F.col("__hot")), "left")
              .select(*slim, spread.alias("__spread")).repartition("l_suppkey", "dt", "__spread"))
    parts = _sums(readings(placed), "l_suppkey", "dt", "__spread")
    return parts.groupBy("l_suppkey", "dt").agg(
        *[(F.min if c == "minv" else F.max if c == "maxv" else F.sum)(c).alias(c) for c in parts.columns
          if c not in ("l_suppkey", "dt", "__spread")])


def _ratio(s: str, n: str) -> F.Column:
    return F.col(s) / F.nullif(F.col(n), F.lit(0))


def _sample_std(ss: str, s: str, n: str) -> F.Column:
    var = (F.col(ss) - F.col(s) * F.col(s) / F.col(n)) / (F.col(n) - 1)
    return F.when(F.col(n) > 1, F.sqrt(F.greatest(var, F.lit(0.0))))


def city_source(spark: SparkSession, sf_dir: str, partials: DataFrame | None = None) -> DataFrame:
    """(dt, city, country, latitude, longitude) -> mean value and uncertainty."""
    p = partials if partials is not None else monthly_partials(spark, sf_dir)
    loc = supplier_locations(spark, sf_dir)
    return (p.join(loc, p.l_suppkey == loc.suppkey)
            .select("dt", _ratio("sv", "nv").alias("average_temperature"),
                    _ratio("su", "nu").alias("average_temperature_uncertainty"),
                    "city", "country", "latitude", "longitude"))


def major_city_source(spark: SparkSession, sf_dir: str, partials: DataFrame | None = None) -> DataFrame:
    """Major suppliers only, returned items left out; a month with only returns has no row."""
    p = (partials if partials is not None else monthly_partials(spark, sf_dir)).where(F.col("n_k") > 0)
    loc = supplier_locations(spark, sf_dir).where("is_major")
    return (p.join(loc, p.l_suppkey == loc.suppkey)
            .select("dt", _ratio("sv_k", "nv_k").alias("average_temperature"),
                    _ratio("su_k", "nu_k").alias("average_temperature_uncertainty"),
                    "city", "country", "latitude", "longitude"))


def country_source(spark: SparkSession, sf_dir: str, partials: DataFrame | None = None) -> DataFrame:
    p = (partials if partials is not None else monthly_partials(spark, sf_dir)) \
        .where(F.col("dt") < F.lit(COUNTRY_SOURCE_END).cast("date"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation")
    country_text = F.when(F.pmod(F.col("n_nationkey"), F.lit(PADDED_NATION_EVERY)) == 0,
                          F.concat(F.lit("  "), F.col("n_name"), F.lit(" "))).otherwise(F.col("n_name"))
    per_nation = p.join(s, p.l_suppkey == s.s_suppkey).groupBy("s_nationkey", "dt").agg(
        F.sum("sv").alias("sv"), F.sum("nv").alias("nv"), F.sum("su").alias("su"), F.sum("nu").alias("nu"))
    return (per_nation.join(F.broadcast(n), per_nation.s_nationkey == n.n_nationkey)
            .select("dt", _ratio("sv", "nv").alias("average_temperature"),
                    _ratio("su", "nu").alias("average_temperature_uncertainty"), country_text.alias("country")))


def global_source(spark: SparkSession, sf_dir: str, partials: DataFrame | None = None) -> DataFrame:
    p = partials if partials is not None else monthly_partials(spark, sf_dir)
    g = p.groupBy("dt").agg(*[F.sum(c).alias(c) for c in ("sv", "nv", "su", "nu", "suu", "sd", "nd", "sdd",
                                                          "sva", "nva")],
                            F.max("maxv").alias("maxv"), F.min("minv").alias("minv"))
    return g.select(
        "dt",
        _ratio("sv", "nv").alias("land_average_temperature"),
        _ratio("su", "nu").alias("land_average_temperature_uncertainty"),
        F.col("maxv").alias("land_max_temperature"),
        _sample_std("suu", "su", "nu").alias("land_max_temperature_uncertainty"),
        F.col("minv").alias("land_min_temperature"),
        _ratio("sd", "nd").alias("land_min_temperature_uncertainty"),
        _ratio("sva", "nva").alias("land_and_ocean_average_temperature"),
        _sample_std("sdd", "sd", "nd").alias("land_and_ocean_average_temperature_uncertainty"))
