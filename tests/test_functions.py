"""Column functions on the small fixtures of FIXTURES.md (hand-computed expectations)."""

from datetime import date

from pyspark.sql import functions as F

from isotherm.functions.calendar import calendar_parts, index_to_date, month_index
from isotherm.functions.coords import parse_coordinate, signed_coordinate
from isotherm.functions.labels import (climatic_month, climatic_season, latitude_zone, meteorological_season,
                                       temperature_class)
from isotherm.functions.safe import inf_to_null, safe_divide, try_date, try_double
from isotherm.functions.text import blank_to_null, compose_label, split_label, squeeze_text


def test_coordinates_strict_and_lenient(spark):
    rows = [("57.05N",), ("3.23S",), ("57.05n",), ("abc",), ("10.0X",), (" 12.5N ",), ("\t12.5N",), ("",), (None,),
            ("10E",)]
    df = spark.createDataFrame(rows, "t string")
    v, inv = parse_coordinate("t", "NS", "S")
    out = df.select("t", signed_coordinate("t", "N", "S").alias("strict"), v.alias("len"), inv.alias("inv")).collect()
    got = {r.t: (r.strict, r.len, r.inv) for r in out}
    assert got["57.05N"] == (57.05, 57.05, False)
    assert got["3.23S"] == (-3.23, -3.23, False)
    assert got["57.05n"] == (None, 57.05, False)          # strict is case sensitive
    assert got["abc"] == (None, None, True)
    assert got["10.0X"] == (None, None, True)
    assert got[" 12.5N "] == (12.5, 12.5, False)          # BTRIM strips spaces
    assert got["\t12.5N"] == (None, 12.5, False)          # ... but not tabs; the lenient parser does
    assert got[""] == (None, None, True)
    assert got[None] == (None, None, False)
    assert got["10E"] == (None, None, True)               # a longitude letter on a latitude


def test_text_normalisation(spark):
    df = spark.createDataFrame([("  Ha  Noi\t",), ("   ",), ("\tX",), (None,)], "t string")
    out = df.select(blank_to_null("t").alias("b"), squeeze_text("t").alias("s")).collect()
    assert [r.b for r in out] == ["Ha  Noi\t", None, "\tX", None]
    assert [r.s for r in out] == ["Ha Noi", None, "X", None]
    lab = spark.createDataFrame([("Paris", "France (Metropolitan)")], "c string, k string") \
        .select(compose_label("c", "k").alias("l"))
    name, group = split_label("l")
    r = lab.select(name.alias("n"), group.alias("g")).first()
    # split at the LAST " (": a nested parenthesis stays in the name part
    assert (r.n, r.g) == ("Paris (France", "Metropolitan)")
    r2 = spark.createDataFrame([("Ho Chi Minh City", "Vietnam")], "c string, k string") \
        .select(compose_label("c", "k").alias("l")).select(*[x.alias(a) for x, a in zip(split_label("l"), "ng")]).first()
    assert (r2.n, r2.g) == ("Ho Chi Minh City", "Vietnam")


def test_latitude_zones_right_closed(spark):
    lats = [-90.0, -23.5, 0.0, 23.5, 23.6, 35.0, 55.0, 90.0, 90.1]
    df = spark.createDataFrame([(x,) for x in lats], "lat double")
    got = [r.z for r in df.select(latitude_zone(F.abs("lat")).alias("z")).collect()]
    assert got == ["Polar", "Tropical", "Tropical", "Tropical", "Subtropical", "Subtropical", "Temperate", "Polar",
                   None]


def test_seasons_and_climatic_month(spark):
    df = spark.createDataFrame([(1, 10.0), (7, 10.0), (1, -10.0), (7, -10.0), (12, 0.0)], "m int, lat double")
    out = df.select(meteorological_season("m", "lat").alias("s"), climatic_month("m", "lat").alias("cm")).collect()
    assert [r.s for r in out] == ["Winter", "Summer", "Summer", "Winter", "Winter"]
    assert [r.cm for r in out] == [1, 7, 7, 1, 12]
    cs = spark.createDataFrame([(m,) for m in range(1, 13)], "m int").select(climatic_season("m").alias("s"))
    assert [r.s for r in cs.collect()] == ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Autumn"] * 3 + ["Winter"]


def test_temperature_class_and_safe_math(spark):
    df = spark.createDataFrame([(-1.0, 2.0), (0.0, 0.0), (12.0, None), (29.9, 4.0), (30.0, 1.0), (float("inf"), 1.0)],
                               "v double, d double")
    out = df.select(temperature_class("v").alias("c"), safe_divide("v", "d").alias("q"),
                    inf_to_null("v").alias("i")).collect()
    assert [r.c for r in out] == ["Very cold", "Cool", "Mild", "Warm", "Hot", "Hot"]
    assert [r.q for r in out][:4] == [-0.5, None, None, 29.9 / 4.0]
    assert out[5].i is None


def test_calendar_and_coercion(spark):
    df = spark.createDataFrame([(date(1999, 12, 1), "1.5", "2001-02-30")], "d date, n string, s string")
    parts = calendar_parts("d")
    r = df.select(*[v.alias(k) for k, v in parts.items()], month_index("d").alias("mi"),
                  index_to_date(month_index("d") + 1).alias("next"), try_double("n").alias("x"),
                  try_date("s").alias("bad")).first()
    assert (r.year, r.month, r.quarter, r.decade) == (1999, 12, 4, 1990)
    assert r.mi == 1999 * 12 + 12 and r.next == date(2000, 1, 1)
    assert r.x == 1.5 and r.bad is None
