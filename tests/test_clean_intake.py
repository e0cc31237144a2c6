"""Cleaning, outlier fences, intake rules and the last-wins upsert (batch and streaming)."""

import os
import tempfile
from datetime import date

from pyspark.sql import functions as F

from isotherm.operators.clean import keep_first
from isotherm.streaming import intake as ik


def test_keep_first_partial_aggregate(spark):
    df = spark.createDataFrame([("k", 1, "b"), ("k", 1, "a"), ("k", 1, "a"), ("j", 2, "z")], "k string, n int, p string")
    out = sorted(tuple(r) for r in keep_first(df, ["k"]).collect())
    assert out == [("j", 2, "z"), ("k", 1, "a")]


def _incoming(spark):
    schema = ("observation_date date, city_name string, country_name string, latitude double, longitude double, "
              "city_average_temperature double, city_average_temperature_uncertainty double, data_source string")
    rows = [
        (date(2013, 10, 1), "Hanoi", "Vietnam", 21.03, 105.85, 24.8, 0.25, None),     # valid
        (date(2013, 11, 1), "Hanoi", "Vietnam", 21.03, 105.85, 21.7, 0.22, "upload"),  # valid
        (None, "A", "B", 0.0, 0.0, 1.0, None, None),                                    # bad date
        (date(2013, 11, 15), "A", "B", 0.0, 0.0, 1.0, None, None),                      # not first of month
        (date(2013, 9, 1), "A", "B", 0.0, 0.0, 1.0, None, None),                        # before gap start
        (date(2030, 1, 1), "A", "B", 0.0, 0.0, 1.0, None, None),                        # future
        (date(2013, 12, 1), "", "B", 0.0, 0.0, 1.0, None, None),                        # blank city
        (date(2013, 12, 1), "C", None, 0.0, 0.0, 1.0, None, None),                      # blank country
        (date(2013, 12, 1), "D", "B", 91.0, 0.0, 1.0, None, None),                      # latitude
        (date(2013, 12, 1), "E", "B", 0.0, 181.0, 1.0, None, None),                     # longitude
        (date(2013, 12, 1), "F", "B", 0.0, 0.0, 61.0, None, None),                      # temperature
        (date(2013, 12, 1), "G", "B", 0.0, 0.0, 1.0, -0.1, None),                       # uncertainty
        (date(2014, 1, 1), "H", "B", 0.0, 0.0, 1.0, None, None),                        # duplicate key x2
        (date(2014, 1, 1), "H", "B", 0.0, 0.0, 2.0, None, None),
        (date(2013, 12, 15), "", "B", 95.0, 0.0, 1.0, None, None),                      # three rules at once
    ]
    return spark.createDataFrame(rows, schema)


def test_validation_rules_in_order(spark):
    v = ik.validate(_incoming(spark), "2013-10-01", "2020-01-01").collect()
    errs = [r.validation_error for r in v]
    assert errs.count("") == 2
    for msg in ik.MESSAGES:
        assert any(e == msg for e in errs), msg
    assert ("date must be the first day of a month; missing city name; latitude must be in [-90, 90]") in errs
    acc = ik.accepted(ik.validate(_incoming(spark), "2013-10-01", "2020-01-01")).collect()
    assert sorted(r.data_source for r in acc) == ["upload", "user_observation"]


def test_missing_columns_stop_before_any_job(spark):
    df = spark.createDataFrame([(1,)], "city_name int")
    assert "observation_date" in ik.missing_columns(df)


def test_gap_report(spark):
    acc = ik.accepted(ik.validate(_incoming(spark), "2013-10-01", "2020-01-01"))
    g = ik.gap_report(acc.union(acc.limit(0)), "2013-08-01").first()
    assert (g.months_expected, g.months_supplied, g.months_missing) == (4, 2, 2)
    assert g.first_missing_months == "2013-08, 2013-09" and g.completeness_percent == 50.0


def test_upsert_last_wins(spark):
    cols = "observation_date date, city_name string, country_name string, latitude double, longitude double, " \
           "v double, ingested_batch long, source_row long"
    old = spark.createDataFrame([(date(2014, 1, 1), "A", "B", 0.0, 0.0, 1.0, 1, 2),
                                 (date(2014, 2, 1), "A", "B", 0.0, 0.0, 5.0, 1, 3)], cols)
    new = spark.createDataFrame([(date(2014, 1, 1), "A", "B", 0.0, 0.0, 9.0, 2, 2),
                                 (date(2014, 3, 1), "A", "B", 0.0, 0.0, 7.0, 2, 3)], cols)
    merged = ik.upsert_last(old, new)
    got = {r.observation_date.month: r.v for r in merged.collect()}
    assert got == {1: 9.0, 2: 5.0, 3: 7.0}
    c = ik.upsert_counts(old, new, merged).first()
    assert (c.inserted, c.replaced, c.total) == (1, 1, 3)


def test_stream_intake_available_now(spark):
    base = tempfile.mkdtemp(prefix="isotherm-stream-")
    src = os.path.join(base, "in")
    _incoming(spark).write.parquet(os.path.join(src, "batch1"))
    schema = spark.read.parquet(os.path.join(src, "batch1")).schema
    q = ik.run_stream(spark, os.path.join(src, "*"), schema, os.path.join(base, "pending"),
                      os.path.join(base, "ckpt"), "2013-10-01", "2020-01-01")
    q.awaitTermination(120)
    pending = spark.read.parquet(os.path.join(base, "pending"))
    latest = pending.agg(F.max("version")).first()[0]
    assert pending.where(F.col("version") == latest).count() == 2
