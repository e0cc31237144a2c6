"""Rules that the driver's tables do not reach: faults in audits, constant columns, fallbacks, scans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from isotherm import session
from isotherm.operators import features as fe
from isotherm.operators import modeling as ml
from isotherm.operators import quality as dq
from isotherm.operators import sampling as sm
from isotherm.operators import stats as stt


def test_match_audit_counts_injected_faults(spark):
    d = dt.date(2000, 1, 1)
    rows = spark.createDataFrame([(d, "a", True, 1.0), (d, "a", True, None), (d, "a", False, None), (d, "b", False, None),
                                  (d, None, False, None)], "observation_date date, country string, hit boolean, value double")
    source = spark.createDataFrame([(d, "a"), (d, "a"), (d, None)], "dt date, name string")
    marked = dq.mark_known(rows, source, {"observation_date": "dt", "country": "name"}, "known")
    assert marked.count() == 5  # repeated source keys multiply nothing
    facts = spark.createDataFrame([(5,)], "fact_city_rows long")
    r = dq.match_rate_audit(marked, facts, [dq.Enrichment("e", "hit", "known", "value")]).first()
    assert (r.matched_rows, r.unmatched_rows, r.expected_unmatched, r.unexpected_unmatched) == (2, 3, 2, 1)
    assert (r.source_temperature_nulls, r.match_rate_percent, r.status) == (1, 40.0, "FAIL")


def test_match_audit_of_an_empty_table(spark):
    rows = spark.createDataFrame([], "hit boolean, known boolean, value double")
    facts = spark.createDataFrame([(0,)], "fact_city_rows long")
    r = dq.match_rate_audit(rows, facts, [dq.Enrichment("e", "hit", "known", "value")]).first()
    assert (r.source_rows, r.matched_rows, r.match_rate_percent, r.status) == (0, 0, None, "PASS")


def test_failed_checks_stop_the_job_with_every_row(spark):
    report = spark.createDataFrame([(i, "FAIL") for i in range(30)], "id int, status string")
    with pytest.raises(RuntimeError) as e:
        dq.raise_on_fail(report)
    assert str(e.value).count("'status': 'FAIL'") == 30


def test_domain_checks_count_broken_calendar_order_and_flags(spark):
    rows = spark.createDataFrame(
        [(dt.date(2001, 5, 1), 2001, 5, 2, 2000, 1.0, 2.0, 3.0), (dt.date(2001, 5, 1), 2001, 6, 2, 2000, 3.0, 2.0, 4.0),
         (dt.date(2001, 5, 1), 2001, 5, 2, 1990, None, 9.0, 3.0)],
        "observation_date date, year int, month int, quarter int, decade int, lo double, mid double, hi double")
    r = dq.domain_checks(rows, {"mid": (0, 5)}, broken={"calendar": ~dq.calendar_consistency(),
                                                        "order": ~dq.order_consistency("lo", "mid", "hi")}).first()
    assert (r.mid_out_of_range, r.calendar, r.order) == (1, 2, 1)


def test_metrics_match_numpy_and_constant_labels_have_no_r2(spark):
    import numpy as np
    y, p = np.array([1.0, 2.0, 4.0, 8.0]), np.array([1.5, 1.5, 5.0, 7.0])
    df = spark.createDataFrame([("g", float(a), float(b)) for a, b in zip(y, p)] + [("c", 3.0, 2.0), ("c", 3.0, 4.0)],
                               "g string, y double, prediction double")
    out = {r.g: r for r in ml.metrics(df, "y", group=["g"]).collect()}
    assert out["g"].r2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert out["c"].r2 is None and out["c"].rmse == 1.0


def test_constant_columns_fall_into_the_first_bin(spark):
    df = spark.createDataFrame([(5.0, float(i)) for i in range(4)], "x double, y double")
    assert {r["bin"]: r["count"] for r in stt.histogram(df, "x", 20).collect() if r["count"]} == {0: 4}
    assert {r.x_bin for r in stt.density_grid(df, "x", "y").collect()} == {0}


def test_centred_average_over_more_years_than_its_width(spark):
    df = spark.createDataFrame([(1950 + i, float(i * i)) for i in range(15)], "year long, v double")
    out = {r.year: r.moving_average for r in stt.yearly_trend(df, "year", "v").collect()}
    for i in range(15):
        near = [float(k * k) for k in range(max(0, i - 5), min(14, i + 4) + 1)]
        assert out[1950 + i] == pytest.approx(sum(near) / len(near))


def test_location_statistics_fall_back_to_zone_then_all(spark):
    rows = [("a", 10.0, 2000, 1.0), ("a", 10.0, 2000, 3.0), ("b", 12.0, 2001, 9.0), ("c", 60.0, 2001, 9.0)]
    df = spark.createDataFrame([(n, "X", lat, 0.0, dt.date(y, m + 1, 1), y, v) for m, (n, lat, y, v) in enumerate(rows)],
                               "city_name string, country_name string, latitude double, longitude double, "
                               "observation_date date, year int, t double")
    df = df.unionByName(spark.createDataFrame([("d", "X", 40.0, 0.0, dt.date(2000, 7, 1), 2000, 8.0)], df.schema))
    out = {r.city_name: r for r in fe.location_stats(df, "t", 2000).where("year(observation_date) = 2001").collect()}
    assert out["b"].loc_mean_temperature == 2.0 and out["b"].loc_temperature_std == pytest.approx(2 ** 0.5)  # its zone
    assert out["c"].loc_mean_temperature == 4.0  # nothing in its zone: all train rows


def test_range_scan_reaches_the_scan(spark):
    df = sm.range_scan(spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet"), ["l_suppkey"], "l_shipdate",
                       "1995-01-01", "1996-01-01")
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(l_shipdate" in plan and "ReadSchema: struct<l_suppkey:bigint,l_shipdate:" in plan


def test_bernoulli_scan_has_no_row_cap(spark):
    df = spark.range(60000).select(F.when(F.col("id") % 3 == 0, "train").otherwise("test").alias("data_split"))
    got = {r.data_split: r["count"] for r in sm.bernoulli_scan(df, {"train": 0.5, "test": 1.0}).groupBy("data_split").count().collect()}
    assert got["test"] == 40000 and 9500 < got["train"] < 10500


def test_no_served_feature_is_null(spark):
    from isotherm.plans.q_model import CATEGORICAL, NUMERIC, batch_features
    assert len(NUMERIC) == 14
    f = batch_features(spark, "/root/testdata/sf0.001")
    key = ["city_name", "country_name", "latitude", "longitude", "target_date"]
    r = f.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.struct(*key)).alias("k"),
              *[F.count(c).alias(c) for c in NUMERIC + CATEGORICAL]).first()
    assert r.n == r.k > 0
    assert all(r[c] == r.n for c in CATEGORICAL + [c for c in NUMERIC if c != "loc_temperature_std"])


def test_clusters_need_a_shared_checkpoint_folder(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Unset:
        def isDefined(self):
            return False

    class Context:
        master = "spark://host:7077"

        class _jsc:
            @staticmethod
            def sc():
                return type("S", (), {"getCheckpointDir": staticmethod(Unset)})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(type("Spark", (), {"conf": Conf(), "sparkContext": Context()})())
