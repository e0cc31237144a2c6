"""Series with gaps (FIXTURES.md series_gap): calendar lags, trailing windows, past-only and
leave-one-out statistics, computed by hand."""

from datetime import date

from pyspark.sql import functions as F

from isotherm.operators import features as fe

LOC = ["city_name", "country_name", "latitude", "longitude"]


def _series(spark):
    rows = []
    # location A: months 1..8 of 2000 with month 5 missing
    for m in [1, 2, 3, 4, 6, 7, 8]:
        rows.append(("A", "X", 10.0, 5.0, date(2000, m, 1), float(m)))
    rows.append(("B", "X", -20.0, 5.0, date(2000, 3, 1), 7.0))  # one-row location, southern
    for y in (2000, 2001):                                       # location C: same month two years
        rows.append(("C", "Y", 30.0, 1.0, date(y, 1, 1), float(y - 1990)))
    return spark.createDataFrame(rows, "city_name string, country_name string, latitude double, longitude double, "
                                       "observation_date date, t double")


def test_calendar_lag_respects_gaps(spark):
    s = fe.with_month_index(_series(spark))
    out = s.select("city_name", "observation_date", fe.calendar_lag("t", 1, LOC).alias("lag1"),
                   fe.calendar_lag("t", 12, LOC).alias("lag12")).collect()
    got = {(r.city_name, r.observation_date.month, r.observation_date.year): (r.lag1, r.lag12) for r in out}
    assert got[("A", 6, 2000)] == (None, None)   # month 5 is missing: no silent row shift
    assert got[("A", 7, 2000)] == (6.0, None)
    assert got[("A", 1, 2000)] == (None, None)
    assert got[("C", 1, 2001)] == (None, 10.0)   # exactly 12 months earlier


def test_trailing_requires_min_observations(spark):
    s = fe.with_month_index(_series(spark))
    m, sd = fe.trailing_stats("t", LOC, months=12, min_obs=3)
    out = {r.observation_date.month: (r.m, r.sd) for r in
           s.where("city_name = 'A'").select("observation_date", m.alias("m"), sd.alias("sd")).collect()}
    assert out[3] == (None, None)             # only 2 earlier months
    assert out[4][0] == 2.0                   # mean of 1, 2, 3
    assert abs(out[8][0] - (1 + 2 + 3 + 4 + 6 + 7) / 6) < 1e-12


def test_past_only_and_leave_one_out(spark):
    s = fe.with_month_index(_series(spark))
    mean, std, n = fe.past_only_stats("t", LOC)
    loo_m, loo_s = fe.leave_one_out("t", LOC)
    out = s.select("city_name", "observation_date", mean.alias("pm"), std.alias("ps"), n.alias("n"),
                   loo_m.alias("lm"), loo_s.alias("ls")).collect()
    a = sorted((r for r in out if r.city_name == "A"), key=lambda r: r.observation_date)
    assert a[0].pm is None and a[0].n == 0            # first past-only value is NULL
    assert a[1].pm == 1.0 and a[1].ps is None         # std needs two past rows
    assert abs(a[2].ps - (0.5 ** 0.5)) < 1e-12
    b = [r for r in out if r.city_name == "B"][0]
    assert b.lm is None and b.ls is None              # leave-one-out undefined for n = 1
    c = sorted((r for r in out if r.city_name == "C"), key=lambda r: r.observation_date)
    assert c[0].lm == 11.0 and c[1].lm == 10.0


def test_climatology_two_regimes_and_fallback(spark):
    s = _series(spark).withColumn("year", F.year("observation_date")).withColumn("month", F.month("observation_date")) \
        .withColumnRenamed("t", "v")
    out = fe.climatology(s, "v", train_end=2000, validation_end=2000).collect()
    c = {(r.city_name, r.observation_date): r for r in out}
    first_a = c[("A", date(2000, 1, 1))]
    assert first_a.loc_month_climatology is None and first_a.loc_climatology_imputed  # nothing earlier anywhere
    a2 = c[("A", date(2000, 2, 1))]
    assert a2.loc_month_climatology == 1.0 and a2.loc_climatology_imputed  # location past mean fallback
    c2001 = c[("C", date(2001, 1, 1))]
    assert c2001.data_split == "test" and c2001.loc_month_climatology == 10.0  # fixed train mean
    assert not c2001.loc_climatology_imputed


def test_cyclic_features_use_climatic_angle(spark):
    s = _series(spark).withColumn("year", F.year("observation_date")).withColumn("month", F.month("observation_date"))
    r = fe.cyclic_features(s).where("city_name = 'B'").first()
    assert r.climatic_month == 9 and r.years_since_start == 0
    assert abs(r.abslat_x_month_sin - 20.0 * r.climatic_month_sin) < 1e-12


def test_climatology_and_location_stats_share_one_shuffle_of_the_rows(spark):
    """Statistics of a location are windows over its rows: the only exchange of whole rows is by location."""
    rows = _series(spark).withColumns({"year": F.year("observation_date"), "month": F.month("observation_date")})
    for out in (fe.climatology(rows, "t", 2000, 2000), fe.location_stats(rows, "t", 2000)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan
        assert sum("city_name" in line for line in plan.splitlines() if "Exchange hashpartitioning" in line) == 1


def test_train_means_of_a_location_with_and_without_train_rows(spark):
    rows = _series(spark).unionByName(spark.createDataFrame(
        [("D", "Y", 30.0, 2.0, date(2001, 1, 1), 50.0), (None, "Y", 30.0, 2.0, date(2000, 1, 1), 8.0),
         (None, "Y", 30.0, 2.0, date(2001, 1, 1), 9.0)], "city_name string, country_name string, latitude double, longitude double, "
        "observation_date date, t double")).withColumns({"year": F.year("observation_date"), "month": F.month("observation_date")})
    later = {r.city_name: r for r in fe.climatology(rows, "t", 2000, 2000).where("data_split = 'test'").collect()}
    assert later["C"].loc_month_climatology == 10.0 and not later["C"].loc_climatology_imputed
    zone = (10.0 + 8.0) / 2                                    # January of 23.5 to 35 degrees: C and the unnamed one
    assert later["D"].loc_month_climatology == zone and later["D"].loc_climatology_imputed
    assert later[None].loc_month_climatology == zone and later[None].loc_climatology_imputed   # a NULL key is no location
    stats = {(r.city_name, r.observation_date.year): r for r in fe.location_stats(rows, "t", 2000).collect()}
    assert stats[("C", 2001)].loc_mean_temperature == 10.0 and stats[("D", 2001)].loc_mean_temperature == zone


def test_selection_takes_moments_and_value_counts_once(spark, monkeypatch):
    """select_features: one frame of moments and one of value counts serve two operators each, with the same results."""
    from isotherm.operators import moments, quality, stats
    from isotherm.plans import q_features, q_io
    feats, y = list(q_io.CATALOG), "city_average_temperature"
    nan, inf = float("nan"), float("inf")
    odd = [None, nan, inf, 0.0, -0.0, 1.5]
    rows = [("train", None if i % 11 == 0 else nan if i % 13 == 0 else float(i % 17),
             *[odd[(i + k) % 6] if k == 3 else float((i * (k + 1)) % (3 if k == 5 else 97)) if (i + k) % 9 else None for k in range(len(feats))])
            for i in range(200)]
    f = spark.createDataFrame(rows, f"data_split string, {y} double, " + ", ".join(f"{c} double" for c in feats))
    calls, whole = [], moments.pair_moments
    for module in (moments, stats):
        monkeypatch.setattr(module, "pair_moments", lambda *a, **k: calls.append(a) or whole(*a, **k))
    monkeypatch.setattr(q_features, "feature_frame", lambda s, sf: f)
    got = {r["feature"]: r for r in q_io._select_features(spark, "unused").collect()}
    assert len(calls) == 1
    distinct = {r["feature"]: r["distinct_values"] for r in quality.feature_problems(f, feats).collect()}
    eta = {r["feature"]: r["eta2"] for r in stats.eta_squared(f, feats, y).collect()}
    r = {x["feature"]: x["r"] for x in stats.corr_with_target(f, feats, y).collect()}
    for c in feats:
        assert got[c]["distinct_values"] == distinct[c]
        for name, want in (("eta2", eta.get(c)), ("r", r[c])):
            assert got[c][name] == want or str(got[c][name]) == str(want) or abs(got[c][name] - want) < 1e-12, (c, name)
    shared = stats.value_sums(f, feats, y)
    assert sorted(map(str, quality.feature_problems(f, feats, shared).collect())) == sorted(map(str, quality.feature_problems(f, feats).collect()))
