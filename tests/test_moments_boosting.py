"""Merged moments and shared cross products against numpy; boosting rounds, patience and names."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from isotherm.operators import boosting as bo
from isotherm.operators import modeling as ml
from isotherm.operators import moments as mo
from isotherm.operators import stats as stt


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    n = 600
    a = rng.normal(1e6, 1, n)
    pdf = pd.DataFrame({"a": a, "b": a * 2 + rng.normal(0, 0.1, n), "c": rng.normal(0, 1, n), "d": np.full(n, 0.1),
                        "w": np.arange(n) % 3})
    pdf.loc[::7, "b"] = np.nan
    pdf.loc[::5, "c"] = np.nan
    return pdf, spark.createDataFrame(pdf).select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c != "w" else F.col(c) for c in pdf.columns]).repartition(5)


def test_correlations_equal_pairwise_complete_numpy(table):
    pdf, df = table
    m = mo.pair_moments(df, ["a", "b", "c", "d"], {"all": F.lit(True), "w0": F.col("w") == 0, "none": F.col("w") > 9})
    for window, part in (("all", pdf), ("w0", pdf[pdf.w == 0])):
        for x, y in (("a", "b"), ("a", "c"), ("b", "c"), ("c", "b")):
            both = part[[x, y]].dropna()
            assert m.count(x, y, window) == len(both)
            assert abs(m.correlation(x, y, window) - np.corrcoef(both[x], both[y])[0, 1]) < 1e-9
        assert m.correlation("a", "d", window) is None            # a constant side
    assert m.correlation("a", "b", "none") is None


def test_windows_tell_lasting_redundancy(table):
    _, df = table
    x = df.withColumn("e", F.when(F.col("w") == 0, F.col("c")).otherwise(F.rand(3)))
    got = {(r.feature_a, r.feature_b): r.verdict for r in stt.redundancy_windows(x, ["a", "b", "c", "e"], F.col("w") == 0, F.lit(True)).collect()}
    assert got == {("a", "b"): "lasting", ("c", "e"): "narrow window"}
    assert stt.corr_matrix(df.limit(0), ["a", "b"]).first().r is None


def test_nested_fits_equal_separate_fits(spark, table):
    pdf, df = table
    df = df.withColumn("y", F.col("c") * 2 + F.coalesce(F.col("b"), F.lit(0.0)) * 1e-6 + F.rand(5)).withColumn("g", F.concat(F.lit("g"), "w"))
    df = spark.createDataFrame(df.toPandas()).select(*[F.when(~F.isnan(c), F.col(c)).alias(c) if c in "abcdy" else F.col(c) for c in df.columns])
    train, val = df.where("w < 2"), df.where("w >= 1")
    columns = {**mo.present(["a", "b", "c", "d"], mo.centres(train, ["a", "b", "c", "d"])), **mo.one_hot("g", mo.levels(df, "g"))}
    whole = mo.cross_products(train, columns, F.col("y"))
    parts = mo.cross_products(train.where("w = 0"), columns, F.col("y")) + mo.cross_products(train.where("w = 1"), columns, F.col("y"))
    assert whole.rows == train.where("y is not null").count() and np.allclose(whole.gram, parts.gram)
    products = mo.cross_products(val, columns, F.col("y"))
    for cols, cats in ((["c"], []), (["c", "b"], []), (["a", "b", "c", "d"], ["g"])):
        names = [n for c in cols for n in (c, f"{c}__missing")] + [n for n in columns if cats and n.startswith("g=")]
        fitted = whole.solve(names)
        model = ml.fit(train.where("y is not null"), cols, cats, "y")
        separate = ml.metrics(ml.predict(model, val, cols), "y").first()
        assert abs(products.rmse(fitted) - separate.rmse) < 1e-6
        scored = val.withColumn("prediction", mo.linear_prediction(fitted, columns))
        assert abs(ml.metrics(scored, "y").first().rmse - products.rmse(fitted)) < 1e-6
    with pytest.raises(ValueError, match="more than 2"):
        mo.levels(df, "g", 2)


@pytest.fixture(scope="module")
def steps(spark):
    rng = np.random.default_rng(8)
    n = 900
    x = rng.uniform(-3, 3, (n, 2))
    pdf = pd.DataFrame({"id": np.arange(n), "x": x[:, 0], "z": x[:, 1], "g": rng.choice(["p", "q's"], n)})
    pdf["y"] = np.sin(pdf.x) * 3 + (pdf.g == "p") + rng.normal(0, 0.2, n)
    return spark.createDataFrame(pdf)


def test_boosting_stops_by_patience_and_keeps_the_best_round(spark, steps, tmp_path):
    train, val = steps.where("id < 600"), steps.where("id >= 600")
    prep = ml.fit_preprocessing(train, ["x", "z"], ["g"])
    vec = lambda d: ml.predict(prep, d, ["x", "z"]).select("y", "features")
    b = bo.boost(vec(train), "y", vec(val), rounds=60, patience=3, step=0.3, depth=3, before=prep.stages)
    errors = [v for _, _, v in b.curve]
    assert 1 < b.rounds < 60 and b.rounds == 1 + int(np.argmin(errors))
    assert len(b.curve) == min(60, b.rounds + 3)
    got = ml.metrics(ml.predict(b.model, val, ["x", "z"]), "y").first()
    assert abs(got.rmse - min(errors)) < 1e-9 and got.rmse < 0.5
    names = dict(ml.importances(b.model, ["x", "z"]))
    assert max(names, key=names.get) == "x" and set(names) >= {"x", "z", "x__missing", "g=p", "g=q's"}
    again = ml.save_and_reload(b.model, str(tmp_path / "boosted"))
    assert abs(ml.metrics(ml.predict(again, val, ["x", "z"]), "y").first().rmse - got.rmse) < 1e-12
    fixed = bo.boost(vec(train), "y", rounds=4, step=0.3, depth=3, before=prep.stages)
    assert fixed.rounds == 4 and fixed.curve == []
    # the same seeds grow the same trees: the first rounds' training error is the curve's
    assert abs(ml.metrics(ml.predict(fixed.model, train, ["x", "z"]), "y").first().rmse - b.curve[3][1]) < 1e-9


def test_missing_category_becomes_the_most_frequent(spark, steps):
    train = steps.where("id < 600")
    model = ml.fit(train, ["x", "z"], ["g"], "y")
    top = ml.most_frequent(train, ["g"])["g"]
    row = steps.limit(1)
    lost = ml.predict(model, row.withColumn("g", F.lit(None).cast("string")), ["x", "z"]).first().prediction
    assert lost == ml.predict(model, row.withColumn("g", F.lit(top)), ["x", "z"]).first().prediction
    assert ml.most_frequent(train.limit(0), ["g"]) == {"g": None}
    names = [n for n, _ in ml.coefficients(model, ["x", "z"])]
    assert "g=p" in names and not [n for n in names if n.startswith("category_")]


def test_residuals_are_keyed_and_the_sample_repeats(spark, steps):
    pred = steps.withColumn("prediction", F.when(F.col("id") != 5, F.col("y") - 1))
    res = ml.residuals(pred, ["id"], "y")
    assert res.count() == 899 and abs(res.agg(F.avg("residual")).first()[0] - 1) < 1e-12
    one = {r.id for r in ml.diagnostic_sample(res, ["id"], 0.3).collect()}
    assert one == {r.id for r in ml.diagnostic_sample(res.repartition(7), ["id"], 0.3).collect()} and 200 < len(one) < 340
    imp = ml.exploratory_importance(steps, ["x", "z"], "y", ["id"], max_rows=300, trees=5, depth=4)
    rows = {r.feature: r for r in imp.collect()}
    assert rows["x"].importance > rows["z"].importance and 200 < rows["x"].sampled_rows < 400
