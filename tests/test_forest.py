"""The forest in parts: memory bounds, scores and importances over all trees."""

import numpy as np
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import functions as F

from isotherm.operators import forest as fo
from isotherm.operators import modeling as ml


def _rows(spark, n=600):
    i = F.col("id")
    return spark.range(n).select(i.alias("k"), (i % 37).cast("double").alias("x"), (i % 11).cast("double").alias("z"),
                                 F.when(i % 2 == 0, "a").otherwise("b").alias("g"),
                                 ((i % 37) * 2.0 + F.when(i % 2 == 0, 5.0).otherwise(0.0)).alias("y"))


def test_fit_bounds_the_histograms_of_a_task(spark, monkeypatch):
    """An executor of 10 GB with four tasks has 6 GB of heap: 2 GB of histograms a task do not fit."""
    seen = []
    init = RandomForestRegressor.__init__
    monkeypatch.setattr(RandomForestRegressor, "__init__", lambda self, **kw: (seen.append(kw), init(self, **kw))[1])
    ml.fit(_rows(spark), ["x", "z"], ["g"], "y", "forest", numTrees=3, maxDepth=4)
    assert seen and all(kw["maxMemoryInMB"] <= 256 for kw in seen)


def test_parts_hold_all_trees_and_average_over_them(spark):
    df = _rows(spark)
    prep = ml.fit_preprocessing(df, ["x", "z"], ["g"])
    vectors = ml.predict(prep, df, ["x", "z"]).select("features", "y")
    model = fo.fit_forest(vectors, "y", prep, trees=7, depth=4, min_leaf=5, nodes=2 * 2 ** 4 * 3)
    assert [p.trees for p in model.parts] == [2, 2, 3]                    # at most three trees of at most 32 nodes
    assert all(p.nodes <= 2 * 2 ** 4 * 3 for p in model.parts)
    got = {r.k: r.prediction for r in ml.predict(model, df, ["x", "z"]).select("k", "prediction").collect()}
    trees = [t for p in model.parts for t in RandomForestRegressionModel.load(p.path).trees]
    assert len(trees) == 7
    for r in ml.predict(prep, df, ["x", "z"]).where("k < 40").collect():
        assert abs(got[r.k] - np.mean([t.predict(r.features) for t in trees])) < 1e-9
    assert abs(sum(model.featureImportances) - 1) < 1e-9
    assert [n for n, _ in ml.importances(model, ["x", "z"])][0] == "x"


def test_scores_do_not_depend_on_the_passes(spark, monkeypatch):
    df = _rows(spark)
    model = ml.fit(df, ["x", "z"], ["g"], "y", "forest", numTrees=4, maxDepth=3)
    model.parts = [fo.Part(p.path, p.trees, p.nodes) for p in model.parts * 3]
    one = {r.k: r.prediction for r in ml.predict(model, df, ["x", "z"]).collect()}
    assert len(model.passes()) == 1 and len(model.passes(nodes=1)) == len(model.parts)
    whole = model.passes
    monkeypatch.setattr(model, "passes", lambda: whole(1))
    several = {r.k: r.prediction for r in ml.predict(model, df, ["x", "z"]).collect()}
    assert len(one) == 600 and all(abs(several[k] - v) < 1e-9 for k, v in one.items())
