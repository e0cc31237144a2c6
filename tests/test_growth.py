"""A forest's trees grown inside tasks: against an exhaustive search; draws, bounds and the number of jobs."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import functions as F

from isotherm.operators import forest as fo
from isotherm.operators import growth as gr
from isotherm.operators import histograms as hg
from isotherm.operators import modeling as ml


def rows_of(layout, x, y, draw):
    return gr.rows_of(layout, lambda: ((layout.encode(x[i:i + 700]), y[i:i + 700], draw[i:i + 700]) for i in range(0, len(y), 700)))


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(3)
    n = 2000
    x = np.column_stack([rng.integers(0, 20, n), rng.integers(-3, 4, n) / 2, np.full(n, 7.0), rng.integers(0, 2, (n, 11))]).astype(float)
    y = np.where(x[:, 0] > 8, 3.0, -1.0) * x[:, 1] + 2 * x[:, 5] - x[:, 13] + rng.normal(0, 0.3, n)
    cuts = tuple(hg.cut_points(x[:, i], x[:, i].min(), x[:, i].max()) for i in (0, 1))
    layout = hg.Layout(n, 14, (0, 1), cuts, tuple(range(3, 14)), np.full(11, 0.5))
    return x, y, layout, rows_of(layout, x, y, rng.integers(0, 2 ** 32, n, dtype=np.uint32))


def test_splits_equal_an_exhaustive_search(table):
    x, y, layout, rows = table
    times = gr.weights(rows.draw, 1.0, 77)
    tree = gr.grow(rows, times, layout, np.random.default_rng(1), 5, 40, 14, 1 << 16)
    at, seen = {0: np.repeat(np.arange(len(y)), times.astype(int))}, 0
    for i in range(len(tree.left)):
        r = at[i]
        assert len(r) == tree.n[i] >= 40
        assert np.allclose([tree.s[i], tree.q[i]], [y[r].sum(), (y[r] ** 2).sum()])
        gains = [np.var(y[r]) - left.mean() * np.var(y[r][left]) - (~left).mean() * np.var(y[r][~left])
                 for slot in range(14) for cut in (np.unique(x[:, slot])[:-1] + np.unique(x[:, slot])[1:]) / 2
                 for left in [x[r, slot] <= cut] if min(left.sum(), (~left).sum()) >= 40]
        if tree.left[i] < 0:
            assert i >= 31 or not gains or max(gains) < 1e-9
            continue
        assert abs(tree.gain[i] - max(gains)) < 1e-9
        low = x[r, tree.slot[i]] <= tree.threshold[i]
        at[tree.left[i]], at[tree.left[i] + 1] = r[low], r[~low]
        seen += 1
    assert seen > 20


def test_nodes_are_the_same_however_many_are_handled_at_once(table):
    _, _, layout, rows = table
    w = gr.weights(rows.draw, 1.0, 77)
    one, many = (gr.grow(rows, w, layout, np.random.default_rng(2), 9, 3, 8, cells) for cells in (1, 1 << 16))
    assert len(one.left) > 200
    for a, b in zip(vars(one).values(), vars(many).values(), strict=True):
        assert np.array_equal(a, b)


def test_rows_are_drawn_with_replacement_and_features_for_every_node():
    draw = np.random.default_rng(5).integers(0, 2 ** 32, 200_000, dtype=np.uint32)
    for share in (1.0, 0.5, 3.0):
        w = gr.weights(draw, share, 77)
        assert abs(w.mean() - share) < 0.02 and abs(w.var() - share) < 0.05
    drawn = gr.draw_features(np.random.default_rng(6), 3000, 10, 6)
    assert (drawn.sum(axis=1) == 6).all() and abs(drawn.mean(axis=0) - 0.6).max() < 0.05
    assert [fo.features_of_a_node(s, 29, 100) for s in ("auto", "all", "onethird", "sqrt", "log2", "0.6", "1.0", "7", "90")] == [10, 29, 10, 6, 5, 18, 29, 7, 29]


def test_a_forest_takes_a_few_jobs_whatever_its_depth(spark):
    """Spark's estimator runs a job for every level and every 128 MB of histograms of every part: these 10 trees took 109."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, 3))
    df = spark.createDataFrame(pd.DataFrame({"x": list(x), "y": x[:, 0] + rng.normal(0, 1, 3000)}))
    df = df.select(array_to_vector(F.col("x")).alias("features"), "y").repartition(4)
    spark.sparkContext.setJobGroup("forest", "forest")
    try:
        model = fo.fit_forest(df, "y", ml.PipelineModel([]), trees=10, depth=12, min_leaf=5, nodes=2500)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("forest")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(model.parts) == 5 and sum(p.nodes for p in model.parts) > 2000
    assert len(jobs) < 30
    got = ml.metrics(model.transform(df), "y").first()
    assert got.n == 3000 and got.r2 > 0.6


def test_trees_of_more_rows_than_a_task_holds_are_the_same_trees(spark, table, monkeypatch):
    x, y, _, _ = table
    df = spark.createDataFrame(pd.DataFrame({"k": np.arange(len(y)), "x": list(x), "y": y}))
    df = df.select("k", array_to_vector(F.col("x")).alias("features"), "y").repartition(4).localCheckpoint()

    def fitted():
        model = fo.fit_forest(df, "y", ml.PipelineModel([]), trees=3, depth=7, min_leaf=4, feature_share="all", nodes=300)
        scores = {r.k: r.prediction for r in model.transform(df).select("k", "prediction").collect()}
        return model, scores

    whole, scores = fitted()
    monkeypatch.setattr(fo, "LOCAL_ROWS", 400)
    monkeypatch.setattr(fo, "HISTOGRAM_MB", 0)  # a node at a time
    split, same = fitted()
    assert [p.nodes for p in split.parts] == [p.nodes for p in whole.parts] and sum(p.nodes for p in whole.parts) > 100
    assert max(abs(same[k] - v) for k, v in scores.items()) < 1e-9
    assert np.allclose(whole.featureImportances.toArray(), split.featureImportances.toArray())
    trees = [t for p in split.parts for t in RandomForestRegressionModel.load(p.path).trees]
    for r in df.where("k < 20").collect():
        assert abs(same[r.k] - np.mean([t.predict(r.features) for t in trees])) < 1e-9
