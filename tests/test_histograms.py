"""Trees on binned rows: against an exhaustive search, Spark's own trees and Spark's scores; what rounds leave on disk."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressionModel
from pyspark.sql import functions as F

from isotherm.operators import boosting as bo
from isotherm.operators import histograms as hg
from isotherm.session import checkpoint_dir


def vectors(spark, x, y, parts=5):
    pdf = pd.DataFrame({"x": list(x), "y": y})
    return spark.createDataFrame(pdf).repartition(parts).select(array_to_vector(F.col("x")).alias("features"), F.col("y"))


def blocks_of(spark, rows, base=0.0):
    layout = hg.find_layout(rows, 1)
    rows = rows.select("features", F.col("y").alias("__y"))
    return hg.to_blocks(rows, True, layout, base, 1).localCheckpoint(), layout


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(3)
    n = 3000
    flags = rng.integers(0, 2, (n, 11)).astype(float)
    x = np.column_stack([rng.integers(0, 20, n), rng.integers(-3, 4, n) / 2, np.full(n, 7.0), flags])
    y = np.where(x[:, 0] > 8, 3.0, -1.0) * x[:, 1] + 2 * x[:, 5] - x[:, 13] + rng.normal(0, 0.3, n)
    return x, y


def brute(x, y):
    best = (0.0, None, None)
    for slot in range(x.shape[1]):
        v = np.unique(x[:, slot])
        for cut in (v[:-1] + v[1:]) / 2:
            left = x[:, slot] <= cut
            gain = np.var(y) - left.mean() * np.var(y[left]) - (~left).mean() * np.var(y[~left])
            if gain > best[0] * (1 + 1e-9):
                best = (gain, slot, cut)
    return best


def test_splits_equal_an_exhaustive_search(spark, table):
    x, y = table
    blocks, layout = blocks_of(spark, vectors(spark, x, y))
    assert layout.ranged == (0, 1) and layout.flags == tuple(range(3, 14)) and layout.size == 4  # slot 2 is constant
    tree = hg.grow(blocks, layout, 5, 3, 1.0, 1.0)
    rows = {1: np.arange(len(y))}
    for i in range(1, 8):
        r = rows[i]
        gain, slot, cut = brute(x[r], y[r])
        assert tree.split[i] and (tree.slot[i], tree.threshold[i]) == (slot, cut) and abs(tree.gain[i] - gain) < 1e-9
        assert np.allclose(tree.stats[i], [len(r), y[r].sum(), (y[r] ** 2).sum()])
        left = x[r, slot] <= cut
        rows[2 * i], rows[2 * i + 1] = r[left], r[~left]


def test_tree_scores_as_spark_and_is_as_good_as_spark_s(spark, table):
    x, y = table
    df = vectors(spark, x, y)
    blocks, layout = blocks_of(spark, df)
    tree = hg.grow(blocks, layout, 5, 6, 1.0, 1.0)
    ours = DecisionTreeRegressionModel(tree.model(spark, layout.width)).setFeaturesCol("features").transform(df)
    ours = ours.agg(F.sum((F.col("y") - F.col("prediction")) ** 2)).first()[0]
    scored = hg.add_tree(blocks, layout, tree, 1.0).agg(F.sum("error")).first()[0]
    assert abs(ours - scored) < 1e-6
    spark_s = DecisionTreeRegressor(labelCol="y", maxDepth=6, maxBins=32).fit(df).transform(df)
    assert abs(ours - spark_s.agg(F.sum((F.col("y") - F.col("prediction")) ** 2)).first()[0]) < 1e-6


def test_a_level_in_several_passes_grows_the_same_tree(spark, table, monkeypatch):
    x, y = table
    blocks, layout = blocks_of(spark, vectors(spark, x, y))
    whole = hg.grow(blocks, layout, 9, 5, 0.7, 0.6)
    monkeypatch.setattr(hg, "NODES", 4)
    parts = hg.grow(blocks, layout, 9, 5, 0.7, 0.6)
    assert (whole.slot == parts.slot).all() and np.allclose(whole.stats, parts.stats)
    assert 0.65 * len(y) < whole.stats[1, 0] < 0.75 * len(y)


def test_cut_points_keep_rare_values_and_many_values():
    assert hg.cut_points(np.zeros(50), 0.0, 1.0).tolist() == [0.5]                # a value the sample missed
    assert hg.cut_points(np.array([1.0, np.nan, 2.0]), 1.0, 2.0).tolist() == [1.5]
    v = np.random.default_rng(1).exponential(size=20_000)
    cuts = hg.cut_points(v, v.min(), v.max())
    share = np.diff(np.searchsorted(np.sort(v), cuts)) / len(v)
    assert len(cuts) == hg.FINE - 1 and share.max() < 2 / hg.FINE
    layout = hg.Layout(len(v), 1, (0,), (cuts,), (), np.array([]))
    assert (layout.encode(cuts[:, None])[:, 0] == np.arange(len(cuts))).all()     # a value on a cut is left of it
    assert layout.encode(np.array([[np.nan]]))[0, 0] == hg.FINE - 1               # and no value right of all, as in Spark
    for seed in range(5):
        groups = layout.groups(np.random.default_rng(seed))[0]
        assert (np.diff(groups) >= 0).all() and groups.max() <= hg.COARSE and len(np.unique(groups)) >= hg.COARSE


def test_cuts_are_placed_slot_by_slot(spark, table):
    x, y = table
    x = np.column_stack([x, np.arange(len(y)) ** 1.5])
    layout = hg.find_layout(vectors(spark, x, y), 1)
    assert layout.rows == len(y) and layout.ranged == (0, 1, 14) and layout.flags == tuple(range(3, 14))
    for slot, cuts in zip(layout.ranged, layout.cuts, strict=True):
        assert cuts.tolist() == hg.cut_points(x[:, slot], x[:, slot].min(), x[:, slot].max()).tolist()


def test_rounds_leave_no_rows_behind(spark, table):
    """Every fifth round's scores used to stay in the checkpoint folder with the vectors."""
    x, y = table
    def size():
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(checkpoint_dir(spark)) for f in files)
    df, before = vectors(spark, x, y), size()
    b = bo.boost(df, "y", df, rounds=11, patience=11, step=0.3, depth=3)
    assert b.rounds == 11 and [t for _, t, _ in b.curve] == pytest.approx([v for _, _, v in b.curve])
    assert size() - before < 20_000
    again = bo.boost(df, "y", df, rounds=11, patience=11, step=0.3, depth=3)
    assert [v for _, _, v in again.curve] == pytest.approx([v for _, _, v in b.curve])
    assert isinstance(b.model.stages[0], GBTRegressionModel) and b.model.stages[0].getNumTrees == 11


def test_constant_features_and_missing_labels(spark):
    df = vectors(spark, np.ones((40, 2)), np.arange(40.0), 2)
    b = bo.boost(df, "y", rounds=2, depth=2)
    assert b.model.stages[0].totalNumNodes == 2
    # each tree takes its share of the rows, so its only leaf is their mean, not 0
    assert abs(b.model.transform(df).agg(F.avg("prediction")).first()[0] - 19.5) < 2
    with pytest.raises(ValueError, match="no validation row"):
        bo.boost(df, "y", df.withColumn("y", F.lit(None).cast("double")), rounds=2, depth=2)
