"""Distributed exact quantiles and dense ids against numpy / pandas, including a hot group."""

import numpy as np
import pandas as pd

from isotherm.functions.ids import dense_index
from isotherm.operators.quantiles import exact_quantiles, iqr_fences


def test_exact_quantiles_match_numpy_with_hot_group(spark):
    rng = np.random.default_rng(7)
    n = 4000
    groups = np.where(rng.random(n) < 0.7, "hot", rng.choice(["a", "b", "c"], n))  # one group holds ~70 %
    values = np.round(rng.normal(10, 5, n), 1)  # many ties
    values[::97] = np.nan
    pdf = pd.DataFrame({"g": groups, "v": values})
    df = spark.createDataFrame(pdf).repartition(7)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {r.g: r for r in exact_quantiles(df, "v", probs, ["g"]).collect()}
    for g, part in pdf.dropna().groupby("g"):
        expect = np.quantile(part.v.to_numpy(), probs)
        for p, e in zip(probs, expect):
            assert abs(got[g][f"q{int(round(p * 100))}"] - e) < 1e-9


def test_global_quantiles_and_fences(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0] + [None]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    f = iqr_fences(df, "v").first()
    assert (f.q1, f.q3) == (2.0, 4.0)
    assert f.lower_fence == -1.0 and f.upper_fence == 7.0


def test_dense_index_is_rank_in_key_order(spark):
    keys = [(f"k{i:04d}", i % 3) for i in range(500)]
    df = spark.createDataFrame(keys, "name string, grp int").repartition(5)
    out = dense_index(df, ["grp", "name"], "id", num_partitions=4).toPandas()
    expect = sorted(keys, key=lambda t: (t[1], t[0]))
    got = out.sort_values("id")[["name", "grp"]].itertuples(index=False, name=None)
    assert list(got) == expect
    assert out.id.tolist() and sorted(out.id.tolist()) == list(range(1, 501))


def test_dense_index_with_payload_at_size(spark):
    """Counts and rows must see the same range boundaries, also when only the rows carry a payload."""
    from pyspark.sql import functions as F

    from isotherm.functions.ids import dense_index
    n = 500_000
    keys = spark.range(n).select(F.hash("id").cast("long").alias("h"), "id", F.repeat(F.lit("x"), 20).alias("payload"))
    out = dense_index(keys, ["h", "id"], "n", num_partitions=16)
    r = out.agg(F.count("n").alias("rows"), F.countDistinct("n").alias("ids"), F.min("n").alias("lo"), F.max("n").alias("hi")).first()
    assert (r.rows, r.ids, r.lo, r.hi) == (n, n, 1, n)


def test_quantiles_on_value_counts_without_exchange_reuse(spark):
    """A value that fills a third of the rows, many distinct values, and exchanges that are not shared."""
    from pyspark.sql import functions as F

    from isotherm.operators.quantiles import average_ranks
    n = 300_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0.5)).otherwise(F.rand(7)).alias("v"),
                               F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.lit("g")).alias("g"))
    spark.createDataFrame([], "x int")
    pdf = df.toPandas()
    df = spark.createDataFrame(pdf)
    old = {k: spark.conf.get(k) for k in ("spark.sql.exchange.reuse", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.exchange.reuse", "false")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        got = exact_quantiles(df, "v", [0.25, 0.5, 0.9]).first()
        assert np.allclose([got.q25, got.q50, got.q90], np.quantile(pdf.v, [0.25, 0.5, 0.9]), atol=1e-12)
        by = {r.g: r for r in exact_quantiles(df, "v", [0.25, 0.5], ["g"]).collect()}
        for g, part in pdf.groupby("g", dropna=False):
            key = None if g != g or g is None else g
            assert np.allclose([by[key].q25, by[key].q50], np.quantile(part.v, [0.25, 0.5]), atol=1e-12)
        ranks = {r.v: r.r for r in average_ranks(df, [], "v", "r").where("v between 0.49 and 0.51").collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want = pdf.v.rank()
    for i in pdf.index[(pdf.v >= 0.49) & (pdf.v <= 0.51)][:200]:
        assert ranks[pdf.v[i]] == want[i]
