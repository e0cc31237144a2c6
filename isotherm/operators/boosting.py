"""Gradient boosting round by round, with a validation curve and patience (ML-05, ML-12).

Spark's own boosting either runs a fixed number of rounds or stops at the first
round that gains too little, and gives its first tree full weight.  Here every
round fits one tree to the residuals of the training rows, shrinks it, and scores
both windows in one aggregate; after ``patience`` rounds without a better
validation error the search ends and the trees up to the best round are kept.
The rows are binned once (see ``histograms``); the blocks with their residuals are
written every round, the round's errors are taken while they are written and the blocks
of the round before are removed, so a round reads one small table whatever the
number of rounds.  The result is an ordinary pipeline model around Spark's
boosted-tree model: it scores, saves, loads and reports importances like any other.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from isotherm.operators import histograms as hg
from isotherm.session import scratch_path
from isotherm.sources import commits

#: Bytes of a row group of the block table; tasks read whole ones.
ROW_GROUP = 16 * 1024 * 1024


@dataclass
class Boosted:
    """A fitted ensemble: ``rounds`` trees, and per round the errors of both windows."""
    model: PipelineModel
    rounds: int
    curve: list[tuple[int, float, float | None]]


class _Blocks:
    """The block table of the current round."""

    def __init__(self, spark):
        self.spark, self.path, self.home = spark, None, scratch_path(spark, f"boosting-{uuid.uuid4().hex}")

    def write(self, blocks: DataFrame, k: int) -> tuple[DataFrame, float | None, float | None]:
        """Write the blocks after round ``k``, remove those before, return them and the windows' errors (None: no row)."""
        path, seen = f"{self.home}/round-{k:05d}", Observation()
        of = {"t": F.col("fit"), "v": ~F.col("fit")}
        sums = [m for name, w in of.items() for m in (F.sum(F.when(w, F.col("error"))).alias(f"{name}_error"),
                                                     F.sum(F.when(w, F.col("rows").cast("long"))).alias(f"{name}_rows"))]
        blocks.observe(seen, *sums).write.option("parquet.block.size", ROW_GROUP).parquet(path)
        errors = seen.get
        self.remove()
        self.path = path
        return (self.spark.read.schema(hg.BLOCK_SCHEMA).parquet(path),
                *(math.sqrt(errors[f"{n}_error"] / errors[f"{n}_rows"]) if errors[f"{n}_rows"] else None for n in of))

    def remove(self) -> None:
        if self.path:
            commits.remove(self.spark, self.path)


def boost(train: DataFrame, target: str, validation: DataFrame | None = None, rounds: int = 500, patience: int = 20,
          step: float = 0.08, depth: int = 8, row_share: float = 0.8, feature_share: float = 0.8,
          seed: int = 42, before: Sequence = ()) -> Boosted:
    """Boost on squared error.  ``train`` and ``validation`` hold ``features`` and the target.

    With ``validation`` the ensemble ends at its best round; without it all ``rounds`` are kept (a
    refit).  ``before``: fitted transformers put in front of the returned pipeline."""
    spark = train.sparkSession
    y = F.col(target).cast("double").alias("__y")
    base = train.agg(F.avg(target)).first()[0]
    if base is None:
        raise ValueError("no training row has a label")
    windows = [(w.where(F.col(target).isNotNull()).select("features", y), fit)
               for w, fit in ((train, True), (validation, False)) if w is not None]
    layout = hg.find_layout(windows[0][0], seed)
    blocks = reduce(DataFrame.unionByName, [hg.to_blocks(rows, fit, layout, float(base), seed) for rows, fit in windows])
    table = _Blocks(spark)
    blocks, _, start = table.write(blocks.repartition(hg.parts(spark, layout)), 0)
    if validation is not None and start is None:
        raise ValueError("no validation row has a label")
    trees, curve, best, best_error = [], [], 0, float("inf")
    for k in range(1, rounds + 1):
        trees.append(hg.grow(blocks, layout, seed + k, depth, row_share, feature_share))
        blocks, fit_error, error = table.write(hg.add_tree(blocks, layout, trees[-1], step), k)
        if validation is None:
            continue
        curve.append((k, fit_error, error))
        if error < best_error:
            best, best_error = k, error
        elif k - best >= patience:
            break
    table.remove()
    kept = trees[:best] if validation is not None else trees
    model = GBTRegressionModel(hg.ensemble(spark, kept, step, layout.width)).setFeaturesCol("features").setPredictionCol("__boosted")
    shift = SQLTransformer(statement=f"SELECT *, __boosted + {float(base)!r}D AS prediction FROM __THIS__")
    return Boosted(PipelineModel([*before, model, shift]), len(kept), curve)
