"""Spark ML re-expression of the model jobs (ML-01..14, SNK-07, DQ-29).

Scikit-learn / XGBoost are single-machine; here every fit is a Spark ML
estimator on DataFrames.  Coefficients and scores will not equal the
reference's bit by bit; metrics are plain aggregates (checkable in SQL).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (Imputer, OneHotEncoder, OneHotEncoderModel, SQLTransformer, StandardScaler,
                                StringIndexer, StringIndexerModel, VectorAssembler)
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.operators.forest import HISTOGRAM_MB, Forest, fit_forest
from isotherm.operators.sampling import hash_bucket
from isotherm.session import cut_lineage


def prepare(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """Booleans -> double, ±inf -> NULL (PRJ-10) so that the imputer sees them as missing."""
    out = df
    for c in numeric:
        v = F.col(c).cast("double")
        out = out.withColumn(c, F.when(v.isin(float("inf"), float("-inf")), F.lit(None).cast("double")).otherwise(v))
    return out


def preprocessing(numeric: Sequence[str], categorical: Sequence[str], missing_indicators: bool = True,
                  frequent: dict[str, str | None] | None = None) -> list:
    """Median impute (+ missing indicators), standard scale, most-frequent impute, index and one-hot the
    categories with unknown kept (ML-01).  ``frequent``: the training rows' most frequent value of
    each category.  Spark's Imputer median is approximate (relative error 0.001)."""
    imp_out = [f"{c}__imp" for c in numeric]
    stages = [Imputer(inputCols=list(numeric), outputCols=imp_out, strategy="median")]
    num_vec = VectorAssembler(inputCols=imp_out + ([f"{c}__miss" for c in numeric] if missing_indicators else []),
                              outputCol="__num", handleInvalid="keep")
    stages += [num_vec, StandardScaler(inputCol="__num", outputCol="__num_scaled", withMean=True, withStd=True)]
    cat_cols = []
    for c in categorical:
        value = (frequent or {}).get(c)
        quoted = "NULL" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
        stages.append(SQLTransformer(statement=f"SELECT *, coalesce(`{c}`, {quoted}) AS `{c}__filled` FROM __THIS__"))
        stages.append(StringIndexer(inputCol=f"{c}__filled", outputCol=f"{c}__idx", handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCol=f"{c}__idx", outputCol=f"{c}__oh", handleInvalid="keep"))
        cat_cols.append(f"{c}__oh")
    stages.append(VectorAssembler(inputCols=["__num_scaled", *cat_cols], outputCol="features"))
    return stages


def most_frequent(df: DataFrame, categorical: Sequence[str]) -> dict[str, str | None]:
    """The most frequent value of each category (ties: the smallest), None if there is none."""
    out: dict[str, str | None] = {}
    for c in categorical:
        top = (df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("__n"))
               .orderBy(F.desc("__n"), F.asc(c)).limit(1).collect())
        out[c] = top[0][0] if top else None
    return out


def with_missing_indicators(df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    return df.select("*", *[F.col(c).isNull().cast("double").alias(f"{c}__miss") for c in numeric])


def fit(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str, kind: str = "linear",
        **params) -> PipelineModel | Forest:
    """Fit preprocessing + one regressor: ``linear`` (OLS) or ``forest`` (ML-02, ML-04; in parts)."""
    if kind == "linear":
        est = LinearRegression(featuresCol="features", labelCol=target, regParam=params.get("regParam", 0.0))
    elif kind == "forest":
        prep = fit_preprocessing(df, numeric, categorical)
        return fit_forest(predict(prep, df, numeric).select("features", target), target, prep, trees=params.get("numTrees", 100),
                          depth=params.get("maxDepth", 18), min_leaf=params.get("minLeaf", 5),
                          feature_share=params.get("featureSubsetStrategy", "auto"), row_share=params.get("subsamplingRate", 1.0))
    else:
        raise ValueError(kind)
    pipe = Pipeline(stages=[*preprocessing(numeric, categorical, frequent=most_frequent(df, categorical)), est])
    return pipe.fit(with_missing_indicators(prepare(df, numeric), numeric))


def predict(model: PipelineModel, df: DataFrame, numeric: Sequence[str]) -> DataFrame:
    return model.transform(with_missing_indicators(prepare(df, numeric), numeric))


def metrics(pred: DataFrame, label: str, prediction: str = "prediction", group: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE, R2 and bias (mean residual) as one aggregate, no window and one pass (ML-07).
    R2 is 1 - SSE / (n * population variance); NULL for a constant label."""
    err = F.col(label) - F.col(prediction)
    valid = pred.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    n = F.count(F.lit(1))
    return valid.groupBy(*group).agg(
        n.alias("n"), F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse"),
        (1 - F.try_divide(F.sum(err * err), n * F.var_pop(label))).alias("r2"), F.avg(err).alias("bias"))


def coefficients(model: PipelineModel, numeric: Sequence[str]) -> list[tuple[str, float]]:
    """Linear coefficients named and sorted by absolute value (ML-03); metric-sized."""
    values = [float(c) for c in model.stages[-1].coefficients]
    return sorted(zip(slot_names(model, numeric), values, strict=True), key=lambda t: -abs(t[1]))


def importances(model: PipelineModel, numeric: Sequence[str]) -> list[tuple[str, float]]:
    """Importances of a tree ensemble (the impurity it removes: for a boosted one its gain), named and
    sorted (ML-06, FSEL-08)."""
    trees = next(s for s in model.stages if hasattr(s, "featureImportances"))
    names = slot_names(model, numeric)
    values = [float(v) for v in trees.featureImportances.toArray()]
    return sorted(zip(names, values + [0.0] * (len(names) - len(values)), strict=True), key=lambda t: -t[1])


def save_and_reload(model: PipelineModel, path: str) -> PipelineModel:
    """SNK-07: write the fitted pipeline (shared storage) and load it back."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def max_abs_diff(a: DataFrame, b: DataFrame, key: Sequence[str], col: str = "prediction") -> DataFrame:
    """DQ-29: predictions of two models joined on the key, max |difference|."""
    j = a.select(*key, F.col(col).alias("__a")).join(b.select(*key, F.col(col).alias("__b")), list(key))
    return j.agg(F.max(F.abs(F.col("__a") - F.col("__b"))).alias("max_abs_diff"), F.count(F.lit(1)).alias("rows"))


def fit_preprocessing(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> PipelineModel:
    """The preprocessing stages alone (ML-01), for estimators that are not one Spark stage."""
    return Pipeline(stages=preprocessing(numeric, categorical, frequent=most_frequent(df, categorical))).fit(with_missing_indicators(prepare(df, numeric), numeric))


def slot_names(model: PipelineModel, numeric: Sequence[str]) -> list[str]:
    """ML-03: the feature of every slot of the ``features`` vector: numbers, their missing flags, then
    one name per category value, as the fitted indexers and encoders lay them out."""
    names = [*numeric, *[f"{c}__missing" for c in numeric]]
    labels = {s.getOutputCol(): (s.getInputCol(), list(s.labels)) for s in model.stages if isinstance(s, StringIndexerModel)}
    for s in model.stages:
        if isinstance(s, OneHotEncoderModel):
            for col, size in zip(s.getInputCols() if s.isSet("inputCols") else [s.getInputCol()], s.categorySizes, strict=True):
                source, values = labels[col]
                source = source.removesuffix("__filled")
                slots = [f"{source}={v}" for v in values] + [f"{source}=(unseen)", f"{source}=(invalid)"]
                kept = size + (1 if s.getHandleInvalid() == "keep" else 0) - (1 if s.getDropLast() else 0)
                names += slots[:kept]
    return names


def residuals(pred: DataFrame, key: Sequence[str], label: str, prediction: str = "prediction") -> DataFrame:
    """ML-13: key, actual, predicted and residual (actual - predicted) of every row that has both."""
    both = pred.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    r = F.col(label) - F.col(prediction)
    return both.select(*key, F.col(label).alias("actual"), F.col(prediction).alias("predicted"), r.alias("residual"),
                       F.abs(r).alias("abs_residual"))


def diagnostic_sample(res: DataFrame, key: Sequence[str], fraction: float) -> DataFrame:
    """A repeatable share of the residual frame, chosen by the digest of the key's text form."""
    name = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key])
    return res.where(hash_bucket(name) < int(round(fraction * 10000)))


def exploratory_importance(df: DataFrame, features: Sequence[str], target: str, key: Sequence[str], max_rows: int = 120_000,
                           trees: int = 60, depth: int = 14, min_leaf: int = 20) -> DataFrame:
    """FSEL-08: importances of a forest on a repeatable sample of the rows without missing values, by
    feature name; the sample's size is the feature (``max_rows`` is met in expectation)."""
    dense = prepare(df, features).select(*dict.fromkeys([*key, target, *features])).na.drop()
    n = dense.count()
    if not n:
        return df.sparkSession.createDataFrame([], "feature string, importance double, sampled_rows long")
    data = diagnostic_sample(dense, key, 1.0 if n <= max_rows else max_rows / n)
    vector = VectorAssembler(inputCols=list(features), outputCol="features").transform(data).select("features", target)
    forest = RandomForestRegressor(featuresCol="features", labelCol=target, numTrees=trees, maxDepth=depth,
                                   minInstancesPerNode=min_leaf, featureSubsetStrategy="all", seed=42,
                                   maxMemoryInMB=HISTOGRAM_MB).fit(cut_lineage(vector))
    used = data.count()
    return df.sparkSession.createDataFrame(
        [(f, float(v), used) for f, v in zip(features, forest.featureImportances.toArray(), strict=True)],
        "feature string, importance double, sampled_rows long")
