"""Data profiles (AGG-10..19, AGG-20, DQ-02, DQ-03, PRJ-18).

Wide profiles are computed as one aggregate over a long (column_name, value)
form produced by ``stack``: one shuffle for any number of columns, and a column
with a hot value is still partially aggregated per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isotherm.operators.quantiles import exact_quantiles

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def to_long(df: DataFrame, cols: Sequence[str], cast: str = "double", keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., column_name, value) with ``stack``; values cast to one type."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS {cast})" for c in cols)
    keep_sql = "".join(f"`{k}`, " for k in keep)
    return df.selectExpr(f"{keep_sql}stack({len(cols)}, {pairs}) AS (column_name, value)")


def describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std (n-1), min, 25/50/75 % (exact, linear) and max per numeric column (AGG-10)."""
    cols = list(cols or numeric_columns(df))
    long = to_long(df, cols)
    basic = long.groupBy("column_name").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    q = exact_quantiles(long, "value", [0.25, 0.5, 0.75], ["column_name"], names=["q25", "q50", "q75"])
    return basic.join(q, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def target_summary(df: DataFrame, col: str) -> DataFrame:
    """count, mean, median, std, min, max, range (AGG-20)."""
    basic = df.agg(F.count(col).alias("count"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
                   F.min(col).alias("min"), F.max(col).alias("max"))
    med = exact_quantiles(df, col, [0.5], names=["median"])
    return basic.crossJoin(med).select("count", "mean", "median", "std", "min", "max",
                                       (F.col("max") - F.col("min")).alias("range"))


def unique_profile(df: DataFrame, cols: Sequence[str] | None = None, digits: int = 2) -> DataFrame:
    """Distinct non-NULL values per column and ratio to rows in percent (AGG-12)."""
    cols = list(cols or df.columns)
    long = to_long(df, cols, cast="string").where(F.col("value").isNotNull())
    distinct_vals = long.groupBy("column_name", "value").agg(F.lit(1).alias("__one"))  # partial aggregation
    per_col = distinct_vals.groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_values"))
    total = df.agg(F.count(F.lit(1)).alias("__rows"))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column_name string")
    return (names.join(per_col, "column_name", "left").crossJoin(F.broadcast(total))
            .select("column_name", F.coalesce("distinct_values", F.lit(0)).alias("distinct_values"),
                    F.round(F.try_divide(F.coalesce("distinct_values", F.lit(0)) * 100.0, F.col("__rows")), digits)
                    .alias("unique_percent")))


def categorical_profile(df: DataFrame, cols: Sequence[str], digits: int = 2) -> DataFrame:
    """groups, missing count / %, most frequent value and its count (ties: smallest value) (AGG-13)."""
    long = to_long(df, cols, cast="string")
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    nonnull = counts.where(F.col("value").isNotNull())
    top = nonnull.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("groups"),
        F.min(F.struct((-F.col("n")).alias("neg_n"), F.col("value").alias("v"))).alias("__top"))
    miss = counts.groupBy("column_name").agg(
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("missing"),
        F.sum("n").alias("rows"))
    return miss.join(top, "column_name", "left").select(
        "column_name", F.coalesce("groups", F.lit(0)).alias("groups"), F.col("missing").cast("long").alias("missing"),
        F.round(F.try_divide(F.col("missing") * 100.0, F.col("rows")), digits).alias("missing_percent"),
        F.col("__top.v").alias("top_value"), (-F.col("__top.neg_n")).alias("top_count"))


def schema_profile(df: DataFrame) -> DataFrame:
    """dtype per column (as a portable family) and non-NULL rows (AGG-14)."""
    fam = {T.ByteType: "integer", T.ShortType: "integer", T.IntegerType: "integer", T.LongType: "integer",
           T.FloatType: "float", T.DoubleType: "float", T.DecimalType: "float", T.StringType: "string",
           T.BooleanType: "boolean", T.DateType: "date", T.TimestampType: "timestamp",
           T.TimestampNTZType: "timestamp"}
    types = {f.name: next((v for k, v in fam.items() if isinstance(f.dataType, k)), f.dataType.simpleString())
             for f in df.schema.fields}
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    long = to_long(row, df.columns, cast="bigint").withColumnRenamed("value", "non_null")
    names = df.sparkSession.createDataFrame(list(types.items()), "column_name string, dtype string")
    return names.join(long, "column_name")


def overview(name: str, df: DataFrame, key: Sequence[str], date_col: str | None = None) -> DataFrame:
    """rows, columns, missing cells, full-row duplicates, key duplicates, date range (AGG-19, DQ-02, DQ-03)."""
    cols = df.columns
    missing = sum((F.col(f"`{c}`").isNull().cast("long") for c in cols[1:]), F.col(f"`{cols[0]}`").isNull().cast("long"))
    a = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(missing).alias("missing_cells"),
               F.count_distinct(F.struct(*key)).alias("__keys"),
               *([F.min(date_col).cast("date").alias("min_date"), F.max(date_col).cast("date").alias("max_date")]
                 if date_col else [F.lit(None).cast("date").alias("min_date"),
                                   F.lit(None).cast("date").alias("max_date")]))
    distinct_rows = df.distinct().agg(F.count(F.lit(1)).alias("__distinct"))
    return a.crossJoin(distinct_rows).select(
        F.lit(name).alias("table_name"), "rows", F.lit(len(cols)).cast("long").alias("columns"),
        F.coalesce("missing_cells", F.lit(0)).cast("long").alias("missing_cells"),
        (F.col("rows") - F.col("__distinct")).alias("full_duplicates"),
        (F.col("rows") - F.col("__keys")).alias("key_duplicates"), "min_date", "max_date")


def policy_classifier(policy: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """Column -> policy label from label -> columns (PRJ-18); applied as a literal column."""
    return {c: label for label, cs in policy.items() for c in cs}
