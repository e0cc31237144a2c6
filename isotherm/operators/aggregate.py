"""Coverage aggregates and grouped summaries (AGG-01..09, AGG-15..18, AGG-24..30, AGG-39..41, AGG-45).

All aggregates are plain ``groupBy().agg()`` so Spark does a map-side partial
aggregation before the shuffle: a hot key is combined inside each task and only
one partial row per (task, key) crosses the network.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def coverage(df: DataFrame, keys: Sequence[str], value: str,
             averages: dict[str, str] | None = None, first_last: str | None = None) -> DataFrame:
    """Per key: COUNT(*), COUNT(v), COUNT(*) FILTER (v IS NULL), AVG/MIN/MAX(v) + extra AVGs.

    ``first_last`` (e.g. ``"year"``) adds ``first_<x>``/``last_<x>`` (decadal form, AGG-02).
    """
    v = F.col(value)
    aggs: list[Column] = []
    if first_last:
        aggs += [F.min(first_last).alias(f"first_{first_last}"), F.max(first_last).alias(f"last_{first_last}")]
    aggs += [
        F.count(F.lit(1)).alias("observation_months"),
        F.count(v).alias("valid_temperature_months"),
        F.count_if(v.isNull()).alias("missing_temperature_months"),
        F.avg(v).alias("average_temperature"),
        F.min(v).alias("minimum_temperature"),
        F.max(v).alias("maximum_temperature"),
    ]
    for out, col in (averages or {}).items():
        aggs.append(F.avg(col).alias(out))
    return df.groupBy(*keys).agg(*aggs)


def value_counts(df: DataFrame, col: str, top: int | None = None, digits: int = 2) -> DataFrame:
    """count and percent of total per value, sorted by count desc then value (AGG-15/AGG-38).

    The total is a one-row aggregate cross-joined (broadcast) to the counts.
    """
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("__total"))
    out = (counts.crossJoin(F.broadcast(total))
           .select(col, "n", F.round(F.try_divide(F.col("n") * 100.0, F.col("__total")), digits).alias("percent")))
    if top is not None:
        out = out.orderBy(F.desc("n"), F.asc(col)).limit(top)
    return out


def ranked_counts(df: DataFrame, key: str, top_n: int) -> DataFrame:
    """Rows per key, ranked by count desc then key (WIN-01); ``in_top`` for the first ``top_n``.

    The window runs on the aggregated frame (one row per key), never on facts.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    w = Window.orderBy(F.desc("row_count"), F.asc(key))
    return counts.withColumn("row_rank", F.row_number().over(w).cast("long")) \
                 .withColumn("in_top", F.col("row_rank") <= top_n)


def date_profile(df: DataFrame, date_col: str) -> DataFrame:
    """min, max, span in days, distinct months, distinct years (AGG-18)."""
    d = F.col(date_col)
    return df.agg(F.min(d).alias("min_date"), F.max(d).alias("max_date"),
                  F.datediff(F.max(d), F.min(d)).cast("long").alias("span_days"),
                  F.count_distinct(F.trunc(d, "MM")).alias("distinct_months"),
                  F.count_distinct(F.year(d)).alias("distinct_years"),
                  F.count_if(d.isNull()).alias("null_dates"))


def missing_by(df: DataFrame, key: str, value: str, digits: int = 2) -> DataFrame:
    """size, NULL count and percent per key (AGG-16; AGG-17 is ``rows``)."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(value).isNull()).alias("missing"),
    ).withColumn("missing_percent", F.round(F.try_divide(F.col("missing") * 100.0, F.col("rows")), digits))


def mean_of_means(df: DataFrame, inner_key: str, outer_key: Column | str, value: str,
                  outer_name: str) -> DataFrame:
    """Two-level mean: mean per inner key, then mean of those per outer key (AGG-30)."""
    inner = df.groupBy(inner_key).agg(F.avg(value).alias("__m"))
    outer = outer_key if isinstance(outer_key, Column) else F.col(outer_key)
    return inner.groupBy(outer.alias(outer_name)).agg(
        F.avg("__m").alias("mean_of_means"), F.count(F.lit(1)).alias("n_groups"))


def extremes(df: DataFrame, key: Sequence[str], metric: str, k: int) -> DataFrame:
    """k lowest and k highest groups, labelled, de-duplicated by key (TOP-03/TOP-04).

    Two bounded top-k's (TakeOrderedAndProject) instead of a global sort.
    """
    low = df.orderBy(F.asc(metric), *[F.asc(c) for c in key]).limit(k).withColumn("extreme", F.lit("lowest"))
    high = df.orderBy(F.desc(metric), *[F.asc(c) for c in key]).limit(k).withColumn("extreme", F.lit("highest"))
    both = low.unionByName(high)
    # a key that is both lowest and highest (2k > groups) is kept once, as "lowest"
    return both.withColumn("__r", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("extreme")))) \
               .where("__r = 1").drop("__r")
