"""Exact quantiles and ranks on value counts (AGG-10, AGG-20, AGG-21, AGG-44, WIN-20, FSEL-03).

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer, so a global quartile over a very large table (or one hot
group holding a third of the rows) ends up in a single task.  Here equal values
are first counted, ``(group, value) -> count``, in partial aggregates, so a value
that fills a third of the table is one row.  Those rows are range-partitioned by
``(group, value)``, which splits a hot group over many tasks, and written once
with their partition number; running counts inside partitions and the offsets of
partitions both read that written frame (two range exchanges would sample their
own boundaries and could disagree).  Every distinct value then knows the first of
the positions it fills, and linear interpolation looks up the values at two of them:

    h = (n - 1) * p;  q = v[floor(h)] + (h - floor(h)) * (v[floor(h) + 1] - v[floor(h)])

which is the definition used by pandas ``quantile``, DuckDB ``quantile_cont`` and
Spark ``percentile``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isotherm.session import cut_lineage


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    cond = F.lit(True)
    for a, b in zip(left, right, strict=True):
        cond = cond & F.col(a).eqNullSafe(F.col(b))
    return cond


def value_positions(df: DataFrame, group_cols: Sequence[str], value_col: str,
                    num_partitions: int | None = None, weight: str | None = None, counted: bool = False) -> DataFrame:
    """Per group and distinct value: ``__v``, its count ``__c``, the 0-based position ``__pos`` of its
    first row in the group's order, and the group's rows ``__n``.  NULL and NaN values are left out, a
    NULL group is a group.  With ``weight`` each input row stands for that many rows; ``counted``: ``df`` has
    one row per group and value already, whose rows ``weight`` counts."""
    g = list(group_cols)
    n_parts = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    v = F.col(value_col)
    there = df.where(v.isNotNull() & ~F.isnan(v.cast("double")))
    if counted:
        counts = there.select(*g, v.alias("__v"), F.col(weight).alias("__c"))
    else:
        counts = there.groupBy(*g, v.alias("__v")).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("__c"))
    order = [F.col(c).asc_nulls_first() for c in g] + [F.col("__v").asc()]
    placed = cut_lineage(counts.repartitionByRange(n_parts, *order).withColumn("__part", F.spark_partition_id()))
    per_part = placed.groupBy(*g, "__part").agg(F.sum("__c").alias("__k"))
    # one row per (group, partition it reaches into)
    before = Window.partitionBy(*g).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    names = [f"__g{i}" for i in range(len(g))]
    offsets = per_part.select(*[F.col(c).alias(a) for c, a in zip(g, names, strict=True)], F.col("__part").alias("__gpart"),
                              F.coalesce(F.sum("__k").over(before), F.lit(0)).alias("__off"),
                              F.sum("__k").over(Window.partitionBy(*g)).alias("__n"))
    inside = Window.partitionBy("__part", *g).orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("__in", F.coalesce(F.sum("__c").over(inside), F.lit(0)))
    side = offsets if g else F.broadcast(offsets)   # without groups: one row per partition
    cond = _same(g, names) & (F.col("__part") == F.col("__gpart"))
    return local.join(side, cond).select(*g, "__v", "__c", (F.col("__off") + F.col("__in")).cast("long").alias("__pos"), "__n")


def exact_quantiles(df: DataFrame, value_col: str, probs: Sequence[float],
                    group_cols: Sequence[str] = (), names: Sequence[str] | None = None,
                    weight: str | None = None, counted: bool = False) -> DataFrame:
    """One row per group with one column per probability (``q<p*100>`` unless ``names``).

    A distinct value meets the probabilities whose positions fall into its run of rows, so one
    grouped aggregate over the value counts gives all quantiles."""
    g = list(group_cols)
    names = list(names or [f"q{int(round(p * 100))}" for p in probs])
    pos = value_positions(df, g, value_col, weight=weight, counted=counted)
    first, last = F.col("__pos"), F.col("__pos") + F.col("__c") - 1
    cols = []
    for p, name in zip(probs, names, strict=True):
        h = (F.col("__n") - 1) * F.lit(float(p))
        at = lambda k: F.max(F.when(k.between(first, last), F.col("__v")))  # noqa: E731, B023
        lo, hi, share = at(F.floor(h)), at(F.ceil(h)), F.max(h - F.floor(h))
        cols.append((lo + share * (hi - lo)).alias(name))
    return pos.groupBy(*g).agg(*cols)


def average_ranks(df: DataFrame, group_cols: Sequence[str], value_col: str, out: str,
                  weight: str | None = None, centred: bool = False) -> DataFrame:
    """(group, value) -> 1-based average rank of the value's rows in the group (WIN-20); ``centred``
    takes the group's mean rank off."""
    rank = F.col("__pos") + (F.col("__c") + 1) / F.lit(2.0)
    if centred:
        rank = rank - (F.col("__n") + 1) / F.lit(2.0)
    return value_positions(df, group_cols, value_col, weight=weight).select(
        *group_cols, F.col("__v").alias(value_col), rank.alias(out))


def iqr_fences(df: DataFrame, value_col: str, k: float = 1.5, group_cols: Sequence[str] = ()) -> DataFrame:
    """q1, q3, iqr, lower and upper fence (AGG-21)."""
    q = exact_quantiles(df, value_col, [0.25, 0.75], group_cols, names=["q1", "q3"])
    iqr = F.col("q3") - F.col("q1")
    return q.select(*group_cols, "q1", "q3", iqr.alias("iqr"), (F.col("q1") - k * iqr).alias("lower_fence"),
                    (F.col("q3") + k * iqr).alias("upper_fence"))
