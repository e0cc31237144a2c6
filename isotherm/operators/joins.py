"""Join helpers: key-join validation, coverage-aware misses, cardinality checks,
fallback chains and key-set comparison (JON-08, JON-11..13, JON-15, JON-16, JON-20, SET-05)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_safe_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def validate_key_join(name: str, left: DataFrame, right: DataFrame, on: Sequence[str],
                      expected_unmatched: DataFrame | int = 0) -> DataFrame:
    """Distinct keys of ``left`` LEFT JOIN distinct keys of ``right`` (NULL keys match, as in pandas).

    One row: source keys, rows after join, matched, unmatched, expected unmatched,
    row multiplication, match %, PASS/FAIL.  ``expected_unmatched`` may be a one-row
    frame with column ``expected_unmatched``.
    """
    lk = left.select(*on).distinct()
    rk = right.select(*on).distinct().withColumn("__matched", F.lit(True))
    lk_a, rk_a = lk.alias("l"), rk.alias("r")
    cond = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in on])
    joined = lk_a.join(rk_a, cond, "left")
    stats = joined.agg(F.count(F.lit(1)).alias("rows_after_join"),
                       F.count_if(F.col("__matched").isNotNull()).alias("matched_keys"),
                       F.count_if(F.col("__matched").isNull()).alias("unmatched_keys"))
    src = lk.agg(F.count(F.lit(1)).alias("source_keys"))
    exp = (expected_unmatched if isinstance(expected_unmatched, DataFrame)
           else src.sparkSession.range(1).select(F.lit(expected_unmatched).cast("long").alias("expected_unmatched")))
    out = src.crossJoin(stats).crossJoin(exp.select("expected_unmatched"))
    mult = F.col("rows_after_join") - F.col("source_keys")
    return out.select(
        F.lit(name).alias("check_name"), "source_keys", "rows_after_join", "matched_keys", "unmatched_keys",
        "expected_unmatched", mult.alias("row_multiplication"),
        F.try_divide(F.col("matched_keys") * 100.0, F.col("source_keys")).alias("match_percent"),
        F.when((mult == 0) & (F.col("unmatched_keys") == F.col("expected_unmatched")), F.lit("PASS"))
         .otherwise(F.lit("FAIL")).alias("status"))


def coverage_expected_unmatched(keys: DataFrame, reference: DataFrame, entity: str, date: str) -> DataFrame:
    """Keys whose date lies outside the entity's [min, max] date in ``reference`` are expected
    misses (JON-12).  Returns a one-row frame ``expected_unmatched``."""
    cov = reference.groupBy(entity).agg(F.min(date).alias("__start"), F.max(date).alias("__end"))
    j = keys.select(entity, date).distinct().join(cov, entity, "left")
    inside = F.coalesce(F.col(date).between(F.col("__start"), F.col("__end")), F.lit(False))
    return j.agg(F.count_if(~inside).alias("expected_unmatched"))


def duplicate_key_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """rows - distinct key tuples (a tuple containing NULL still counts: struct, not multi-arg)."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_distinct(F.struct(*keys)).alias("distinct_keys")) \
             .withColumn("duplicate_rows", F.col("rows") - F.col("distinct_keys"))


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "frame") -> None:
    """``validate='one_to_one'/'many_to_one'``: raise when the one side repeats a key (JON-13).

    Runs one aggregate; only a one-row result reaches the driver.
    """
    row = duplicate_key_count(df, keys).first()
    if row["duplicate_rows"]:
        raise ValueError(f"{what}: {row['duplicate_rows']} duplicate rows on key {list(keys)}")


def key_set_diff(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """inserted = new keys not in old; replaced = new keys already in old; one row (SET-05/JON-20)."""
    old = existing.select(*keys).distinct().withColumn("__old", F.lit(True))
    new = incoming.select(*keys).distinct()
    j = new.join(old, list(keys), "left")
    return j.agg(F.count_if(F.col("__old").isNull()).alias("inserted"),
                 F.count_if(F.col("__old").isNotNull()).alias("replaced"))
