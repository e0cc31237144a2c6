"""Sampling (SAM-01..03, SRC-09, SRC-10).

Seeded Bernoulli samples cannot reproduce numpy or PostgreSQL draws; the hash
sample is the reproducible form (same rows in any engine, any partitioning).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_bucket(key: str | Column, buckets: int = 10000) -> Column:
    """First 8 hex digits of md5(key) as an integer, modulo ``buckets`` (SAM-03)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("long") % buckets


def hash_sample(df: DataFrame, key: str, fraction: float, buckets: int = 10000) -> DataFrame:
    return df.where(hash_bucket(key, buckets) < int(round(fraction * buckets)))


def simple_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Seeded Bernoulli sample without replacement (SAM-01); size is approximate."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def stratified_sample(df: DataFrame, stratum: str, fraction: float, strata: Sequence[str], seed: int = 42) -> DataFrame:
    """Same fraction in each stratum (SAM-02)."""
    return df.sampleBy(stratum, {s: fraction for s in strata}, seed)


def bernoulli_scan(df: DataFrame, fractions: Mapping[str, float], split: str = "data_split", seed: int = 42) -> DataFrame:
    """Seeded Bernoulli sample with one fraction per split, in one pass (SRC-10); splits that are not
    named give no rows."""
    return df.sampleBy(split, dict(fractions), seed)


def range_scan(df: DataFrame, columns: Sequence[str], column: str, start: str, end: str) -> DataFrame:
    """Some columns of the rows with ``start <= column < end`` (SRC-08, SRC-09): both reach the scan,
    and whole periods are kept, so no series is cut by a row count."""
    return df.where((F.col(column) >= F.lit(start).cast("date")) & (F.col(column) < F.lit(end).cast("date"))).select(*columns)
