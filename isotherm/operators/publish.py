"""Write, audit, publish (SNK-04, DQ-04, DQ-20).

A table is a folder of versions and a pointer.  A new version is written where no
reader looks, audited from what was written, and becomes the table only when every
check that must be zero is zero; then the pointer document is replaced in one
rename.  A failed audit raises with its rows and leaves the pointer, and so the
previous version, as it was.  The audit itself is kept beside the versions.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.operators.quality import unpivot_one_row
from isotherm.sources import commits

POINTER = "_published.json"


class AuditFailed(RuntimeError):
    """Checks that had to be zero and were not; the version was not published."""

    def __init__(self, path: str, failed: Mapping[str, int], report: DataFrame):
        super().__init__(f"{path}: not published, failed checks: {dict(failed)}")
        self.failed, self.report = dict(failed), report


@dataclass(frozen=True)
class AuditSpec:
    """What is counted over a written version.

    ``invalid`` counts rows a condition holds for (NULL counts as not holding), ``cells`` counts
    negative values over columns, ``reported`` conditions are counted without being errors.
    """
    key: Sequence[str]
    critical: Sequence[str]
    invalid: Mapping[str, Column] = field(default_factory=dict)
    non_negative: Sequence[str] = ()
    reported: Mapping[str, Column] = field(default_factory=dict)

    @property
    def must_be_zero(self) -> list[str]:
        return ["critical_missing_rows", "business_duplicate_rows", "exact_full_row_duplicates",
                "negative_uncertainty_cells", *self.invalid]


def _surplus(df: DataFrame, *by: Column) -> DataFrame:
    """Rows beyond the first of each group, as one row: two partial aggregates, NULL keys equal."""
    groups = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    return groups.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("long").alias("n"))


def audit(df: DataFrame, spec: AuditSpec) -> DataFrame:
    """(check_name, result, required_zero): one pass of counts and two of duplicates.

    Full-row duplicates are told by 128 bits of hash, so rows are not shuffled whole."""
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in spec.critical])
    cells = reduce(lambda a, b: a + b, [F.when(F.col(c) < 0, 1).otherwise(0) for c in spec.non_negative], F.lit(0))
    one = df.agg(
        F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).cast("long").alias("columns"),
        F.count_if(any_null).alias("critical_missing_rows"),
        F.coalesce(F.sum(cells), F.lit(0)).cast("long").alias("negative_uncertainty_cells"),
        *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in {**spec.invalid, **spec.reported}.items()])
    every = [F.col(f"`{c}`") for c in df.columns]
    # a NULL is hashed as a flag of its own: xxhash64 alone skips NULLs, so (NULL, 1) would equal (1, NULL)
    marked = [x for c in every for x in (c.isNull(), c)]
    keys = _surplus(df, *[F.col(c) for c in spec.key]).select(F.lit("business_duplicate_rows").alias("check_name"), F.col("n").alias("result"))
    rows = _surplus(df, F.xxhash64(*marked).alias("__a"), F.xxhash64(F.lit(1), *marked).alias("__b")).select(
        F.lit("exact_full_row_duplicates").alias("check_name"), F.col("n").alias("result"))
    long = unpivot_one_row(one, "check_name", "result").unionByName(keys).unionByName(rows)
    return long.withColumn("required_zero", F.col("check_name").isin(spec.must_be_zero))


def constraint_violations(df: DataFrame, not_null: Sequence[str], checks: Mapping[str, Column]) -> DataFrame:
    """SNK-04's column constraints as counts: (constraint_name, violations).  As in SQL, a CHECK is
    violated only where it is false; unknown passes."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"not_null:{c}") for c in not_null],
                 *[F.count_if(F.coalesce(~cond, F.lit(False))).alias(f"check:{n}") for n, cond in checks.items()])
    return unpivot_one_row(one, "constraint_name", "violations")


def published_version(spark: SparkSession, path: str) -> str | None:
    text = commits.read_text(spark, f"{path}/{POINTER}")
    return json.loads(text)["version"] if text else None


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The published version; fails if nothing has been published."""
    version = published_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"{path}: nothing is published")
    return spark.read.parquet(f"{path}/{version}")


def write_audit_publish(df: DataFrame, path: str, spec: AuditSpec, not_null: Sequence[str] = (),
                        checks: Mapping[str, Column] | None = None, order: Sequence[str] | None = None) -> DataFrame:
    """Write a version of ``path``, audit what was written, publish it; returns the audit's rows.

    ``order`` fixes the column contract: the columns and their order.  Raises ``ValueError`` before
    writing when ``df`` breaks it, ``AuditFailed`` after the audit when a check that must be zero or a
    constraint is not met."""
    spark = df.sparkSession
    if order is not None and list(order) != df.columns:
        raise ValueError(f"columns differ from the contract: {[c for c in df.columns if c not in order]} not in it, "
                         f"{[c for c in order if c not in df.columns]} missing, or another order")
    version = f"version-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{version}")
    written = spark.read.schema(df.schema).parquet(f"{path}/{version}")
    rows = audit(written, spec).collect()                       # one row a check
    broken = constraint_violations(written, not_null, checks or {}).where("violations > 0").collect() if not_null or checks else []
    size, files = commits.size_and_files(spark, f"{path}/{version}")
    failed = {r.check_name: r.result for r in rows if r.required_zero and r.result}
    failed |= {r.constraint_name: r.violations for r in broken}
    report = spark.createDataFrame([(r.check_name, r.result, r.required_zero) for r in rows],
                                   "check_name string, result long, required_zero boolean")
    document = {"version": version, "bytes": size, "files": files, "failed": failed,
                "audit": {r.check_name: r.result for r in rows}}
    commits.commit_text(spark, f"{path}/_audits/{version}.json", json.dumps(document, sort_keys=True))
    if failed:
        raise AuditFailed(path, failed, report)
    commits.commit_text(spark, f"{path}/{POINTER}", json.dumps(document, sort_keys=True))
    return report


def drop_unpublished(spark: SparkSession, path: str) -> list[str]:
    """Remove every version that is not the published one; returns their names.  Run between loads: a
    version under audit looks unpublished too."""
    current = published_version(spark, path)
    gone = [v for v in commits.children(spark, path) if v.startswith("version-") and v != current]
    for v in gone:
        commits.remove(spark, f"{path}/{v}")
    return gone


def require_manifest(manifest: DataFrame, n: int, rank_col: str, what: str = "manifest") -> DataFrame:
    """DQ-06: exactly ``n`` rows with ``n`` different ranks, or the job stops."""
    r = manifest.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(rank_col).alias("ranks")).first()
    if (r["rows"], r["ranks"]) != (n, n):
        raise RuntimeError(f"{what}: {r['rows']} rows with {r['ranks']} different ranks, {n} expected")
    return manifest
