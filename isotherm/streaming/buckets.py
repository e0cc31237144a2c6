"""A last-wins table in key buckets (SNK-08, ING-06).

Keys hash into a fixed number of buckets, each a folder of versions.  A batch
reads and rewrites only the buckets its keys fall into; every other bucket keeps
the version it has.  A commit is one small document that names the current
version of every bucket, put in place by a rename: readers see all of a batch or
nothing of it, a batch that failed half-way leaves files no commit names, and a
batch that is run again after its commit changes nothing.  Versions no longer
named by the newest commits are removed after it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from isotherm.sources import commits


@dataclass
class BucketTable:
    """``path`` holds bucket=<b>/version=<batch> folders and ``_commits/<batch>.json``."""
    spark: SparkSession
    path: str
    key: Sequence[str]
    schema: StructType
    buckets: int = 64
    keep_commits: int = 2

    def _bucket(self) -> Column:
        # a NULL in the key is hashed as a flag of its own
        parts = [x for c in self.key for x in (F.col(c).isNull(), F.col(c))]
        return F.pmod(F.xxhash64(*parts), F.lit(self.buckets)).cast("int")

    def _commits(self) -> list[int]:
        names = commits.children(self.spark, f"{self.path}/_commits")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _versions(self, batch: int) -> dict[int, int]:
        text = commits.read_text(self.spark, f"{self.path}/_commits/{batch:020d}.json")
        return {int(b): v for b, v in json.loads(text)["versions"].items()}

    def versions(self) -> dict[int, int]:
        """Bucket -> version of the newest commit."""
        done = self._commits()
        return self._versions(done[-1]) if done else {}

    def _folders(self, versions: dict[int, int], only: Sequence[int] | None = None) -> DataFrame:
        paths = [f"{self.path}/bucket={b}/version={v}" for b, v in sorted(versions.items()) if only is None or b in only]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self) -> DataFrame:
        return self._folders(self.versions())

    def merge(self, batch: int, rows: DataFrame, pick: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """Merge ``rows`` into the buckets they fall into and commit; returns the buckets rewritten.

        ``pick(existing, incoming)`` decides which row of a key stays.  Batches are numbered in
        order; one whose number is not above the last commit's has been merged already."""
        done = self._commits()
        if done and batch <= done[-1]:
            return []
        current = self._versions(done[-1]) if done else {}
        incoming = rows.select(*self.schema.names)
        # at most ``buckets`` numbers
        touched = sorted(r[0] for r in incoming.select(self._bucket().alias("b")).distinct().collect())
        if touched:
            merged = pick(self._folders(current, touched), incoming).select(*self.schema.names)
            (merged.withColumn("bucket", self._bucket()).withColumn("version", F.lit(batch).cast("long"))
             .repartition("bucket").write.option("partitionOverwriteMode", "dynamic").mode("overwrite")
             .partitionBy("bucket", "version").parquet(self.path))
        versions = current | {b: batch for b in touched}
        commits.commit_text(self.spark, f"{self.path}/_commits/{batch:020d}.json",
                            json.dumps({"batch": batch, "touched": touched, "versions": versions}))
        self._clean()
        return touched

    def _clean(self) -> None:
        """Drop commits beyond the newest ``keep_commits`` and the versions that none of those names."""
        done = self._commits()
        kept, old = done[-self.keep_commits:], done[: -self.keep_commits]
        if not old:
            return
        named = {(b, v) for c in kept for b, v in self._versions(c).items()}
        for c in old:
            for b, v in self._versions(c).items():
                if (b, v) not in named and commits.exists(self.spark, f"{self.path}/bucket={b}/version={v}"):
                    commits.remove(self.spark, f"{self.path}/bucket={b}/version={v}")
            commits.remove(self.spark, f"{self.path}/_commits/{c:020d}.json")
