"""Stages of the driver plans as named Parquet tables with a manifest.

The reference persists every stage (staging, dimensions, facts, clean table) as a
database table.  Here a stage is written once per Spark application into the
shared ``spark.checkpoint.dir`` and read back as Parquet: later queries prune its
columns and push filters into its scan, range-partitioning jobs (which sample
their input) do not re-run its lineage, and a lost executor costs one re-read.
Each write adds an entry to the application's manifest (name, source, path, rows,
files, bytes, columns, schema), so the inventory is what was written, not what the
code believes it made.
"""

from __future__ import annotations

import hashlib
import json
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from isotherm.session import scratch_path
from isotherm.sources import commits

_STAGES: dict[tuple, DataFrame] = {}
_LOCK = threading.RLock()

MANIFEST = ("stage string, source string, path string, rows long, files long, bytes long, columns long, schema string")


def app_key(spark: SparkSession):
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - e.g. a Connect session
        return id(spark)


def _home(spark: SparkSession, sf_dir: str) -> str:
    source = hashlib.sha256(sf_dir.rstrip("/").encode()).hexdigest()[:16]
    return scratch_path(spark, f"isotherm-stages/{app_key(spark)}/{source}")


def write_stage(spark: SparkSession, name: str, sf_dir: str, df: DataFrame) -> DataFrame:
    """Write ``df`` as the stage ``name`` of ``sf_dir``, enter it in the manifest and read it back."""
    home = _home(spark, sf_dir)
    path = f"{home}/{name}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    size, files = commits.size_and_files(spark, path)
    commits.commit_text(spark, f"{home}/_manifest/{name}.json", json.dumps({
        "stage": name, "source": sf_dir.rstrip("/"), "path": path, "rows": seen.get["rows"], "files": files,
        "bytes": size, "columns": len(df.columns), "schema": df.schema.json()}))
    return spark.read.schema(df.schema).parquet(path)


def stage(spark: SparkSession, name: str, sf_dir: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Compute and write a stage once per application."""
    key = (app_key(spark), name, sf_dir)
    with _LOCK:  # queries may be launched from several driver threads
        df = _STAGES.get(key)
        if df is None:
            df = write_stage(spark, name, sf_dir, build())
            _STAGES[key] = df
    return df


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per stage written for ``sf_dir`` in this application whose table is still there."""
    home = f"{_home(spark, sf_dir)}/_manifest"
    entries = [json.loads(commits.read_text(spark, f"{home}/{f}")) for f in commits.children(spark, home) if f.endswith(".json")]
    there = [e for e in entries if commits.exists(spark, f"{e['path']}/_SUCCESS")]
    fields = [c.split()[0] for c in MANIFEST.split(", ")]
    return spark.createDataFrame([tuple(e[c] for c in fields) for e in there], MANIFEST)


def read_stage(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    """A written stage by its name, from its manifest entry; fails if it was not written."""
    text = commits.read_text(spark, f"{_home(spark, sf_dir)}/_manifest/{name}.json")
    if text is None:
        raise FileNotFoundError(f"stage {name} of {sf_dir} has not been written")
    entry = json.loads(text)
    from pyspark.sql.types import StructType
    return spark.read.schema(StructType.fromJson(json.loads(entry["schema"]))).parquet(entry["path"])
