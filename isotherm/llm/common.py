"""Helpers shared by the operators: input projection, stage tables, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.session import checkpoint_dir

#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


PACKAGE = Path(__file__).resolve().parents[1]
ARCHIVE = "isotherm_code.zip"


def ship(spark: SparkSession) -> None:
    """Give the executors this package's source once per application, as ``--py-files`` would.

    The archive is made on the driver and served by Spark; executors import from their copy."""
    sc = spark.sparkContext
    if ARCHIVE in sc._python_includes:
        return
    path = Path(tempfile.mkdtemp(prefix="isotherm-code-")) / ARCHIVE
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(PACKAGE.rglob("*.py")):
            z.write(f, f.relative_to(PACKAGE.parent))
    sc.addPyFile(str(path))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh Parquet folder on the cluster's shared storage and read it back.

    Cuts the lineage: a lost executor re-reads the stage, and sampling jobs (range
    partitioning) do not run the expensive part twice.  The reader prunes columns.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/isotherm-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, for the small frames of iterative jobs."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint behind a count of the (staged) frame; a larger one is joined by shuffle."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` begins with it."""
    taken = [c.lower() for c in df.columns]
    while any(c.startswith(name.lower()) for c in taken):
        name += "_"
    return name


def remainder(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; NULL ids give NULL."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % F.lit(n)


def parts_for(rows: int, per_part: int, least: int = 1) -> int:
    return max(least, -(-int(rows) // per_part))
