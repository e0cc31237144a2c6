"""CSV / JSON sources and sinks with contracts (SRC-01..12, SNK-01..05, SNK-08).

Paths may be local or any Hadoop-compatible URI; existence checks go through the
Hadoop FileSystem of the session, never through machine-local listings.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "nullValue": "", "encoding": "UTF-8",
               "dateFormat": "yyyy-MM-dd", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _fs_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def require_files(spark: SparkSession, paths: Mapping[str, str]) -> None:
    """SRC-07: fail with the list of missing inputs before any job starts."""
    missing = [name for name, p in paths.items() if not _fs_exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"missing input files: {missing}")


def scan_csv(spark: SparkSession, path: str, schema: T.StructType, mode: str = "FAILFAST") -> DataFrame:
    """SRC-01..03: declared schema, header skipped, '"' quote and escape, '' = NULL, UTF-8.

    ``FAILFAST`` aborts on the first malformed line, so a partial load is never visible
    (the write that follows publishes only complete outputs)."""
    return spark.read.schema(schema).options(**CSV_OPTIONS).option("mode", mode).csv(path)


def file_catalog(df: DataFrame, role: str) -> DataFrame:
    """SRC-06: per file rows, columns, size in MB and column names, from the scan's metadata."""
    cols = [c for c in df.columns]
    meta = df.select("_metadata.file_path", "_metadata.file_size")
    return meta.groupBy("file_path", "file_size").agg(F.count(F.lit(1)).alias("rows")).select(
        "file_path", "rows", F.lit(len(cols)).cast("long").alias("columns"),
        F.round(F.col("file_size") / (1024 * 1024), 2).alias("size_mb"),
        F.lit(", ".join(cols)).alias("column_names"), F.lit(role).alias("role"))


def write_csv(df: DataFrame, path: str, order: Sequence[str], gzip: bool = False, float_digits: int | None = None,
              mode: str = "overwrite") -> None:
    """SNK-01 / SNK-02: fixed column order asserted, ISO dates, optional gzip and rounded floats."""
    if list(order) != [c for c in order if c in df.columns] or set(order) - set(df.columns):
        raise ValueError("output columns missing from the frame")
    out = df.select(*order)
    if float_digits is not None:
        out = out.select(*[F.round(c, float_digits).alias(c) if t in ("double", "float") else F.col(c)
                           for c, t in out.dtypes])
    w = out.write.options(**CSV_OPTIONS).mode(mode)
    if gzip:
        w = w.option("compression", "gzip")
    w.csv(path)


def read_back_header(spark: SparkSession, path: str) -> list[str]:
    """SNK-02: the header of the written files (one row read)."""
    return spark.read.options(**CSV_OPTIONS).csv(path).columns


def write_table(df: DataFrame, path: str, key: Sequence[str], mode: str = "errorifexists") -> DataFrame:
    """SNK-03 / SNK-04 / SRC-04: write Parquet (refusing a non-empty target by default), then check the
    written row count and key uniqueness on the read-back table (Spark has no primary key)."""
    expected = df.count()
    df.write.mode(mode).parquet(path)
    back = df.sparkSession.read.parquet(path)
    r = back.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(F.struct(*key)).alias("keys")).first()
    return df.sparkSession.createDataFrame(
        [(path, expected, r["rows"], r["keys"], r["rows"] == expected and r["keys"] == r["rows"])],
        "path string, expected_rows long, written_rows long, distinct_keys long, passed boolean")


def load_into_empty(df: DataFrame, path: str) -> bool:
    """SRC-04: load a staging table that is absent or has no row; False if it has rows (nothing is written)."""
    spark = df.sparkSession
    if _fs_exists(spark, path) and not spark.read.parquet(path).isEmpty():
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def write_json_document(spark: SparkSession, doc: Mapping, path: str) -> None:
    """SNK-05: one JSON document (features, cutoffs, counts, fallbacks) written as a one-row file."""
    spark.createDataFrame([(json.dumps(doc, sort_keys=True),)], "doc string").coalesce(1) \
        .write.mode("overwrite").text(path)


def read_json_contract(spark: SparkSession, path: str, required: Sequence[str]) -> dict:
    """SRC-12: read the document back (one small file) and fail on missing keys."""
    doc = json.loads(spark.read.text(path).first()[0])
    missing = [k for k in required if k not in doc]
    if missing:
        raise KeyError(f"contract keys missing: {missing}")
    return doc


def contract_read(spark: SparkSession, path: str, required: Sequence[str]) -> DataFrame:
    """SRC-11: fail when the table or a needed column is absent."""
    if not _fs_exists(spark, path):
        raise FileNotFoundError(path)
    df = spark.read.parquet(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing from {path}: {missing}")
    return df.select(*required)
