"""Text scans that keep the row number of the file (ING-03's ``source_row``).

A row's number is its place in the input, which a distributed scan does not know.
Each scan task numbers its rows as it reads them; rows are written once with their
file and the start of their split, splits are counted, and each split's offset is
the sum of those before it in its file (and of the files before it, by name).  No
global sort and no single task: the offsets are one row per split.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isotherm.session import scratch_path
from isotherm.sources.files import CSV_OPTIONS


def scan_csv_numbered(spark: SparkSession, path: str, columns: list[str], first: int = 2,
                      row_col: str = "source_row") -> DataFrame:
    """All columns as text, and ``row_col`` counted from ``first`` (2: below the header line) over the
    files of ``path`` in name order.  Unreadable lines come back with NULL columns and keep their
    number, so that validation can report them."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = (spark.read.schema(schema).options(**CSV_OPTIONS).option("mode", "PERMISSIVE").csv(path)
           .select(*columns, F.col("_metadata.file_path").alias("__file"),
                   F.col("_metadata.file_block_start").alias("__start"), F.monotonically_increasing_id().alias("__at")))
    written = scratch_path(spark, f"numbered-{uuid.uuid4().hex}")
    raw.write.parquet(written)
    rows = spark.read.schema(raw.schema).parquet(written)
    splits = rows.groupBy("__file", "__start").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    order = Window.orderBy("__file", "__start").rowsBetween(Window.unboundedPreceding, -1)   # one row per split
    offsets = splits.select("__file", "__start", "__first", F.coalesce(F.sum("__n").over(order), F.lit(0)).alias("__before"))
    return rows.join(F.broadcast(offsets), ["__file", "__start"]).select(
        (F.lit(first) + F.col("__before") + F.col("__at") - F.col("__first")).cast("long").alias(row_col), *columns)
