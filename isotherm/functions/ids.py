"""Dense consecutive ids without a single-partition window (WIN-19, SRC-05).

``row_number() over (order by k)`` without a partition funnels the whole frame
through one task.  ``dense_index`` range-partitions the frame once, writes the
placed rows with their partition number to a reliable checkpoint, numbers rows
inside each partition, and adds the per-partition offsets.  Counts and rows both
read that checkpoint: two separate range exchanges would sample their own
boundaries and could disagree.  The id is the rank of the key in the total
order, so it does not depend on where the range boundaries fall.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isotherm.session import cut_lineage


def dense_index(df: DataFrame, order_cols: Sequence[str], id_col: str,
                num_partitions: int | None = None, start: int = 1) -> DataFrame:
    """Assign ``start..N`` to the rows of ``df`` in ``order_cols`` order (keys must be unique)."""
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = [F.col(c).asc_nulls_first() for c in order_cols]
    parted = cut_lineage(df.repartitionByRange(n, *ordered).withColumn("__part", F.spark_partition_id()))
    counts = parted.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    # one row per partition: a tiny frame, safe to window without partitioning
    offsets = counts.select(
        "__part",
        (F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)),
                    F.lit(0)) + start).alias("__offset"))
    within = Window.partitionBy("__part").orderBy(*ordered)
    return (parted.join(F.broadcast(offsets), "__part")
            .withColumn(id_col, (F.col("__offset") + F.row_number().over(within) - 1).cast("long"))
            .drop("__part", "__offset"))
