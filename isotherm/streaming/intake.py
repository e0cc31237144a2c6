"""Validated last-wins intake of new observations (ING-01..06, WIN-15, WIN-16, SET-05, SET-06, SNK-08).

The same functions run as a batch job and inside ``foreachBatch`` of a stream:
each micro-batch is validated, accepted rows are merged into the pending table
(last arrival wins per business key), and the table is rewritten atomically by
writing a new version and never reading and overwriting the same path in one job.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.functions.text import join_reasons

KEY = ["observation_date", "city_name", "country_name", "latitude", "longitude"]
REQUIRED = ["observation_date", "city_name", "country_name", "latitude", "longitude", "city_average_temperature"]
OUTPUT = [*REQUIRED, "city_average_temperature_uncertainty", "data_source"]
# Validation messages in rule order.
MESSAGES = ["invalid date", "date must be the first day of a month", "observations start at the gap start",
            "observation is in the future", "missing city name", "missing country name",
            "latitude must be in [-90, 90]", "longitude must be in [-180, 180]",
            "temperature must be in [-90, 60]", "uncertainty must not be negative", "duplicate key in this batch"]


def missing_columns(df: DataFrame, required: Sequence[str] = REQUIRED) -> list[str]:
    """ING-01: names of required columns absent from the input (checked before any job)."""
    return [c for c in required if c not in df.columns]


def validate(df: DataFrame, gap_start: str, as_of: str) -> DataFrame:
    """ING-02: every row with a ``validation_error`` listing the broken rules in order ('' = valid).

    ``as_of`` is the current month, passed in (never ``current_date()``) so results repeat.
    The duplicate rule flags every row of a repeated key (``keep=False``): key counts come
    from a partial aggregate joined back, not from a window over a possibly hot key.
    """
    miss = missing_columns(df)
    if miss:
        raise ValueError(f"missing required columns: {miss}")
    d = F.col("observation_date")
    ok_date = d.isNotNull()
    blank = lambda c: F.col(c).isNull() | (F.col(c) == "")
    outside = lambda c, lo, hi: F.col(c).isNull() | ~F.col(c).between(lo, hi)
    dup_counts = df.groupBy(*KEY).agg(F.count(F.lit(1)).alias("__k"))
    j = df.join(dup_counts, [df[k].eqNullSafe(dup_counts[k]) for k in KEY], "left").select(df["*"], "__k")
    reasons = join_reasons(
        (~ok_date, MESSAGES[0]),
        (ok_date & (F.dayofmonth(d) != 1), MESSAGES[1]),
        (ok_date & (d < F.lit(gap_start).cast("date")), MESSAGES[2]),
        (ok_date & (d > F.lit(as_of).cast("date")), MESSAGES[3]),
        (blank("city_name"), MESSAGES[4]),
        (blank("country_name"), MESSAGES[5]),
        (outside("latitude", -90, 90), MESSAGES[6]),
        (outside("longitude", -180, 180), MESSAGES[7]),
        (outside("city_average_temperature", -90, 60), MESSAGES[8]),
        (F.col("city_average_temperature_uncertainty").isNotNull()
         & (F.col("city_average_temperature_uncertainty") < 0), MESSAGES[9]),
        (F.col("__k") > 1, MESSAGES[10]))
    return j.withColumn("validation_error", reasons).drop("__k")


def accepted(validated: DataFrame, default_source: str = "user_observation") -> DataFrame:
    """ING-03: valid rows in contract order with a default ``data_source``."""
    return validated.where(F.col("validation_error") == "").select(
        *REQUIRED, "city_average_temperature_uncertainty",
        F.coalesce(F.col("data_source"), F.lit(default_source)).alias("data_source"))


def rejected(validated: DataFrame) -> DataFrame:
    """ING-03: rows that broke a rule, with the number they have in their file and all reasons."""
    return validated.where(F.col("validation_error") != "").select("source_row", *OUTPUT, "validation_error")


def typed(raw: DataFrame) -> DataFrame:
    """Text columns of an upload as observation columns: trimmed names, dates and numbers that do not
    parse become NULL, so that the rules report them instead of the scan failing."""
    have = set(raw.columns)
    text = lambda c: F.col(c) if c in have else F.lit(None).cast("string")
    number = lambda c: F.trim(text(c)).try_cast("double").alias(c)
    return raw.select(
        "source_row", F.trim(text("observation_date")).try_cast("date").alias("observation_date"),
        F.trim(text("city_name")).alias("city_name"), F.trim(text("country_name")).alias("country_name"),
        number("latitude"), number("longitude"), number("city_average_temperature"),
        number("city_average_temperature_uncertainty"), F.trim(text("data_source")).alias("data_source"))


def gap_report(acc: DataFrame, gap_start: str) -> DataFrame:
    """ING-04 / SET-06: per location, months expected from ``gap_start`` to the latest month, supplied,
    missing, completeness % and the first six missing months ('YYYY-MM', comma-joined)."""
    loc = ["city_name", "country_name", "latitude", "longitude"]
    per = acc.groupBy(*loc).agg(F.max("observation_date").alias("latest_observation"),
                                F.collect_set(F.trunc("observation_date", "MM")).alias("__present"))
    # collect_set holds the distinct months of one location: bounded by the calendar, not by rows
    expected = F.sequence(F.lit(gap_start).cast("date"), F.trunc("latest_observation", "MM"), F.expr("INTERVAL 1 MONTH"))
    missing = F.array_sort(F.array_except(expected, F.col("__present")))
    out = per.select(*loc, "latest_observation", F.size(expected).cast("long").alias("months_expected"),
                     F.size("__present").cast("long").alias("months_supplied"),
                     F.size(missing).cast("long").alias("months_missing"),
                     F.round(F.size("__present") * 100.0 / F.size(expected), 2).alias("completeness_percent"),
                     F.array_join(F.transform(F.slice(missing, 1, 6), lambda m: F.date_format(m, "yyyy-MM")), ", ")
                     .alias("first_missing_months"))
    return out


def summary(validated: DataFrame, gaps: DataFrame) -> DataFrame:
    """ING-05: accepted, rejected, distinct cities, total missing months."""
    v = validated.agg(F.count_if(F.col("validation_error") == "").alias("accepted"),
                      F.count_if(F.col("validation_error") != "").alias("rejected"),
                      F.count_distinct(F.when(F.col("validation_error") == "", F.col("city_name"))).alias("cities"))
    g = gaps.agg(F.coalesce(F.sum("months_missing"), F.lit(0)).cast("long").alias("total_missing_months"))
    return v.crossJoin(g)


def upsert_last(existing: DataFrame, incoming: DataFrame, order_cols: Sequence[str] = ("ingested_batch", "source_row")
                ) -> DataFrame:
    """ING-06 / WIN-16: existing ∪ incoming, the last arrival per key wins.

    ``max(struct(order..., payload))`` per key is a partial aggregate: a key repeated
    many times is reduced inside each task before the shuffle.
    """
    both = existing.unionByName(incoming)
    rest = [c for c in both.columns if c not in KEY and c not in order_cols]
    best = both.groupBy(*KEY).agg(F.max(F.struct(*order_cols, *rest)).alias("__w"))
    return best.select(*KEY, *[F.col(f"__w.{c}").alias(c) for c in [*order_cols, *rest]])


def upsert_counts(existing: DataFrame, incoming: DataFrame, merged: DataFrame) -> DataFrame:
    """inserted = new keys not present before, replaced = new keys already present, total rows."""
    old = existing.select(*KEY).distinct().withColumn("__old", F.lit(True))
    new = incoming.select(*KEY).distinct()
    j = new.join(old, [new[k].eqNullSafe(old[k]) for k in KEY], "left")
    c = j.agg(F.count_if(F.col("__old").isNull()).alias("inserted"),
              F.count_if(F.col("__old").isNotNull()).alias("replaced"))
    return c.crossJoin(merged.agg(F.count(F.lit(1)).alias("total")))


def _has_versions(spark: SparkSession, pending_dir: str) -> bool:
    """Whether the pending table has a published version, asked of its own file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{pending_dir.rstrip('/')}/version=*")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def run_stream(spark: SparkSession, source_dir: str, schema, pending_dir: str, checkpoint_location: str,
               gap_start: str, as_of: str | None = None, trigger_available_now: bool = True,
               transform=None, path_glob: str | None = None):
    """Structured Streaming intake: each micro-batch is validated and merged (last wins) into the
    pending table.  Every batch writes a complete new ``version=<batch_id>`` partition with dynamic
    partition overwrite, so a retried batch rewrites only its own version (idempotent) and readers
    take the newest version below the batch being written."""
    as_of = as_of or date.today().replace(day=1).isoformat()

    def merge(batch: DataFrame, batch_id: int) -> None:
        if transform is not None:  # e.g. raw events -> incoming observation columns
            batch = transform(batch)
        acc = (accepted(validate(batch, gap_start, as_of))
               .withColumn("ingested_batch", F.lit(batch_id).cast("long"))
               .withColumn("source_row", F.lit(0).cast("long")))  # keys are unique inside an accepted batch
        latest = None
        if _has_versions(spark, pending_dir):  # a table that is there but cannot be read fails the batch
            pending = spark.read.parquet(pending_dir).where(F.col("version") < batch_id)
            latest = pending.agg(F.max("version")).first()[0]
        if latest is None:
            merged = acc
        else:
            existing = pending.where(F.col("version") == latest).drop("version")
            merged = upsert_last(existing, acc.select(*existing.columns))
        (merged.withColumn("version", F.lit(batch_id).cast("long")).write
         .option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("version").parquet(pending_dir))

    reader = spark.readStream.schema(schema)
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    stream = reader.parquet(source_dir)
    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if trigger_available_now else writer
    return writer.start()


def run_bucketed_stream(spark: SparkSession, source_dir: str, schema, table, checkpoint_location: str,
                        gap_start: str, as_of: str, transform=None):
    """Structured Streaming intake into a ``BucketTable``: each micro-batch is validated, and its accepted
    rows replace those of the same key in the buckets they fall into.  A micro-batch run again after its
    commit is recognised by its number."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        if transform is not None:
            batch = transform(batch)
        acc = accepted(validate(batch, gap_start, as_of)).withColumn("ingested_batch", F.lit(batch_id).cast("long"))
        # one row a key inside an accepted batch: the batch number alone decides
        table.merge(batch_id, acc, lambda old, new: upsert_last(old, new, ("ingested_batch",)))

    return (spark.readStream.schema(schema).parquet(source_dir).writeStream.foreachBatch(merge)
            .option("checkpointLocation", checkpoint_location).trigger(availableNow=True).start())
