"""Queries: intake validation, gap report, summary and last-wins upsert on events re-shaped as
incoming observation files; hash / Bernoulli / stratified samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from isotherm.operators import sampling as sm
from isotherm.plans.q_clean import clean_frame
from isotherm.plans.registry import register
from isotherm.sources.tables import table
from isotherm.streaming import intake as ik

# Intake window for the driver events (January 2024 events map to 2023-01 .. 2025-06).
GAP_START, AS_OF = "2023-06-01", "2024-12-01"
FIRST_BATCH_END, SECOND_BATCH_START = "2024-01-16", "2024-01-10"


def incoming(spark, sf, where=None):
    e = table(spark, sf, "events")
    if where is not None:
        e = e.where(where)
    return incoming_from_events(e)


def incoming_from_events(e):
    """events -> an incoming observation file with faults: mid-month and pre-start dates, future
    months, blank city, NULL country, latitude / temperature out of range, negative uncertainty,
    duplicate keys inside the batch."""
    day = F.dayofmonth("ts")
    obs = F.when(F.col("event_type") == "error", F.to_date("ts")).otherwise(
        F.make_date((F.lit(2023) + ((day - 1) / 12).cast("int")), ((day - 1) % 12 + 1), F.lit(1)))
    uid = F.col("user_id")
    return e.select(
        (F.col("event_id") + 2).alias("source_row"),
        obs.alias("observation_date"),
        F.when((F.col("event_type") == "signup") & (uid % 7 == 0), F.lit(""))
         .otherwise(F.concat(F.lit("user_"), uid.cast("string"), F.lit("_"), F.col("event_type"))).alias("city_name"),
        F.when(uid % 11 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("segment_"), (uid % 5).cast("string"))).alias("country_name"),
        (((uid * 37) % 181 - 90).cast("double") + F.when(F.col("value") > 300, 100.0).otherwise(0.0))
        .alias("latitude"),
        ((uid * 53) % 361 - 180).cast("double").alias("longitude"),
        (F.col("value") / 4.0 - 10.0).alias("city_average_temperature"),
        F.when((F.col("event_type") == "click") & (F.col("value") < 5), F.lit(-0.5))
         .otherwise(F.col("value") / 100.0).alias("city_average_temperature_uncertainty"),
        F.when(F.col("event_type") == "purchase", F.lit("upload")).alias("data_source"),
    )


def incoming_df(spark, sf, where=None):
    return incoming(spark, sf, where)


SRC_SQL = """src AS (SELECT event_id + 2 AS source_row,
  CASE WHEN event_type = 'error' THEN CAST(ts AS DATE)
       ELSE make_date(2023 + (day(ts) - 1) // 12, (day(ts) - 1) % 12 + 1, 1) END AS observation_date,
  CASE WHEN event_type = 'signup' AND user_id % 7 = 0 THEN ''
       ELSE 'user_' || CAST(user_id AS VARCHAR) || '_' || event_type END AS city_name,
  CASE WHEN user_id % 11 = 0 THEN NULL ELSE 'segment_' || CAST(user_id % 5 AS VARCHAR) END AS country_name,
  CAST((user_id * 37) % 181 - 90 AS DOUBLE) + CASE WHEN value > 300 THEN 100.0 ELSE 0.0 END AS latitude,
  CAST((user_id * 53) % 361 - 180 AS DOUBLE) AS longitude,
  value / CAST(4 AS DOUBLE) - CAST(10 AS DOUBLE) AS city_average_temperature,
  CASE WHEN event_type = 'click' AND value < 5 THEN -0.5 ELSE value / CAST(100 AS DOUBLE) END
    AS city_average_temperature_uncertainty,
  CASE WHEN event_type = 'purchase' THEN 'upload' END AS data_source
  FROM events {where})"""

_K = ", ".join(ik.KEY)
_KON = " AND ".join(f"s.{k} IS NOT DISTINCT FROM k.{k}" for k in ik.KEY)


def _validated_sql(name: str, where: str = "", source: str | None = None) -> str:
    src = (source or SRC_SQL).replace("src AS", f"{name}_src AS", 1).replace("{where}", where)
    return f"""{src},
{name}_k AS (SELECT {_K}, count(*) AS kc FROM {name}_src GROUP BY ALL),
{name} AS (SELECT s.*, concat_ws('; ',
  CASE WHEN s.observation_date IS NULL THEN '{ik.MESSAGES[0]}' END,
  CASE WHEN s.observation_date IS NOT NULL AND day(s.observation_date) <> 1 THEN '{ik.MESSAGES[1]}' END,
  CASE WHEN s.observation_date < DATE '{GAP_START}' THEN '{ik.MESSAGES[2]}' END,
  CASE WHEN s.observation_date > DATE '{AS_OF}' THEN '{ik.MESSAGES[3]}' END,
  CASE WHEN s.city_name IS NULL OR s.city_name = '' THEN '{ik.MESSAGES[4]}' END,
  CASE WHEN s.country_name IS NULL OR s.country_name = '' THEN '{ik.MESSAGES[5]}' END,
  CASE WHEN s.latitude IS NULL OR NOT (s.latitude BETWEEN -90 AND 90) THEN '{ik.MESSAGES[6]}' END,
  CASE WHEN s.longitude IS NULL OR NOT (s.longitude BETWEEN -180 AND 180) THEN '{ik.MESSAGES[7]}' END,
  CASE WHEN s.city_average_temperature IS NULL OR NOT (s.city_average_temperature BETWEEN -90 AND 60)
       THEN '{ik.MESSAGES[8]}' END,
  CASE WHEN s.city_average_temperature_uncertainty < 0 THEN '{ik.MESSAGES[9]}' END,
  CASE WHEN k.kc > 1 THEN '{ik.MESSAGES[10]}' END) AS validation_error
  FROM {name}_src s LEFT JOIN {name}_k k ON {_KON})"""


VALIDATE_SQL = f"WITH {_validated_sql('v')}\nSELECT * FROM v"


def validated(spark, sf, where=None):
    return ik.validate(incoming_df(spark, sf, where), GAP_START, AS_OF)


@register("ingest_validate", VALIDATE_SQL, ids="ING-01 ING-02 ING-03 WIN-15 SCA-10")
def ingest_validate(spark, sf):
    return validated(spark, sf)


_ACC = ("SELECT observation_date, city_name, country_name, latitude, longitude, city_average_temperature, "
        "city_average_temperature_uncertainty, coalesce(data_source, 'user_observation') AS data_source")
GAP_CTE = f""", acc AS ({_ACC} FROM v WHERE validation_error = ''),
per AS (SELECT city_name, country_name, latitude, longitude, max(observation_date) AS latest_observation,
  list(DISTINCT CAST(date_trunc('month', observation_date) AS DATE)) AS present FROM acc GROUP BY ALL),
e AS (SELECT *, list_transform(generate_series(DATE '{GAP_START}', CAST(date_trunc('month', latest_observation) AS DATE),
  INTERVAL 1 MONTH), lambda x: CAST(x AS DATE)) AS expected FROM per),
m AS (SELECT *, list_sort(list_filter(expected, lambda x: NOT list_contains(present, x))) AS missing FROM e),
gaps AS (SELECT city_name, country_name, latitude, longitude, latest_observation,
  CAST(len(expected) AS BIGINT) AS months_expected, CAST(len(present) AS BIGINT) AS months_supplied,
  CAST(len(missing) AS BIGINT) AS months_missing,
  round(CAST(len(present) AS DOUBLE) * 100 / len(expected), 2) AS completeness_percent,
  array_to_string(list_transform(missing[1:6], lambda x: strftime(x, '%Y-%m')), ', ') AS first_missing_months FROM m)
"""


@register("gap_report", f"WITH {_validated_sql('v')}{GAP_CTE}SELECT * FROM gaps", round_cols=["completeness_percent"],
          ids="ING-04 SET-06 SCA-03 SCA-10")
def gap_report(spark, sf):
    return ik.gap_report(ik.accepted(validated(spark, sf)), GAP_START)


SUMMARY_SQL = f"""WITH {_validated_sql('v')}{GAP_CTE}
SELECT count(*) FILTER (WHERE validation_error = '') AS accepted, count(*) FILTER (WHERE validation_error <> '') AS rejected,
  count(DISTINCT CASE WHEN validation_error = '' THEN city_name END) AS cities,
  (SELECT CAST(coalesce(sum(months_missing), 0) AS BIGINT) FROM gaps) AS total_missing_months FROM v"""


@register("ingest_summary", SUMMARY_SQL, ids="ING-05")
def ingest_summary(spark, sf):
    v = validated(spark, sf)
    return ik.summary(v, ik.gap_report(ik.accepted(v), GAP_START))


def _batches(spark, sf):
    old = validated(spark, sf, F.col("ts") < F.lit(FIRST_BATCH_END).cast("timestamp_ntz"))
    new = validated(spark, sf, F.col("ts") >= F.lit(SECOND_BATCH_START).cast("timestamp_ntz"))

    def acc(v, batch):
        return (v.where(F.col("validation_error") == "")
                .select(*ik.KEY, "city_average_temperature", "city_average_temperature_uncertainty",
                        F.coalesce("data_source", F.lit("user_observation")).alias("data_source"),
                        F.lit(batch).cast("long").alias("ingested_batch"), "source_row"))
    return acc(old, 1), acc(new, 2)


_UPSERT_CTES = (f"WITH {_validated_sql('v1', f'WHERE ts < TIMESTAMP {chr(39)}{FIRST_BATCH_END}{chr(39)}')},\n"
                f"{_validated_sql('v2', f'WHERE ts >= TIMESTAMP {chr(39)}{SECOND_BATCH_START}{chr(39)}')},\n"
                f"""a1 AS ({_ACC}, CAST(1 AS BIGINT) AS ingested_batch, source_row FROM v1 WHERE validation_error = ''),
a2 AS ({_ACC}, CAST(2 AS BIGINT) AS ingested_batch, source_row FROM v2 WHERE validation_error = ''),
merged AS (SELECT * FROM (SELECT * FROM a1 UNION ALL SELECT * FROM a2)
  QUALIFY row_number() OVER (PARTITION BY {_K} ORDER BY ingested_batch DESC, source_row DESC) = 1)
""")


@register("upsert_last", _UPSERT_CTES + "SELECT * FROM merged", ids="ING-06 WIN-16 SNK-08 SET-03")
def upsert_last(spark, sf):
    old, new = _batches(spark, sf)
    return ik.upsert_last(old, new)


UPSERT_COUNTS_SQL = _UPSERT_CTES + f"""
SELECT count(*) FILTER (WHERE o.k IS NULL) AS inserted, count(*) FILTER (WHERE o.k IS NOT NULL) AS replaced,
  (SELECT count(*) FROM merged) AS total
FROM (SELECT DISTINCT {_K} FROM a2) n LEFT JOIN (SELECT DISTINCT {_K}, TRUE AS k FROM a1) o
  ON {' AND '.join(f'n.{k} IS NOT DISTINCT FROM o.{k}' for k in ik.KEY)}"""


@register("upsert_counts", UPSERT_COUNTS_SQL, ids="ING-06 SET-05 JON-20")
def upsert_counts(spark, sf):
    old, new = _batches(spark, sf)
    return ik.upsert_counts(old, new, ik.upsert_last(old, new))


# ---------------------------------------------------------------- uploads as text files

UPLOAD = [c for c in ik.OUTPUT]


def upload_text(spark, sf):
    """The events as the text file a user would upload, in event order: the faults of ``incoming`` and,
    as text can hold them, dates that are no dates, longitudes off the map and padded names."""
    rows = incoming_from_events(table(spark, sf, "events").select("*"))
    uid = F.col("user_id")
    e = table(spark, sf, "events").select(
        (F.col("event_id") + 2).alias("source_row"), F.col("event_id"), uid, F.col("event_type"))
    j = e.join(rows, "source_row")
    text = {c: F.col(c).cast("string") for c in UPLOAD}
    text["observation_date"] = F.when((F.col("event_type") == "error") & (uid % 13 == 0), F.lit("not a date")).otherwise(text["observation_date"])
    text["longitude"] = F.when(uid % 17 == 0, (F.col("longitude") + 400).cast("string")).otherwise(text["longitude"])
    text["city_name"] = F.when(uid % 3 == 0, F.concat(F.lit("  "), "city_name", F.lit(" "))).otherwise(F.col("city_name"))
    return j.orderBy("event_id").select(*[text[c].alias(c) for c in UPLOAD])


_UPLOAD_SRC = """src AS (SELECT row_number() OVER (ORDER BY event_id) + 1 AS source_row,
  CASE WHEN event_type = 'error' AND user_id % 13 = 0 THEN NULL WHEN event_type = 'error' THEN CAST(ts AS DATE)
       ELSE make_date(2023 + (day(ts) - 1) // 12, (day(ts) - 1) % 12 + 1, 1) END AS observation_date,
  CASE WHEN event_type = 'signup' AND user_id % 7 = 0 AND user_id % 3 <> 0 THEN NULL
       WHEN event_type = 'signup' AND user_id % 7 = 0 THEN ''
       ELSE 'user_' || CAST(user_id AS VARCHAR) || '_' || event_type END AS city_name,
  CASE WHEN user_id % 11 = 0 THEN NULL ELSE 'segment_' || CAST(user_id % 5 AS VARCHAR) END AS country_name,
  CAST((user_id * 37) % 181 - 90 AS DOUBLE) + CASE WHEN value > 300 THEN 100.0 ELSE 0.0 END AS latitude,
  CAST((user_id * 53) % 361 - 180 AS DOUBLE) + CASE WHEN user_id % 17 = 0 THEN 400.0 ELSE 0.0 END AS longitude,
  value / CAST(4 AS DOUBLE) - CAST(10 AS DOUBLE) AS city_average_temperature,
  CASE WHEN event_type = 'click' AND value < 5 THEN -0.5 ELSE value / CAST(100 AS DOUBLE) END
    AS city_average_temperature_uncertainty,
  CASE WHEN event_type = 'purchase' THEN 'upload' END AS data_source
  FROM events {where})"""
REJECTED_SQL = (f"WITH {_validated_sql('v', source=_UPLOAD_SRC)}\nSELECT source_row, {', '.join(ik.OUTPUT)}, validation_error "
                "FROM v WHERE validation_error <> ''")


@register("ingest_rejected", REJECTED_SQL, ids="ING-03 ING-02 PRJ-05")
def ingest_rejected(spark, sf):
    """Rejected rows of an uploaded CSV, each with its row number in the file (2 is the first below the
    header) and the rules it broke: text that is no date or number is a reason, not a failed load."""
    import uuid

    from isotherm.session import scratch_path
    from isotherm.sources import files as io
    from isotherm.sources.numbered import scan_csv_numbered
    path = scratch_path(spark, f"upload_{uuid.uuid4().hex}")
    io.write_csv(upload_text(spark, sf), path, UPLOAD)
    return ik.rejected(ik.validate(ik.typed(scan_csv_numbered(spark, path, UPLOAD)), GAP_START, AS_OF))


# ---------------------------------------------------------------- bucketed last-wins table

# Three uploads of the events by time; they overlap, so keys of one replace those of the one before.
UPLOADS = [("2024-01-01", "2024-01-13"), ("2024-01-10", "2024-01-22"), ("2024-01-18", "2024-03-01")]


def _upload_where(start: str, end: str) -> str:
    return f"WHERE ts >= TIMESTAMP '{start}' AND ts < TIMESTAMP '{end}'"


BUCKET_SQL = "WITH " + ",\n".join(_validated_sql(f"v{i}", _upload_where(*u)) for i, u in enumerate(UPLOADS)) + f""",
every AS ({' UNION ALL '.join(f"{_ACC}, CAST({i} AS BIGINT) AS ingested_batch FROM v{i} WHERE validation_error = ''" for i in range(len(UPLOADS)))})
SELECT * FROM every QUALIFY row_number() OVER (PARTITION BY {_K} ORDER BY ingested_batch DESC) = 1"""


def bucket_schema():
    from pyspark.sql import types as T
    kinds = {"observation_date": T.DateType(), "city_name": T.StringType(), "country_name": T.StringType(), "data_source": T.StringType()}
    return T.StructType([*(T.StructField(c, kinds.get(c, T.DoubleType())) for c in ik.OUTPUT), T.StructField("ingested_batch", T.LongType())])


def bucketed_intake(spark, sf, base: str, buckets: int = 16):
    """Three uploads, each one micro-batch of the same checkpointed stream into a bucketed table."""
    from isotherm.streaming.buckets import BucketTable
    pending = BucketTable(spark, f"{base}/pending", ik.KEY, bucket_schema(), buckets)
    events = table(spark, sf, "events")
    for start, end in UPLOADS:
        span = (F.col("ts") >= F.lit(start).cast("timestamp_ntz")) & (F.col("ts") < F.lit(end).cast("timestamp_ntz"))
        events.where(span).write.mode("append").parquet(f"{base}/uploads")
        ik.run_bucketed_stream(spark, f"{base}/uploads", events.schema, pending, f"{base}/checkpoint", GAP_START, AS_OF,
                               transform=incoming_from_events).awaitTermination()
    return pending


@register("intake_buckets", BUCKET_SQL, ids="SNK-08 ING-06 WIN-16")
def intake_buckets(spark, sf):
    """Structured Streaming over three overlapping uploads: the last reading of a key stays, and a
    micro-batch rewrites only the key buckets it falls into."""
    import uuid

    from isotherm.session import scratch_path
    return bucketed_intake(spark, sf, scratch_path(spark, f"intake_buckets_{uuid.uuid4().hex}")).read()


# ---------------------------------------------------------------- sampling

HASH_SQL = """SELECT * FROM lineitem
WHERE CAST(('0x' || substr(md5(CAST(l_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) % 10000 < 1000"""


@register("sample_hash", HASH_SQL, ids="SAM-03")
def sample_hash(spark, sf):
    """Repeatable 10 % sample keyed on the order: identical rows in Spark and DuckDB."""
    return sm.hash_sample(table(spark, sf, "lineitem"), "l_orderkey", 0.10)


@register("sample_simple", None, ids="SAM-01")
def sample_simple(spark, sf):
    return sm.simple_sample(clean_frame(spark, sf), 0.2, seed=42)


@register("sample_stratified", None, ids="SAM-02")
def sample_stratified(spark, sf):
    from isotherm.functions.labels import ZONE_LABELS, latitude_zone
    z = clean_frame(spark, sf).withColumn("latitude_zone", latitude_zone(F.abs("latitude")))
    return sm.stratified_sample(z, "latitude_zone", 0.2, ZONE_LABELS, seed=42)


@register("bernoulli_scan", None, ids="SRC-10 SET-03")
def bernoulli_scan(spark, sf):
    """A training sample: one fraction per split."""
    from isotherm.plans.q_features import feature_frame
    return sm.bernoulli_scan(feature_frame(spark, sf), {"train": 0.6, "validation": 0.2, "test": 0.2}, seed=42)


STREAM_SQL = f"""WITH {_validated_sql('v')}
{_ACC}, CAST(0 AS BIGINT) AS ingested_batch, CAST(0 AS BIGINT) AS source_row FROM v WHERE validation_error = ''"""


@register("intake_stream", STREAM_SQL, ids="ING-06 SNK-08 ING-01 ING-02")
def intake_stream(spark, sf):
    """Structured Streaming: the events file is read with ``readStream`` (availableNow), each
    micro-batch is re-shaped, validated and upserted through ``foreachBatch`` into a versioned
    pending table in the shared scratch folder; the newest version is returned."""
    import os
    import uuid

    from isotherm.session import scratch_path
    base = scratch_path(spark, f"intake_stream_{uuid.uuid4().hex[:12]}")
    schema = table(spark, sf, "events").schema
    q = ik.run_stream(spark, sf, schema, os.path.join(base, "pending"), os.path.join(base, "checkpoint"),
                      GAP_START, AS_OF, transform=incoming_from_events, path_glob="events.parquet")
    q.awaitTermination()
    pending = spark.read.parquet(os.path.join(base, "pending"))
    latest = pending.agg(F.max("version")).first()[0]
    return pending.where(F.col("version") == latest).drop("version")
