"""The bucketed last-wins table, the streamed uploads and the numbered CSV scan."""

import tempfile
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isotherm.plans import q_intake as qi
from isotherm.sources import commits
from isotherm.sources.numbered import scan_csv_numbered
from isotherm.streaming import intake as ik
from isotherm.streaming.buckets import BucketTable

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType()), T.StructField("b", T.LongType())])


def last(old, new):
    both = old.unionByName(new)
    best = both.groupBy("k").agg(F.max(F.struct("b", "v")).alias("w"))
    return best.select("k", F.col("w.v").alias("v"), F.col("w.b").alias("b"))


@pytest.fixture()
def home():
    return f"file://{tempfile.mkdtemp(prefix='isotherm-buckets-')}/table"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_only_touched_buckets_are_rewritten_and_a_replay_changes_nothing(spark, home):
    t = BucketTable(spark, home, ["k"], SCHEMA, buckets=8)
    assert rows(t.read()) == []
    frame = lambda pairs, b: spark.createDataFrame([(k, v, b) for k, v in pairs], SCHEMA)
    t.merge(0, frame([(f"k{i}", i) for i in range(40)] + [(None, -1)], 0), last)
    before = t.versions()
    assert len(rows(t.read())) == 41 and set(before.values()) == {0}
    touched = t.merge(1, frame([("k3", 300), ("new", 1)], 1), last)
    assert 1 <= len(touched) <= 2 and {b for b, v in t.versions().items() if v == 1} == set(touched)
    want = rows(t.read())
    assert ("k3", 300, 1) in want and ("new", 1, 1) in want and len(want) == 42
    assert t.merge(1, frame([("k3", -5)], 1), last) == [] and rows(t.read()) == want       # replayed
    assert t.merge(2, frame([], 2), last) == [] and rows(t.read()) == want                 # nothing in it
    t.merge(3, frame([("k3", 301), (None, -2)], 3), last)
    assert ("k3", 301, 3) in rows(t.read()) and (None, -2, 3) in rows(t.read())
    # versions that the newest commits do not name are gone
    assert len(commits.children(spark, f"{home}/_commits")) == t.keep_commits


def test_a_batch_that_failed_half_way_is_not_seen(spark, home):
    t = BucketTable(spark, home, ["k"], SCHEMA, buckets=4)
    t.merge(0, spark.createDataFrame([("a", 1, 0)], SCHEMA), last)
    b = next(iter(t.versions()))
    spark.createDataFrame([("a", 9, 1)], SCHEMA).write.parquet(f"{home}/bucket={b}/version=1")     # written, never committed
    assert rows(t.read()) == [("a", 1, 0)]
    t.merge(1, spark.createDataFrame([("a", 2, 1)], SCHEMA), last)
    assert rows(t.read()) == [("a", 2, 1)]


def test_streamed_uploads_replace_keys(spark):
    sf = "/root/testdata/sf0.001"
    t = qi.bucketed_intake(spark, sf, f"file://{tempfile.mkdtemp(prefix='isotherm-uploads-')}", buckets=4)
    got = t.read()
    assert got.groupBy(*ik.KEY).count().where("count > 1").count() == 0
    assert {r[0] for r in got.select("ingested_batch").distinct().collect()} <= {0, 1, 2} and got.count() > 0


def test_numbered_scan_keeps_file_order_over_splits(spark, tmp_path):
    n = 5000
    for part in range(3):
        lines = [f"{part * n + i},{'x' * (i % 50)}" for i in range(n)]
        (tmp_path / f"part-{part}.csv").write_text("id,text\n" + "\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = scan_csv_numbered(spark, f"file://{tmp_path}", ["id", "text"])
        assert got.count() == 3 * n and got.where(F.col("source_row") != F.col("id").cast("long") + 2).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_text_that_is_no_value_is_a_reason(spark, tmp_path):
    (tmp_path / "u.csv").write_text(
        "observation_date,city_name,country_name,latitude,longitude,city_average_temperature\n"
        "2024-01-01, Rome ,Italy,41.9,12.5,8.1\nyesterday,Rome,Italy,41.9,12.5,8.1\n2024-02-01,Rome,Italy,41.9,190,warm\n"
        "2024-03-05,,Italy,north,12.5,8.1\n")
    raw = scan_csv_numbered(spark, f"file://{tmp_path}", ["observation_date", "city_name", "country_name", "latitude", "longitude",
                                                          "city_average_temperature"])
    v = ik.validate(ik.typed(raw), "2023-06-01", "2024-12-01")
    bad = {r.source_row: r.validation_error for r in ik.rejected(v).collect()}
    M = ik.MESSAGES
    assert bad == {3: M[0], 4: f"{M[7]}; {M[8]}", 5: f"{M[1]}; {M[4]}; {M[6]}"}
    ok = ik.accepted(v).collect()
    assert [(r.observation_date, r.city_name, r.data_source) for r in ok] == [(date(2024, 1, 1), "Rome", "user_observation")]
