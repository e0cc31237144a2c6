"""A third of the rows on one key: de-duplication, upsert and duplicate flags stay correct and
run as partial aggregates (no key window)."""

from datetime import date

from pyspark.sql import functions as F

from isotherm.operators.clean import keep_first
from isotherm.streaming import intake as ik


def _hot(spark, n=3000):
    rows = [(date(2014, 1, 1) if i % 3 == 0 else date(2014, 1 + i % 12, 1), "Hot" if i % 3 == 0 else f"c{i}",
             "B", 1.0, 2.0, float(i), 1 if i < n // 2 else 2, i) for i in range(n)]
    return spark.createDataFrame(rows, "observation_date date, city_name string, country_name string, "
                                       "latitude double, longitude double, v double, ingested_batch long, "
                                       "source_row long")


def test_keep_first_on_hot_key(spark):
    df = _hot(spark).repartition(8)
    out = keep_first(df, ik.KEY)
    hot = out.where("city_name = 'Hot'").collect()
    assert len(hot) == 1 and hot[0].v == 0.0          # smallest remaining row wins, deterministically
    plan = out._jdf.queryExecution().executedPlan().toString()
    # partial aggregate before the exchange (a hot key is reduced per task), no key window
    assert "Window" not in plan and "partial_min" in plan


def test_upsert_last_on_hot_key(spark):
    df = _hot(spark).repartition(8)
    old, new = df.where("ingested_batch = 1"), df.where("ingested_batch = 2")
    merged = ik.upsert_last(old, new)
    hot = merged.where("city_name = 'Hot'").collect()
    assert len(hot) == 1 and hot[0].source_row == 2997  # latest batch, latest row
    assert merged.count() == df.select(*ik.KEY).distinct().count()


def test_duplicate_flag_on_hot_key(spark):
    df = _hot(spark).drop("ingested_batch", "source_row").withColumnRenamed("v", "city_average_temperature") \
        .withColumn("city_average_temperature_uncertainty", F.lit(None).cast("double")) \
        .withColumn("data_source", F.lit(None).cast("string"))
    v = ik.validate(df, "2013-10-01", "2020-01-01")
    flagged = v.where(F.col("validation_error").contains("duplicate key")).count()
    assert flagged == 1000                             # every row of the repeated key
