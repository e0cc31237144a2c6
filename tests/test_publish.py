"""Write, audit, publish: a failed audit raises and the version before it stays; stages and their manifest."""

import tempfile

import pytest
from pyspark.sql import functions as F

from isotherm.operators import publish as pb
from isotherm.operators import quality as dq
from isotherm.plans import materialize as mat
from isotherm.sources import commits

SCHEMA = "d string, city string, t double, u double, flag boolean"
GOOD = [("2000-01", "a", 1.0, 0.1, False), ("2000-02", "a", 2.0, None, True), ("2000-01", "b", 3.0, 0.0, False)]


def spec():
    return pb.AuditSpec(key=["d", "city"], critical=["d", "city", "t"], non_negative=["u"],
                        invalid={"invalid_t": ~F.coalesce(F.col("t").between(-90, 60), F.lit(False))},
                        reported={"flagged": F.col("flag")})


@pytest.fixture()
def home():
    return f"file://{tempfile.mkdtemp(prefix='isotherm-publish-')}/table"


def counts(report):
    return {r.check_name: r.result for r in report.collect()}


def test_audit_counts(spark):
    rows = [*GOOD, GOOD[0], ("2000-02", "a", 99.0, -1.0, None), (None, "c", None, -2.0, True), ("2000-03", None, 5.0, None, False)]
    got = counts(pb.audit(spark.createDataFrame(rows, SCHEMA).repartition(3), spec()))
    assert got == {"rows": 7, "columns": 5, "critical_missing_rows": 2, "business_duplicate_rows": 2, "exact_full_row_duplicates": 1,
                   "negative_uncertainty_cells": 2, "invalid_t": 2, "flagged": 2}


def test_full_row_duplicates_tell_nulls_apart(spark):
    rows = [(None, "x"), ("x", None), (None, None), (None, None)]
    df = spark.createDataFrame(rows, "a string, b string")
    got = counts(pb.audit(df, pb.AuditSpec(key=["a", "b"], critical=["a"])))
    assert got["exact_full_row_duplicates"] == 1 and got["business_duplicate_rows"] == 1


def test_failed_audit_raises_and_keeps_the_published_version(spark, home):
    with pytest.raises(FileNotFoundError):
        pb.read_published(spark, home)
    good = spark.createDataFrame(GOOD, SCHEMA)
    pb.write_audit_publish(good, home, spec(), ["d", "city"], {"t": F.col("t") < 60}, SCHEMA.replace(" string", "").replace(" double", "").replace(" boolean", "").split(", "))
    first = pb.published_version(spark, home)
    for rows, failed in (([*GOOD, GOOD[1]], {"business_duplicate_rows": 1, "exact_full_row_duplicates": 1}),
                         ([*GOOD, (None, "z", 1.0, None, None)], {"critical_missing_rows": 1, "not_null:d": 1}),
                         ([*GOOD, ("2001-01", "z", 75.0, None, None)], {"invalid_t": 1, "check:t": 1})):
        with pytest.raises(pb.AuditFailed) as e:
            pb.write_audit_publish(spark.createDataFrame(rows, SCHEMA), home, spec(), ["d", "city"], {"t": F.col("t") < 60})
        assert e.value.failed == failed and counts(e.value.report)["rows"] == 4
        assert pb.published_version(spark, home) == first and pb.read_published(spark, home).count() == 3
    with pytest.raises(ValueError, match="contract"):
        pb.write_audit_publish(good.drop("u"), home, spec(), order=good.columns)
    assert len(pb.drop_unpublished(spark, home)) == 3
    pb.write_audit_publish(spark.createDataFrame([("2002-01", "q", 1.0, None, None)], SCHEMA), home, spec())
    assert pb.read_published(spark, home).count() == 1 and pb.published_version(spark, home) != first


def test_constraints_pass_on_unknown(spark):
    df = spark.createDataFrame([(None,), (5,), (13,)], "m int")
    got = {r.constraint_name: r.violations for r in pb.constraint_violations(df, ["m"], {"m": F.col("m").between(1, 12)}).collect()}
    assert got == {"not_null:m": 1, "check:m": 1}


def test_manifest_and_contract_stop_the_job(spark):
    m = spark.createDataFrame([("a", 1), ("b", 2), ("c", 2)], "k string, r int")
    assert pb.require_manifest(m.where("k < 'c'"), 2, "r").count() == 2
    with pytest.raises(RuntimeError, match="3 rows with 2 different ranks"):
        pb.require_manifest(m, 3, "r")
    report = spark.createDataFrame([("rows", "PASS"), ("ranks", "FAIL")], "metric string, status string")
    with pytest.raises(RuntimeError, match="ranks"):
        dq.raise_on_fail(report)


def test_text_commit_replaces_whole(spark, home):
    assert commits.read_text(spark, f"{home}/x.json") is None and commits.children(spark, home) == []
    for text in ("{}", '{"a": "ü"}'):
        commits.commit_text(spark, f"{home}/x.json", text)
        assert commits.read_text(spark, f"{home}/x.json") == text
    assert [c for c in commits.children(spark, home) if not c.startswith(".")] == ["x.json"]


def test_stage_is_a_pruned_table_with_a_manifest_entry(spark):
    source = f"mem-{tempfile.mktemp()}"
    df = mat.stage(spark, "numbers", source, lambda: spark.range(1000).select("id", (F.col("id") % 7).alias("k"), F.lit("x").alias("s")))
    again = mat.stage(spark, "numbers", source, lambda: pytest.fail("built twice"))
    assert again.agg(F.sum("id")).first()[0] == 499500
    plan = df.where("k = 3").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint,k:bigint>" in plan and "PushedFilters: [IsNotNull(k), EqualTo(k,3)]" in plan
    mat.stage(spark, "none", source, lambda: spark.range(0).toDF("id"))
    entries = {r.stage: r for r in mat.manifest(spark, source).collect()}
    assert (entries["numbers"].rows, entries["numbers"].columns, entries["none"].rows) == (1000, 3, 0)
    assert entries["numbers"].files > 0 and mat.read_stage(spark, "numbers", source).schema == df.schema
    commits.remove(spark, entries["none"].path)
    assert [r.stage for r in mat.manifest(spark, source).collect()] == ["numbers"]
    with pytest.raises(FileNotFoundError):
        mat.read_stage(spark, "other", source)
