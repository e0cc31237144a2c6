"""CSV / JSON / Parquet sources and sinks: declared schema, FAILFAST, contracts, read-back."""

import os
import tempfile
from datetime import date

import pytest
from pyspark.sql import types as T

from isotherm.sources import files as io

SCHEMA = T.StructType([T.StructField("dt", T.DateType()), T.StructField("v", T.DoubleType()),
                       T.StructField("city", T.StringType())])


def test_csv_roundtrip_keeps_padding_quotes_and_nulls(spark):
    base = tempfile.mkdtemp(prefix="isotherm-csv-")
    df = spark.createDataFrame([(date(2000, 1, 1), 1.5, '  "Quoted", city '), (date(2000, 2, 1), None, None)],
                               SCHEMA)
    path = os.path.join(base, "c")
    io.write_csv(df, path, ["dt", "v", "city"])
    back = sorted(io.scan_csv(spark, path, SCHEMA).collect(), key=lambda r: r.dt)
    assert back[0].city == '  "Quoted", city ' and back[0].v == 1.5
    assert back[1].v is None and back[1].city is None
    assert io.read_back_header(spark, path) == ["dt", "v", "city"]


def test_failfast_and_required_files(spark):
    base = tempfile.mkdtemp(prefix="isotherm-csv-")
    bad = os.path.join(base, "bad.csv")
    with open(bad, "w") as fh:
        fh.write("dt,v,city\n2000-01-01,not-a-number,x\n")
    with pytest.raises(Exception):
        io.scan_csv(spark, bad, SCHEMA).collect()
    with pytest.raises(FileNotFoundError):
        io.require_files(spark, {"city": os.path.join(base, "missing.csv")})


def test_table_sink_refuses_non_empty_target_and_checks_keys(spark):
    base = tempfile.mkdtemp(prefix="isotherm-tbl-")
    df = spark.createDataFrame([(date(2000, 1, 1), 1.0, "a"), (date(2000, 1, 1), 2.0, "b")], SCHEMA)
    path = os.path.join(base, "t")
    r = io.write_table(df, path, ["dt", "city"]).first()
    assert r.passed and r.written_rows == 2
    with pytest.raises(Exception):
        io.write_table(df, path, ["dt", "city"])
    assert io.contract_read(spark, path, ["city", "v"]).columns == ["city", "v"]
    with pytest.raises(ValueError):
        io.contract_read(spark, path, ["nope"])


def test_json_contract(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="isotherm-json-"), "meta")
    io.write_json_document(spark, {"target": "t", "features": ["a", "b"]}, path)
    assert io.read_json_contract(spark, path, ["target", "features"])["features"] == ["a", "b"]
    with pytest.raises(KeyError):
        io.read_json_contract(spark, path, ["split_counts"])
