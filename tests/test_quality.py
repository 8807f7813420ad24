import pytest
from pyspark.sql import functions as F

from lakehold.operators import quality


def test_all_null_column_fails(spark):
    df = spark.createDataFrame([(None, None), (None, None)], "id int, value string")
    with pytest.raises(quality.ColumnGateError):
        quality.assert_columns_populated(df)
    gate = {r.column_name: r.passed for r in quality.column_counts(df).collect()}
    assert gate == {"id": False, "value": False}


def test_empty_frame_fails_gate(spark):
    with pytest.raises(quality.ColumnGateError):
        quality.assert_columns_populated(spark.createDataFrame([], "id int"))


def test_populated_frame_passes(spark):
    df = spark.createDataFrame([(1, None), (None, "x")], "id int, value string")
    assert quality.assert_columns_populated(df) is df


def test_quarantine_split(spark):
    df = spark.createDataFrame([(1, 40.7, -74.0), (2, None, -74.0), (3, 40.7, None)],
                               "station_id int, latitude double, longitude double")
    ok, bad = quality.split_valid(df, ["station_id", "latitude", "longitude"])
    assert ok.count() == 1 and bad.count() == 2
    assert sorted(r.reject_reasons[0] for r in bad.collect()) == ["latitude:null", "longitude:null"]


def test_null_in_non_negative_column_is_rejected_not_lost(spark):
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None)], "id int, power_kw double")
    ok, bad = quality.split_valid(df, ["id"], ["power_kw"])
    assert ok.count() + bad.count() == 3
    reasons = {r.id: r.reject_reasons for r in bad.collect()}
    assert reasons == {2: ["power_kw:negative"], 3: ["power_kw:null"]}


def test_validity_never_null(spark):
    df = spark.createDataFrame([(None, None)], "a int, b double")
    r = quality.with_validity(df, ["a"], ["b"]).first()
    assert r.is_valid is False and r.reject_reasons == ["a:null", "b:null"]
    assert quality.with_validity(df, [], []).where(F.col("is_valid")).count() == 1
