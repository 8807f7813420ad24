import json

import pytest

from lakehold.sources import observations

DOC = {"coord": {"lat": 40.7, "lon": -74.0}, "weather": [{"main": "Rain", "description": "light rain"}],
       "main": {"temp": 50.5, "pressure": 1012, "humidity": 80}, "visibility": 10000, "rain": {"1h": 0.3},
       "wind": {"speed": 3.1}, "clouds": {"all": 75}, "dt": 1704067200}


def test_flatten_13_columns_and_defaults(spark):
    no_precip = {k: v for k, v in DOC.items() if k != "rain"}
    df = spark.createDataFrame([(1, json.dumps(DOC)), (2, json.dumps(no_precip))], "id int, raw string")
    ok, bad = observations.split_observations(df, "raw", keep=["id"])
    assert bad.count() == 0 and len(ok.columns) == 14
    r = {x.id: x for x in ok.collect()}
    assert r[1].rain == 0.3 and r[2].rain == 0.0 and r[2].snow == 0.0 and r[1].dt == 1704067200


def test_missing_fields_rejected(spark):
    empty_weather = dict(DOC, weather=[])
    df = spark.createDataFrame([(1, "{}"), (2, json.dumps(empty_weather))], "id int, raw string")
    ok, bad = observations.split_observations(df, "raw", keep=["id"])
    assert ok.count() == 0
    miss = {r.id: r.missing_fields for r in bad.collect()}
    assert "lat" in miss[1] and miss[2] == ["weather", "description"]


def test_no_observations(spark):
    with pytest.raises(observations.NoUpdatesError):
        observations.require_observations(spark.createDataFrame([], "raw string"))
