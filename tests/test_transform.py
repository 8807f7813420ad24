"""Cleaning operators on small rows of our own."""

import datetime as dt
import json

from pyspark.sql import functions as F

from lakehold.functions.columns import ts_ntz
from lakehold.operators import transform, upsert
from lakehold.sources import grid, landing
from lakehold.sources.schemas import CONNECTION, CONNECTION_FIELDS, STATION_FIELDS

STATION = {
    "ID": 9017, "UUID": "doc-a",
    "AddressInfo": {"Title": "Depot 4", "AddressLine1": "Dock Road", "Town": "Harrison", "StateOrProvince": "NJ",
                    "Latitude": 40.51, "Longitude": -74.02},
    "Connections": [{"ConnectionTypeID": 33, "ConnectionType": {"Title": "Combo"}, "LevelID": 3, "Amps": 125,
                     "Voltage": 400, "PowerKW": 50.5, "Quantity": 1, "CurrentType": {"Title": "DC"}}],
    "StatusType": {"Title": "Planned", "ID": 20},
    "DateLastStatusUpdate": "2023-07-09T05:30:00Z", "DateCreated": "2022-03-04T00:00:00Z",
    "DataProvider": {"WebsiteURL": "https://data.invalid/a"},
}


def test_station_document_extraction(spark):
    df = spark.createDataFrame([(json.dumps(STATION),)], "raw_text string")
    out = transform.extract_json(df, "raw_text", STATION_FIELDS)
    assert len(out.columns) == 12
    r = transform.standardize_values(out, "state_or_province").first()
    assert r.station_id == "9017" and r.state_or_province == "New Jersey" and r.latitude == "40.51"
    assert json.loads(r.connections)[0]["PowerKW"] == 50.5
    typed = transform.cast_columns(out, {"latitude": "double", "longitude": "double"}).first()
    assert typed.latitude == 40.51 and typed.longitude == -74.02


def test_malformed_document_gives_nulls(spark):
    df = spark.createDataFrame([("{not json",), ('{"ID": null}',)], "raw_text string")
    rows = transform.extract_json(df, "raw_text", STATION_FIELDS).collect()
    assert all(r.station_id is None and r.town is None for r in rows)


def test_explode_connections_cases(spark):
    docs = [(1, json.dumps(STATION["Connections"] * 2)), (2, "[]"), (3, None), (4, '[{"LevelID": ')]
    df = spark.createDataFrame(docs, "station_id int, connections string")
    ex = transform.explode_json_array(df, "connections", CONNECTION, keep=["station_id"], alias="conn")
    flat = transform.flatten(ex, CONNECTION_FIELDS, keep=["station_id"])
    counts = {r.station_id: r["count"] for r in flat.groupBy("station_id").count().collect()}
    assert counts == {1: 2, 2: 1, 3: 1, 4: 1}
    r = flat.where("station_id = 1").first()
    assert r.power_kw == 50.5 and r.connection_type == "Combo" and r.current_type == "DC"
    assert len(flat.columns) == 9


def test_bronze_metadata_keeps_every_document_without_uuid(spark):
    docs = [json.dumps({"UUID": u, "n": n}) if u else text for n, (u, text) in enumerate(
        [("k7", ""), ("k7", ""), ("k7", ""), ("k8", ""), (None, "{broken"), (None, "[1, 2]"), (None, "[1, 2]"), (None, None)])]
    df = spark.createDataFrame([(d,) for d in docs], "raw_text string")
    out = landing.add_bronze_metadata(df, "2023-05-06 00:00:00")
    assert set(out.columns) == {"raw_text", "UUID", "ingest_timestamp", "source_file"}
    by = {}
    for r in out.collect():
        by.setdefault(r.UUID, []).append(r.raw_text)
    assert {k: len(v) for k, v in by.items()} == {"k7": 1, "k8": 1, None: 4}
    # the same document stays, in whatever order they come
    again = landing.add_bronze_metadata(df.orderBy(F.desc("raw_text")).repartition(3), "2023-05-06 00:00:00")
    assert again.where("UUID = 'k7'").first().raw_text == by["k7"][0]


def test_dedup_all_and_keys(spark):
    df = spark.createDataFrame([("p", 10, None), ("p", 10, "m"), ("q", None, "m"), ("q", None, "m"), (None, None, None)], "g string, n int, s string")
    assert transform.dedup(df).count() == 4
    assert sorted(map(str, (r.g for r in transform.dedup(df, ["g", "n"]).collect()))) == ["None", "p", "q"]


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, 1, "old"), (1, 2, "new"), (None, 5, "n1"), (None, 6, "n2")], "k int, t int, v string")
    out = {r.k: r.v for r in transform.latest_per_key(df, ["k"], ["t"]).collect()}
    assert out == {1: "new", None: "n2"}


def test_incremental_filter_strict(spark):
    base = dt.datetime(2022, 9, 30, 6)
    rows = [(h, base + dt.timedelta(hours=h)) for h in range(-3, 4)] + [(99, None)]
    df = spark.createDataFrame(rows, "id int, ingest_timestamp timestamp_ntz")
    assert sorted(r.id for r in transform.incremental_filter(df, "2022-09-30 06:00:00").collect()) == [1, 2, 3]


def test_buffer(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 1, 1, 12, 0),), (dt.datetime(2025, 1, 1, 0, 10),)], "t timestamp_ntz")
    out = [r[0] for r in df.select(transform.buffered("t", 15)).collect()]
    assert out == [dt.datetime(2025, 1, 1, 11, 45), dt.datetime(2024, 12, 31, 23, 55)]


def test_zone_rounding_half_up(spark):
    df = spark.createDataFrame([(40.75, -74.25), (40.74, -73.96)], "latitude double, longitude double")
    rows = transform.assign_zone(df).collect()
    assert (rows[0].weather_zone_lat, rows[0].weather_zone_lon) == (40.8, -74.3)
    assert (rows[1].weather_zone_lat, rows[1].weather_zone_lon) == (40.7, -74.0)
    assert transform.distinct_zones(transform.assign_zone(df.union(df))).count() == 2


def test_request_grid_matches_arange(spark):
    import numpy as np

    for box in [(40.0, -74.0, 40.2, -73.8), (40.0, -74.0, 40.05, -73.95), (40.4874, -74.2591, 40.9176, -73.6995)]:
        g = grid.request_grid(spark, *box, 0.1).collect()
        expect = [(a, b) for a in np.arange(box[0], box[2], 0.1) for b in np.arange(box[1], box[3], 0.1)]
        assert sorted((r.lat, r.lon) for r in g) == sorted((float(a), float(b)) for a, b in expect)
    assert grid.request_grid(spark, 40.0, -74.0, 40.0, -74.0).count() == 0


def test_upsert_one_row_per_key(spark):
    t = spark.createDataFrame([(10, "x", 1), (20, "y", 1), (None, "z", 1), (30, "w", 1)], "k int, v string, n int")
    s = spark.createDataFrame([(20, "new", 5), (20, "newer", 6), (40, "a", 1), (40, "a", 1), (40, "b", 0), (None, "nil", 2)], "k int, v string, n int")
    out = sorted(((r.k or -1, r.v, r.n) for r in upsert.upsert(t, s, ["k"], ["n"]).collect()))
    assert out == [(-1, "nil", 2), (10, "x", 1), (20, "newer", 6), (30, "w", 1), (40, "a", 1)]
    assert [(r.k, r.v) for r in upsert.inserted_rows(t, s, ["k"], ["n"]).collect()] == [(40, "a")]
    # the choice does not depend on the input's order
    again = upsert.upsert(t, s.orderBy(F.desc("v")).repartition(3), ["k"])
    assert sorted(map(repr, again.collect())) == sorted(map(repr, upsert.upsert(t, s, ["k"]).collect()))
    assert upsert.upsert(t, s.limit(0), ["k"]).count() == 4 and upsert.upsert(t.limit(0), s, ["k"]).count() == 3



def test_ingest_timestamp_is_one_constant(spark):
    df = transform.add_ingest_timestamp(spark.range(5), "2025-01-01 00:00:00")
    assert df.select("ingest_timestamp").distinct().count() == 1
    assert df.schema["ingest_timestamp"].dataType.simpleString() == "timestamp_ntz"
    assert df.where(F.col("ingest_timestamp") == ts_ntz("2025-01-01 00:00:00")).count() == 5


def test_publish_and_gated_publish(spark, tmp_path):
    import pytest

    from lakehold.sources import tables

    name = f"pub_{abs(hash(str(tmp_path))) % 10**8}"
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    assert tables.publish_gated(spark, name, df, str(tmp_path / "v1")) == 2
    assert spark.table(name).count() == 2
    bad = spark.createDataFrame([(3, None)], "id int, v string")
    with pytest.raises(tables.GateFailed):
        tables.publish_gated(spark, name, bad, str(tmp_path / "v2"))
    assert spark.table(name).count() == 2  # the failing state was never published
    assert tables.publish(spark, name, bad, str(tmp_path / "v3")) == 1
    assert spark.table(name).count() == 1
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_create_if_absent_and_remove_nulls(spark, tmp_path):
    from lakehold.sources import tables
    from lakehold.sources.schemas import STATIONS_TABLE

    name = f"stations_{abs(hash(str(tmp_path))) % 10**8}"
    t = tables.create_if_absent(spark, name, STATIONS_TABLE, str(tmp_path / "st"))
    assert t.count() == 0 and t.columns == STATIONS_TABLE.fieldNames()
    assert tables.create_if_absent(spark, name, STATIONS_TABLE).count() == 0  # second call keeps it
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (1.0, None)], "latitude double, longitude double")
    assert transform.remove_nulls(df, ["latitude", "longitude"]).count() == 1


def test_new_watermark_from_source(spark):
    import datetime as dt

    from lakehold.operators import control

    df = spark.createDataFrame([(dt.datetime(2025, 1, 1),), (dt.datetime(2025, 1, 3),)], "ingest_timestamp timestamp_ntz")
    assert control.new_watermark(df).first()[0] == dt.datetime(2025, 1, 3)


def test_to_json_documents_round_trip(spark):
    df = spark.createDataFrame([(1, "a", 2.5)], "ID int, UUID string, v double")
    doc = json.loads(landing.to_json_documents(df).first().raw_text)
    assert doc == {"ID": 1, "UUID": "a", "v": 2.5}
