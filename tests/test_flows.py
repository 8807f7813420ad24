"""Bronze -> silver -> gold on small documents (the reference's integration flow)."""

import json

from pyspark.sql import functions as F

from lakehold.operators import geo
from lakehold.plans import flows
from lakehold.sources import observations
from lakehold.sources.schemas import STATIONS_TABLE

AS_OF = "2025-01-10 00:00:00"


def station(i, status, conns, state="NJ", lat=40.77, lon=-74.0):
    return {"ID": i, "UUID": f"u{i}", "AddressInfo": {"Title": f"S{i}", "AddressLine1": "x", "Town": "t",
            "StateOrProvince": state, "Latitude": lat, "Longitude": lon}, "Connections": conns,
            "StatusType": {"Title": "Operational" if status == 50 else "Unavailable", "ID": status},
            "DateLastStatusUpdate": "2025-01-01T00:00:00Z", "DateCreated": "2024-12-01T00:00:00Z",
            "DataProvider": {"WebsiteURL": "https://example.org"}}


CONN = {"ConnectionTypeID": 1, "ConnectionType": {"Title": "J1772"}, "LevelID": 2, "Amps": 32, "Voltage": 240.0,
        "PowerKW": 7.68, "Quantity": 2, "CurrentType": {"Title": "AC"}}


def test_bronze_to_gold(spark):
    docs = [station(1, 50, [CONN]), station(2, 30, [dict(CONN, LevelID=3)], state="NY"), station(3, 50, []),
            station(1, 50, [CONN])]
    landing = spark.createDataFrame([(json.dumps(d),) for d in docs], "raw_text string")
    bronze = flows.bronze_stations(landing, "2025-01-02 00:00:00")
    assert bronze.count() == 3
    regions = geo.boxes(spark, [("Manhattan", -74.02, 40.70, -73.93, 40.88)])
    rows, bad = flows.silver_station_rows(bronze, "2025-01-01 00:00:00", AS_OF, regions)
    assert bad.count() == 0 and rows.count() == 3
    r = {x.station_id: x for x in rows.collect()}
    assert r["1"].state_or_province == "New Jersey" and r["2"].state_or_province == "New York"
    assert r["1"].town == "Manhattan" and r["1"].weather_zone_lat == 40.8

    empty = spark.createDataFrame([], STATIONS_TABLE).withColumnRenamed("station_sk", "station_sk")
    st = flows.apply_station_history(empty, rows.select(*[c for c in rows.columns]))
    assert st.where("is_current").count() == 3

    conns, conn_bad = flows.connector_rows(rows, AS_OF)
    assert conns.count() == 2 and conn_bad.count() == 1  # the station without connectors
    cempty = spark.createDataFrame([], "station_id string, connection_type_id int, level_id int, connection_type string, "
                                       "amps int, voltage double, power_kw double, quantity int, current_type string, "
                                       "date_last_status_update timestamp_ntz, ingest_timestamp timestamp_ntz, "
                                       "valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean, connection_sk long")
    ch = flows.apply_connector_history(cempty, conns)

    wdoc = {"coord": {"lat": 40.77, "lon": -74.0}, "weather": [{"main": "Thunderstorm", "description": "x"}],
            "main": {"temp": 100.0, "pressure": 1000, "humidity": 50}, "visibility": 1000,
            "wind": {"speed": 1.0}, "clouds": {"all": 1}, "dt": 1736380800}
    wb = spark.createDataFrame([(json.dumps(wdoc),)], "raw string")
    ok, _ = observations.split_observations(wb, "raw")
    ok = ok.withColumn("ingest_timestamp", F.lit("2025-01-09 00:00:00").cast("timestamp_ntz"))
    weather = flows.silver_weather(ok, "2025-01-01 00:00:00", AS_OF)
    weather = flows.upsert_weather(weather.limit(0), weather)

    from lakehold.operators import control
    from lakehold.plans import health

    name = f"ctl_gold_{abs(hash(AS_OF)) % 10**6}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    import tempfile
    root = tempfile.mkdtemp(prefix="gold-test-")
    control.create_control_table(spark, name, f"{root}/ctl")
    wt, inserted = flows.run_weather_batch(spark, name, ok.unionByName(ok), weather.limit(0), f"{root}/weather", AS_OF)
    assert wt.count() == 1 and inserted == 1  # a repeated observation is one row
    wt, inserted = flows.run_weather_batch(spark, name, ok, wt, f"{root}/weather2", AS_OF)
    assert wt.count() == 1 and inserted == 0
    tables, report = flows.run_gold(spark, name, st, ch, wt, f"{root}/gold", AS_OF)
    assert tables["station_facts"].count() == 2
    summary = health.health_summary(report).first()
    assert summary.failed == 0, report.where("status = 'fail'").collect()
    assert {r.layer for r in spark.table(name).collect()} == {"silver", "gold"}
    again, _ = flows.run_gold(spark, name, st, ch, wt, f"{root}/gold", AS_OF)  # a repeated run
    assert again["station_facts"].count() == 2
    later, _ = flows.run_gold(spark, name, st, ch, wt, f"{root}/gold", "2025-01-11 00:00:00")
    assert later["station_facts"].count() == 4 and later["station_dim"].count() == 2  # facts append
    assert control.last_watermark(spark.table(name), "marts", "gold").isoformat() == "2025-01-11T00:00:00"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    facts, sdim, wdim = flows.gold(st, ch, weather, AS_OF)
    f = {x.station_id: x for x in facts.collect()}
    assert set(f) == {"1", "2"}
    assert f["1"].is_operational is True and f["2"].is_operational is False
    assert f["2"].risk_score == 100 and f["1"].risk_score == 75
    assert sdim.count() == 2 and wdim.count() == 1


def control_table(spark, tmp_path):
    from lakehold.operators import control

    name = f"ctl_{abs(hash(str(tmp_path))) % 10**8}"
    return control.create_control_table(spark, name, str(tmp_path / "ctl"))


def empty_store(spark, root):
    store = flows.station_store(root, buckets=8)
    empty = spark.createDataFrame([], STATIONS_TABLE).withColumnRenamed("station_sk", "sk")
    store.init(empty)
    return store


def landed(spark, docs):
    return spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "raw_text string")


def test_run_station_batch_records_and_advances(spark, tmp_path):
    import datetime as dt

    from lakehold.operators import control

    name = control_table(spark, tmp_path)
    bronze = flows.bronze_stations(landed(spark, [station(1, 50, [CONN]), station(2, 30, [CONN], lat=None)]), "2025-01-02 00:00:00")
    store = empty_store(spark, str(tmp_path / "store"))
    valid = flows.run_station_batch(spark, name, bronze, store, str(tmp_path / "q"), AS_OF)
    st = store.state(spark)
    assert valid.count() == 1 and st.where("is_current").count() == 1
    assert spark.read.parquet(str(tmp_path / "q")).count() == 1
    rec = spark.table(name).first()
    assert (rec.status, rec.records_processed, rec.records_failed) == ("success", 1, 1)
    assert rec.last_processed_timestamp == dt.datetime(2025, 1, 2)
    before = sorted(map(repr, st.collect()))
    # the same bronze again: nothing newer than the watermark, state unchanged
    assert flows.run_station_batch(spark, name, bronze, store, str(tmp_path / "q"), AS_OF) is None
    assert sorted(map(repr, store.state(spark).collect())) == before
    assert control.last_watermark(spark.table(name), "stations", "silver") == dt.datetime(2025, 1, 2)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_rejected_batch_is_taken_once_and_replay_safe(spark, tmp_path):
    name = control_table(spark, tmp_path)
    store = empty_store(spark, str(tmp_path / "store"))
    bad = [station(1, 50, [CONN], lat="abc"), station(2, 50, [CONN], lat="NaN"), dict(station(3, 50, [CONN]), DateLastStatusUpdate="not a date"),
           "{broken", "also broken"]
    bronze = flows.bronze_stations(landed(spark, bad), "2025-01-02 00:00:00")
    assert bronze.count() == 5  # documents without a UUID all stay
    q = str(tmp_path / "q")
    assert flows.run_station_batch(spark, name, bronze, store, q, AS_OF) is None
    assert flows.run_station_batch(spark, name, bronze, store, q, AS_OF) is None
    rows = spark.read.parquet(q)
    assert rows.count() == 5 and store.state(spark).count() == 0
    reasons = {r.station_id: list(r.reject_reasons) for r in rows.collect()}
    assert reasons["1"] == ["latitude:malformed"] and reasons["2"] == ["latitude:not_finite"] and reasons["3"] == ["date_last_status_update:malformed"]
    assert rows.where("station_id = '1'").first().raw.latitude == "abc"  # the text itself is kept
    # the same run again from the same watermark (its record was lost) overwrites its quarantine folder
    fresh = control_table(spark, tmp_path / "lost")
    flows.run_station_batch(spark, fresh, bronze, store, q, AS_OF)
    assert spark.read.parquet(q).count() == 5
    for t in (name, fresh):
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_gate_stops_a_run_and_is_recorded(spark, tmp_path):
    import pytest

    from lakehold.operators.quality import ColumnGateError

    name = control_table(spark, tmp_path)
    store = empty_store(spark, str(tmp_path / "store"))
    docs = [dict(station(i, 50, [CONN]), DateCreated=None) for i in (1, 2)]
    with pytest.raises(ColumnGateError, match="date_created"):
        flows.run_station_batch(spark, name, flows.bronze_stations(landed(spark, docs), "2025-01-02 00:00:00"), store, str(tmp_path / "q"), AS_OF)
    rec = spark.table(name).first()
    assert rec.status == "failed" and "date_created" in rec.error_message and store.state(spark).count() == 0
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_bronze_and_connector_runs(spark, tmp_path):
    name = control_table(spark, tmp_path)
    docs = landed(spark, [station(1, 50, [CONN, dict(CONN, LevelID=3)]), station(2, 30, [dict(CONN, PowerKW=-1.0)]), station(1, 50, [CONN])])
    bronze = flows.run_bronze_batch(spark, name, docs, str(tmp_path / "bronze"), "2025-01-02 00:00:00")
    assert bronze.count() == 2
    # nothing modified since: the run is recorded as skipped
    assert flows.run_bronze_batch(spark, name, docs, str(tmp_path / "bronze"), "2025-01-03 00:00:00") is None
    store = empty_store(spark, str(tmp_path / "store"))
    valid = flows.run_station_batch(spark, name, bronze, store, str(tmp_path / "q"), AS_OF)
    conns = flows.connector_store(str(tmp_path / "conns"), buckets=4)
    conns.init(spark.createDataFrame([], "station_id string, connection_type_id int, level_id int, connection_type string, amps int, "
                                         "voltage double, power_kw double, quantity int, current_type string, date_last_status_update timestamp_ntz, "
                                         "ingest_timestamp timestamp_ntz, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean, sk long"))
    for _ in range(2):  # the second run replays the first
        table = flows.run_connector_batch(spark, name, valid, conns, str(tmp_path / "cq"), AS_OF)
        assert table.count() in (1, 2) and table.where("is_current").count() == table.count()
        assert spark.read.parquet(str(tmp_path / "cq")).count() == 1
    got = {(r.pipeline_name, r.layer, r.status) for r in spark.table(name).collect()}
    assert got == {("stations", "bronze", "success"), ("stations", "bronze", "skipped"), ("stations", "silver", "success"), ("connectors", "silver", "success")}
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_bronze_files_are_taken_once_and_none_is_lost(spark, tmp_path):
    import os

    name = control_table(spark, tmp_path)
    root = str(tmp_path)
    os.makedirs(f"{root}/in")

    def land(file, docs, mtime=None):
        with open(f"{root}/in/{file}", "w") as f:
            f.write("".join(json.dumps(d) + "\n" for d in docs))
        if mtime:
            os.utime(f"{root}/in/{file}", (mtime, mtime))

    run = lambda stamp: flows.run_bronze_files(spark, name, f"{root}/in", f"{root}/bronze", f"{root}/checkpoint", stamp)
    assert run("2025-01-01 00:00:00") is None
    land("a.json", [station(1, 50, [CONN]), station(1, 50, [CONN]), station(2, 50, [])])
    assert run("2025-01-02 00:00:00").count() == 2
    assert run("2025-01-03 00:00:00") is None
    # documents that were modified long before, in a file that lands late, beside a delivered one
    old = dict(station(3, 50, [CONN]), DateLastStatusUpdate="2012-01-01T00:00:00Z")
    land("b.json", [old, station(2, 50, [])])
    rows = run("2025-01-04 00:00:00")
    assert sorted(r.UUID for r in rows.collect()) == ["u2", "u3"]
    assert spark.read.parquet(f"{root}/bronze").count() == 4
    got = sorted((r.last_processed_timestamp.isoformat()[:10], r.status, r.records_processed) for r in spark.table(name).collect())
    assert got == [("2011-01-01", "skipped", 0), ("2025-01-02", "skipped", 0), ("2025-01-02", "success", 2), ("2025-01-04", "success", 2)]
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_partitioned_upsert_touches_its_days_only(spark, tmp_path):
    import datetime as dt
    import glob

    from lakehold.operators import upsert

    root = str(tmp_path)
    day = F.to_date("t")
    frame = lambda rows: spark.createDataFrame(rows, "id int, v string, t timestamp_ntz")
    T = lambda d: dt.datetime(2025, 1, d, 5)
    go = lambda rows, k: upsert.upsert_partitions(f"{root}/t", rows, ["id"], day, f"{root}/s{k}")
    assert go(frame([]), 0) == 0
    assert go(frame([(1, "a", T(1)), (2, "a", T(1)), (3, "a", T(2)), (4, "a", None), (5, "a", T(3)), (5, "b", T(3))]), 1) == 5
    files = lambda d: sorted(glob.glob(f"{root}/t/part_day={d}/*.parquet"))
    untouched = files("2025-01-02") + files("__HIVE_DEFAULT_PARTITION__")
    assert len(untouched) == 2
    assert go(frame([(1, "z", T(1)), (9, "n", T(1))]), 2) == 1
    assert untouched == files("2025-01-02") + files("__HIVE_DEFAULT_PARTITION__")
    # a key whose day changes leaves its old one, which may become empty; the table itself may be read from
    table = spark.read.schema("id int, v string, t timestamp_ntz").parquet(f"{root}/t")
    moved = table.where("id in (3, 4)").withColumns({"t": F.lit("2025-01-05 01:00:00").cast("timestamp_ntz"), "v": F.lit("moved")})
    assert go(moved, 3) == 0
    assert files("2025-01-02") == [] and files("__HIVE_DEFAULT_PARTITION__") == []
    got = sorted((r.id, r.v, r.t.day) for r in spark.read.schema("id int, v string, t timestamp_ntz").parquet(f"{root}/t").collect())
    assert got == [(1, "z", 1), (2, "a", 1), (3, "moved", 5), (4, "moved", 5), (5, "b", 3), (9, "n", 1)]


def test_weather_run_reads_and_writes_one_table(spark, tmp_path):
    from lakehold.operators import transform

    name = control_table(spark, tmp_path)
    bronze = spark.createDataFrame([(40.0 + k, -74.0, "Rain", "x", 50.0, 1, 2, 3, 0.0, 0.0, 1.0, 5, 1704067200 + 86400 * k, f"2025-01-0{1 + k} 00:00:00") for k in range(3)],
                                   "lat double, lon double, weather string, description string, temp double, pressure int, humidity int, visibility int, rain double, "
                                   "snow double, wind_speed double, clouds int, dt long, s string").select("*", F.col("s").cast("timestamp_ntz").alias("ingest_timestamp")).drop("s")
    empty = transform.standardize_weather(bronze.limit(0), AS_OF)
    at = str(tmp_path / "weather")
    t, n = flows.run_weather_batch(spark, name, bronze.where("dt < 1704153600"), empty, at, AS_OF)
    assert (t.count(), n) == (1, 1)
    for want in (2, 0):  # the same table is read and written; then nothing is new
        t, n = flows.run_weather_batch(spark, name, bronze, t, at, AS_OF)
        assert (t.count(), n) == (3, want)
    assert t.columns == empty.columns
    spark.sql(f"DROP TABLE IF EXISTS {name}")
