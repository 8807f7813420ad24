"""Landed files, and bronze rows that carry the parsed fields."""

import json

from pyspark.sql import functions as F

import __spark_entry__ as E
from lakehold.plans import catalog, flows
from lakehold.session import INITIAL_WATERMARK
from lakehold.sources import landing


def _size(spark, path: str) -> int:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).agg(F.sum("length")).first()[0]


def _texts(df) -> list[str]:
    return sorted(r[0] for r in df.select("raw_text").collect())


def test_landed_files_are_compressed_and_whole(spark, tmp_path):
    docs = catalog.station_documents(spark, E.SMOKE_DIR)
    want = _texts(docs)
    landing.write_landing(docs, f"{tmp_path}/a")
    landing.write_landing(docs.limit(10), f"{tmp_path}/a")  # lands beside the first
    got = landing.read_landing(spark, f"{tmp_path}/a")
    assert got.count() == len(want) + 10
    assert set(_texts(got)) == set(want)
    assert _size(spark, f"{tmp_path}/a") < sum(map(len, want)) / 5
    landing.write_landing(docs.withColumn("landing", F.length("raw_text") % 2), f"{tmp_path}/b", ("landing",))
    parts = [landing.read_landing(spark, f"{tmp_path}/b/landing={k}") for k in (0, 1)]
    assert sorted(_texts(parts[0]) + _texts(parts[1])) == want


def test_runs_and_landing_ingest_land_compressed_files(spark, tmp_path, monkeypatch):
    seen = []
    plain = landing.write_landing
    monkeypatch.setattr(landing, "write_landing", lambda docs, path, *a: (seen.append(path), plain(docs, path, *a))[1])
    assert catalog.landing_ingest(spark, E.SMOKE_DIR).count()
    assert len(seen) == 1 and all(f.endswith(".gz") for f in spark.read.text(seen[0]).inputFiles())


def _odd_documents(spark):
    doc = lambda u, **more: json.dumps({"ID": 1, "UUID": u, "AddressInfo": {"Title": "t", "Latitude": "1.5", "Longitude": -7.0},
                                        "Connections": [{"LevelID": 1.50}], "StatusType": {"ID": 50, "Title": "x"},
                                        "DateLastStatusUpdate": "2024-01-01T00:00:00Z", "DataProvider": {"WebsiteURL": "w"}, **more})
    rows = [doc("a"), doc("a"), doc("a", ID=2), doc("a", ID=3), doc("b", AddressInfo="text"), doc("c", Connections="none"), doc("d", StatusType=[1]),
            doc("e", DataProvider=5), doc(None), doc(None), doc("f", ID=1.10), doc({"x": 1}), '{"UUID":"g","ID":', '{"UUID":"h"}', "[]", "", "null", None,
            '{"UUID":"i","UUID":"j","ID":"k"}']
    return spark.createDataFrame([(r,) for r in rows], "raw_text string")


def test_parsed_bronze_gives_the_rows_of_a_second_parse(spark):
    docs, at = _odd_documents(spark), "2024-01-31 00:00:00"
    rows = lambda df: sorted(map(repr, df.collect()))
    plain, parsed = flows.bronze_stations(docs, at), flows.bronze_stations(docs, at, parsed=True)
    assert rows(plain) == rows(parsed.select(*plain.columns))
    for a, b in zip(flows.silver_station_rows(plain, INITIAL_WATERMARK, at, gate=False),
                    flows.silver_station_rows(parsed, INITIAL_WATERMARK, at, gate=False), strict=True):
        assert a.schema == b.schema and rows(a) == rows(b)


def test_texts_that_nobody_reads_are_not_shuffled(spark):
    plan = catalog.silver_stations(spark, E.SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()
    agg = [x for x in plan.splitlines() if "min_by" in x]
    assert agg and not any("min_by(raw_text" in x or "min_by(connections" in x for x in agg)
    assert plan.count("from_json") == 1


def test_row_balance_builds_the_documents_once(spark):
    df = catalog.silver_row_balance(spark, E.SMOKE_DIR)
    got = {r["part"]: r["n"] for r in df.collect()}
    assert got["bronze"] == got["valid"] + got["rejected"] > 0
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Generate inline") == 1


def test_landing_ingest_shuffles_no_texts(spark):
    df = catalog.landing_ingest(spark, E.SMOKE_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "min_by" in plan and "min_by(raw_text" not in plan
    docs = catalog.station_documents(spark, E.SMOKE_DIR)
    uuid = F.get_json_object("raw_text", "$.UUID")
    assert df.count() == docs.where(uuid.isNull()).count() + docs.where(uuid.isNotNull()).select(uuid).distinct().count()
    assert {r["has_text"] for r in df.select("has_text").distinct().collect()} == {True}


def test_parts_of_bronze_rows_make_the_whole(spark, tmp_path, monkeypatch):
    docs, at = _odd_documents(spark), "2024-01-31 00:00:00"
    rows = lambda df: sorted(map(repr, df.collect()))
    want = rows(flows.bronze_stations(docs, at))
    parts = [rows(flows.bronze_stations(docs, at, part=(k, 3))) for k in range(3)]
    assert sum(map(bool, parts)) > 1 and sorted(sum(parts, [])) == want
    monkeypatch.setattr(flows, "BRONZE_BYTES", 500)
    taken, plain = [], landing.add_bronze_metadata
    monkeypatch.setattr(landing, "add_bronze_metadata", lambda *a, **k: (taken.append(k["part"]), plain(*a, **k))[1])
    schema, m = flows._write_bronze(docs, at, f"{tmp_path}/bronze")
    assert len(taken) == taken[0][1] > 1 and m["n"] == len(want) and str(m["wm"]) == at
    flows._write_bronze(docs, at, f"{tmp_path}/bronze")  # a repeated run overwrites it
    assert rows(spark.read.schema(schema).parquet(f"{tmp_path}/bronze")) == want
    assert flows._write_bronze(docs.limit(0), at, f"{tmp_path}/none")[1] == {"n": 0, "wm": None}


def test_runs_leave_no_copies_of_what_they_staged(spark):
    root = catalog._scheduled_runs(spark, E.SMOKE_DIR)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    folders = {r["path"].split(root.rsplit("/", 1)[1] + "/")[1].rsplit("/", 1)[0] for r in files.collect()}
    assert {"landing", "stations/log", "connectors/log", "bronze", "weather"} <= {x for f in folders for x in (f.split("/")[0], "/".join(f.split("/")[:2]))}
    assert not [f for f in folders if f.startswith(("dealt", "staging", "conn-staging")) or "/staged/" in f]


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    import time

    from lakehold.session import shuffles_freed

    held = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = held(), spark.conf.get(key)
    with shuffles_freed(spark):
        spark.range(1000).repartition(4).write.parquet(f"{tmp_path}/a")
        assert spark.range(1000).groupBy(F.col("id") % 7).count().count() == 7
    until = time.time() + 20
    while held() - before and time.time() < until:
        time.sleep(0.2)
    assert not held() - before and spark.conf.get(key) == was
