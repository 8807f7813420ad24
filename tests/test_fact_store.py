"""Facts kept from batches equal the facts over all rows, for any cut into batches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakehold.functions.columns import ts_ntz
from lakehold.plans import marts
from lakehold.plans.fact_store import FactStore
from tests.test_marts import AS_OF, KW, random_inputs

OPEN = dt.datetime(2999, 12, 31)


def store_at(path, mode="parity", **kw):
    return FactStore(str(path), mode, tuple(KW["station_zone"]), tuple(KW["weather_zone"]), ("connection_sk",), **kw)


def same(store, spark, v, c, w, as_of=AS_OF, mode="parity"):
    want = marts.station_facts(v, c, w, as_of, mode=mode, connector_order=("connection_sk",), **KW)
    got = store.facts(spark, as_of)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("mode", ["parity", "corrected"])
def test_batches_equal_one_pass(spark, tmp_path, mode):
    v, c, w = (x.cache() for x in random_inputs(spark, 11))
    store = store_at(tmp_path, mode, buckets=4, max_rows=8)  # so small that buckets split
    store.create(spark, v, c, w)
    none = F.lit(False)
    cut = v.agg(F.expr("percentile_approx(cast(valid_from as timestamp), 0.5)")).first()[0]
    cut = cut.strftime("%Y-%m-%d %H:%M:%S")
    open_end = F.lit(OPEN).cast(v.schema["valid_to"].dataType)
    early = v.where(F.col("valid_from") < ts_ntz(cut)).withColumn("valid_to", F.when(F.col("valid_to") >= ts_ntz(cut), open_end).otherwise(F.col("valid_to")))
    late = v.where((F.col("valid_from") >= ts_ntz(cut)) | (F.col("valid_to") >= ts_ntz(cut)))
    zone = KW["weather_zone"][0]
    w1, c1 = F.col(zone) % 3 == 0, F.col("connection_sk") % 2 == 0
    store.apply(early, c.where(c1), w.where(w1), 0, cut)
    same(store, spark, early, c.where(c1), w.where(w1), cut, mode)
    store.apply(late, c.where(~c1), w.where(none), 1, AS_OF)
    same(store, spark, v, c, w.where(w1), mode=mode)
    store.apply(v.where(none), c.where(none), w.where(~w1), 2, AS_OF)  # zones seen for the first time wake their stations
    same(store, spark, v, c, w, mode=mode)
    same(store, spark, v, c, w, "2031-07-15 13:37:11", mode)  # read later, without a batch
    assert store.directory(spark).split
    store.apply(late, c.where(~c1), w, 2, AS_OF)  # the batch again, with rows known before
    same(store, spark, v, c, w, mode=mode)


def test_a_batch_opens_its_buckets_only(spark, tmp_path):
    v, c, w = (x.cache() for x in random_inputs(spark, 12))
    store = store_at(tmp_path, buckets=16)
    store.create(spark, v, c, w)
    store.apply(v, c, w, 0, AS_OF)
    station = v.agg(F.max("station_id")).first()[0]
    new = v.where(F.col("station_id") == station).orderBy("station_sk").limit(1).withColumn("status_id", F.lit(30).cast(v.schema["status_id"].dataType))
    opened = store.apply(new, c.limit(0), w.limit(0), 1, AS_OF)
    assert len(opened) == 1
    d = store.directory(spark)
    files = store._rows(spark, "state", d, [b for b in d.last if d.last[b] == 1]).inputFiles()
    assert files and all(f"bucket={opened[0]}/" in f for f in files if "batch=1/" in f)
    key = ["station_id", "station_sk"]
    same(store, spark, v.join(new.select(*key), key, "left_anti").unionByName(new), c, w)
    # a newer observation of a known zone computes no station anew
    newer = w.orderBy(F.desc("dt_utc"), F.desc("weather_sk")).limit(1).withColumns(
        {"weather_sk": F.lit(10**6).cast(w.schema["weather_sk"].dataType), "dt_utc": F.col("dt_utc") + F.expr("interval 1 day"), "weather": F.lit("big snow")})
    assert store.apply(v.limit(0), c.limit(0), newer, 2, AS_OF) == []
    same(store, spark, v.join(new.select(*key), key, "left_anti").unionByName(new), c, w.unionByName(newer))


def test_edges(spark, tmp_path):
    v, c, w = (x.cache() for x in random_inputs(spark, 13))
    store = store_at(tmp_path)
    store.create(spark, v, c, w)
    assert store.facts(spark, AS_OF).count() == 0
    none = F.lit(False)
    assert store.apply(v.where(none), c.where(none), w.where(none), 0, AS_OF) == []
    key = v.schema["station_id"].dataType
    dirty_v = v.withColumn("station_id", F.when(F.col("station_sk") % 7 != 0, F.col("station_id")).cast(key)).withColumn(
        "valid_from", F.when(F.col("station_sk") % 5 != 0, F.col("valid_from"))).withColumn("clash", F.lit(1)).withColumn("batch", F.lit("x"))
    zone = KW["station_zone"][0]
    dirty_v = dirty_v.withColumn(zone, F.when(F.col("station_sk") % 11 != 0, F.col(zone)))
    dirty_c = c.unionByName(c).unionByName(c.withColumn("level_id", F.lit(3).cast(c.schema["level_id"].dataType))).withColumn("power_kw", F.when(F.col("level_id") > 1, F.col("power_kw")))
    dirty_w = w.withColumn("dt_utc", F.when(F.col("weather_sk") % 4 != 0, F.col("dt_utc"))).withColumn("latest", F.lit(0))
    store.apply(dirty_v, dirty_c, dirty_w, 1, AS_OF)
    same(store, spark, dirty_v, dirty_c, dirty_w.drop("latest"))
    with pytest.raises(ValueError):
        store.facts(spark, "2001-01-01 00:00:00")
    with pytest.raises(ValueError):
        store_at(tmp_path, "other")


def test_a_batch_takes_its_rows_once(spark, tmp_path):
    v, c, w = (x.cache() for x in random_inputs(spark, 14))
    store = store_at(tmp_path / "s", buckets=4)
    store.create(spark, v, c, w)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    v.write.parquet(str(tmp_path / "v"))
    marked = store._marked(spark.read.parquet(str(tmp_path / "v")), store._zones(w, 0), None)
    assert plan(marked).count("Relation [station_id") == 1  # versions of seen and unseen zones together
    store.apply(v, c, w, 0, AS_OF)
    d = store.directory(spark, 0)
    assert "Window" not in plan(store._log(spark, "versions", d, d.leaves(), 0))  # there is no other batch to compare with
    zone, key = KW["weather_zone"][0], ["station_id", "station_sk"]
    again = v.where("station_sk % 3 = 0").withColumn("status_id", F.lit(30).cast(v.schema["status_id"].dataType))
    store.apply(again, c.limit(0), w.limit(0), 1, AS_OF)
    d, station = store.directory(spark), v.select("station_id").dropna().limit(1)
    now = store._log(spark, "versions", d, d.leaves(), 1, station)
    want = v.join(again.select(*key), key, "left_anti").unionByName(again).join(station, "station_id", "left_semi").select(*now.columns)
    assert sorted(map(str, now.collect())) == sorted(map(str, want.collect())) and zone in w.columns
    same(store, spark, v.join(again.select(*key), key, "left_anti").unionByName(again), c, w)
