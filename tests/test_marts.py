"""Gold marts: fixture values, and the fan-out-free plan equals the fan-out plan."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakehold.plans import marts

AS_OF = "2025-06-01 00:00:00"
VSCHEMA = ("station_id long, station_sk long, status_id int, date_last_status_update timestamp_ntz, "
           "valid_from timestamp_ntz, valid_to timestamp_ntz, date_created timestamp_ntz, zone int")
CSCHEMA = "station_id long, connection_sk long, level_id int, power_kw double, quantity int"
WSCHEMA = ("weather_sk long, zone int, weather_zone_id long, dt_utc timestamp_ntz, weather string, "
           "description string, temp double, pressure int, humidity int, visibility int, rain double, snow double")
KW = dict(station_zone=("zone",), weather_zone=("zone",))
D = dt.datetime


def fanout_facts(v, c, w, as_of):
    """The naive plan: join all three, window newest-first, aggregate (with unique tie-breakers)."""
    now = F.lit(as_of).cast("timestamp_ntz")
    j = (v.alias("s").join(c.alias("c"), "station_id").join(w.alias("w"), "zone")
         .where(F.col("status_id").isin(50, 30)).withColumn("is_operational", F.col("status_id") == 50))
    win = Window.partitionBy("station_id").orderBy(F.col("date_last_status_update").desc(), F.col("station_sk").desc(),
                                                   "connection_sk", "w.weather_sk")
    j = j.withColumn("prev", F.lag("is_operational").over(win)).withColumn("rn", F.row_number().over(win))
    j = j.withColumn("total_power", F.col("power_kw") * F.col("quantity"))
    counted = ~F.col("is_operational") & (F.col("prev") | F.col("prev").isNull())
    latest = F.max(F.struct("dt_utc", "w.weather_sk", "weather", "temp"))
    a = j.groupBy("station_id").agg(
        F.max("w.weather_zone_id").alias("weather_zone_id"),
        latest.alias("lw"),
        F.max_by("is_operational", F.struct("date_last_status_update", "station_sk")).alias("is_operational"),
        F.sum(F.when(counted, 1).otherwise(0)).alias("offline_count"),
        F.sum(F.when(counted, F.timestamp_diff("MINUTE", "valid_from", F.least(now, "valid_to")))
              .otherwise(0)).alias("offline_duration"),
        F.timestamp_diff("MINUTE", F.max("date_created"), now).alias("total_duration"),
        F.max("level_id").alias("ml"),
        F.sum(F.when(F.col("rn") == 1, F.round(0.35 * F.col("total_power"))).otherwise(0)).alias("avg_energy_cost_per_hour"),
    )
    return a.select("station_id", "weather_zone_id", F.col("lw.weather_sk").alias("weather_sk"), "is_operational",
                    "offline_count", "offline_duration", "total_duration", "avg_energy_cost_per_hour")


def random_inputs(spark, seed, n_st=40):
    rnd = random.Random(seed)
    vs, cs, ws = [], [], []
    sk = 0
    for s in range(n_st):
        t = D(2024, 1, 1)
        zone = rnd.randrange(5)
        for _ in range(rnd.randrange(1, 8)):
            t = t + dt.timedelta(days=rnd.choice([0, 1, 3, 10]))
            vs.append([s, sk, rnd.choice([50, 30, 20]), t, t, None, D(2023, 6, 1), zone])
            sk += 1
        for k in range(rnd.randrange(0, 4)):
            # connection_sk is a surrogate key: unique (a random, shuffled order)
            cs.append((s, rnd.randrange(1000) * 1000 + len(cs), rnd.randrange(1, 4),
                       float(rnd.randrange(1, 90)), rnd.randrange(1, 3)))
    vs.sort(key=lambda r: (r[0], r[3], r[1]))
    for i, r in enumerate(vs):
        nxt = vs[i + 1] if i + 1 < len(vs) and vs[i + 1][0] == r[0] else None
        r[5] = nxt[3] if nxt else D(2999, 12, 31)
    for i in range(60):
        z = rnd.randrange(6)
        ws.append((i, z, z, D(2024, 5, 1) + dt.timedelta(hours=rnd.randrange(50)), rnd.choice(["Snow", "Thunderstorm", "Clear"]),
                   "d", float(rnd.randrange(0, 120)), 1000, 50, 10000, 0.0, 0.0))
    return (spark.createDataFrame([tuple(r) for r in vs], VSCHEMA), spark.createDataFrame(cs, CSCHEMA),
            spark.createDataFrame(ws, WSCHEMA))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_gfast_equals_fanout(spark, seed):
    v, c, w = random_inputs(spark, seed)
    cols = ["station_id", "weather_zone_id", "weather_sk", "is_operational", "offline_count",
            "offline_duration", "total_duration", "avg_energy_cost_per_hour"]
    fast = marts.station_facts(v, c, w, AS_OF, connector_order=("connection_sk",), **KW).select(*cols)
    slow = fanout_facts(v, c, w, AS_OF).select(*cols)
    assert fast.count() == slow.count()
    assert fast.exceptAll(slow).count() == 0 and slow.exceptAll(fast).count() == 0


@pytest.mark.parametrize("seed", [4, 5])
def test_split_window_gives_same_facts(spark, seed):
    v, c, w = random_inputs(spark, seed)
    plain = marts.station_facts(v, c, w, AS_OF, connector_order=("connection_sk",), **KW)
    split = marts.station_facts(v, c, w, AS_OF, connector_order=("connection_sk",),
                                split=F.date_trunc("week", "date_last_status_update"), **KW)
    assert plain.exceptAll(split).count() == 0 and split.exceptAll(plain).count() == 0


def _one_station(spark, status=50, weather="Thunderstorm", temp=100.0, level=3, power=(50.0, 100.0)):
    v = spark.createDataFrame([(1, 10, status, D(2025, 1, 1), D(2025, 1, 1), D(2999, 12, 31), D(2025, 1, 1), 1)], VSCHEMA)
    c = spark.createDataFrame([(1, i, level, p, 1) for i, p in enumerate(power)], CSCHEMA)
    w = spark.createDataFrame([(7, 1, 1, D(2025, 5, 1), weather, "heavy", temp, 1000, 80, 9000, 0.0, 0.0)], WSCHEMA)
    return v, c, w


def test_high_risk(spark):
    r = marts.station_facts(*_one_station(spark), AS_OF, connector_order=("connection_sk",), **KW).first()
    assert r.risk_score == 100 and r.risk_severity_level == "high_risk"


def test_snow_capital_missed_by_parity_caught_by_corrected(spark):
    args = _one_station(spark, weather="Snow", temp=50.0, level=1)
    p = marts.station_facts(*args, AS_OF, connector_order=("connection_sk",), **KW).first()
    c = marts.station_facts(*args, AS_OF, mode="corrected", connector_order=("connection_sk",), **KW).first()
    assert p.risk_score == 15 and c.risk_score == 45


def test_metric_arithmetic(spark):
    df = spark.createDataFrame([(1, 100.0, 60, 1000)], "station_id int, avg_energy_cost_per_hour double, "
                               "offline_duration long, total_duration long")
    r = marts.add_fact_metrics(df, AS_OF).first()
    assert r.est_downtime_cost == 100.0 and r.availability == 0.94


def test_zero_total_duration_gives_null_availability(spark):
    df = spark.createDataFrame([(1, 100.0, 0, 0)], "station_id int, avg_energy_cost_per_hour double, "
                               "offline_duration long, total_duration long")
    assert marts.add_fact_metrics(df, AS_OF).first().availability is None


def test_status_filter_and_operational_flag(spark):
    v = spark.createDataFrame([(i, i, s, D(2025, 1, 1), D(2025, 1, 1), D(2999, 12, 31), D(2025, 1, 1), 1)
                               for i, s in enumerate([50, 30, 20])], VSCHEMA)
    c = spark.createDataFrame([(i, i, 1, 10.0, 1) for i in range(3)], CSCHEMA)
    w = _one_station(spark)[2]
    out = {r.station_id: r.is_operational for r in
           marts.station_facts(v, c, w, AS_OF, connector_order=("connection_sk",), **KW).collect()}
    assert out == {0: True, 1: False}


def test_station_dim_max_power(spark):
    v, c, w = _one_station(spark, power=(50.0, 100.0))
    v = v.withColumns({"title": F.lit("t"), "address": F.lit("a"), "town": F.lit("x"),
                       "state_or_province": F.lit("NY"), "latitude": F.lit(40.7), "longitude": F.lit(-74.0)})
    r = marts.station_dim(v, c, w, AS_OF, **KW).collect()
    assert len(r) == 1 and r[0].max_power_kw == 100.0


def test_weather_dim_one_row_per_sk(spark):
    v, c, _ = _one_station(spark)
    w = spark.createDataFrame([(7, 1, 1, D(2025, 5, 1), "Rain", "x", 50.0, 1, 1, 1, 0.0, 0.0),
                               (7, 1, 1, D(2025, 5, 1), "Rain", "x", 50.0, 1, 1, 1, 0.0, 0.0),
                               (8, 1, 1, D(2025, 5, 2), "Rain", "x", 51.0, 1, 1, 1, 0.0, 0.0)], WSCHEMA)
    assert marts.weather_dim(v, c, w, AS_OF, **KW).count() == 2
