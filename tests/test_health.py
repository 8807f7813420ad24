import datetime as dt

from pyspark.sql import functions as F

from lakehold.plans import health

D = dt.datetime


def _status(report):
    return {(r.table_name, r.check_name): r.status for r in report.collect()}


def test_marts_health(spark):
    facts = spark.createDataFrame([(1, True, 40, 10.0, 0.5, D(2025, 1, 1)), (2, None, 140, 5.0, 1.5, D(2025, 1, 1))],
                                  "station_id int, is_operational boolean, risk_score int, "
                                  "avg_energy_cost_per_hour double, availability double, ingest_timestamp timestamp_ntz")
    dim = spark.createDataFrame([(1, 40.7, -74.0, D(2025, 1, 1)), (1, 40.7, -74.0, D(2025, 1, 1))],
                                "station_id int, latitude double, longitude double, ingest_timestamp timestamp_ntz")
    empty = spark.createDataFrame([], "weather_sk long, weather string, temp double, ingest_timestamp timestamp_ntz")
    rep = health.health_report(spark, {"station_facts": facts, "station_dim": dim, "weather_dim": empty},
                               health.MART_RULES, "2025-01-02 00:00:00")
    st = _status(rep)
    assert st[("station_facts", "nulls:is_operational")] == "fail"
    assert st[("station_facts", "range:risk_score")] == "warning"
    assert st[("station_facts", "range:availability")] == "warning"
    assert st[("station_facts", "freshness")] == "pass"
    assert st[("station_dim", "unique:station_id")] == "fail"
    assert st[("weather_dim", "not_empty")] == "fail" and st[("weather_dim", "nulls:temp")] == "skipped"
    s = health.health_summary(rep).first()
    assert s.healthy is False and s.failed == 3


def test_missing_table_and_stale(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1))], "station_id int, ingest_timestamp timestamp_ntz")
    rep = health.health_report(spark, {"a": df, "b": None}, {}, "2025-01-01 00:00:00")
    st = _status(rep)
    assert st[("b", "table_exists")] == "fail" and st[("a", "freshness")] == "warning"


def test_merged_states_equal_the_report_of_all_rows(spark, tmp_path):
    from lakehold.plans import health

    schema = "id long, v double, s string, ingest_timestamp timestamp_ntz"
    rows = [(k % 40 if k % 9 else None, float(k), None if k % 7 == 0 else "x", f"2025-01-0{1 + k % 3}") for k in range(100)]
    df = spark.createDataFrame([(i, v, s, None) for i, v, s, _ in rows], schema)
    times = spark.createDataFrame([(float(k), rows[k][3]) for k in range(100)], "v double, t string")
    df = df.drop("ingest_timestamp").join(times, "v").withColumn("ingest_timestamp", F.col("t").cast("timestamp_ntz")).select("id", "v", "s", "ingest_timestamp")
    rules = {"t": health.TableRules(critical=["s", "id", "absent"], ranges={"v": (10, 50)}, unique_key="id")}
    log = health.HealthLog(str(tmp_path / "h"), rules)
    want = lambda d: sorted(map(tuple, health.health_report(spark, {"t": d}, rules, "2025-01-04 00:00:00").collect()))
    got = lambda: sorted(map(tuple, log.report(spark, ["t"], "2025-01-04 00:00:00").collect()))
    assert got() == [("t", "table_exists", "fail", None)]
    log.add("t", df.limit(0), 0)
    assert got() == want(df.limit(0))
    for run, (lo, hi) in enumerate([(0, 30), (30, 80), (80, 100)], 1):
        for _ in range(2):  # a repeated run
            log.add("t", df.where((F.col("v") >= lo) & (F.col("v") < hi)), run)
        assert got() == want(df.where(F.col("v") < hi))
