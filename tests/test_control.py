import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakehold.operators import control

D = dt.datetime


@pytest.fixture()
def table_name(spark, tmp_path):
    name = f"control_{abs(hash(str(tmp_path))) % 10**8}"
    control.create_control_table(spark, name, str(tmp_path / "control"))
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_schema_order_and_idempotent(spark, table_name, tmp_path):
    control.create_control_table(spark, table_name, str(tmp_path / "control"))
    assert spark.table(table_name).columns == control.CONTROL_COLUMNS


def test_default_watermark(spark, table_name):
    assert control.last_watermark(spark.table(table_name), "p", "bronze") == D(2011, 1, 1)


def test_latest_by_end_time_and_null_end_time(spark, table_name):
    for wm, end in [(D(2025, 1, 1), D(2025, 1, 1, 1)), (D(2025, 1, 3), D(2025, 1, 3, 1)), (D(2025, 1, 2), D(2025, 1, 2, 1))]:
        control.append_run(spark, table_name, control.run_record(spark, "p", "bronze", last_processed_timestamp=wm, end_time=end))
    assert control.last_watermark(spark.table(table_name), "p", "bronze") == D(2025, 1, 3)
    control.append_run(spark, table_name, control.run_record(spark, "q", "silver", last_processed_timestamp=D(2024, 5, 5)))
    assert control.last_watermark(spark.table(table_name), "q", "silver") == D(2024, 5, 5)
    wm = {(r.pipeline_name, r.layer): r.watermark for r in control.watermarks(spark.table(table_name)).collect()}
    assert wm == {("p", "bronze"): D(2025, 1, 3), ("q", "silver"): D(2024, 5, 5)}


def test_record_fields(spark, table_name):
    a = control.append_run(spark, table_name, control.run_record(spark, "p", "gold"))
    b = control.append_run(spark, table_name, control.run_record(spark, "p", "gold", records_processed=5))
    rows = spark.table(table_name).collect()
    assert a != b and len({r.batch_id for r in rows}) == 2
    assert {r.records_processed for r in rows} == {None, 5}


def test_failed_run_is_recorded(spark, table_name):
    def boom():
        raise ValueError("bad batch")

    with pytest.raises(ValueError):
        control.run_step(spark, table_name, "p", "silver", boom)
    control.run_step(spark, table_name, "p", "silver", lambda: (D(2025, 2, 2), 10, 1))
    st = {r.status: r for r in spark.table(table_name).collect()}
    assert st["failed"].error_message == "bad batch" and st["success"].records_failed == 1


def test_batch_records(spark):
    df = spark.createDataFrame([(D(2025, 1, 1, 1), 0.5), (D(2025, 1, 1, 2), 3.0), (D(2025, 1, 2, 1), 2.0)],
                               "ts timestamp_ntz, value double")
    r = {x.batch_id: x for x in control.batch_records(df, F.to_date("ts"), "ts", F.col("value") < 1, "e", "bronze").collect()}
    assert r["e/bronze/2025-01-01"].records_processed == 2 and r["e/bronze/2025-01-01"].records_failed == 1
    assert r["e/bronze/2025-01-02"].last_processed_timestamp == D(2025, 1, 2, 1)
