"""Control (watermark / run-log) table: create, append a run, read the watermark,
and run records for many batches computed in one grouped job."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (LongType, StringType, StructField, StructType,
                               TimestampNTZType)

from lakehold.functions.columns import ts_ntz
from lakehold.session import INITIAL_WATERMARK, shuffles_freed

CONTROL_SCHEMA = StructType([
    StructField("pipeline_name", StringType()),
    StructField("layer", StringType()),
    StructField("last_processed_timestamp", TimestampNTZType()),
    StructField("batch_id", StringType()),
    StructField("status", StringType()),
    StructField("records_processed", LongType()),
    StructField("records_failed", LongType()),
    StructField("start_time", TimestampNTZType()),
    StructField("end_time", TimestampNTZType()),
    StructField("error_message", StringType()),
])
CONTROL_COLUMNS = [f.name for f in CONTROL_SCHEMA.fields]


def utc_now() -> dt.datetime:
    """The run clock: UTC wall time, as the watermarks are, whatever the driver's zone."""
    return dt.datetime.now(dt.UTC).replace(tzinfo=None)


def create_control_table(spark: SparkSession, name: str, location: str | None = None) -> str:
    """CREATE TABLE IF NOT EXISTS with the fixed column order (idempotent)."""
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CONTROL_SCHEMA.fields)
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{loc}")
    return name


def run_record(spark: SparkSession, pipeline_name: str, layer: str, *,
               last_processed_timestamp: dt.datetime | None = None, status: str = "success",
               records_processed: int | None = None, records_failed: int | None = None,
               start_time: dt.datetime | None = None, end_time: dt.datetime | None = None,
               error_message: str | None = None, batch_id: str | None = None) -> DataFrame:
    """One control row (unset metrics stay null); batch id is a fresh UUID."""
    row = (pipeline_name, layer, last_processed_timestamp, batch_id or str(uuid.uuid4()), status,
           records_processed, records_failed, start_time, end_time, error_message)
    return spark.createDataFrame([row], CONTROL_SCHEMA)


def append_run(spark: SparkSession, table: str, record: DataFrame) -> str:
    record.select(*CONTROL_COLUMNS).write.insertInto(table)
    return record.first()["batch_id"]


def _latest_key() -> Column:
    # ORDER BY end_time DESC NULLS LAST, batch_id DESC as one comparable struct
    return F.struct(F.col("end_time").isNotNull(), F.col("end_time"), F.col("batch_id"))


def watermarks(control: DataFrame, default: str = INITIAL_WATERMARK) -> DataFrame:
    """Per (pipeline_name, layer): the last non-null watermark of the latest run by
    end time (a run without end time still counts, after all timed runs)."""
    ok = control.where(F.col("last_processed_timestamp").isNotNull())
    top = ok.groupBy("pipeline_name", "layer").agg(
        F.max_by("last_processed_timestamp", _latest_key()).alias("wm"))
    groups = control.select("pipeline_name", "layer").distinct()
    return groups.join(top, on=["pipeline_name", "layer"], how="left").select(
        "pipeline_name", "layer", F.coalesce(F.col("wm"), ts_ntz(default)).alias("watermark"))


def last_watermark(control: DataFrame, pipeline_name: str, layer: str,
                   default: str = INITIAL_WATERMARK) -> dt.datetime:
    """The watermark of one pipeline/layer (a top-1, one row to the driver)."""
    row = (control.where((F.col("pipeline_name") == pipeline_name) & (F.col("layer") == layer)
                         & F.col("last_processed_timestamp").isNotNull())
           .orderBy(F.col("end_time").desc_nulls_last(), F.col("batch_id").desc())
           .select("last_processed_timestamp").limit(1).collect())
    return row[0][0] if row else dt.datetime.fromisoformat(default)


def batch_records(df: DataFrame, batch: Column, ts: str, failed: Column,
                  pipeline_name: str, layer: str) -> DataFrame:
    """Control rows for many batches in one grouped job: processed / failed counts,
    watermark = max event time, start/end = first/last event time."""
    g = df.withColumn("__batch", batch).groupBy("__batch").agg(
        F.count(F.lit(1)).alias("records_processed"),
        F.count_if(failed).alias("records_failed"),
        F.max(ts).alias("last_processed_timestamp"),
        F.min(ts).alias("start_time"),
    )
    return g.select(
        F.lit(pipeline_name).alias("pipeline_name"),
        F.lit(layer).alias("layer"),
        F.col("last_processed_timestamp").cast("timestamp_ntz").alias("last_processed_timestamp"),
        F.concat_ws("/", F.lit(pipeline_name), F.lit(layer), F.col("__batch").cast("string")).alias("batch_id"),
        F.lit("success").alias("status"),
        "records_processed",
        "records_failed",
        F.col("start_time").cast("timestamp_ntz").alias("start_time"),
        F.col("last_processed_timestamp").cast("timestamp_ntz").alias("end_time"),
        F.lit(None).cast("string").alias("error_message"),
    )


def run_step(spark: SparkSession, table: str, pipeline_name: str, layer: str,
             step: Callable[[], tuple]) -> str:
    """Run ``step`` and ALWAYS append a control record (success or failed). The step
    returns (watermark, rows processed, rows failed), and a status if it has its own."""
    start = utc_now()
    status, err, wm, n_ok, n_bad = "success", None, None, None, None
    try:
        with shuffles_freed(spark):
            wm, n_ok, n_bad, *own = step()
        status = own[0] if own else status
    except Exception as e:  # recorded, then re-raised
        status, err = "failed", str(e)
        raise
    finally:
        rec = run_record(spark, pipeline_name, layer, last_processed_timestamp=wm, status=status,
                         records_processed=n_ok, records_failed=n_bad, start_time=start,
                         end_time=utc_now(), error_message=err)
        append_run(spark, table, rec)
    return status


def new_watermark(df: DataFrame, column: str = "ingest_timestamp") -> DataFrame:
    """The watermark a run hands on: max of the *source* stamp (one-row frame)."""
    return df.agg(F.max(column).alias("last_processed_timestamp"))
