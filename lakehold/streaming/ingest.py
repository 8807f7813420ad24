"""Incremental ingest with re-delivery de-duplication (the 15-minute overlap of the
batch design becomes the watermark delay)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from lakehold.operators.keyed_table import KeyedTable


def read_table_stream(spark: SparkSession, directory: str, file_glob: str,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet file source over ``directory`` (only files matching ``file_glob``)."""
    schema = spark.read.option("pathGlobFilter", file_glob).parquet(directory).schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(directory)


def dedup_stream(stream: DataFrame, keys: Sequence[str], event_time: str,
                 delay: str = "15 minutes") -> DataFrame:
    """Drop re-delivered rows of the same key within the watermark delay (state is
    kept only for ``delay`` past the max event time seen; rows that come later than that
    are dropped, see ``dedup_into`` for a form that keeps them). Watermarks need a
    ``timestamp``; a ``timestamp_ntz`` event time is watermarked through a cast copy."""
    if isinstance(stream.schema[event_time].dataType, TimestampNTZType):
        et = "__event_time"
        s = stream.withColumn(et, F.col(event_time).cast("timestamp"))
        return s.withWatermark(et, delay).dropDuplicatesWithinWatermark(list(keys)).drop(et)
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def dedup_into(stream: DataFrame, table: KeyedTable, checkpoint: str, timeout_s: int | None = None) -> None:
    """Add everything available now to a table of one row per key, however late a row or
    its repetition comes, and however far apart their times are: each micro-batch is
    compared with the stored keys of the buckets it touches. The row of the least event
    time stays, so the table does not depend on how the input is cut into files. No row is
    lost to a watermark and no state is held in memory; the table itself is the state. A
    retried micro-batch overwrites its own folders, so it is exactly-once."""
    table.create(stream.sparkSession, stream.schema)
    q = (stream.writeStream.foreachBatch(lambda batch, batch_id: table.apply(batch, batch_id) and None)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    if q.exception():
        raise q.exception()


def run_to_parquet(stream: DataFrame, out_path: str, checkpoint: str,
                   timeout_s: int | None = None) -> None:
    """Process everything available now into a parquet sink (exactly-once via the
    sink log and the checkpoint), then stop."""
    q = (stream.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination(timeout_s)
    if q.exception():
        raise q.exception()
