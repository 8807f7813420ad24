"""Data layout: Z-order clustering as a rewrite job, and a maintenance report.

Every key column of an orderable type is cut into buckets at the quantiles of a bounded
sample (so skewed values and 64-bit hashes spread evenly, and strings are compared as
they are), the bucket numbers' bits are interleaved into one z value, rows are
range-partitioned by z and sorted within partitions. Written parquet files then hold
narrow min/max ranges on every key, so row-group skipping works on each of them.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, MapType

SAMPLE_ROWS = 20_000  # rows that the cut points are taken from
MAX_BITS = 8  # bits per column: up to 256 buckets
ROWS_PER_RANGE = 1_000_000  # rows per output partition
TOTAL = "TOTAL"


def cut_points(df: DataFrame, cols: Sequence[str], bits: int, rows: int | None = None) -> list[list]:
    """Per column, at most ``2**bits - 1`` ascending cut points: quantiles of a sample of about
    ``SAMPLE_ROWS`` rows. They steer the layout only, never what a row holds."""
    n = df.count() if rows is None else rows
    picked = df.select(*cols) if n <= SAMPLE_ROWS else df.select(*cols).sample(fraction=SAMPLE_ROWS / n, seed=42)
    sample = picked.limit(2 * SAMPLE_ROWS).collect()
    buckets, out = 1 << bits, []
    for i in range(len(cols)):
        values = sorted(r[i] for r in sample if r[i] is not None and r[i] == r[i])
        out.append(sorted({values[len(values) * k // buckets] for k in range(1, buckets)}) if values else [])
    return out


def bucket_of(col: Column, cuts: Sequence, kind: DataType) -> Column:
    """Number of cut points that are not above the value, by binary search; null is 0."""
    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(col < F.lit(cuts[mid]).cast(kind), search(lo, mid)).otherwise(search(mid + 1, hi))

    return F.when(col.isNull(), F.lit(0)).otherwise(search(0, len(cuts))).cast("long")


def z_value(df: DataFrame, cols: Sequence[str], bits: int | None = None, rows: int | None = None) -> Column:
    """Interleaved bucket numbers; ``bits`` per column, as many as fit into 63 by default."""
    cols = list(cols)
    bits = min(MAX_BITS, 63 // len(cols)) if bits is None else bits
    if bits < 1 or bits * len(cols) > 63:
        raise ValueError(f"{len(cols)} columns of {bits} bits do not fit into a z value of 63 bits")
    parts = [bucket_of(F.col(c), cuts, df.schema[c].dataType) for c, cuts in zip(cols, cut_points(df, cols, bits, rows), strict=True)]
    z = F.lit(0).cast("long")
    for b in range(bits):
        for i, p in enumerate(parts):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(p, b).bitwiseAND(F.lit(1)), b * len(cols) + i))
    return z


def zorder(df: DataFrame, cols: Sequence[str], bits: int | None = None, partitions: int | None = None,
           z_col: str = "z", rows: int | None = None) -> DataFrame:
    """Rows clustered by the z value of ``cols`` (adds ``z_col``), in as many ranges as the
    data has millions of rows. A row hash is the second range key, so one heavily
    repeated z value still spreads over partitions."""
    n = df.count() if rows is None else rows
    partitions = partitions or max(1, math.ceil(n / ROWS_PER_RANGE))
    tie = F.xxhash64(*[F.col(f.name) for f in df.schema.fields if not isinstance(f.dataType, MapType)])
    return (df.withColumn(z_col, z_value(df, cols, bits, n))
            .repartitionByRange(partitions, F.col(z_col), tie)
            .sortWithinPartitions(z_col))


def optimize_tables(spark: SparkSession, tables: dict[str, Sequence[str]], out_root: str,
                    bits: int | None = None) -> DataFrame:
    """Rewrite each parquet table clustered by its z value into ``out_root/<name>``; a failure
    is recorded and the loop continues. Returns a row per table and a ``TOTAL`` row: rows
    read and written, seconds, and how many operations failed (``errors``)."""
    report = []
    for path, cols in tables.items():
        start = dt.datetime.now(dt.UTC)
        name = path.rstrip("/").split("/")[-1]
        target = f"{out_root.rstrip('/')}/{name}"
        n_in = n_out = None
        try:
            df = spark.read.parquet(path)
            n_in = df.count()
            zorder(df, cols, bits, rows=n_in).drop("z").write.mode("overwrite").parquet(target)
            n_out = spark.read.schema(df.schema).parquet(target).count()
            status, err = ("success", None) if n_in == n_out else ("failed", f"{n_in} rows read, {n_out} written")
        except Exception as e:  # noqa: BLE001 - reported, loop continues
            status, err = "failed", str(e)
        seconds = (dt.datetime.now(dt.UTC) - start).total_seconds()
        report.append((name, "optimize", status, n_in, n_out, int(status != "success"), seconds, err, target))
    total = (TOTAL, "optimize", "success" if not any(r[5] for r in report) else "failed", sum(r[3] or 0 for r in report),
             sum(r[4] or 0 for r in report), sum(r[5] for r in report), sum(r[6] for r in report), None, out_root)
    return spark.createDataFrame(
        [*report, total], "table string, operation string, status string, rows_in long, rows_out long, errors int, "
                          "duration_seconds double, error string, location string")
