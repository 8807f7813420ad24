"""Data-quality gates: all-null column gate and the valid / quarantine split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


class ColumnGateError(RuntimeError):
    """A column has no non-null value (the run must stop)."""


def column_counts(df: DataFrame) -> DataFrame:
    """Long form ``(column_name, non_null_count, passed)`` from ONE aggregate."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    return (counts.selectExpr(f"stack({len(df.columns)}, {pairs}) AS (column_name, non_null_count)")
            .withColumn("passed", F.col("non_null_count") > 0))


def assert_columns_populated(df: DataFrame) -> DataFrame:
    """Raise ``ColumnGateError`` when any column is entirely null (an empty frame
    fails too); one Spark job for all columns."""
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    empty = [c for c in df.columns if row[c] == 0]
    if empty:
        raise ColumnGateError(f"Pipeline stopped: column(s) {empty} are all NULL")
    return df


def with_validity(df: DataFrame, required: Sequence[str], non_negative: Sequence[str] = (),
                  raw: str | None = None) -> DataFrame:
    """Add ``is_valid`` (never null) and ``reject_reasons``: ``col:null``, ``col:malformed``
    (null, but ``raw.col`` has text: the struct column ``raw`` holds the values before
    their cast), ``col:not_finite`` (NaN or infinite) and ``col:negative``. A null in a
    non-negative column is a rejection."""
    raw_fields = set(df.schema[raw].dataType.names) if raw else set()

    def reason(c: str, negative: bool):
        missing = F.lit(f"{c}:null")
        if c in raw_fields:
            missing = F.when(F.col(f"{raw}.{c}").isNotNull(), F.lit(f"{c}:malformed")).otherwise(missing)
        out = F.when(F.col(c).isNull(), missing)
        if isinstance(df.schema[c].dataType, (DoubleType, FloatType)):
            out = out.when(F.isnan(c) | (F.abs(F.col(c)) == float("inf")), F.lit(f"{c}:not_finite"))
        return out.when(F.col(c) < 0, F.lit(f"{c}:negative")) if negative else out

    reasons = [reason(c, False) for c in required] + [reason(c, True) for c in non_negative]
    arr = (F.array_distinct(F.filter(F.array(*reasons), lambda x: x.isNotNull())) if reasons
           else F.array().cast("array<string>"))
    return df.withColumn("reject_reasons", arr).withColumn("is_valid", F.size("reject_reasons") == 0)


def split_valid(df: DataFrame, required: Sequence[str], non_negative: Sequence[str] = (),
                raw: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with reasons). Valid + rejected == input."""
    marked = with_validity(df, required, non_negative, raw)
    valid = marked.where(F.col("is_valid")).drop("is_valid", "reject_reasons")
    rejected = marked.where(~F.col("is_valid")).drop("is_valid")
    return valid, rejected
