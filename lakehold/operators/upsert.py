"""Upsert (update-all / insert-all by key) as a DataFrame: the new target state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehold.operators.transform import latest_per_key
from lakehold.sources import tables


def one_per_key(source: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One source row per key: the greatest by ``order`` (default: by all other columns, so
    the choice does not depend on the input's order). A null key is a key like others."""
    rest = [c for c in source.columns if c not in keys]
    order = [*(order or []), *[c for c in rest if c not in (order or [])]]
    return latest_per_key(source, keys, order) if rest else source.distinct()


def _anti(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``left`` rows whose key ``right`` does not have, null-safe (AQE splits a skewed key)."""
    r = right.select(*[F.col(k).alias(f"__r{i}") for i, k in enumerate(keys)])
    cond: Column | None = None
    for i, k in enumerate(keys):
        c = F.col(k).eqNullSafe(F.col(f"__r{i}"))
        cond = c if cond is None else cond & c
    return left.join(r, cond, "left_anti")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Target rows without a source match, plus one source row per key."""
    keys = list(keys)
    return _anti(target, source, keys).unionByName(one_per_key(source, keys, order).select(*target.columns))


def inserted_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Source rows (one per key) whose key is not in the target: what an upsert inserts."""
    keys = list(keys)
    return _anti(one_per_key(source, keys, order), target, keys)


def upsert_partitions(location: str, source: DataFrame, keys: Sequence[str], partition: Column, staging: str,
                      name: str = "part_day", order: Sequence[str] | None = None) -> int:
    """Upsert into a table in files that is partitioned by a value of its rows (a day, say),
    and return the number of rows inserted.

    Only partitions that the source's rows fall into, or that hold a row with one of its
    keys, are read as a whole and replaced; of the others the keys are read. The table may
    be what ``source`` was made from. Without a table at ``location`` one is made.
    """
    spark, keys = source.sparkSession, list(keys)
    one = one_per_key(source, keys, order).select(*source.columns).withColumn(name, partition)
    one.write.mode("overwrite").parquet(f"{staging}/source")
    one = spark.read.schema(one.schema).parquet(f"{staging}/source")
    try:
        spark.read.text(location).limit(0)
    except AnalysisException:  # no such folder
        one.limit(0).write.partitionBy(name).parquet(location)
    target = spark.read.schema(one.schema).parquet(location)
    r = one.select(*[F.col(k).alias(f"__r{i}") for i, k in enumerate(keys)])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__r{i}"))
    held = {h[name]: h["n"] for h in target.select(*keys, name).join(r, same, "left_semi").groupBy(name).agg(F.count(F.lit(1)).alias("n")).collect()}
    mine = {h[name]: h["n"] for h in one.groupBy(name).agg(F.count(F.lit(1)).alias("n")).collect()}
    touched = list({**held, **mine})
    if touched:
        merged = _anti(target.where(tables.in_partitions(name, touched)), one, keys).unionByName(one)
        tables.overwrite_partitions(merged, location, name, touched, f"{staging}/merged")
    tables.drop_folder(spark, f"{staging}/source")
    return sum(mine.values()) - sum(held.values())
