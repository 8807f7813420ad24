"""Shared helpers of the training-data operators."""

from __future__ import annotations

import sys
from collections.abc import Callable, Hashable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakehold.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared checkpoint folder and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(id_col, folds: int = 5):
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def sample_by_hash(df: DataFrame, col: str, max_rows: int) -> DataFrame:
    """About ``max_rows`` rows of ``df`` (all, if it has no more; never over twice as many): those with the
    smallest hashes of ``col``, ties by all columns, so the same rows in every run. Rows are dropped where they
    are, so little more than the sample moves."""
    n = df.count()
    if n <= max_rows:
        return df
    place = F.shiftrightunsigned(F.xxhash64(F.lit(0), F.col(col)), 11)
    return df.where(place < int((1 << 53) * (max_rows / n))).orderBy(place, *df.columns).limit(2 * max_rows)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = f"_{name}"
    return name


MEMBER_BITS_LOG2 = 23  # bit table of one megabyte


def maybe_among(keys: DataFrame, col: str) -> Callable[[Column], Column]:
    """A test whether a key may be among ``keys``: never false for one that is, seldom true for another.

    It reads a bit table of fixed size, so rows that cannot match need not be shuffled for a join. With so
    many keys that the table fills up, all rows go the way of the join, and the result stays the same.
    """
    bit = lambda c: F.shiftrightunsigned(F.xxhash64(c), 64 - MEMBER_BITS_LOG2)
    words = keys.select(bit(F.col(col)).alias("bit")).selectExpr("bit div 64 as word", "shiftleft(1L, cast(bit % 64 as int)) as mask")
    table = np.zeros(1 << MEMBER_BITS_LOG2 - 6, np.int64)
    for r in words.groupBy("word").agg(F.bit_or("mask").alias("mask")).collect():  # at most as many as the table has
        table[r["word"]] = r["mask"]
    known = keys.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def maybe(bits: pd.Series) -> pd.Series:
        b = bits.to_numpy()
        return pd.Series((known.value[b >> 6] >> (b & 63)) & 1 == 1)

    return lambda c: maybe(bit(c))


def worker_cache(name: Hashable, make: Callable[[], object]):
    """What ``make`` made for ``name`` in this Python worker, kept across its tasks.

    A worker holds one such cache at a time: asking for another lets go of it, so stages that follow each
    other do not add up in memory.
    """
    mods = sys.modules
    if "_lakehold_llm_cache" not in mods:
        mods["_lakehold_llm_cache"] = type(sys)("_lakehold_llm_cache")
    slot = mods["_lakehold_llm_cache"].__dict__
    if slot.get("name") != name:
        slot["name"] = slot["value"] = None
        slot["value"] = make()
        slot["name"] = name
    return slot["value"]
