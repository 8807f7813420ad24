"""Table of one row per key in plain files, the same for any cut of the input into batches.

Of all rows of a key the one with the least event time stays (rows without a time last;
then the least hash of the row), however late and in whatever batch it comes. Layout under
``root``::

    schema/                              an empty file with the columns and the row's hash
    staged/batch=<id>/                   the batch, one row per key
    judged/batch=<id>/                   those of them that change the table
    data/batch=<id>/bucket=<k>/          rows of new keys, or the whole bucket written anew
    commits/batch=<id>/                  per bucket: new rows, rebuilt or split

A batch reads the keys and times of the buckets that its keys fall into, whatever their
times; rows of new keys are appended. Where a row replaces a stored one, or the bucket
grows over ``max_rows``, the bucket is written anew (``operators.buckets``). A batch that
repeats known rows commits nothing, and one that fails or is repeated overwrites its own
folders. Keys compare null-safe: all rows of a null key are one key's.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StructType
from pyspark.errors import AnalysisException

from lakehold.functions.columns import surrogate_key
from lakehold.operators.buckets import INIT_BATCH, MAX_ROWS, BucketFiles, Directory

RANK = "__rank"


@dataclass(frozen=True)
class KeyedTable(BucketFiles):
    root: str
    keys: tuple[str, ...]
    event_time: str
    buckets: int = 64  # at first
    max_rows: int = MAX_ROWS
    _schemas: dict = field(default_factory=dict, compare=False, repr=False)

    def _time_type(self, spark: SparkSession) -> DataType:
        return LongType()  # commits give no spans: a repetition may have any time

    def create(self, spark: SparkSession, schema: StructType) -> None:
        """Create an empty table, if there is none."""
        try:
            spark.read.parquet(f"{self.root}/commits/batch={INIT_BATCH}")
        except AnalysisException:
            empty = spark.createDataFrame([], schema).withColumn(RANK, F.lit(0).cast("long"))
            empty.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/schema")
            self._write(empty.withColumn("bucket", F.lit(0).cast("long")), "data", INIT_BATCH)
            self._commit(spark, [], INIT_BATCH)

    def _order(self, time: Column, rank: Column) -> Column:
        return F.struct(time.isNull().alias("untimed"), time.alias("time"), rank.alias("rank"))

    def _rows(self, spark: SparkSession, d: Directory, buckets: Sequence[int]) -> DataFrame:
        """Stored rows of buckets, with ``bucket``: those since each was last written anew."""
        by_base: dict[int, list[int]] = {}
        for b in buckets:
            if b in d.base:
                by_base.setdefault(d.base[b], []).append(b)
        wanted = F.lit(False)
        for base, bs in by_base.items():
            wanted = wanted | ((F.col("batch") >= base) & F.col("bucket").isin(bs))
        return self._files(spark, "data", "schema").where(wanted & F.col("batch").isin(list(d.batches)))

    def rows(self, spark: SparkSession) -> DataFrame:
        d = self.directory(spark)
        return self._rows(spark, d, list(d.base)).drop("bucket", "batch", RANK)

    def _stored(self, df: DataFrame, part: str, batch_id: int) -> DataFrame:
        path = f"{self.root}/{part}/batch={batch_id}"
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def apply(self, rows: DataFrame, batch_id: int) -> int:
        """Apply and commit a batch. Returns the number of buckets changed."""
        spark = rows.sparkSession
        d = self.directory(spark, batch_id)
        keys, cols = list(self.keys), [f.name for f in self._schema(spark, "schema").fields]
        ranked = rows.withColumn(RANK, surrogate_key(*rows.columns)).select(*cols)
        first = ranked.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in cols if c not in keys]), self._order(F.col(self.event_time), F.col(RANK))).alias("__row"))
        first = first.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in cols]).withColumn("bucket", self._bucket(d))
        staged = self._stored(first, "staged", batch_id)
        touched = [r[0] for r in staged.select("bucket").distinct().collect()]
        if not touched:
            return 0
        held = self._rows(spark, d, touched).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("bucket").alias("__bucket"),
                                                    self._order(F.col(self.event_time), F.col(RANK)).alias("__held"))
        same = F.col("bucket") == F.col("__bucket")
        for i, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
        j = staged.join(held, same, "left").withColumn("is_new", F.col("__held").isNull())
        j = j.where(F.col("is_new") | (self._order(F.col(self.event_time), F.col(RANK)) < F.col("__held")))
        judged = self._stored(j.select(*cols, "bucket", "is_new"), "judged", batch_id)
        per = {r["bucket"]: (r["new"], r["better"]) for r in judged.groupBy("bucket").agg(
            F.count_if("is_new").alias("new"), F.count_if(~F.col("is_new")).alias("better")).collect()}
        if not per:
            return 0
        split, leaves = self._plan({b: (d.rows.get(b, 0) + n, 1) for b, (n, _) in per.items()})
        anew = [b for b in per if per[b][1] or b in leaves]
        after = Directory(d.depth, d.split | set(split))
        out = judged.where(~F.col("bucket").isin(anew)).select(*cols) if anew else judged.select(*cols)
        if anew:
            changed = judged.where(F.col("bucket").isin(anew))
            better = changed.where(~F.col("is_new")).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
            gone = F.lit(True)
            for i, k in enumerate(keys):
                gone = gone & F.col(k).eqNullSafe(F.col(f"__k{i}"))
            kept = self._rows(spark, d, anew).join(better, gone, "left_anti")
            out = out.unionByName(kept.select(*cols)).unionByName(changed.select(*cols))
        self._write(out.withColumn("bucket", self._bucket(after)), "data", batch_id)
        commit = [(b, b in anew, False, n, 0, None, None) for b, (n, _) in per.items() if b not in leaves]
        if leaves:
            below = [x for b in leaves for x in leaves[b]]
            mine = self._files(spark, "data", "schema").where((F.col("batch") == batch_id) & F.col("bucket").isin(below))
            commit += [(r["bucket"], True, False, r["count"], 0, None, None) for r in mine.groupBy("bucket").count().collect()]
            commit += [(b, False, True, 0, 0, None, None) for b in split]
        self._commit(spark, commit, batch_id)
        return len(per)
