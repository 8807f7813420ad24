"""Table sinks without a transactional format: create-if-absent, counted writes,
and publishing a new table state into a fresh directory (never overwrite a path
that the plan still reads)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def create_if_absent(spark: SparkSession, name: str, schema: StructType,
                     location: str | None = None) -> DataFrame:
    if not spark.catalog.tableExists(name):
        w = spark.createDataFrame([], schema).write.format("parquet")
        if location:
            w = w.option("path", location)
        w.saveAsTable(name)
    return spark.table(name)


def write_counted(df: DataFrame, path: str, mode: str = "append",
                  partition_by: list[str] | None = None) -> int:
    """Write and return the row count from the same pass (``Observation``)."""
    obs = Observation("write")
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return int(obs.get["rows"])


def publish(spark: SparkSession, name: str, df: DataFrame, new_location: str) -> int:
    """Write the new state to ``new_location`` and point table ``name`` at it."""
    n = write_counted(df, new_location, mode="errorifexists")
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{new_location}'")
        spark.sql(f"REFRESH TABLE {name}")
    else:
        spark.catalog.createTable(name, path=new_location, source="parquet")
    return n


class GateFailed(RuntimeError):
    pass


def publish_gated(spark: SparkSession, name: str, df: DataFrame, new_location: str) -> int:
    """Publish only when no column is entirely null. The non-null counts come from the
    write pass itself (``Observation``); a failing state is written but never published."""
    obs = Observation("gate")
    counted = df.observe(obs, F.count(F.lit(1)).alias("__rows"),
                         *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    counted.write.mode("errorifexists").format("parquet").save(new_location)
    m = obs.get
    empty = [c for c in df.columns if m[c] == 0]
    if empty:
        raise GateFailed(f"not published: column(s) {empty} are all NULL")
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{new_location}'")
        spark.sql(f"REFRESH TABLE {name}")
    else:
        spark.catalog.createTable(name, path=new_location, source="parquet")
    return int(m["__rows"])


def partition_values(df: DataFrame, name: str) -> list:
    """Distinct values of a partition column (few), null included."""
    return [r[0] for r in df.select(name).distinct().collect()]


def in_partitions(name: str, values: list) -> Column:
    """A test for partition values that may be null; files of other partitions are not opened."""
    test = F.col(name).isin([v for v in values if v is not None])
    return test | F.col(name).isNull() if None in values else test


def overwrite_partitions(df: DataFrame, location: str, name: str, values: list, staging: str) -> None:
    """Replace the given partitions of a table in files by the rows of ``df``, which may read
    that table. The rows are staged first, and the staged files go; other partitions' files stay as they are, and a
    partition that gets no row goes. A repeated call gives the same table."""
    spark = df.sparkSession
    df.write.mode("overwrite").partitionBy(name).parquet(staging)
    rows = spark.read.schema(df.schema).parquet(staging)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(name).parquet(location)
    for v in set(values) - set(partition_values(rows, name)):
        drop_folder(spark, f"{location}/{name}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}")
    drop_folder(spark, staging)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove staged files that nothing reads any more; no such folder is no error."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
