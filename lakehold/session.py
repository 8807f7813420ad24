"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Fixed values of the pipeline contract.
OPEN_END = "2999-12-31 00:00:00"  # open end of a current version
INITIAL_WATERMARK = "2011-01-01 00:00:00"  # watermark before the first run
STATUS_OPERATIONAL = 50
STATUS_TEMP_UNAVAILABLE = 30


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "lakehold", driver_memory: str | None = None, extra: dict | None = None) -> SparkSession:
    """Session with AQE (coalescing + skew join), UTC and no UI. What is not given
    (master, memory, shuffle partitions) is left to the submitting environment."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_ROOTS: dict[int, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``, else the
    context's checkpoint dir). Only a single-process ``local[...]`` session may go
    without one: it gets a folder under the system temp dir. On a cluster a missing
    setting is an error, as executors and driver share no local folder."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session has no local context
        sc = None
    root = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if not root:
        if sc is None or not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _LOCAL_ROOTS.setdefault(id(spark), tempfile.mkdtemp(prefix="lakehold-ckpt-"))
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run in here go as soon as each has ended; else they stay until the
    driver happens to collect its garbage, so those of all steps of a run lie on the disk together."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (see ``checkpoint_root``)."""
    root = checkpoint_root(spark)
    return os.path.join(root.rstrip("/"), f"{name}-{uuid.uuid4().hex[:12]}")
