"""Request grid: every (lat, lon) at ``step`` in a box, upper bound excluded.

Cell values follow the floating-point ``arange`` rule: ``n = ceil((max - min) / step)``
values ``min + i * delta`` where ``delta = (min + step) - min`` (the step as it comes
out after one addition); the grid is a distributed ``range`` split into
(i, j) by integer division, so no cross product is formed.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _count(lo: float, hi: float, step: float) -> int:
    return max(0, math.ceil((hi - lo) / step)) if hi > lo else 0


def request_grid(spark: SparkSession, min_lat: float, min_lon: float, max_lat: float,
                 max_lon: float, step: float = 0.1) -> DataFrame:
    n_lat, n_lon = _count(min_lat, max_lat, step), _count(min_lon, max_lon, step)
    ids = spark.range(n_lat * n_lon)
    i = F.floor(F.col("id") / F.lit(n_lon)) if n_lon else F.lit(0)
    j = F.pmod(F.col("id"), F.lit(n_lon)) if n_lon else F.lit(0)
    d_lat = (float(min_lat) + step) - float(min_lat)
    d_lon = (float(min_lon) + step) - float(min_lon)
    return ids.select(
        (F.lit(float(min_lat)) + i.cast("double") * F.lit(d_lat)).alias("lat"),
        (F.lit(float(min_lon)) + j.cast("double") * F.lit(d_lon)).alias("lon"),
    )


def grid_over(df: DataFrame, lat: str, lon: str, step: float = 0.1) -> DataFrame:
    """Grid over the bounding box of the points in ``df`` (box = one aggregate row)."""
    b = df.agg(F.min(lat).alias("a"), F.min(lon).alias("b"),
               F.max(lat).alias("c"), F.max(lon).alias("d")).first()
    if b["a"] is None:
        return request_grid(df.sparkSession, 0.0, 0.0, 0.0, 0.0, step)
    return request_grid(df.sparkSession, b["a"], b["b"], b["c"], b["d"], step)
