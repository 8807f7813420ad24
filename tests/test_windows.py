"""Neighbour values of keys that no bucket of their own values can spread."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakehold.operators import windows


def plain(df, keys, order, values, direction, prefix):
    shift = F.lag if direction == "prev" else F.lead
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({f"{prefix}{v}": shift(F.col(v)).over(w) for v in values})


def test_one_key_of_one_month_is_spread_over_ranges(spark, monkeypatch):
    n = 300_000
    # all rows of one key within one month, and a few others
    df = spark.range(n).select(F.when(F.col("id") % 1000 == 1, F.lit(2)).when(F.col("id") % 5000 == 2, F.lit(None)).otherwise(1).alias("k"),
                               F.timestamp_add("SECOND", F.col("id").cast("int") * 7 % n, F.lit("2025-01-01").cast("timestamp_ntz")).alias("t"),
                               F.col("id"), (F.col("id") % 13).alias("v"))
    ranges = {}
    whole = windows.with_neighbor

    def seen(stored, *args):
        got = stored.groupBy("k", F.shiftright("__at", 33).alias("p")).count().collect()
        ranges.update({(r.k, r.p): r["count"] for r in got})
        return whole(stored, *args)

    monkeypatch.setattr(windows, "with_neighbor", seen)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for direction in ("prev", "next"):
            got = windows.with_neighbor_ranged(df, ["k"], ["t", "id"], ["v", "t"], direction, "n_")
            want = plain(df, ["k"], ["t", "id"], ["v", "t"], direction, "n_")
            assert got.columns == want.columns
            assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hot = [c for (k, _), c in ranges.items() if k == 1]
    assert len(hot) >= 6 and max(hot) < n / 4


def test_small_and_empty_frames(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "b"), (1, None, "c"), (1, 1, "d")], "k int, o int, v string")
    got = {(r.k, r.o): r.prev_v for r in windows.with_neighbor_ranged(df, ["k"], ["o"], ["v"]).collect()}
    assert got == {(None, 1): None, (None, 2): "a", (1, None): None, (1, 1): "c"}
    assert windows.with_neighbor_ranged(df.limit(0), ["k"], ["o"], ["v"]).count() == 0
