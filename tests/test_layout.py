from pyspark.sql import functions as F

from lakehold.operators import layout


def test_zorder_keeps_content_and_clusters(spark, tmp_path):
    df = spark.range(0, 4096).select((F.col("id") % 64).alias("a"), (F.col("id") / 64).cast("long").alias("b"))
    z = layout.zorder(df, ["a", "b"], bits=6, partitions=8)
    assert sorted(z.drop("z").collect()) == sorted(df.collect())
    assert z.select("z").distinct().count() == 4096
    # each range partition covers a narrow box: fewer distinct a-values than a hash layout
    spans = z.groupBy(F.spark_partition_id().alias("p")).agg(F.countDistinct("a").alias("na")).collect()
    assert max(r.na for r in spans) < 64


def test_optimize_report_continues_after_failure(spark, tmp_path):
    good = str(tmp_path / "good")
    spark.range(100).withColumn("b", F.col("id") * 2).write.parquet(good)
    rep = layout.optimize_tables(spark, {good: ["id", "b"], str(tmp_path / "missing"): ["x"]}, str(tmp_path / "out"))
    got = {r.table: r for r in rep.collect()}
    assert {k: r.status for k, r in got.items()} == {"good": "success", "missing": "failed", "TOTAL": "failed"}
    total = got["TOTAL"]
    assert (total.rows_in, total.rows_out, total.errors) == (100, 100, 1) and got["missing"].error
    assert spark.read.parquet(str(tmp_path / "out" / "good")).count() == 100


def test_zorder_on_timestamp_and_date(spark):
    import datetime as dt

    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), dt.date(2024, 1, 1) + dt.timedelta(days=i % 30))
            for i in range(200)]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, d date")
    z = layout.zorder(df, ["ts", "d", "k"], bits=5, partitions=4)
    assert z.count() == 200 and z.where("z IS NULL").count() == 0


def test_zorder_on_hash_and_string_keys_prunes_row_groups(spark, tmp_path):
    import pyarrow.parquet as pq

    df = spark.range(20_000).select("id", F.xxhash64("id").alias("sk"), F.concat(F.lit("s"), (F.col("id") * 7919 % 500).cast("string")).alias("station"))
    layout.zorder(df, ["sk", "station"], partitions=16).drop("z").write.parquet(str(tmp_path / "z"))
    df.repartition(16).write.parquet(str(tmp_path / "plain"))

    def groups(folder, column, value):
        hit = total = 0
        for f in sorted((tmp_path / folder).glob("*.parquet")):
            meta = pq.ParquetFile(f).metadata
            i = meta.schema.names.index(column)
            for g in range(meta.num_row_groups):
                st = meta.row_group(g).column(i).statistics
                total += 1
                hit += st.min <= value <= st.max
        return hit, total

    some = df.where("id = 4711").first()
    for column, value in (("sk", some.sk), ("station", some.station)):
        z_hit, _ = groups("z", column, value)
        plain_hit, total = groups("plain", column, value)
        assert plain_hit == total and z_hit <= total // 2, column


def test_zorder_refuses_too_many_bits(spark):
    import pytest

    df = spark.range(10).select(*[F.col("id").alias(f"c{k}") for k in range(8)])
    with pytest.raises(ValueError, match="63 bits"):
        layout.zorder(df, df.columns, bits=8)
    z = layout.zorder(df, df.columns)  # seven bits each
    assert z.where("z < 0").count() == 0


def test_zorder_nulls_nan_and_empty(spark):
    rows = [(None, float("nan"), "x"), (1, 2.0, None), (2, None, "y")]
    df = spark.createDataFrame(rows, "a int, b double, c string")
    assert layout.zorder(df, ["a", "b", "c"]).count() == 3
    assert layout.zorder(df.limit(0), ["a", "b", "c"]).count() == 0
