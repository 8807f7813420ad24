"""Property tests on random inputs (few examples each: every example is a Spark job)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakehold.operators import quality, scd2
from lakehold.operators.windows import with_neighbor

D0 = dt.datetime(2025, 1, 1)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

rows_st = st.lists(
    st.tuples(st.sampled_from([0, 0, 0, 1, 2]),  # key 0 is hot
              st.integers(0, 2000),                # hours after D0
              st.sampled_from(["a", "b", None])),
    min_size=1, max_size=60)


@SETTINGS
@given(rows=rows_st, direction=st.sampled_from(["prev", "next"]))
def test_split_neighbor_equals_plain(spark, rows, direction):
    data = [(k, D0 + dt.timedelta(hours=h), v, i) for i, (k, h, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, ts timestamp_ntz, v string, id int")
    plain = with_neighbor(df, ["k"], ["ts", "id"], ["v", "id"], direction, "n_")
    split = with_neighbor(df, ["k"], ["ts", "id"], ["v", "id"], direction, "n_", F.date_trunc("week", "ts"))
    key = lambda r: (r.id,)
    assert sorted(plain.collect(), key=key) == sorted(split.collect(), key=key)


@SETTINGS
@given(rows=rows_st, cut=st.integers(0, 2000))
def test_scd2_invariants(spark, rows, cut):
    data = [(k, v, D0 + dt.timedelta(hours=h), i) for i, (k, h, v) in enumerate(rows)]
    log = spark.createDataFrame(data, "id int, status string, ts timestamp_ntz, seq int")
    c = D0 + dt.timedelta(hours=cut)
    t = scd2.history(log.where(F.col("ts") < c), ["id"], ["status"], ts="ts", order=["seq"])
    s = log.where(F.col("ts") >= c)
    once = scd2.apply_changes(t, s, ["id"], ["status"], ts="ts", order=["seq"])
    out = once.collect()
    keys = {r.id for r in out}
    assert all(sum(1 for r in out if r.id == k and r.is_current) == 1 for k in keys)
    w = Window.partitionBy("id").orderBy("valid_from", "valid_to")
    gaps = once.withColumn("nxt", F.lead("valid_from").over(w)).where("nxt IS NOT NULL AND nxt != valid_to")
    assert gaps.count() == 0
    twice = scd2.apply_changes(once, s, ["id"], ["status"], ts="ts", order=["seq"]).collect()
    assert sorted(map(repr, out)) == sorted(map(repr, twice))


@SETTINGS
@given(vals=st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 5)), st.one_of(st.none(), st.floats(-3, 3))),
                     min_size=1, max_size=40))
def test_split_valid_partitions_input(spark, vals):
    df = spark.createDataFrame(vals, "a int, b double")
    ok, bad = quality.split_valid(df, ["a"], ["b"])
    n_ok, n_bad = ok.count(), bad.count()
    assert n_ok + n_bad == len(vals)
    assert n_ok == sum(1 for a, b in vals if a is not None and b is not None and b >= 0)

