"""Type-2 history: classification, guards and invariants."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakehold.operators import scd2

D = dt.datetime
TSCHEMA = ("id int, status string, valid_from timestamp_ntz, valid_to timestamp_ntz, "
           "is_current boolean, sk long")
SSCHEMA = "id int, status string, ts timestamp_ntz"
END = D(2999, 12, 31)


def target(spark, rows):
    return spark.createDataFrame(rows, TSCHEMA)


def staged(spark, rows):
    return spark.createDataFrame(rows, SSCHEMA)


def actions(spark, t, s, **kw):
    return {r.id: r.scd_action for r in scd2.classify(s, t, ["id"], ["status"], **kw).collect()}


def test_insert_update_unchanged(spark):
    t = target(spark, [(1, "up", D(2025, 1, 1), END, True, 11), (2, "up", D(2025, 1, 1), END, True, 12)])
    s = staged(spark, [(1, "down", D(2025, 2, 1)), (2, "up", D(2025, 2, 1)), (3, "up", D(2025, 2, 1))])
    assert actions(spark, t, s) == {1: "UPDATE", 2: None, 3: "INSERT"}


def test_null_to_value_change(spark):
    t = target(spark, [(1, None, D(2025, 1, 1), END, True, 11)])
    s = staged(spark, [(1, "up", D(2025, 2, 1))])
    assert actions(spark, t, s) == {1: "UPDATE"}
    assert actions(spark, t, s, null_safe=False) == {1: None}


def test_late_row_ignored_and_latest_of_batch_wins(spark):
    t = target(spark, [(1, "up", D(2025, 3, 1), END, True, 11)])
    assert actions(spark, t, staged(spark, [(1, "down", D(2025, 2, 1))])) == {1: None}
    s = staged(spark, [(2, "a", D(2025, 1, 1)), (2, "b", D(2025, 1, 2))])
    new = scd2.apply_changes(t, s, ["id"], ["status"], ts="ts").where("id = 2").collect()
    assert [r.status for r in new] == ["b"]


def test_apply_expires_at_successor_start(spark):
    t = target(spark, [(1, "up", D(2025, 1, 1), END, True, 11)])
    s = staged(spark, [(1, "down", D(2025, 2, 1))])
    out = scd2.apply_changes(t, s, ["id"], ["status"], ts="ts").orderBy("valid_from").collect()
    assert [(r.status, r.valid_from, r.valid_to, r.is_current) for r in out] == [
        ("up", D(2025, 1, 1), D(2025, 2, 1), False), ("down", D(2025, 2, 1), END, True)]


def _random_log(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(20), rnd.choice(["a", "b", None]), D(2025, 1, 1) + dt.timedelta(hours=rnd.randrange(500)))
            for _ in range(400)]
    return spark.createDataFrame(rows, SSCHEMA).dropDuplicates(["id", "ts"])


def _check_invariants(df):
    assert df.groupBy("id").agg(F.count_if("is_current").alias("c")).where("c != 1").count() == 0
    w = Window.partitionBy("id").orderBy("valid_from")
    gaps = df.withColumn("nxt", F.lead("valid_from").over(w)).where("nxt IS NOT NULL AND nxt != valid_to")
    assert gaps.count() == 0


def test_daily_batches_keep_invariants(spark):
    """History before a cut-off, then one apply per day: one current row per key and
    touching intervals after every batch."""
    log = _random_log(spark, 7)
    cut = D(2025, 1, 10)
    applied = scd2.history(log.where(F.col("ts") < cut), ["id"], ["status"], ts="ts")
    later = log.where(F.col("ts") >= cut)
    days = sorted({r.d for r in later.select(F.to_date("ts").alias("d")).distinct().collect()})[:4]
    for d in days:
        applied = scd2.apply_changes(applied, later.where(F.to_date("ts") == F.lit(d)), ["id"], ["status"], ts="ts")
        _check_invariants(applied)


def test_replay_is_noop(spark):
    log = _random_log(spark, 8)
    cut = D(2025, 1, 12)
    t = scd2.history(log.where(F.col("ts") < cut), ["id"], ["status"], ts="ts")
    s = log.where(F.col("ts") >= cut)
    once = scd2.apply_changes(t, s, ["id"], ["status"], ts="ts")
    twice = scd2.apply_changes(once, s, ["id"], ["status"], ts="ts")
    assert sorted(once.collect(), key=repr) == sorted(twice.collect(), key=repr)
    _check_invariants(once)


def test_history_drops_repeats(spark):
    s = staged(spark, [(1, "a", D(2025, 1, 1)), (1, "a", D(2025, 1, 2)), (1, "b", D(2025, 1, 3)), (1, "a", D(2025, 1, 4))])
    h = scd2.history(s, ["id"], ["status"], ts="ts").orderBy("valid_from").collect()
    assert [r.status for r in h] == ["a", "b", "a"] and [r.is_current for r in h] == [False, False, True]


def test_history_split_equals_plain(spark):
    log = _random_log(spark, 9)
    a = scd2.history(log, ["id"], ["status"], ts="ts")
    b = scd2.history(log, ["id"], ["status"], ts="ts", split=F.date_trunc("day", "ts"))
    assert sorted(a.collect(), key=repr) == sorted(b.collect(), key=repr)


def test_null_key_is_one_group(spark):
    t = target(spark, [(None, "up", D(2025, 1, 1), END, True, 11)])
    s = staged(spark, [(None, "down", D(2025, 2, 1)), (None, "down", D(2025, 2, 1))])
    out = scd2.apply_changes(t, s, ["id"], ["status"], ts="ts").collect()
    assert sum(1 for r in out if r.is_current) == 1 and len(out) == 2
    assert actions(spark, t, s) == {None: "UPDATE"}


def test_apply_all_versions_keeps_batch_versions(spark):
    t = target(spark, [(1, "up", D(2025, 1, 5), END, True, 11)])
    s = staged(spark, [(1, "down", D(2025, 1, 6)), (1, "up", D(2025, 1, 7)), (1, "up", D(2025, 1, 8)),
                       (1, "down", D(2025, 1, 1)),  # late: older than the current version
                       (2, "a", D(2025, 1, 6))])
    out = scd2.apply_all_versions(t, s, ["id"], ["status"], ts="ts").orderBy("id", "valid_from").collect()
    assert [(r.id, r.status, r.valid_from.day, r.is_current) for r in out] == [
        (1, "up", 5, False), (1, "down", 6, False), (1, "up", 7, True), (2, "a", 6, True)]
    _check_invariants(scd2.apply_all_versions(t, s, ["id"], ["status"], ts="ts"))


def test_rows_without_a_time_make_no_version(spark):
    import datetime as dt

    d = dt.datetime
    s = "id int, status string, ts timestamp_ntz"
    target = scd2.history(spark.createDataFrame([(1, "up", d(2025, 1, 1))], s), ["id"], ["status"], ts="ts")
    staged = spark.createDataFrame([(1, "down", None), (2, "up", None), (3, "up", d(2025, 1, 2)), (None, "up", d(2025, 1, 2))], s)
    out = scd2.apply_changes(target, staged, ["id"], ["status"], ts="ts")
    assert sorted(str(r.id) for r in out.collect()) == ["1", "3", "None"]
    assert out.where("valid_from is null or is_current is null").count() == 0
    got = {r.id: r.scd_action for r in scd2.classify(staged, target, ["id"], ["status"], ts="ts").collect()}
    assert got == {3: "INSERT", None: "INSERT"}
    assert scd2.untimed(staged, "ts").count() == 2
    assert scd2.history(staged, ["id"], ["status"], ts="ts").count() == 2
    assert scd2.apply_all_versions(target, staged, ["id"], ["status"], ts="ts").count() == 3
