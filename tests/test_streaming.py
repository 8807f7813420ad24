"""Streaming results equal the batch results on the same files."""

import datetime as dt
import random
import shutil

from lakehold.operators import scd2
from lakehold.operators.history_store import HistoryStore
from lakehold.operators.keyed_table import KeyedTable
from lakehold.streaming import ingest, scd2_stream

D = dt.datetime


def _write_batches(spark, root, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "id int, status string, ts timestamp_ntz").coalesce(1) \
            .write.mode("overwrite").parquet(f"{root}/tmp{i}")
        # move each batch into the watched folder as its own file set
        for f in (spark.read.parquet(f"{root}/tmp{i}").inputFiles()):
            import shutil
            shutil.copy(f.replace("file://", ""), f"{root}/in/part-{i:03d}.parquet")


def test_stream_dedup_within_watermark(spark, tmp_path):
    root = str(tmp_path)
    (tmp_path / "in").mkdir()
    b1 = [(1, "a", D(2025, 1, 1, 10, 0)), (2, "a", D(2025, 1, 1, 10, 5))]
    b2 = [(2, "a", D(2025, 1, 1, 10, 5)), (3, "b", D(2025, 1, 1, 10, 20))]  # re-delivered id 2
    _write_batches(spark, root, [b1, b2])
    s = ingest.read_table_stream(spark, f"{root}/in", "*.parquet", max_files_per_trigger=1)
    ingest.run_to_parquet(ingest.dedup_stream(s, ["id"], "ts"), f"{root}/out", f"{root}/ckpt")
    assert sorted(r.id for r in spark.read.parquet(f"{root}/out").collect()) == [1, 2, 3]


S = "id int, status string, ts timestamp_ntz"


def _store(root, buckets=4):
    return HistoryStore(root, ("id",), ("status",), ("status",), "ts", (), buckets)


def _random_log(n=200, seed=3):
    rng = random.Random(seed)
    return [(rng.choice([1, 2, 3, None]), rng.choice(["up", "down", None]), D(2025, 1, 1) + dt.timedelta(minutes=k)) for k in range(n)]


def _files(spark, root, rows, n, seed):
    """``rows`` as ``n`` parquet files whose names are in a random order of time."""
    (root / "in").mkdir(parents=True)
    parts = [rows[k::n] if seed is None else rows[k * len(rows) // n:(k + 1) * len(rows) // n] for k in range(n)]
    random.Random(seed or 0).shuffle(parts)
    _write_batches_as(spark, str(root), parts)


def _write_batches_as(spark, root, parts):
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, S).coalesce(1).write.mode("overwrite").parquet(f"{root}/tmp{i}")
        for f in spark.read.parquet(f"{root}/tmp{i}").inputFiles():
            shutil.copy(f.replace("file://", ""), f"{root}/in/part-{i:03d}.parquet")


def test_stream_scd2_does_not_depend_on_the_batches(spark, tmp_path):
    rows = _random_log()
    want = sorted(map(repr, scd2.history(spark.createDataFrame(rows, S), ["id"], ["status"], ts="ts").collect()))
    for name, n, seed in (("one", 1, 1), ("ordered", 5, None), ("shuffled", 20, 7)):
        root = tmp_path / name
        _files(spark, root, rows, n, seed)
        store = _store(f"{root}/state")
        store.init(scd2.history(spark.createDataFrame([], S), ["id"], ["status"], ts="ts"))  # from an empty table
        s = ingest.read_table_stream(spark, f"{root}/in", "*.parquet", max_files_per_trigger=1)
        scd2_stream.run_scd2_stream(s, store, f"{root}/ckpt")
        assert sorted(map(repr, store.state(spark).collect())) == want, name


def test_stream_dedup_keeps_late_rows_and_drops_repeats(spark, tmp_path):
    rows = [(k % 150, "a", D(2025, 1, 1) + dt.timedelta(minutes=17 * (k % 150))) for k in range(200)] + [(None, "n", None), (None, "n", None)]
    # repeats with other times and values, days before and after, and without a time
    rows += [(k, "later", D(2025, 1, 20)) for k in range(0, 150, 7)] + [(k, "earlier", D(2024, 12, 1)) for k in range(0, 150, 11)]
    rows += [(k, "untimed", None) for k in range(0, 200, 13)] + [(5, "b", D(2025, 1, 1, 1, 25)), (5, "c", D(2025, 1, 1, 1, 25))]
    want = {}
    for k, s, t in rows:
        have = want.get(k)
        want[k] = t if have is None else min(have, t) if t is not None else have
    tables = []
    for name, n, seed in (("one", 1, 1), ("shuffled", 20, 5), ("ordered", 3, None)):
        root = tmp_path / name
        _files(spark, root, rows, n, seed)
        s = ingest.read_table_stream(spark, f"{root}/in", "*.parquet", max_files_per_trigger=1)
        kept = KeyedTable(f"{root}/table", ("id",), "ts", buckets=2, max_rows=20)
        ingest.dedup_into(s, kept, f"{root}/ckpt")
        got = kept.rows(spark).collect()
        assert {r.id: r.ts for r in got} == want and len(got) == len(want)
        tables.append(sorted(map(repr, got)))
        assert len(kept.directory(spark).leaves()) > 4  # buckets were split on the way
    assert tables[0] == tables[1] == tables[2]


def test_keyed_table_reads_and_writes_touched_buckets_only(spark, tmp_path):
    t = KeyedTable(str(tmp_path / "t"), ("id",), "ts", buckets=16)
    frame = lambda rows: spark.createDataFrame(rows, S)
    t.create(spark, frame([]).schema)
    assert t.apply(frame([]), 0) == 0 and t.rows(spark).count() == 0
    rows = [(k, "a", D(2025, 1, 1)) for k in range(100)]
    t.apply(frame(rows), 0)
    t.create(spark, frame([]).schema)  # a table that exists stays
    assert t.apply(frame(rows), 1) == 0  # known rows: no commit
    assert t.apply(frame([(7, "b", D(2025, 3, 1)), (100, "a", D(2025, 1, 1))]), 2) == 1
    assert t.apply(frame([(7, "b", D(2024, 3, 1))]), 3) == 1
    done = spark.read.parquet(f"{t.root}/commits").where("batch > 0").collect()
    assert sorted((r.batch, r.rebuilt, r.n_rows) for r in done) == [(2, False, 1), (3, True, 0)]
    for _ in range(2):  # a retried batch
        t.apply(frame([(101, "a", D(2025, 1, 1)), (8, "b", D(2024, 1, 1))]), 4)
    got = {r.id: (r.status, r.ts.year) for r in t.rows(spark).collect()}
    assert len(got) == 102 and t.rows(spark).count() == 102 and got[7] == ("b", 2024) and got[8] == ("b", 2024) and got[9] == ("a", 2025)


def test_store_touches_only_the_batches_buckets(spark, tmp_path):
    store = _store(str(tmp_path / "t"), buckets=16)
    log = spark.createDataFrame([(k, "up", D(2025, 1, 1)) for k in range(60)], S)
    store.init(scd2.history(log, ["id"], ["status"], ts="ts"))
    assert store.apply(spark.createDataFrame([(7, "down", D(2025, 1, 2))], S), 0) == 1
    written = spark.read.parquet(str(tmp_path / "t/data/batch=0"))
    assert written.select("bucket").distinct().count() == 1
    state = store.state(spark)
    assert state.count() == 61 and state.where("is_current").count() == 60
    # a batch of rows that were applied before changes nothing, nor does an empty batch or one without a time
    before = sorted(map(repr, state.collect()))
    store.apply(spark.createDataFrame([(7, "down", D(2025, 1, 2)), (7, "down", D(2025, 1, 2))], S), 1)
    assert store.apply(spark.createDataFrame([], S), 2) == 0
    assert store.apply(spark.createDataFrame([(8, "down", None)], S), 3) == 0
    assert sorted(map(repr, store.state(spark).collect())) == before
    # a retried batch overwrites its own folder
    store.apply(spark.createDataFrame([(9, "down", D(2025, 1, 3))], S), 4)
    once = sorted(map(repr, store.state(spark).collect()))
    store.apply(spark.createDataFrame([(9, "down", D(2025, 1, 3))], S), 4)
    assert sorted(map(repr, store.state(spark).collect())) == once
    new = store.compact(str(tmp_path / "t2"), spark)
    assert sorted(map(repr, new.state(spark).collect())) == once
    new.apply(spark.createDataFrame([(9, "late", D(2025, 1, 2))], S), 0)
    assert [r.status for r in new.state(spark).where("id = 9").orderBy("valid_from").collect()] == ["up", "late", "down"]
