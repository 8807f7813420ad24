import base64
import hashlib

import pytest

from lakehold.llm import queries, warc
from lakehold.session import shared_dir

PAGES = [(3, "u3", "<a>"), (1, "u1", "<a>"), (2, None, None), (4, "u4", ""), (5, "u\r\n5", "é" * 50_000), (5, "u5", "é" * 50_000),
         (None, "n", "<a>"), (None, "n", "only"), (7, "u7", "b")]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")


def written(spark, rows=PAGES, **kw):
    path = shared_dir(spark, "t-warc")
    warc.write_archive(pages(spark, rows), path, **kw)
    return path


def test_records_and_digests(spark):
    got = warc.read_archive(spark, written(spark)).collect()
    assert len(got) == len(PAGES)
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append(r)
    body = {1: "<a>", 2: "", 3: "<a>", 4: "", 7: "b"}
    for k, t in body.items():
        r = by[k][0]
        assert r.payload_bytes == len(t.encode())
        assert r.payload_digest == base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    assert [(by[k][0].record_type, by[k][0].refers_to) for k in (1, 2, 3, 4, 7)] == [
        ("response", None), ("response", None), ("revisit", 1), ("revisit", 2), ("response", None)]
    assert sorted((r.record_type, r.refers_to) for r in by[5]) == [("response", None), ("revisit", 5)]
    assert sorted(r.record_type for r in by[None]) == ["response", "revisit"]


def test_payloads_once_and_round_trip(spark):
    path = written(spark)
    records, payloads = warc.archive_tables(spark, path)
    assert payloads.count() == 5 and records.count() == len(PAGES)
    for r in warc.reconstruct(spark, path).collect():
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
        assert rest.endswith(b"\r\n\r\n") and int(fields[b"Content-Length"]) == len(rest) - 4
        assert fields[b"WARC-Payload-Digest"] == b"sha1:" + base64.b32encode(hashlib.sha1(rest[:-4]).digest())


def test_min_bytes_and_damage(spark):
    got = warc.read_archive(spark, written(spark, min_bytes=4)).collect()
    assert {r.page_id for r in got if r.record_type == "revisit"} == {5}
    path = written(spark)
    bad = warc.archive_tables(spark, path)[1].selectExpr("digest", "cast('zz' as binary) payload")
    bad.write.parquet(path + "-bad/payloads")
    warc.archive_tables(spark, path)[0].write.parquet(path + "-bad/records")
    with pytest.raises(Exception, match="payload damaged"):
        warc.read_archive(spark, path + "-bad").collect()


def test_empty_table(spark):
    assert warc.read_archive(spark, written(spark, [])).count() == 0


def test_query_has_no_python(spark):
    plan = queries.op2_warc(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
