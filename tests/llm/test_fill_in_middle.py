import hashlib
import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakehold.llm import fill_in_middle as fim
from tests.llm.helpers import LONG, dirty, docs_of

UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def brute(doc_id, text, seed=42, rate=50, spm=80):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    d = [int(h[8 * k:8 * k + 8], 16) for k in range(4)]
    units = UNIT.findall(text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or d[2] % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((d[0] % (n + 1), d[1] % (n + 1)))
    p, m, s = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    if d[3] % 100 < spm:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


ODD = [(k, t) for k in range(100, 130) for t in ("<S a <P", "a <P> b c", "x\x00y \x00", "\t\n", " a", "a ", "<", "< S >", "😀 漢字\x85 ß\xa0é <S", "<M", "a\n\nb c")]


def check(spark, docs, **kw):
    out = fim.transform(docs, **kw)
    got = sorted(map(tuple, out.collect()), key=str)
    assert got == sorted((brute(r.doc_id, r.text, **{{"spm_rate": "spm"}.get(k, k): v for k, v in kw.items()}) for r in docs.collect()), key=str)
    back = out.select("doc_id", fim.restored(F.col("output"), F.col("form")).alias("text"))
    assert sorted(map(str, back.collect())) == sorted(map(str, docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()))
    return got


def test_equals_brute_force_and_comes_back(spark):
    got = check(spark, dirty(spark).unionByName(docs_of(spark, ODD)))
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    forms = check(spark, docs_of(spark, ODD), seed=7, rate=100, spm_rate=0)
    assert {r[2] for r in forms} == {"plain", "psm"}
    assert fim.transform(dirty(spark).limit(0)).count() == 0


def test_long_text_and_small_slices(spark, monkeypatch):
    big = LONG * 20
    rows = [(k, t) for k, t in enumerate(["a b", big, "", "c  d ", None, big + " ", "e"])]
    monkeypatch.setattr(fim, "SLICE_BYTES", 8)
    check(spark, docs_of(spark, rows), rate=100)


def test_slices_hold_all_rows():
    b = pa.record_batch([pa.array(range(6)), pa.array(["", "abc", "é", "x" * 50, "", "y"])], names=["i", "t"])
    for size in (1, 3, 5, 100):
        parts = list(fim.by_size(b, 1, size))
        assert pa.Table.from_batches(parts).to_pydict() == pa.Table.from_batches([b]).to_pydict()
        assert all(p.num_rows == 1 or sum(len(t.as_py().encode()) for t in p.column(1)) <= size for p in parts)
    assert list(fim.by_size(b.slice(0, 0), 1, 5)) == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab \t\n\x0b\x0c\r<é\x85\x00"), min_size=1, max_size=12), min_size=1, max_size=5), st.integers(0, 2**32), st.integers(0, 2**32))
def test_pieces_of_any_text(texts, h1, h2):
    import numpy as np

    k = len(texts)
    got = fim.split_at(pa.array(texts), np.full(k, h1), np.full(k, h2))
    for row, t in enumerate(texts):
        u = UNIT.findall(t)
        a, b = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
        assert [g[row].as_py() for g in got] == ["".join(u[:a]), "".join(u[a:b]), "".join(u[b:])]
