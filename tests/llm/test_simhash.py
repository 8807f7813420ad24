import random
import re

import numpy as np
import xxhash

from lakehold.llm import components, simhash
from tests.llm.helpers import EXTRA, brute_words, dirty, docs_of


def brute(text):
    w = brute_words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    sh = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, bits=4):
    """Least member of each fingerprint's component."""
    fps = sorted(set(fps))
    par = {f: f for f in fps}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                x, y = find(a), find(b)
                par[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def test_near_duplicates_of_dirty_rows(spark):
    docs = dirty(spark)
    got = simhash.near_duplicates(docs).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fp = {(i, t): brute(t) for i, t in rows}
    root = brute_components(fp.values())
    least = {}
    for (i, _), f in fp.items():
        if i is not None:
            least[root[f]] = min(i, least.get(root[f], i))
    want = sorted((-1 if i is None else i, f"{fp[i, t]:016x}", least.get(root[fp[i, t]])) for i, t in rows)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    assert len(got) == len(rows)


def test_dense_and_long_lists_in_blocks(spark):
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    fps = {rng.getrandbits(64) for _ in range(150)} | {0, (1 << 64) - 1}
    for _ in range(500):  # a cloud around one fingerprint, chains included
        f = centre
        for _ in range(rng.randint(0, 9)):
            f ^= 1 << rng.randrange(64)
        fps.add(f)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    want = brute_components(fps)
    for block in (simhash.BLOCK, 20):
        edges = simhash.links(df, 4, block).distinct()
        assert edges.count() < 40 * len(fps)  # forests, not pairs
        got = {r.node % (1 << 64): r.root % (1 << 64) for r in components.connected_components(edges).collect()}
        groups = {}
        for f in fps:
            groups.setdefault(got.get(f, f), set()).add(f)
        brute_groups = {}
        for f in fps:
            brute_groups.setdefault(want[f], set()).add(f)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, brute_groups.values()))


def test_list_blocks_split_hot_lists(spark):
    df = spark.range(3000).selectExpr("id as fp")  # equal in all bytes but two
    blocks = simhash.list_blocks(df, simhash.position_masks(4), 200)
    assert blocks.max() > 1


def test_keep_one(spark):
    docs = dirty(spark)
    out = simhash.keep_one(docs)
    assert out.columns == ["doc_id", "text", *EXTRA]
    got = sorted((-1 if r.doc_id is None else r.doc_id) for r in out.collect())
    roots = {}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    root = brute_components([brute(t) for _, t in rows])
    for i, t in rows:
        key = (i is None, -1 if i is None else i)
        r = root[brute(t)]
        roots[r] = min(roots.get(r, key), key)
    assert got == sorted(k[1] for k in roots.values())


def test_empty_table_and_random_fingerprints(spark):
    assert simhash.near_duplicates(dirty(spark).limit(0)).count() == 0
    assert simhash.keep_one(dirty(spark).limit(0)).count() == 0
    for t in ["", "A", "a B c", "a B\x0bc d\te " * 50, "é 漢 \x85 \xa0x y"]:
        assert simhash.fingerprint(t) == brute(t)
    assert simhash.fingerprint("x " * 5000, 4) == brute("x " * 5000)
    x = np.array([0x0102030405060708], np.uint64)
    assert simhash.shared_bytes(x, np.uint64(0x0102030405060700)).tolist() == [7]


def test_components_of_a_long_chain(spark):
    n = 300
    edges = spark.range(n - 1).selectExpr("(id * 7919) % 300 as a", "((id + 1) * 7919) % 300 as b")
    got = components.connected_components(edges.unionByName(edges).unionByName(spark.createDataFrame([(1000, 1000), (2001, 2000)], "a long, b long")))
    assert sorted((r.node, r.root) for r in got.collect()) == [(k, 0) for k in range(1, n)] + [(2001, 2000)]
    assert components.connected_components(edges.limit(0)).count() == 0


def test_maybe_among_never_misses(spark):
    from pyspark.sql import functions as F

    from lakehold.llm.common import maybe_among

    keys = spark.range(0, 4000, 2).selectExpr("concat('k', id) as key")
    maybe = maybe_among(keys, "key")
    rows = spark.range(4000).selectExpr("id", "concat('k', id) as key").withColumn("m", maybe(F.col("key")))
    assert rows.where("id % 2 = 0 and not m").count() == 0
    assert rows.where("id % 2 = 1 and m").count() < 40
    none = maybe_among(keys.limit(0), "key")
    assert keys.where(none(F.col("key"))).count() == 0
