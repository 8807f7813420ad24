import hashlib
import random

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from lakehold.llm import queries, simhash
from tests.llm.helpers import dirty
from tests.llm.test_decontaminate import ITEM
from tests.llm.test_simhash import brute, brute_components

LIB = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def tables(spark, path):
    rng = random.Random(12)
    rows, labels = [], []
    for k in range(300):
        words = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(20, 60))]
        bad = k % 5 == 0
        rows.append((k, " ".join(w + ("###" if bad else "") for w in words), "en", "s", 1))
        labels.append((k, int(not bad), 0))
    rows += [(300, rows[1][1], "en", "s", 1), (301, rows[2][1], None, None, None), (302, f"{rows[3][1]} {ITEM}", "en", "s", 1),
             (303, rows[4][1] + " token: abcdef123456", "en", "s", 1), (None, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return rows, {i for i, q, _ in labels if q}


def test_pipeline_equals_brute_force(spark, tmp_path):
    rows, good = tables(spark, str(tmp_path))
    kept = [r for r in rows if r[0] in good or r[0] is None or r[0] >= 300]
    root = brute_components([brute(t) for _, t, *_ in kept])
    first = {}
    for i, t, *_ in kept:
        k = (i is None, -1 if i is None else i)
        first[root[brute(t)]] = min([(k, t), *([first[root[brute(t)]]] if root[brute(t)] in first else [])], key=lambda x: x[0])
    texts = {k[1]: t for k, t in first.values() if ITEM not in (t or "")}
    if 303 in texts:
        texts[303] = texts[303].replace("token: abcdef123456", "[SECRET]")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {-1 if r.doc_id is None else r.doc_id for r in got} == set(texts)
    for r in got:
        ids = LIB.encode(texts[-1 if r.doc_id is None else r.doc_id] or "", add_special_tokens=False).ids
        assert list(r.ids) == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_stages_return_the_columns_of_documents(spark, tmp_path):
    tables(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontaminated", "secrets", "encoded"]


def test_stages_take_empty_and_dirty_tables(spark, tmp_path):
    tables(spark, str(tmp_path))
    for docs in (dirty(spark), dirty(spark).limit(0)):
        docs.write.mode("overwrite").parquet(f"{tmp_path}/in")
        stored = spark.read.parquet(f"{tmp_path}/in")
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, stored, str(tmp_path))
            n = out.count()
            assert n <= stored.count(), name
            if name in ("secrets", "encoded"):
                assert n == stored.count()


def test_all_queries_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {f"op{k}" for k in range(1, 11)} == {n.split("_")[0] for n in queries.QUERIES} and "pipeline" in names
    assert set(queries.QUERIES) <= names and set(queries.ORACLES) <= set(queries.QUERIES)
    assert simhash.MAX_BITS == 4
