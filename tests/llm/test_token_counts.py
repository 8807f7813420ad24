import os

import public_tokenizers
from tokenizers import Tokenizer

from lakehold.llm import token_counts
from lakehold.session import shared_dir
from tests.llm.helpers import dirty, docs_of

PATH = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
LIB = Tokenizer.from_file(PATH)


def run(docs, cache):
    return token_counts.count_tokens(docs, cache, PATH, RANKS, public_tokenizers.PATTERN, max_tokens=10)


def test_counts_as_the_library(spark):
    docs = dirty(spark).unionByName(docs_of(spark, [(20, "a<|endoftext|>b"), (21, " " * 3000), (22, "é" * 500), (23, "a" * 5000), (24, "don't  stop\r\n\tnow"), (25, "​x")]))
    got = sorted((tuple(r) for r in run(docs, shared_dir(spark, "t-cache")).collect()), key=str)
    want = []
    for r in docs.collect():
        t = r.text or ""
        n = len(LIB.encode(t, add_special_tokens=False))
        want.append((r.doc_id, len(t.encode()), n, n > 10))
    assert got == sorted(want, key=str)


def test_only_misses_are_encoded(spark):
    cache = shared_dir(spark, "t-cache")
    rows = lambda: spark.read.schema(token_counts.CACHE_SCHEMA).parquet(cache)
    run(docs_of(spark, [(1, "one"), (2, "two"), (3, "one"), (4, None), (5, "")]), cache).collect()
    assert rows().count() == 3
    version = token_counts.tokenizer_version(PATH)
    # a cached count is taken as it is: the text is not encoded again
    spark.createDataFrame([("x", version, 1)], token_counts.CACHE_SCHEMA).write.mode("append").parquet(cache)
    doctored = rows().selectExpr("digest", "version", "n_tokens + 100 as n_tokens")
    path = cache + "-2"
    doctored.write.parquet(path)
    got = {r.doc_id: r.n_tokens for r in run(docs_of(spark, [(1, "one"), (9, "nine")]), path).collect()}
    assert got[1] == 101 and got[9] == 1
    assert spark.read.parquet(path).count() == 5
    # another version of the tokenizer shares nothing
    spark.createDataFrame([("x", "other", 7)], token_counts.CACHE_SCHEMA).write.mode("append").parquet(path)
    assert token_counts.cached(spark, path, "other").count() == 1


def test_empty_table(spark):
    cache = shared_dir(spark, "t-cache")
    assert run(dirty(spark).limit(0), cache).count() == 0
    assert os.path.isdir(cache) or "://" in cache


def test_whole_small_table_as_the_library(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    got = run(docs, shared_dir(spark, "t-cache")).collect()
    assert len(got) == len(text)
    assert all(r.n_tokens == len(LIB.encode(text[r.doc_id], add_special_tokens=False)) for r in got)


def test_registered_query_equals_the_library_on_all_documents(spark):
    from lakehold.llm.queries import op7_token_counts

    folder = "/root/testdata/sf0.1"
    rows = sorted(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect())
    texts = [r.text or "" for r in rows]
    want = []
    for k in range(0, len(texts), 500):
        want += [len(x.ids) for x in LIB.encode_batch(texts[k:k + 500], add_special_tokens=False)]
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in op7_token_counts(spark, folder).collect()}
    assert len(got) == len(rows)
    assert got == {r.doc_id: (len(t.encode()), n, n > 1024) for r, t, n in zip(rows, texts, want, strict=True)}
