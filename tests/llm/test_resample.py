import math
import random

import numpy as np
from pyspark.sql import functions as F

from lakehold.llm import resample
from tests.llm.helpers import EXTRA, dirty, docs_of, labels_of


def corpus(spark, n=600):
    rng = random.Random(8)
    rows, labels = [], []
    for k in range(n):
        bad = k % 6 == 0
        words = [f"w{rng.randint(0, 200)}" for _ in range(rng.randint(30, 90))]
        rows.append((k, " ".join(w + ("###" if bad else "") for w in words)))
        labels.append((k, int(not bad), 0))
    return docs_of(spark, rows), labels_of(spark, labels), {i for i, q, _ in labels if not q}


def test_keeps_clean_and_rejects_junk(spark):
    docs, labels, bad = corpus(spark)
    sampler, rows = resample.learn(docs, labels.where("doc_id % 2 = 0"))
    out = sampler.select(docs)
    assert out.columns == ["doc_id", "text", *EXTRA]
    assert {r.doc_id for r in out.collect()} == set(range(600)) - bad
    assert rows.count() == 600


def test_weights_equal_brute_force(spark):
    docs, labels, _ = corpus(spark, 60)
    _, rows = resample.learn(docs, labels)
    text = {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id for r in labels.where("quality = 1").where(~resample.for_cut("doc_id")).collect()}
    size = 1 << resample.BUCKETS_LOG2
    raw, target = np.zeros(size), np.zeros(size)
    for i, t in text.items():
        c = np.bincount(resample.buckets(t), minlength=size)
        raw += c
        target += c if i in good else 0
    ratio = np.log((target + 10) / (raw * target.sum() / raw.sum() + 10))
    for r in rows.collect():
        w = ratio[resample.buckets(text[r.doc_id])].mean() * 200
        assert abs(r.log_weight - w) < 1e-3 * max(1, abs(w))


def test_exact_k_with_ties(spark):
    values = [1.5, 1.5, 1.5, -2.0, 7.25, 0.0, 1e-9, 1.5, 1e300, -1e300, 3.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k, want in enumerate(sorted(values, reverse=True), 1):
        assert resample.kth_largest(df, "v", k) == want
    rng = random.Random(3)
    many = [rng.gauss(0, 1) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in many], "v double")
    for k in (1, 2, 1500, 2999, 3000):
        assert resample.kth_largest(df, "v", k) == sorted(many, reverse=True)[k - 1]


def test_given_k_and_gumbel_noise(spark):
    docs, labels, _ = corpus(spark, 200)
    sampler, _ = resample.learn(docs, labels, k=50)
    assert sampler.select(docs).count() == 50
    other, _ = resample.learn(docs, labels, k=50, seed=99)
    assert {r.doc_id for r in sampler.select(docs).collect()} != {r.doc_id for r in other.select(docs).collect()}
    g = np.array([r.g for r in spark.range(20_000).withColumn("g", resample.gumbel("id")).collect()])
    assert abs(g.mean() - 0.5772) < 0.03 and abs(g.std() - math.pi / math.sqrt(6)) < 0.03
    none, _ = resample.learn(docs, labels, k=0)
    assert none.select(docs).count() == 0


def test_dirty_rows_and_missing_labels(spark):
    rows = dirty(spark)
    for labels in (labels_of(spark, []), labels_of(spark, [(None, 1, 0), (5, None, 0), (1, 1, 0)]), labels_of(spark, [(1, 0, 0)])):
        sampler, scored = resample.learn(rows, labels)
        assert sampler.select(rows).count() == rows.count() == scored.count()
    _, scored = resample.learn(rows, labels_of(spark, [(1, 1, 0), (5, 0, 0), (5, 1, 0)]))
    assert {r.log_weight for r in scored.where(F.col("doc_id").isin(2, 3, 4)).collect()} == {0.0}
    sampler, scored = resample.learn(rows.limit(0), labels_of(spark, [(1, 1, 0), (2, 0, 0)]))
    assert scored.count() == 0 and sampler.select(rows.limit(0)).count() == 0


def test_held_out_labels(spark):
    """Learnt from half of the labels, the sample keeps the good texts of the other half and rejects the bad ones."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    hidden = F.pmod(F.xxhash64(F.lit(99), "doc_id"), F.lit(2)) == 0
    sampler, rows = resample.learn(docs, labels.where(~hidden))
    got = rows.join(labels.where(hidden), "doc_id").withColumn("kept", (F.col("sample_key") >= sampler.least).cast("int"))
    share = {r.quality: r.kept for r in got.groupBy("quality").agg(F.avg("kept").alias("kept")).collect()}
    assert share[1] >= 0.98 and share[0] <= 0.2
