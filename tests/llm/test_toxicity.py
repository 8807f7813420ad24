import random

from lakehold.llm import toxicity
from tests.llm.helpers import dirty, docs_of, labels_of


def brute_segments(scores):
    """Maximal segments by their definition: the best one, then those left and right of it."""
    def rec(lo, hi):
        best = None
        for i in range(lo, hi):
            total = 0.0
            for j in range(i + 1, hi + 1):
                total += scores[j - 1]
                if best is None or total > best[0] + 1e-12 or (abs(total - best[0]) < 1e-12 and j - i < best[2] - best[1]):
                    best = (total, i, j)
        if best is None or best[0] <= 1e-12:
            return []
        v, i, j = best
        return [*rec(lo, i), (i, j, round(v, 6)), *rec(j, hi)]

    return rec(0, len(scores))


def test_segments_equal_their_definition():
    rng = random.Random(1)
    for _ in range(300):
        scores = [rng.choice([-0.25] * 4 + [1.13, 2.7, -0.9, 0.4]) for _ in range(rng.randint(0, 22))]
        hits = [(i, s + 0.25) for i, s in enumerate(scores) if s != -0.25]
        assert [(s, e, round(v, 6)) for s, e, v in toxicity.maximal_segments(hits, 0.25)] == brute_segments(scores)


def test_segments_of_many_hits():
    import time

    def plain(hits, drift):  # looks back over all segments
        out, total, last = [], 0.0, -1
        for i, w in hits:
            total -= drift * (i - last - 1)
            seg = [i, i + 1, total, total + w - drift]
            total, last = seg[3], i
            while w > drift:
                k = next((k for k in range(len(out) - 1, -1, -1) if out[k][2] < seg[2]), -1)
                if k < 0 or out[k][3] >= seg[3]:
                    out.append(seg)
                    break
                seg = [out[k][0], seg[1], out[k][2], seg[3]]
                del out[k:]
        return [(s, e, r - b) for s, e, b, r in out]

    rng = random.Random(9)
    for gap in (1, 4, 12):
        at, hits = 0, []
        for _ in range(1500):
            at += rng.randint(1, gap)
            hits.append((at, rng.choice([0.1, 0.3, 1.0, 4.0, -2.0])))
        assert toxicity.maximal_segments(hits, 0.25) == plain(hits, 0.25)
    for weights in ([1.0], [1.0, 0.3, 2.0], [5.0, 0.5]):  # apart, or one long chain
        for gap in (1, 50):
            hits = [(gap * k, weights[k % len(weights)]) for k in range(100_000)]
            t = time.perf_counter()
            toxicity.maximal_segments(hits, 0.25)
            assert time.perf_counter() - t < 5


def corpus(spark):
    rng = random.Random(2)
    word = lambda: f"w{rng.randint(0, 300)}"
    rows, labels = [], []
    for k in range(600):
        words = [word() for _ in range(rng.randint(5, 80))]
        bad = k % 5 == 0
        for _ in range(3 if bad else 0):
            words[rng.randrange(len(words))] = rng.choice(["Vile,", "NASTY!", "rotten"])
        rows.append((k, " ".join(words)))
        labels.append((k, 1, int(bad)))
    return docs_of(spark, rows), labels_of(spark, labels), {i for i, _, t in labels if t}


def test_held_out_accuracy_and_passages(spark):
    docs, labels, bad = corpus(spark)
    got = toxicity.score(docs, toxicity.learn(docs, labels)).collect()
    out = [r for r in got if r.held_out]
    assert sum((r.predicted == 1) == (r.doc_id in bad) for r in out) / len(out) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert sum(len(r.passages) > 0 for r in got if r.predicted) > 0.95 * sum(r.predicted for r in got)
    assert all(p.expected <= toxicity.MAX_EXPECTED for r in got for p in r.passages)
    clean = [r for r in got if r.doc_id not in bad]
    assert sum(len(r.passages) for r in clean) <= 3 * toxicity.MAX_EXPECTED * len(clean)


def test_extreme_value_fit_recovers_the_law_of_its_data():
    """Fair +1/-1 steps of unequal chance: lambda is known (log(q/p)), and the fitted K predicts how many texts reach a score."""
    import math

    import numpy as np

    rng, p = random.Random(3), 0.2
    weights, drift = {"up": 2.0}, 1.0  # +1 with chance p, else -1
    rate = toxicity._rate(weights, {"up": p}, drift)
    assert abs(rate - math.log((1 - p) / p)) < 1e-6
    best, n = [], 200
    for _ in range(1500):
        hits = [(i, 2.0) for i in range(n) if rng.random() < p]
        best.append(max((v for _, _, v in toxicity.maximal_segments(hits, drift)), default=0.0))
    best = np.array(best)
    scale = toxicity._scale(best, np.full(best.size, float(n)), rate)
    model = toxicity.Model(weights, drift, rate, scale, 0.0, 1.0)
    for s in (4.0, 5.0, 6.0):
        predicted, seen = 1 - math.exp(-model.expected(s, n)), float((best >= s).mean())
        assert 0.5 * predicted <= seen <= 2 * predicted


def test_held_out_labels_are_not_used(spark):
    docs, labels, _ = corpus(spark)
    from lakehold.llm.common import fold

    flipped = labels.withColumn("toxic", (1 - labels.toxic) * (fold("doc_id") == 0).cast("int") + labels.toxic * (fold("doc_id") != 0).cast("int")).select("doc_id", "quality", "toxic")
    assert toxicity.learn(docs, labels).weights == toxicity.learn(docs, flipped.selectExpr("doc_id", "quality", "cast(toxic as int) toxic")).weights


def test_dirty_rows_and_missing_labels(spark):
    docs, labels, _ = corpus(spark)
    rows = dirty(spark)
    got = toxicity.score(rows, toxicity.learn(docs, labels)).collect()
    assert len(got) == rows.count() and all(r.predicted == 0 for r in got)
    none = toxicity.learn(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(rows, none).collect()} == {0.0}
    one_class = toxicity.learn(docs, labels.where("toxic = 1"))
    assert {r.predicted for r in toxicity.score(rows, one_class).collect()} == {1}
    assert toxicity.score(rows.limit(0), none).count() == 0
    assert toxicity.learn(rows, labels_of(spark, [(None, 1, 1), (1, None, None), (5, 1, 0), (5, 1, 1)])).drift == toxicity.DRIFT
