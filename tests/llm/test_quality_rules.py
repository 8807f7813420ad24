import random

import numpy as np

from lakehold.llm import quality_rules as qr
from tests.llm.helpers import brute_words, dirty, docs_of, labels_of


def brute(text):
    text = text or ""
    w = brute_words(text)
    at = {}
    for i in range(len(w) - 2):
        at.setdefault(tuple(w[i:i + 3]), []).append(i)
    hit = {p + k for v in at.values() if len(v) > 1 for p in v for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if brute_words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(hit)


def test_statistics_equal_brute_force():
    rng = random.Random(4)
    texts = ["", None, "a a a a", "a b c\na b c\n\n \na b c", "x|y & <z>", "é é é é\x0bé", "a b c a b c"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 40))) + rng.choice(["\n", ""]) * 2 for _ in range(200)]
    for t in texts:
        assert qr.statistics(t)[:5] == brute(t), t


def corpus(spark, n=900):
    rng = random.Random(6)
    rows, labels = [], []
    for k in range(n):
        bad = k % 4 == 0
        words = [f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(60, 120))]
        if bad and k % 8 == 0:
            words = [w + rng.choice(["###", "$$$"]) for w in words]
        elif bad:
            words = [w.upper() + "!!" for w in words]
        rows.append((k, " ".join(words)))
        labels.append((k, int(not bad), 0))
    return docs_of(spark, rows), labels_of(spark, labels), {i for i, q, _ in labels if not q}


def test_learnt_list_rejects_junk_and_keeps_clean(spark):
    docs, labels, bad = corpus(spark)
    # learn from two thirds, judge the rest
    got = qr.judge(docs, labels.where("doc_id % 3 > 0")).where("doc_id % 3 = 0").collect()
    assert all(r.kept != (r.doc_id in bad) for r in got) and not any(r.base_failed for r in got)


def test_verdict_column_equals_conditions():
    rules = [(qr.Condition("symbols_per_char", True, 0.1), qr.Condition("chars_per_word", False, 9.0)), (qr.Condition("dup_lines", True, 0.5),)]
    text = str(qr.verdict(rules))
    assert text.index("n_symbols") < text.index("n_dup_lines")  # in the order of the list


def test_learning_without_one_class():
    counts = {c: np.arange(1, 50, dtype=np.int64) for c in qr.COUNTS}
    assert qr.learn(counts, np.zeros(49, bool), np.arange(49) % 3 == 0) == []
    assert qr.learn({c: np.empty(0, np.int64) for c in qr.COUNTS}, np.empty(0, bool), np.empty(0, bool)) == []


def test_dirty_rows_and_missing_labels(spark):
    docs = dirty(spark)
    got = qr.judge(docs, labels_of(spark, [(None, 0, 0), (7, None, 1), (5, 0, 0), (5, 1, 0)])).collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed)
    by = {(r.doc_id, r.n_words) for r in got}
    assert (2, 0) in by and (7, 60_000) in by
    assert qr.judge(docs.limit(0), labels_of(spark, [])).count() == 0
