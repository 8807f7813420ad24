import collections
import math
import re
import zlib

import numpy as np
import pytest

from lakehold.llm import kneser_ney as kn
from tests.llm.helpers import brute_words, dirty, docs_of


def tokens(t):
    return brute_words(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + ["</s>"]


class Brute:
    """Interpolated modified Kneser-Ney, written down directly."""

    def __init__(self, texts, order):
        self.order, self.counts = order, {order: collections.Counter()}
        self.words = collections.Counter(w for t in texts for w in t)
        for t in texts:
            p = ["<s>"] * (order - 1) + t
            for i in range(order - 1, len(p)):
                self.counts[order][tuple(p[i - order + 1:i + 1])] += 1
        for k in range(order - 1, 0, -1):
            self.counts[k] = collections.Counter(g[1:] for g in self.counts[k + 1])
        self.d = {k: self.discount(k) for k in self.counts}
        self.total = {k: collections.defaultdict(lambda: [0, 0.0]) for k in self.counts}
        for k, c in self.counts.items():
            for g, n in c.items():
                t = self.total[k][g[:-1]]
                t[0] += n
                t[1] += self.d[k][min(n, 3)]

    def discount(self, k):
        n = [sum(v == j for v in self.counts[k].values()) for j in (1, 2, 3, 4)]
        if not all(n):
            return [0, 0.5, 1.0, 1.5]
        y = n[0] / (n[0] + 2 * n[1])
        return [0, *(min(max(j + 1 - (j + 2) * y * n[j + 1] / n[j], 0), j + 1) for j in range(3))]

    def p(self, g):
        k = len(g)
        low = self.p(g[1:]) if k > 1 else 1 / (len(self.words) + 1)
        if g[:-1] not in self.total[k]:
            return low
        n, mass = self.total[k][g[:-1]]
        c = self.counts[k].get(g, 0)
        return max(c - self.d[k][min(c, 3)], 0) / n + mass / n * low

    def score(self, t):
        p = ["<s>"] * (self.order - 1) + t
        return sum(math.log10(self.p(tuple(p[i - self.order + 1:i + 1]))) for i in range(self.order - 1, len(p)))

    def base(self, t):
        n, v = sum(self.words.values()), len(self.words)
        return sum(math.log10((self.words[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)


def corpus(spark):
    rng = np.random.default_rng(3)
    rows = [(k, " ".join(f"W{min(int(x), 40)}" for x in rng.zipf(1.4, rng.integers(1, 60)))) for k in range(80)]
    return docs_of(spark, rows).unionByName(dirty(spark))


@pytest.mark.parametrize("order", [2, 3])
def test_scores_equal_brute_force(spark, order):
    docs = corpus(spark)
    rows = [(r.doc_id, tokens(r.text)) for r in docs.collect()]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    model = Brute([t for i, t in rows if not held(i)], order)
    want = sorted(((-1 if i is None else i, len(t), held(i), sum(model.words[w] > 0 for w in t), round(model.score(t), 6), round(model.base(t), 6)) for i, t in rows))
    got = kn.score_held_out(docs.repartition(5), order).collect()
    have = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.held_out, r.n_known, round(r.score, 6), round(r.base_score, 6)) for r in got)
    assert len(have) == len(want)
    for a, b in zip(have, want, strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], abs=1e-4) and a[5] == pytest.approx(b[5], abs=1e-4)
    assert {r.train_tokens for r in got} == {sum(model.words.values())}


def test_probabilities_add_up_to_one(spark):
    model = kn.train(corpus(spark), order=2)
    reader = kn.Reader(model)
    words = [f"w{k}" for k in range(1, 41)]
    for context in ("w1", "w7", "never-seen"):
        texts = [kn.token_hashes(f"{context} {w}") for w in words]
        known = sum(10 ** reader.log_scores([t])[0][1] for t in texts)
        assert 0 < known <= 1 + 1e-9


def test_pack_round_trip_and_empty(spark):
    cols = [np.array([1, 1, 2], np.uint64), np.array([5, 9, 5], np.uint64)]
    for top in (3, 300, 70_000, 5_000_000_000):
        counts = np.array([1, 2, top], np.int64)
        c, n = kn.unpack(kn.pack(cols, counts))
        assert [x.tolist() for x in c] == [x.tolist() for x in cols] and n.tolist() == counts.tolist()
    assert kn.score_held_out(dirty(spark).limit(0)).count() == 0
    only_held = docs_of(spark, [(1, "a b")]) if zlib.crc32(b"1") % 5 == 1 else docs_of(spark, [(next(k for k in range(50) if zlib.crc32(str(k).encode()) % 5 == 1), "a b")])
    r = kn.score_held_out(only_held).first()
    assert (r.train_tokens, r.score, r.n_known, r.n_tokens) == (0, 0.0, 0, 3)


def test_held_out_text_fits_better_than_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = kn.score_held_out(docs).where("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert got.s > got.b


def test_registered_query_sees_two_words_of_context(spark, tmp_path):
    from lakehold.llm.queries import op3_kneser_ney

    # what follows "x" is known only from the word before it
    rows = [(k, ["a x p", "b x q"][k % 2]) for k in range(60)]
    docs_of(spark, rows).select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    train = [tokens(t) for i, t in rows if zlib.crc32(str(i).encode()) % 5 != 1]
    model = Brute(train, 3)
    for r in op3_kneser_ney(spark, str(tmp_path)).collect():
        assert r.score == pytest.approx(model.score(tokens(rows[r.doc_id][1])), abs=1e-6)


def test_packed_parts_and_files_come_back(tmp_path):
    rng = np.random.default_rng(3)
    for n, vocabulary, top in ((1, 1, 1), (50, 3, 2), (3000, 700, 300), (90_000, 70_000, 70_000)):
        words = rng.integers(0, 1 << 63, vocabulary, np.uint64)
        for k in (1, 2, 3):
            columns, counts = kn.summed([rng.choice(words, n) for _ in range(k)], rng.integers(1, top + 1, n))
            back, many = kn.unpack(kn.pack(columns, counts))
            assert all((a == b).all() for a, b in zip(back, columns, strict=True)) and (many == counts).all()
    arrays = [np.array(x, np.uint64) for x in ([], [1, 2, 255], [256], [1 << 40, 3], [70_000] * 5, [1 << 63])]
    kn.write_arrays(str(tmp_path / "a"), arrays)
    got = kn.map_arrays(str(tmp_path / "a"))
    assert [g.tolist() for g in got] == [a.tolist() for a in arrays] and [g.itemsize for g in got] == [1, 1, 2, 8, 4, 8]


def test_a_missing_model_file_is_an_error(spark):
    import glob
    import os

    docs = docs_of(spark, [(k, f"a b c d{k} a b {k % 7}") for k in range(60)])
    model = kn.train(docs, order=3, shards=4)
    assert model.path.startswith("file:/")
    assert kn.score(docs, model).count() == 60
    path = sorted(glob.glob(f"{model.path.removeprefix('file:')}/3-*"))[0]
    os.remove(path)
    with pytest.raises(Exception, match="No such file"):
        kn.score(docs, model).collect()


def test_word_hashes_depend_on_the_word_alone():
    text = "\x0b".join(["A", "a", "aB", "ba", "É", "é", "x" * 100_000, "\x1c\x85", *(f"w{k}" for k in range(250_000))]) + " \n"
    words = text.encode().lower().split()
    hashes = kn.token_hashes(text)
    assert hashes.size == len(words) + 1 and hashes[-1] == kn.END and kn.token_hashes(None).tolist() == kn.token_hashes(" \t").tolist() == [kn.END]
    assert len(set(words)) == len(set(hashes[:-1].tolist())) == len(set(zip(words, hashes.tolist())))
    for k in (0, 2, 3, 7, 99_999, 100_000, 100_008, 250_007):
        assert kn.token_hashes(words[k].decode())[0] == hashes[k]


def test_sorted_hashes_are_found_and_others_are_not():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 100, 50_000):
        h = np.unique(rng.integers(0, 1 << 63, n, np.uint64))
        h[n // 2:] |= np.uint64(7)  # uneven buckets
        h = np.unique(h)
        starts, low, values = kn.sorted_hashes(h, h)
        asked = np.concatenate([h, rng.integers(0, 1 << 63, 1000, np.uint64)])
        at = kn.places(starts, low, asked)
        assert (values[at[:h.size]] == h).all() and (at[h.size:] == -1).all()
