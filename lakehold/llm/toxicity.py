"""Toxicity by maximum-scoring segments.

Every token has a log-odds score between toxic and other labelled texts, with a Dirichlet prior in proportion
to its overall use; tokens without significant log-odds, and all others by a drift, score below zero, so that
clean text drifts down. A linear-time scan finds every maximal scoring segment of a text. Under clean text the
number of segments of at least a score S in n tokens is about Poisson with mean K*n*exp(-lambda*S): lambda solves
E[exp(lambda*score)] = 1 over the tokens of the clean sample as often as they occur there, and K is the
maximum-likelihood fit of that extreme-value law to the best segments of the clean texts. A text's evidence is the
sum of its segments' logarithmic significance, mapped to a probability by a logistic fit; its passages are the
segments of which clean text of its length would hold at most ``MAX_EXPECTED``.

Learning takes a bounded sample of the labelled rows outside the held-out fold: about ``PER_CLASS`` rows per
class (at most twice as many), those with the smallest hash of the id. Every significant token of them is scored; one
needs several texts of the sample, so the weights are a small part of its words. Only the text is an input of a score.

Cases: null, empty and wordless texts have no segments and get the lowest score; without labels of both
classes every score is the share of toxic labels (0 without any labels); rows with an equal id are scored each
on its own; a null id is in no fold and has no label; whole texts are scanned.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehold.llm.common import fold, sample_by_hash, stored

HELD_OUT = 0  # remainder of the held-out fold
PER_CLASS = 10_000
MAX_EXPECTED = 0.05  # of a returned passage: segments like it that clean text of that length would hold
PRIOR_SHARE = 0.1  # a token's prior count per occurrence in either class
MIN_Z, DRIFT = 3.0, 0.25
WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]  # positive and negative token scores, before the drift
    drift: float
    rate: float  # lambda
    scale: float  # K
    offset: float  # logistic map of the evidence
    slope: float

    def segments(self, text: str | None) -> tuple[list[tuple[int, int, float]], int]:
        """Maximal scoring segments ``(first token, end token, score)`` and the number of tokens."""
        tokens = WORD.findall((text or "").lower())
        known = self.weights
        hits = [(i, known[t]) for i, t in enumerate(tokens) if t in known]
        return maximal_segments(hits, self.drift), len(tokens)

    def evidence(self, segments: list[tuple[int, int, float]], n: int) -> float:
        """Sum of the segments' logarithmic significance in a text of ``n`` tokens."""
        floor = math.log(self.scale * max(n, 1))
        return sum(max(0.0, self.rate * s - floor) for _, _, s in segments)

    def expected(self, score: float, n: int) -> float:
        """Segments of at least this score in ``n`` tokens of clean text."""
        return self.scale * max(n, 1) * math.exp(-self.rate * score)

    def score(self, evidence: float) -> float:
        x = self.offset + self.slope * evidence
        return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def maximal_segments(hits: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (Ruzzo and Tompa) of a sequence that scores ``-drift`` everywhere but at
    ``hits``, where the given weight is added. Linear in the number of hits: a segment keeps the place of its
    nearest predecessor with a lesser total before it, so the search skips what lies between."""
    out: list[list] = []  # [start, end, total before it, total at its end, place of that predecessor or -1]
    total, last = 0.0, -1
    for i, w in hits:
        total -= drift * (i - last - 1)
        before, total, last = total, total + w - drift, i
        if w <= drift:
            continue
        start, k = i, len(out) - 1
        while k >= 0 and out[k][2] >= before:
            k = out[k][4]
        while k >= 0 and out[k][3] < total:  # it grows over that one, whose own predecessor comes next
            start, before, above = out[k][0], out[k][2], out[k][4]
            del out[k:]
            k = above
        out.append([start, i + 1, before, total, k])
    return [(s, e, r - b) for s, e, b, r, _ in out]


def labelled_texts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   per_class: int = PER_CLASS) -> DataFrame:
    """``(text, toxic)`` of the sample: about ``per_class`` rows of each class outside the held-out fold.

    The chosen ids are at most ``4 * per_class`` rows, so they are broadcast; no text is shuffled.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    known = known.where(fold("id") != HELD_OUT).distinct()
    pick = [sample_by_hash(known.where(c), "id", per_class) for c in ("toxic = 1", "toxic <> 1")]
    chosen = stored(pick[0].unionByName(pick[1]), "toxicity-sample-ids")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.join(F.broadcast(chosen), "id").select(F.coalesce("text", F.lit("")).alias("text"), (F.col("toxic") == 1).alias("toxic"))


def token_weights(sample: DataFrame, prior_share: float = PRIOR_SHARE, min_z: float = MIN_Z) -> dict[str, tuple[float, int]]:
    """Log-odds of the significant tokens, and how often each occurs in clean texts; for the log-odds a text counts
    each of its tokens once, and equal texts count once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            toxic, clean, uses = Counter(), Counter(), Counter()
            for text, is_toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = WORD.findall(text.lower())
                (toxic if is_toxic else clean).update(set(words))
                if not is_toxic:
                    uses.update(words)
            words = list(toxic.keys() | clean.keys())
            yield pa.record_batch([pa.array(words, pa.string()), *(pa.array([x[w] for w in words], pa.int64()) for x in (toxic, clean, uses))],
                                  names=["token", "t", "c", "uses"])

    distinct = sample.groupBy(F.sha2("text", 256).alias("d")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic")
    counts = stored(distinct.mapInArrow(count, "token string, t long, c long, uses long").groupBy("token").agg(
        F.sum("t").alias("t"), F.sum("c").alias("c"), F.sum("uses").alias("uses")), "toxicity-tokens")
    n_t, n_c = counts.agg(F.coalesce(F.sum("t"), F.lit(0)), F.coalesce(F.sum("c"), F.lit(0))).first()
    if not n_t or not n_c:
        return {}
    prior, all_prior = (F.col("t") + F.col("c")) * prior_share, (n_t + n_c) * prior_share
    odds = lambda y, n: F.log((y + prior) / (F.lit(n + all_prior) - y - prior))
    scored = counts.select("token", "uses", (odds(F.col("t"), n_t) - odds(F.col("c"), n_c)).alias("delta"),
                           F.sqrt(1 / (F.col("t") + prior) + 1 / (F.col("c") + prior)).alias("sd"))
    return {r["token"]: (r["delta"], r["uses"]) for r in scored.where(F.abs(F.col("delta") / F.col("sd")) >= min_z).collect()}


def _segment_rows(sample: DataFrame, model: Model) -> list:
    """``(toxic, n, scores of the segments)`` of the bounded sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [model.segments(t.as_py()) for t in b.column(0)]
            yield pa.record_batch([b.column(1), pa.array([n for _, n in found], pa.int64()),
                                   pa.array([[s for _, _, s in x] for x, _ in found], pa.list_(pa.float64()))], names=["toxic", "n", "scores"])

    return sample.mapInArrow(run, "toxic boolean, n long, scores array<double>").collect()


def _rate(weights: dict[str, float], share: dict[str, float], drift: float) -> float:
    """lambda > 0 with E[exp(lambda * score)] = 1 over clean tokens (1 if there is no such value)."""
    rest = max(0.0, 1 - sum(share.values()))
    mean = lambda x: rest * math.exp(-x * drift) + sum(p * math.exp(x * (weights[w] - drift)) for w, p in share.items()) - 1
    low, high = 1e-3, 1.0
    while mean(high) < 0 and high < 64:
        high *= 2
    if mean(low) > 0 or mean(high) < 0:
        return 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if mean(mid) < 0 else (low, mid)
    return high


def _scale(best: np.ndarray, n: np.ndarray, rate: float) -> float:
    """K by maximum likelihood from the best segment of each clean text (0: none, which only says that it is small)."""
    return float(((best > 0).sum() + 0.5) / max(1e-9, (n * np.exp(-rate * best)).sum()))


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 50, ridge: float = 1e-3) -> tuple[float, float]:
    """Offset and slope by Newton's method with a small ridge."""
    a = np.stack([np.ones_like(x), x], 1)
    w = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(2)
        w = w + np.linalg.solve(h, a.T @ (y - p) - ridge * w)
    return float(w[0]), float(w[1])


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    sample = stored(labelled_texts(docs, labels, id_col, text_col), "toxicity-sample")
    scored = token_weights(sample)
    weights = {w: delta for w, (delta, _) in scored.items()}
    rows = _segment_rows(sample, Model(weights, DRIFT, 1.0, 1.0, 0.0, 1.0))
    toxic = np.array([bool(r["toxic"]) for r in rows])
    if not toxic.size or toxic.all() or not toxic.any():
        share = float(toxic.mean()) if toxic.size else 0.0
        offset = -1000.0 if share == 0 else 30.0 if share == 1 else math.log(share / (1 - share))
        return Model({}, DRIFT, 1.0, 1.0, offset, 0.0)
    n = np.array([r["n"] for r in rows], float)
    best = np.array([max(r["scores"], default=0.0) for r in rows])
    # half an occurrence for each scored token, as those of toxic texts alone do occur in clean text at times
    clean_tokens = max(1.0, n[~toxic].sum() + 0.5 * len(scored))
    rate = _rate(weights, {w: (uses + 0.5) / clean_tokens for w, (_, uses) in scored.items()}, DRIFT)
    model = Model(weights, DRIFT, rate, _scale(best[~toxic], n[~toxic], rate), 0.0, 1.0)
    e = np.array([model.evidence([(0, 0, s) for s in r["scores"]], r["n"]) for r in rows])
    offset, slope = _logistic(e, toxic.astype(float))
    return Model(weights, DRIFT, rate, model.scale, offset, max(0.0, slope))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, held_out, score, predicted, passages`` (token positions, score and expected number in clean
    text of each significant segment)."""
    weights = docs.sparkSession.sparkContext.broadcast(model.weights)  # significant tokens of a bounded sample
    rest = (model.drift, model.rate, model.scale, model.offset, model.slope)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(weights.value, *rest)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("expected", pa.float64())]))
        for b in batches:
            found = [m.segments(t.as_py()) for t in b.column(1)]
            p = np.array([m.score(m.evidence(x, n)) for x, n in found], float)
            yield pa.record_batch([b.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32)),
                                   pa.array([[{"start": s, "end": e, "score": v, "expected": m.expected(v, n)} for s, e, v in x
                                              if m.expected(v, n) <= MAX_EXPECTED] for x, n in found], kind)],
                                  names=["doc_id", "score", "predicted", "passages"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = src.mapInArrow(run, "doc_id long, score double, predicted int, passages array<struct<start:int,end:int,score:double,expected:double>>")
    return out.select("doc_id", F.coalesce(fold("doc_id") == HELD_OUT, F.lit(False)).alias("held_out"), "score", "predicted", "passages")
