"""Quality by importance resampling.

Two generative models of hashed word n-grams (one- and two-word, a fixed number of buckets) are counted: one
over the target texts (rows labelled good), one over all raw texts. A text's log importance weight is the mean
log ratio of its n-grams, times a common length, so that texts are compared as if equally long; the sample are
the ``k`` texts with the largest weight plus Gumbel noise, which draws without replacement in proportion to the
weights.

``k`` defaults to the number of texts whose weight is at least the cut that best tells good from bad texts. Half
of the labelled rows (by the hash of their id) are for the target, the other half for the cut, so the cut is
taken from texts that the target has not seen. The raw model counts every row; target and cut use about ``MAX_LABELLED`` labelled
rows of each class (at most twice as many: those with the smallest hash of the id). What is broadcast has the size of the model.

Cases: null and empty texts have weight 0; noise depends on the id and the seed alone, so repeated rows get
equal keys, and rows that tie with the k-th key are all kept; null ids share one draw and have no label; without
good and bad labels, or for ``k`` at or above the number of rows, all rows are kept.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakehold.llm.common import fresh, sample_by_hash, stored, worker_cache

BUCKETS_LOG2 = 16
SMOOTHING = 10.0  # added to a bucket's target count, and to its raw count on the target's scale
LENGTH = 200  # n-grams that every text is weighed as having
MAX_LABELLED = 10_000
SEED = 17
CACHED_WORDS = 250_000
GOOD_COST = 4.0  # a good text lost weighs as much as so many bad ones kept, as shares of their class
BINS = 4096  # per round of the search for the k-th key
TOKEN = re.compile(rb"[\w\x80-\xff]+|[^\w\s\x80-\xff]+")


class TokenHashes(dict):
    def __missing__(self, token: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        h = self[token] = xxhash.xxh64_intdigest(token, 1)
        return h


def buckets(text: str | None) -> np.ndarray:
    """Bucket of every one- and two-word n-gram of a whole text."""
    tokens = TOKEN.findall((text or "").encode("utf-8", "surrogatepass").lower())
    known = worker_cache("token hashes", TokenHashes)
    one = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
    two = (one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (np.concatenate([one, two]) >> np.uint64(64 - BUCKETS_LOG2)).astype(np.int64)


def labelled_ids(labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``(id, good)``: about ``max_labelled`` ids of each class, at most twice as many."""
    known = labels.select(F.col("doc_id").cast("long").alias("id"), (F.col("quality") == 1).alias("good")).dropna().distinct()
    part = [sample_by_hash(known.where(c), "id", max_labelled) for c in ("good", "not good")]
    return stored(part[0].unionByName(part[1]), "resample-labels")


def for_cut(id_col: str) -> Column:
    """Whether a labelled row is for the cut, not for the target."""
    return F.pmod(F.xxhash64(F.lit(7), F.col(id_col)), F.lit(2)) == 0


def ratio_table(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> np.ndarray | None:
    """Log ratio of target and raw probability per bucket; None without target texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 << BUCKETS_LOG2
        raw, target = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for b in batches:
            for t, good in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                c = np.bincount(buckets(t.as_py()), minlength=size)
                raw += c
                if good:
                    target += c
        used = np.flatnonzero(raw)
        yield pa.record_batch([pa.array(used), pa.array(raw[used]), pa.array(target[used])], names=["bucket", "raw", "target"])

    good = ids.where(F.col("good") & ~for_cut("id")).select("id", F.lit(True).alias("good"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    marked = texts.join(F.broadcast(good), "id", "left").select("text", "good")  # at most 2 * MAX_LABELLED ids
    sums = marked.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()  # at most one row per bucket
    raw, target = (np.zeros(1 << BUCKETS_LOG2) for _ in range(2))
    raw[sums["bucket"]], target[sums["bucket"]] = sums["raw"], sums["target"]
    if not target.sum():
        return None
    return np.log((target + SMOOTHING) / (raw * (target.sum() / raw.sum()) + SMOOTHING)).astype(np.float32)


def log_weight(grams: np.ndarray, ratio: np.ndarray) -> float:
    return float(ratio[grams].mean(dtype=np.float64)) * LENGTH if grams.size else 0.0


def with_weight(docs: DataFrame, table: np.ndarray | None, text_col: str, out: str) -> DataFrame:
    """``docs`` and the log importance weight of each row's text."""
    if table is None:
        return docs.withColumn(out, F.lit(0.0))
    at = docs.columns.index(text_col)
    known = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = known.value
        for b in batches:
            w = [log_weight(buckets(t.as_py()), ratio) for t in b.column(at)]
            yield pa.record_batch([*b.columns, pa.array(w, pa.float64())], names=[*b.schema.names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))


def gumbel(id_col: str, seed: int = SEED) -> Column:
    """Standard Gumbel noise that depends on id and seed."""
    u = (F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit(seed)), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    return -F.log(-F.log(u))


def kth_largest(keys: DataFrame, col: str, k: int) -> float:
    """The exact k-th largest value of a column, by counts over ever narrower bins."""
    low, high = keys.agg(F.min(col), F.max(col)).first()
    while low < high:
        width = (high - low) / BINS
        if width == 0 or low + width == low:
            break
        inside = keys.where(F.col(col).between(low, high))
        hist = inside.groupBy(F.least(F.floor((F.col(col) - F.lit(low)) / F.lit(width)), F.lit(BINS - 1)).alias("bin")).agg(
            F.count("*").alias("n"), F.min(col).alias("lo"), F.max(col).alias("hi")).orderBy(F.desc("bin")).collect()
        for r in hist:
            if r["n"] >= k:
                low, high = r["lo"], r["hi"]
                break
            k -= r["n"]
        if hist and len(hist) == 1 and low < high and hist[0]["n"] == 1:
            break
    if low < high:  # neighbours that no bin can part: few distinct values are left
        for r in keys.where(F.col(col).between(low, high)).groupBy(col).count().orderBy(F.desc(col)).collect():
            if r["count"] >= k:
                return r[col]
            k -= r["count"]
    return low


@dataclass(frozen=True)
class Sampler:
    """A learnt sample: rows whose weight plus noise is at least ``least`` belong to it."""

    table: np.ndarray | None
    least: float
    seed: int

    def weighted(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str, str]:
        w = fresh(docs, "log_weight")
        out = with_weight(docs, self.table, text_col, w)
        key = fresh(out, "sample_key")
        return out.withColumn(key, F.col(w) + gumbel(id_col, self.seed)), w, key

    def select(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """The rows of ``docs`` in the sample, with their own columns."""
        out, _, key = self.weighted(docs, id_col, text_col)
        return out.where(F.col(key) >= F.lit(self.least)).select(*docs.columns)


def best_cut(weights: np.ndarray, good: np.ndarray) -> float:
    """The cut with the best weighted sum of good texts kept and bad texts rejected, midway in its gap."""
    order = np.argsort(weights, kind="stable")
    w, g = weights[order], good[order]
    kept = 1 - np.concatenate([[0], np.cumsum(g)]) / max(1, g.sum())
    rejected = np.concatenate([[0], np.cumsum(~g)]) / max(1, (~g).sum())
    free = np.concatenate([[True], w[1:] != w[:-1], [False]])  # no cut within equal weights
    i = int(np.argmax(np.where(free, GOOD_COST * kept + rejected, -1)))
    return -math.inf if i == 0 else float((w[i - 1] + w[i]) / 2)


def learn(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = SEED, id_col: str = "doc_id",
          text_col: str = "text") -> tuple[Sampler, DataFrame]:
    """The sampler, and ``(doc_id, log_weight, sample_key)`` of all rows, stored."""
    ids = labelled_ids(labels)
    table = ratio_table(docs, ids, id_col, text_col)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out, w, key = Sampler(table, -math.inf, seed).weighted(src)
    rows = stored(out.select("doc_id", F.col(w).alias("log_weight"), F.col(key).alias("sample_key")), "resample-weights")
    total = rows.count()
    if k is None and table is not None:
        known = rows.join(F.broadcast(ids.where(for_cut("id"))), F.col("doc_id") == F.col("id")).select("log_weight", "good").limit(4 * MAX_LABELLED).toPandas()
        good = known["good"].to_numpy(bool)
        cut = best_cut(known["log_weight"].to_numpy(float), good) if good.any() and not good.all() else -math.inf
        k = rows.where(F.col("log_weight") >= F.lit(cut)).count()
    if k is None or k >= total:
        return Sampler(table, -math.inf, seed), rows
    return Sampler(table, kth_largest(rows, "sample_key", k) if k > 0 else math.inf, seed), rows
