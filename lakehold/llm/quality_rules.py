"""Quality rules: an ordered decision list, learnt by sequential covering from labelled text statistics.

Each rule is a conjunction of thresholds on ratios of a text's statistics. It is grown on one part of the
labelled rows by information gain, pruned on the other by its worth there, and accepted only with a high
precision on the pruning part; the rows that it covers are then set aside and the next rule is learnt. The
list becomes one ordered Spark conditional expression.

Statistics are taken over all rows and whole texts; learning takes a bounded sample of the labelled rows
(about ``MAX_LABELLED``, at most twice as many: those with the smallest hash of the id).

Cases: a null or empty text has no words and fails the base rule; without labels of both kinds the list is
empty and only the base rule decides; rows with an equal id are judged each on its own, and an id with several
labels gives one example per label; null ids have no label.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakehold.llm.common import sample_by_hash, stored

SYMBOLS = "#*$%&|<>"  # fixed value
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50  # base rule
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_digits"]
#: Ratios that rules may test, each (numerator, denominator); a denominator of 0 counts as 1.
RATIOS = {
    "symbols_per_char": ("n_symbols", "word_chars"), "symbols_per_word": ("n_symbols", "n_words"),
    "chars_per_word": ("word_chars", "n_words"), "dup_lines": ("n_dup_lines", "n_lines"),
    "repeated_words": ("n_repeat_words", "n_words"), "upper_per_char": ("n_upper", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"), "digits_per_char": ("n_digits", "word_chars"),
}
MAX_LABELLED = 20_000
CUTS = 64  # candidate thresholds per ratio
MIN_PRECISION, MIN_COVER, MAX_CONDITIONS = 0.95, 5, 4
UPPER = bytes(range(ord("A"), ord("Z") + 1))


def repeated_words(words: list) -> int:
    """Words that lie in a window of three words found twice or more."""
    if len(words) < 4:
        return 0
    ids: dict = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    _, pair = np.unique(a[:-1] * len(ids) + a[1:], return_inverse=True)
    _, triple, count = np.unique(pair[:-1] * len(ids) + a[2:], return_inverse=True, return_counts=True)
    again = count[triple] > 1
    hit = np.zeros(len(words), bool)
    for k in range(3):
        hit[k:len(words) - 2 + k] |= again
    return int(hit.sum())


def statistics(text: str | None) -> tuple[int, ...]:
    """The values of ``COUNTS`` for a whole text."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    blank = sum(map(text.count, " \t\n\x0b\x0c\r"))
    lines = [x for x in data.split(b"\n") if x.strip()]
    return (len(words), len(text) - blank, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words),
            len(lines), len(data) - len(data.translate(None, UPPER)), text.count("!") + text.count("?"),
            len(data) - len(data.translate(None, b"0123456789")))


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``COUNTS`` per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = np.array([statistics(t.as_py()) for t in b.column(1)], np.int64).reshape(-1, len(COUNTS))
            yield pa.record_batch([b.column(0), *(pa.array(rows[:, k]) for k in range(len(COUNTS)))], names=["doc_id", *COUNTS])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS)]))


@dataclass(frozen=True)
class Condition:
    ratio: str
    above: bool  # ratio >= cut, else ratio <= cut
    cut: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.ratio] >= self.cut if self.above else x[self.ratio] <= self.cut

    def column(self) -> Column:
        top, bottom = RATIOS[self.ratio]
        value = F.col(top).cast("double") / F.greatest(F.col(bottom), F.lit(1)).cast("double")
        return value >= F.lit(self.cut) if self.above else value <= F.lit(self.cut)


def ratios(counts: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {r: counts[a].astype(float) / np.maximum(counts[b], 1).astype(float) for r, (a, b) in RATIOS.items()}


def _covers(rule: tuple[Condition, ...], x: dict[str, np.ndarray], n: int) -> np.ndarray:
    got = np.ones(n, bool)
    for c in rule:
        got &= c.holds(x)
    return got


def _grow(x: dict[str, np.ndarray], bad: np.ndarray) -> tuple[Condition, ...]:
    """Add the condition of the largest gain until no good row is covered."""
    rule: tuple[Condition, ...] = ()
    inside = np.ones(bad.size, bool)
    while len(rule) < MAX_CONDITIONS and (inside & ~bad).any():
        p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        best, gain = None, 1e-9
        for r, v in x.items():
            seen = np.unique(v[inside])
            cuts = np.unique(np.quantile(seen, np.linspace(0, 1, CUTS + 1), method="nearest"))
            order = np.sort(v[inside & bad]), np.sort(v[inside & ~bad])
            for above in (True, False):
                if above:
                    p, n = (o.size - np.searchsorted(o, cuts, "left") for o in order)
                else:
                    p, n = (np.searchsorted(o, cuts, "right") for o in order)
                with np.errstate(divide="ignore", invalid="ignore"):
                    g = np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), 0)
                k = int(np.argmax(g))
                if g[k] > gain:
                    best, gain = Condition(r, above, float(cuts[k])), g[k]
        if best is None:
            break
        rule += (best,)
        inside &= best.holds(x)
    return rule


def _prune(rule: tuple[Condition, ...], x: dict[str, np.ndarray], bad: np.ndarray) -> tuple[Condition, ...]:
    """Drop last conditions while that does not lower (p - n) / (p + n) on the pruning rows."""
    def worth(r):
        got = _covers(r, x, bad.size)
        p, n = (got & bad).sum(), (got & ~bad).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), -len(r)), default=())


def learn(counts: dict[str, np.ndarray], bad: np.ndarray, prune: np.ndarray) -> list[tuple[Condition, ...]]:
    """Rules that recognise the rows marked ``bad``; ``prune`` marks the pruning part."""
    x, rules = ratios(counts), []
    open_rows = np.ones(bad.size, bool)
    while True:
        g, q = open_rows & ~prune, open_rows & prune
        if not (g & bad).any():
            return rules
        rule = _grow({r: v[g] for r, v in x.items()}, bad[g])
        rule = _prune(rule, {r: v[q] for r, v in x.items()}, bad[q]) if rule else rule
        got = _covers(rule, x, bad.size) & open_rows if rule else np.zeros(bad.size, bool)
        p, n = (got & prune & bad).sum(), (got & prune & ~bad).sum()
        all_p, all_n = (got & bad).sum(), (got & ~bad).sum()
        if all_p < MIN_COVER or p == 0 or p / (p + n) < MIN_PRECISION or all_p / (all_p + all_n) < MIN_PRECISION:
            return rules
        rules.append(rule)
        open_rows &= ~got


def labelled_sample(stats: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED):
    """``(counts, bad, prune)`` of about ``max_labelled`` labelled rows, by the hash of their id."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).dropna()
    pick = stats.join(sample_by_hash(known, "doc_id", max_labelled), "doc_id").withColumn("h", F.xxhash64("doc_id"))
    got = pick.limit(2 * max_labelled).toPandas().sort_values(["h", "doc_id", "quality", *COUNTS])
    counts = {c: got[c].to_numpy(np.int64) for c in COUNTS}
    return counts, got["quality"].to_numpy() == 0, (got["h"].to_numpy(np.int64) % 3) == 0


def verdict(rules: list[tuple[Condition, ...]]) -> Column:
    """The decision list as one conditional expression: false where a rule holds, true otherwise."""
    out = None
    for rule in rules:
        cond = F.lit(True)
        for c in rule:
            cond = cond & c.column()
        out = F.when(cond, False) if out is None else out.when(cond, False)
    return F.lit(True) if out is None else out.otherwise(True)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, the statistics, ``base_failed`` and ``kept``."""
    stats = stored(text_statistics(docs, id_col, text_col), "rules-statistics")
    rules = learn(*labelled_sample(stats, labels))
    failed = (F.col("n_words") < MIN_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEAT_PERCENT) * F.col("n_words"))
    return stats.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(rules))
