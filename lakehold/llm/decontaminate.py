"""Benchmark decontamination by template canonicalisation.

Texts become templates: numbers, names and units turn into typed placeholders, other words stay, in lower
case. Template windows of a benchmark item and of a document are joined by hash; windows that line up form an
alignment, in which every slot value of the item should stand for one value of the document and the other way
round. So both verbatim passages and questions asked anew with other numbers or names are found, while
chance windows with mixed-up slots are refused.

A name is a capitalised word that does not begin a sentence. As copies may lose or gain capitals and sentence
marks, windows are also compared with names kept as words. A unit is a unit word right after a number. Windows
with numbers and units are compared with all tokens as words, too: so verbatim copies meet however few plain
words they hold, whereas typed windows need ``MIN_LITERALS`` of them.

A fixed-size bit table of the benchmark's window hashes keeps document windows that cannot match from leaving
their task; the join by hash is exact. Equal items are one class, given by its least ``item_id``.

Decision: an alignment counts if its slots are consistent and its windows cover ``MIN_RUN`` tokens of the
item or ``MIN_SHARE`` of the item's tokens. If a slot value stands for two, only the windows that hold such a
changed pair are left out, and the others count if they cover ``MIN_RUN`` tokens besides changed slots. Items shorter than the window are compared as a whole; items with
fewer than ``MIN_LITERALS`` plain words in every window match verbatim copies alone.

Cases: null and empty texts on either side match nothing; repeated rows are each judged; null document ids are
judged like others, and give a null ``doc_id``; an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehold.llm.common import fresh, maybe_among, stored, worker_cache

WINDOW = 8
MIN_LITERALS = 4  # plain words in a typed window
MIN_RUN, MIN_SHARE = 13, 0.5
BITS_LOG2 = 24  # bit table: 2 MB
CACHED_TOKENS = 400_000
CHUNK_CHARS = 2_000_000  # characters that a task turns into windows at a time

# Words for numbers and units.
NUMBER_WORDS = set("""zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen
nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen half""".split())
UNIT_WORDS = set("""mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces pound pounds ton
tons ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years
dollar dollars cent cents euro euros percent degree degrees meter meters metre metres kilometer kilometers kilometre kilometres""".split())

TOKEN = re.compile(r"[+-]?\d+(?:[.,:/]\d+)*|\w+|[$€£%°]|[.!?]+|\n")
NUMBER = re.compile(r"[+-]?\d+(?:[.,:/]\d+)*")
END_MARKS = ".!?\n"
PLAIN, NUM, NAME, UNIT, STOP, WORD_NUM, UNIT_WORD, CAPITAL = range(8)
SLOT_HASH = {NUM: 11, NAME: 12, UNIT: 13}


class Kinds(dict):
    """token -> hash of its lower-cased form, with its kind by itself in the lowest three bits."""

    def __missing__(self, token: str) -> int:
        low = token.lower()
        if token[0] in END_MARKS:
            kind = STOP
        elif NUMBER.fullmatch(token):
            kind = NUM
        elif low in NUMBER_WORDS:
            kind = WORD_NUM
        elif low in UNIT_WORDS or token in "$€£%°":
            kind = UNIT_WORD
        else:
            kind = CAPITAL if token[0].isupper() else PLAIN
        if len(self) >= CACHED_TOKENS:
            self.clear()
        got = self[token] = xxhash.xxh64_intdigest(low.encode("utf-8", "surrogatepass"), 3) & ~7 | kind
        return got


@dataclass(frozen=True)
class Template:
    """Tokens of some texts in a row, without sentence marks."""

    raw: list[str]
    at: np.ndarray  # index in ``raw`` of each token
    text: np.ndarray  # number of its text
    kind: np.ndarray  # PLAIN, NUM, NAME or UNIT
    word: np.ndarray  # hash of its lower-cased form

    def typed(self, names: bool) -> tuple[np.ndarray, np.ndarray]:
        """Token hashes with placeholders for slots, and which tokens are slots; ``names``: names are slots."""
        slot = (self.kind == NUM) | (self.kind == UNIT) | ((self.kind == NAME) if names else False)
        h = self.word.copy()
        for k, v in SLOT_HASH.items():
            h[slot & (self.kind == k)] = np.uint64(v)
        return h, slot


def template(texts: list[str | None]) -> Template:
    known = worker_cache("kinds", Kinds)
    raw, sizes = [], []
    for t in texts:
        before = len(raw)
        raw.append("\n")  # every text begins a sentence
        raw += TOKEN.findall(t or "")
        sizes.append(len(raw) - before)
    both = np.fromiter(map(known.__getitem__, raw), np.uint64, len(raw))
    kind = (both & np.uint64(7)).astype(np.int8)
    before, after = np.append(STOP, kind[:-1]), np.append(kind[1:], STOP)
    # a number word is a number beside a unit or another number word, or within a sentence; else a word
    spelled = (kind == WORD_NUM) & ((after == UNIT_WORD) | (before == WORD_NUM) | (after == WORD_NUM) | (before == PLAIN))
    number = (kind == NUM) | spelled
    out = np.full(kind.size, PLAIN, np.int8)
    out[number] = NUM
    out[(kind == UNIT_WORD) & np.append(False, number[:-1])] = UNIT
    out[(kind == CAPITAL) & (before != STOP)] = NAME
    at = np.flatnonzero(kind != STOP)
    return Template(raw, at, np.repeat(np.arange(len(texts)), sizes)[at], out[at], both[at] & ~np.uint64(7))


def window_hashes(h: np.ndarray, slot: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window of ``size`` tokens, and whether it has enough plain words."""
    n = h.size - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, bool)
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out ^= h[k:k + n]
        out *= np.uint64(0xC2B2AE3D27D4EB4F)
        out ^= out >> np.uint64(29)
    plain = np.append(0, np.cumsum(~slot))
    return out, plain[size:] - plain[:-size] >= min(size, MIN_LITERALS)


WINDOWS = "h long, size int, at int, kinds array<int>, slots array<string>"


def windows_of(texts: list[str | None], sizes: list[int], wanted=None, verbatim: bool = False) -> Iterator[tuple]:
    """``(number of the text, h, size, at, 8 * place + kind of each slot, slot values)`` of the windows of some
    texts; ``wanted`` picks hashes. Windows with names come twice: with names as slots and as words. ``verbatim``: windows with
    numbers or units come once more, with all tokens as words."""
    t = template(texts)
    first = np.searchsorted(t.text, np.arange(len(texts)))
    last_hashes: dict[int, np.ndarray] = {}
    forms = [t.typed(True), *([t.typed(False)] if (t.kind == NAME).any() else []), *([(t.word, np.zeros(t.word.size, bool))] if verbatim else [])]
    for h, slot in forms:
        for size in sizes:
            w, ok = window_hashes(h, slot, size)
            if not w.size:
                continue
            ok &= t.text[:w.size] == t.text[size - 1:]
            if size in last_hashes:
                ok &= w != last_hashes[size]
            last_hashes[size] = w
            some = np.flatnonzero(ok)
            for i in (some if wanted is None else some[wanted(w[some])]).tolist():
                s = np.flatnonzero(slot[i:i + size]) + i
                yield (int(t.text[i]), int(w[i].view(np.int64)), size, i - int(first[t.text[i]]), (8 * (s - i) + t.kind[s]).tolist(),
                       [t.raw[j].lower() for j in t.at[s].tolist()])


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item_id, item_tokens`` and the window columns, one class of equal items each."""
    distinct = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).groupBy(
        F.sha2("text", 256).alias("d")).agg(F.min("item_id").alias("item_id"), F.first("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for key, item, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                n = template([text]).kind.size
                rows += [(key, item, n, *w[1:]) for w in windows_of([text], [min(window, n)] if n else [], verbatim=True)]
            yield _batch(rows, [pa.string(), pa.int64(), pa.int32()], ["item", "item_id", "item_tokens"])

    return distinct.select("d", "item_id", "text").mapInArrow(run, f"item string, item_id long, item_tokens int, {WINDOWS}")


def _batch(rows: list[tuple], kinds: list, names: list[str]) -> pa.RecordBatch:
    kinds = [*kinds, pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.string())]
    names = [*names, "h", "size", "at", "kinds", "slots"]
    cols = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
    return pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)


def bit_table(items: DataFrame) -> np.ndarray:
    """Bits of the window hashes that occur in the benchmark; its size is fixed."""
    bit = F.shiftrightunsigned("h", 64 - BITS_LOG2) + 1  # Spark's bitmaps begin with 1
    parts = items.groupBy(F.bitmap_bucket_number(bit).alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).collect()
    out = np.zeros(1 << BITS_LOG2 - 3, np.uint8)
    for r in parts:  # bit p lies in bucket p // 32768 + 1, at position p % 32768
        start = (r["k"] - 1) * 4096
        out[start:start + 4096] |= np.frombuffer(bytes(r["bits"]), np.uint8)[:out.size - start]
    return out


def document_windows(docs: DataFrame, table: np.ndarray, sizes: list[int], keys: list[str], text_col: str) -> DataFrame:
    """``keys`` and the window columns of the document windows whose hash may occur in the benchmark."""
    known = docs.sparkSession.sparkContext.broadcast(table)
    src = docs.select(F.col(text_col).cast("string").alias("text"), *keys)
    key_schema = src.select(*keys).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = known.value

        def wanted(w):
            p = (w >> np.uint64(64 - BITS_LOG2)).astype(np.int64)
            return (bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1

        for b in batches:
            sizes_of = np.cumsum([t.as_py() or 0 for t in pc.utf8_length(b.column(0))])
            cuts = [0, *(np.flatnonzero(np.diff(sizes_of // CHUNK_CHARS)) + 1).tolist(), b.num_rows]
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                found = list(windows_of(b.column(0)[s:e].to_pylist(), sizes, wanted, verbatim=True))
                picked = b.select(keys).take(pa.array([s + w[0] for w in found], pa.int64()))
                rest = _batch([w[1:] for w in found], [], [])
                yield pa.RecordBatch.from_arrays([*picked.columns, *rest.columns], names=[*keys, *rest.schema.names])

    return src.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in key_schema), WINDOWS]))


def alignments(items: DataFrame, found: DataFrame, keys: list[str], min_run: int = MIN_RUN, min_share: float = MIN_SHARE) -> DataFrame:
    """Per document key and item class: the best alignment, if it counts as contamination."""
    i = items.select("h", "size", "item", "item_id", "item_tokens", F.col("at").alias("item_at"), F.col("kinds").alias("item_kinds"), F.col("slots").alias("item_slots"))
    # equal hashes must also have equal places and kinds of slots
    pairs = found.join(i, ["h", "size"]).where("kinds = item_kinds").select(
        *keys, "item", "item_id", "item_tokens", "size", "item_at", (F.col("at") - F.col("item_at")).alias("shift"),
        F.arrays_zip(F.transform("item_kinds", lambda k: F.col("item_at") + F.shiftright(k, 3)).alias("place"), F.col("item_slots").alias("a"), F.col("slots").alias("b")).alias("slots"))
    # an alignment has at most a few rows per window of the item; windows with names as slots and as words add up
    one = pairs.groupBy(*keys, "item", "shift").agg(
        F.min("item_id").alias("item_id"), F.max("item_tokens").alias("item_tokens"), F.max("size").alias("size"), F.collect_set(F.struct("item_at", "slots")).alias("windows"))
    values = lambda slots: F.array_distinct(F.transform(slots, lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"))))
    # of two pairs that contradict each other at least one is changed; without the changed ones the others agree
    one = one.withColumn("pairs", values(F.flatten("windows.slots")))
    one = one.withColumn("bad", F.filter("pairs", lambda x: (x["a"] != x["b"]) & F.exists("pairs", lambda y: (x["a"] == y["a"]) != (x["b"] == y["b"]))))
    one = one.withColumn("consistent", F.size("bad") == 0)
    one = one.withColumn("windows", F.when(F.col("consistent"), F.col("windows")).otherwise(F.filter("windows", lambda w: ~F.exists(
        w["slots"], lambda x: F.exists("bad", lambda y: (x["a"] == y["a"]) & (x["b"] == y["b"]))))))
    one = one.withColumn("at", F.array_sort(F.array_distinct("windows.item_at"))).withColumn("edits", F.filter(F.flatten("windows.slots"), lambda x: x["a"] != x["b"]))
    ends = F.transform("at", lambda a, k: F.least(F.col("size"), F.coalesce(F.try_element_at("at", k + 2) - a, F.col("size"))))
    covered = F.aggregate(ends, F.lit(0), lambda s, x: s + x)
    judged = one.select(
        *keys, "item", "item_id", "item_tokens", "consistent", covered.cast("long").alias("covered"),
        F.size(values(F.col("edits"))).cast("long").alias("changed"), F.size(F.array_distinct("edits.place")).alias("edited_tokens"))
    whole = (F.col("covered") >= min_run) | (F.col("covered") >= F.lit(min_share) * F.col("item_tokens"))
    hit = judged.where(F.when(F.col("consistent"), whole).otherwise(F.col("covered") - F.col("edited_tokens") >= min_run))
    best = F.max(F.struct("covered", (-F.col("changed")).alias("unchanged")))
    return hit.groupBy(*keys, "item").agg(F.min("item_id").alias("item_id"), F.max("item_tokens").alias("item_tokens"), best.alias("best")).select(
        *keys, "item_id", F.col("best.covered").alias("covered_tokens"), F.col("item_tokens").cast("long").alias("item_tokens"),
        (-F.col("best.unchanged")).alias("changed_slots"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Pairs of document and benchmark item: ``doc_id, item_id, covered_tokens, item_tokens, changed_slots``."""
    numbered = docs.select(F.monotonically_increasing_id().alias("row_no"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return _hits(numbered, benchmark, ["row_no", "doc_id"], window).drop("row_no")


def _hits(docs: DataFrame, benchmark: DataFrame, keys: list[str], window: int) -> DataFrame:
    items = stored(item_windows(benchmark, window), "decontaminate-items")
    sizes = [r["size"] for r in items.select("size").distinct().collect()]  # at most WINDOW values
    return alignments(items, document_windows(docs, bit_table(items), sizes, keys, "text"), keys)


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold a benchmark passage. The verdict depends on the text alone, so rows
    are matched by the text's digest."""
    key = fresh(docs, "text_key")
    keyed = docs.withColumn(key, F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256))
    hits = _hits(keyed.select(F.col(text_col).alias("text"), F.col(key).alias("digest")), benchmark, ["digest"], window)
    bad = stored(hits.select(F.col("digest").alias(key)).distinct(), "decontaminate-texts")
    maybe = maybe_among(bad, key)  # all other rows stay where they are
    rest = keyed.where(maybe(F.col(key))).join(bad, key, "left_anti")
    return keyed.where(~maybe(F.col(key))).unionByName(rest.select(*keyed.columns)).select(*docs.columns)
