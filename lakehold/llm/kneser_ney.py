"""Interpolated modified Kneser-Ney n-gram scores.

A first Spark job counts the words and numbers them by their sorted hashes, one file per shard of the hashes.
Counting n-grams is a second job: map tasks turn words into numbers by these files, reduce their n-grams to packed
arrays per shard, a shuffle by shard (the upper bits of the context's hash) brings each context's n-grams together,
and every level passes the number of its distinct left extensions on to the level below. Each reduce task writes its
shard as sorted hash arrays to the shared folder, under a name that depends on level and shard alone and by an atomic
rename, so a task that runs twice leaves the same file. Only sums (counts of counts, sizes of shards) come to the
driver.

Scoring maps these files into the workers' memory and looks up batches of n-grams in buckets of the sorted hashes, so
no worker holds the model or the vocabulary, whatever its size. Words are told apart by 64 bits, n-grams by the shard
and at least 33 further bits: of 10^9 look-ups of absent n-grams some two find another's count.

Texts: A-Z are lower-cased; tokens are the words between ASCII white space and one end per text.

Cases: a null text is the empty text (one token, the end); a null id belongs to the training fold; repeated
rows count as often as they occur and are each scored; without training texts every probability is 1.
"""

from __future__ import annotations

import mmap
import os
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehold.llm.common import fold
from lakehold.session import shared_dir

HELD_OUT = 1
CHUNK_TOKENS = 2_000_000  # tokens that a map task packs at a time
BLOCK_WORDS = 100_000  # words that are hashed at a time
SCORE_TOKENS = 400_000  # tokens that are looked up at a time
MIN_SHARDS, SHARDS_PER_SPLIT, MAX_SHARDS = 16, 2, 1 << 18
END = np.uint64(xxhash.xxh64_intdigest(b"\nend"))  # no word has a line end
UNKNOWN, BEGIN, FIRST = np.uint64(0), np.uint64(1), 2  # numbers of words; those of the vocabulary follow
ROW = "level int, shard int, data binary, stats array<long>"
STATS = 6  # n-grams that occur once, twice, three, four times; all distinct ones; sum of counts (then the shard)
PER_BUCKET_LOG2 = 3  # hashes that share an entry of a file's directory
LOW = np.uint64(0xFFFFFFFF)


# ---------------------------------------------------------------- tokens and hashes

def spread(numbers: np.ndarray) -> np.ndarray:
    """Hashes of word numbers."""
    h = numbers * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
BASE = np.uint64(0xC2B2AE3D27D4EB4F)
BYTES = spread(np.arange(1, 257, dtype=np.uint64))  # a random number for each byte, the same for A-Z as for a-z
BYTES[ord("A"):ord("Z") + 1] = BYTES[ord("a"):ord("z") + 1]


def token_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash per word, then the end's: the sum over a word's bytes of a random number for each byte times the
    power of an odd base for its place, mixed with the word's length."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    inside = np.concatenate(([False], ~SPACE[raw], [False]))
    cuts = np.flatnonzero(inside[1:] != inside[:-1])
    starts, sizes = cuts[::2], cuts[1::2] - cuts[::2]
    out = np.full(starts.size + 1, END)
    for k in range(0, starts.size, BLOCK_WORDS):  # a long text takes no more memory than its words need
        s, n = starts[k:k + BLOCK_WORDS], sizes[k:k + BLOCK_WORDS]
        part = slice(int(s[0]), int(s[-1] + n[-1]))
        byte = raw[part][inside[1:-1][part]]
        first = np.cumsum(n) - n
        powers = np.cumprod(np.full(int(n.max()), BASE))
        sums = np.add.reduceat(BYTES[byte] * powers[np.arange(byte.size) - np.repeat(first, n)], first)
        out[k:k + n.size] = spread(sums + n.astype(np.uint64))
    return out


def mix(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a context's hash with a word's hash after it."""
    h = (context ^ np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xC2B2AE3D27D4EB4F) + word
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x165667B19E3779F9)
    return h ^ (h >> np.uint64(32))


def context_hash(columns: list[np.ndarray]) -> np.ndarray:
    """Hash of a context of the hashes of one or more words."""
    h = columns[0]
    for c in columns[1:]:
        h = mix(h, c)
    return h


def shard_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    kind = np.uint16 if bits <= 16 else np.uint32  # the narrower sorts faster
    return (hashes >> np.uint64(64 - bits)).astype(kind) if bits else np.zeros(hashes.size, kind)


def grams(words: np.ndarray, sizes: list[int], order: int, begin: int) -> list[np.ndarray]:
    """The ``order`` columns of all n-grams of texts of these sizes, given their words one after another."""
    ends = np.cumsum(sizes)
    padded = np.insert(words, np.repeat(ends - sizes, order - 1), begin)
    starts = ends - sizes + (order - 1) * np.arange(len(sizes))
    keep = np.ones(padded.size, bool)
    for k in range(order - 1):
        keep[starts + k] = False
    last = np.flatnonzero(keep)
    return [padded[last - (order - 1 - k)] for k in range(order)]


def summed(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct n-grams in the order of their columns, with the sums of their counts."""
    if not counts.size:
        return columns, counts
    bits = max(int(c.max()) for c in columns).bit_length()
    if bits * len(columns) <= 64:
        key = columns[0].astype(np.uint64)
        for c in columns[1:]:
            key = (key << np.uint64(bits)) | c.astype(np.uint64)
        order = np.argsort(key)
        key = key[order]
        at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    else:
        order = np.lexsort(columns[::-1])
        at = np.flatnonzero(np.append(True, np.any([c[order][1:] != c[order][:-1] for c in columns], axis=0)))
    return [c[order[at]] for c in columns], np.add.reduceat(counts[order], at)


# ---------------------------------------------------------------- packed n-grams of a shard

def pack(columns: list[np.ndarray], counts: np.ndarray) -> bytes:
    """Sorted distinct n-grams of numbers as bytes."""
    words, ids = np.unique(np.concatenate(columns), return_inverse=True)
    return _packed(words, np.split(ids.ravel(), len(columns)), counts)


def _packed(words: np.ndarray, ids: list[np.ndarray], counts: np.ndarray) -> bytes:
    """A sorted dictionary of the part's words, then the words' places in it (runs of the first column) and the
    counts; all in the least widths, dictionary and first column as differences. ``ids`` are places in ``words``."""
    used = np.zeros(words.size, bool)
    for c in ids:
        used[c] = True
    at = np.flatnonzero(used)
    place = np.empty(words.size, np.uint32)
    place[at] = np.arange(at.size, dtype=np.uint32)
    words, ids = words[at], [place[c] for c in ids]
    at = np.flatnonzero(np.append(True, ids[0][1:] != ids[0][:-1]))
    step = lambda x: np.diff(x, prepend=x.dtype.type(0))
    arrays = [step(words), step(ids[0][at]), np.diff(np.append(at, counts.size)), *ids[1:], counts]
    widths = [_width(int(a.max())) for a in arrays]
    body = b"".join(_planes(a, w) for a, w in zip(arrays, widths, strict=True))
    head = np.array([len(ids), counts.size, at.size, words.size, *widths], np.int64)
    return zstandard.compress(head.tobytes() + body, 5)


def _planes(a: np.ndarray, width: int) -> bytes:
    """The first bytes of all numbers, then the second ones and so on."""
    return np.ascontiguousarray(a.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T).tobytes()


def _width(most: int) -> int:
    """Bytes that hold numbers up to ``most``."""
    return next(w for w in (1, 2, 4, 8) if w == 8 or most < 1 << (8 * w))


def _parts(data: bytes) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Dictionary, columns of places in it, counts."""
    data = zstandard.decompress(data)
    k, n, m, d = np.frombuffer(data, np.int64, 4).tolist()
    at, out = 8 * (4 + 3 + k), []
    for size, w in zip((d, m, m, *[n] * k), np.frombuffer(data, np.int64, 3 + k, 32).tolist(), strict=True):
        plane = np.frombuffer(data, np.uint8, size * w, at).reshape(w, size)
        out.append(np.ascontiguousarray(plane.T).view(f"<u{w}").ravel())
        at += size * w
    first = np.repeat(np.cumsum(out[1], dtype=np.int64), out[2].astype(np.int64))
    return np.cumsum(out[0], dtype=np.uint64), [first, *out[3:-1]], out[-1].astype(np.int64)


def unpack(data: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    words, ids, counts = _parts(data)
    return [words[i] for i in ids], counts


def merged(packed: list[bytes]) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Distinct n-grams of several parts, with the sums of their counts: words, columns of places in them, counts."""
    parts = [_parts(p) for p in packed]
    words = np.unique(np.concatenate([w for w, _, _ in parts]))
    place = [np.searchsorted(words, w).astype(np.uint32) for w, _, _ in parts]
    ids = [np.concatenate([p[c[k]] for p, (_, c, _) in zip(place, parts, strict=True)]) for k in range(len(parts[0][1]))]
    return words, *summed(ids, np.concatenate([n for _, _, n in parts]))


def packed_rows(level: int, words: np.ndarray, ids: list[np.ndarray], counts: np.ndarray, hashes: np.ndarray, bits: int) -> Iterator[tuple]:
    """One row per shard, which is the upper bits of ``hashes``."""
    shard = shard_of(hashes, bits)
    order = np.argsort(shard, kind="stable")
    shard = shard[order]
    cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])).tolist() + [shard.size]
    for s, e in zip(cuts[:-1], cuts[1:], strict=True):
        part = order[s:e]
        yield level, int(shard[s]), _packed(words, [c[part] for c in ids], counts[part]), None


def gram_rows(level: int, numbers: np.ndarray, ids: list[np.ndarray], counts: np.ndarray, bits: int) -> list[tuple]:
    """Rows of n-grams of word numbers, by their contexts (by the word, for one column)."""
    hashed = spread(numbers)
    return list(packed_rows(level, numbers, ids, counts, context_hash([hashed[c] for c in ids[:-1] or ids]), bits))


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64())]
    return pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["level", "shard", "data", "stats"])


# ---------------------------------------------------------------- files of sorted hash arrays

def _local(uri: str) -> str | None:
    if "://" not in uri and not uri.startswith("file:"):
        return uri
    return "/" + uri[5:].lstrip("/") if uri.startswith("file:") else None


def write_arrays(uri: str, arrays: list[np.ndarray]) -> None:
    """Lengths, widths and arrays of unsigned numbers in their least widths, each from a multiple of 8 bytes on;
    under ``uri`` at once or not at all."""
    arrays = [a.astype(f"u{_width(int(a.max()) if a.size else 0)}") for a in arrays]
    head = np.array([len(arrays), *(a.size for a in arrays), *(a.itemsize for a in arrays)], np.int64)
    data = [head.tobytes(), *(a.tobytes().ljust(-(-a.nbytes // 8) * 8, b"\0") for a in arrays)]
    attempt = f"{uri}.{uuid.uuid4().hex}"
    path = _local(attempt)
    if path:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as f:
            f.writelines(data)
        os.replace(path, _local(uri))
        return
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(attempt)
    store.create_dir(os.path.dirname(name), recursive=True)
    with store.open_output_stream(name) as f:
        for d in data:
            f.write(d)
    store.move(name, fs.FileSystem.from_uri(uri)[1])


def map_arrays(uri: str) -> list[np.ndarray]:
    """The arrays of a file, mapped into memory; an error if there is no such file.

    A file of another store is copied to a nameless temporary file first, which ends with the worker.
    """
    path = _local(uri)
    if path:
        f = open(path, "rb")  # noqa: SIM115 - the mapping outlives it
    else:
        from pyarrow import fs

        store, name = fs.FileSystem.from_uri(uri)
        f = tempfile.TemporaryFile()  # noqa: SIM115
        with store.open_input_stream(name) as src:
            while block := src.read(1 << 22):
                f.write(block)
        f.flush()
    with f:
        view = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    n = int(np.frombuffer(view, np.int64, 1)[0])
    sizes, widths = (np.frombuffer(view, np.int64, n, 8 + 8 * n * k).tolist() for k in range(2))
    at, out = 8 * (2 * n + 1), []
    for s, w in zip(sizes, widths, strict=True):
        out.append(np.frombuffer(view, f"u{w}", s, at))
        at += -(-s * w // 8) * 8
    return out


def slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The directory entry of each hash (its lowest ``bits`` bits) before the next 32 bits."""
    return ((hashes & np.uint64((1 << bits) - 1)) << np.uint64(32)) | ((hashes >> np.uint64(bits)) & LOW)


def sorted_hashes(hashes: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """A directory, the 32 bits of each hash in the order of ``slots``, and the values in that order."""
    bits = max(hashes.size.bit_length() - PER_BUCKET_LOG2, 1)
    slot = slots(hashes, bits)
    by = np.argsort(slot)
    slot = slot[by]
    starts = np.searchsorted(slot, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(32))
    return [starts, slot & LOW, *(v[by] for v in values)]


def places(starts: np.ndarray, low: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Where each hash is in the arrays of ``sorted_hashes``; -1 if it is not there.

    Hashes are evenly spread, so the search begins near their share of the bucket and goes up or down from there.
    """
    slot = slots(hashes, (starts.size - 1).bit_length() - 1)
    bucket, want = (slot >> np.uint64(32)).astype(np.int64), (slot & LOW).astype(np.int64)
    first, end = starts[bucket].astype(np.int64), starts[bucket + 1].astype(np.int64)
    out = np.full(hashes.size, -1, np.int64)
    of = np.flatnonzero(first < end)
    want, first, end = want[of], first[of], end[of]
    at = first + ((want * (end - first)) >> 32)
    seen = low[at]
    hit = seen == want
    out[of[hit]] = at[hit]
    for step in (1, -1):
        live = np.flatnonzero(seen < want if step == 1 else seen > want)
        at_, want_, edge, of_ = at[live] + step, want[live], (end if step == 1 else first - 1)[live], of[live]
        while at_.size:
            inside = np.flatnonzero(at_ != edge)
            at_, want_, edge, of_ = at_[inside], want_[inside], edge[inside], of_[inside]
            now = low[at_]
            hit = now == want_
            out[of_[hit]] = at_[hit]
            on = np.flatnonzero(now < want_ if step == 1 else now > want_)
            at_, want_, edge, of_ = at_[on] + step, want_[on], edge[on], of_[on]
    return out


def _found(starts: np.ndarray, low: np.ndarray, hashes: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Which hashes are there and where; which are not."""
    at = places(starts, low, hashes)
    hit = at >= 0
    which = np.flatnonzero(hit)
    return (which, at[which]), np.flatnonzero(~hit)


# ---------------------------------------------------------------- counting

def _chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, list[int]]]:
    """The tokens of several texts one after another, and the sizes of the texts."""
    texts, size = [], 0
    for b in batches:
        for t in b.column(0):
            texts.append(token_hashes(t.as_py()))
            size += texts[-1].size
            if size >= most:
                yield np.concatenate(texts), [t.size for t in texts]
                texts, size = [], 0
    if texts:
        yield np.concatenate(texts), [t.size for t in texts]


def _count_words(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for tokens, _ in _chunks(batches, CHUNK_TOKENS):
        words, counts = np.unique(tokens, return_counts=True)
        yield batch_of(list(packed_rows(0, words, [np.arange(words.size)], counts, words, bits)))


def _write_words(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Sorted hashes and counts of a shard's words."""
    for shard, rows in _shard_runs(batches):
        words, _, counts = merged([d for _, d in rows])
        write_arrays(f"{path}/0-{shard}", [words, counts.astype(np.uint64)])
        yield batch_of([(0, shard, None, [words.size])])


def _count_texts(batches: Iterator[pa.RecordBatch], vocabulary: Model) -> Iterator[pa.RecordBatch]:
    order, reader = vocabulary.order, Reader(vocabulary)
    for tokens, sizes in _chunks(batches, CHUNK_TOKENS):
        words, ids = np.unique(tokens, return_inverse=True)
        # numbers rise with the hashes, and the begin is below all
        numbers = np.append(BEGIN, reader.words(words)[0])
        columns = grams(ids + 1, sizes, order, 0)
        ids, counts = summed(columns, np.ones(columns[0].size, np.int64))
        yield batch_of(gram_rows(order, numbers, ids, counts, vocabulary.bits))


def _shard_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list]]:
    """Rows of one shard at a time, from a partition sorted by shard; rows of sums come as shard None."""
    held, shard = [], None
    for b in batches:
        for s, data, stats, level in zip(b.column(1).to_pylist(), b.column(2), b.column(3), b.column(0).to_pylist(), strict=True):
            if stats.is_valid:
                yield None, [(level, stats.as_py())]
                continue
            if s != shard and held:
                yield shard, held
                held = []
            shard = s
            held.append((level, data.as_py()))
    if held:
        yield shard, held


def _reduce(batches: Iterator[pa.RecordBatch], level: int, bits: int, path: str) -> Iterator[pa.RecordBatch]:
    """Sum the n-grams of ``level`` per shard, write the shard's arrays, pass on what the level below counts.

    Rows of sums pass through.
    """
    for shard, rows in _shard_runs(batches):
        if shard is None:
            yield batch_of([(lv, -1, None, st) for lv, st in rows])
            continue
        numbers, columns, counts = merged([d for _, d in rows])
        of = [int((counts == k).sum()) for k in (1, 2, 3, 4)]
        out = [(level, -1, None, [*of, int(counts.size), int(counts.sum()), shard])]
        tally, one, hashed = counts.astype(np.uint64), counts == 1, spread(numbers)
        hashed = [hashed[c] for c in columns]
        context = context_hash(hashed[:-1]) if level > 1 else None
        h = mix(context, hashed[-1]) if level > 1 else hashed[0]
        # what occurs once needs no count beside its hash
        arrays = [*sorted_hashes(h[one]), *sorted_hashes(h[~one], tally[~one])]
        if level > 1:
            # the n-grams of a context are neighbours; a context's total is 1 if it has one n-gram that occurs once
            at = np.flatnonzero(np.append(True, np.any([c[1:] != c[:-1] for c in columns[:-1]], axis=0)))
            total = np.add.reduceat(tally, at)
            kinds = [np.add.reduceat(sel.astype(np.uint64), at) for sel in (one, counts == 2, counts > 2)]
            ctx, once = context[at], total == 1
            arrays += [*sorted_hashes(ctx[once]), *sorted_hashes(ctx[~once], *(v[~once] for v in (total, *kinds)))]
            out += gram_rows(level - 1, numbers, *summed(columns[1:], np.ones(counts.size, np.int64)), bits)
        write_arrays(f"{path}/{level}-{shard}", arrays)
        yield batch_of(out)


@dataclass(frozen=True)
class Model:
    """What scoring needs besides the files: the folder, sums per level, which shards of a level were written, and the
    number of the first word of each shard of the vocabulary."""

    path: str
    order: int
    bits: int
    stats: dict[int, list[int]]
    written: dict[int, frozenset[int]]
    first: np.ndarray

    def discounts(self, level: int) -> np.ndarray:
        """Discount for a count of 0, 1, 2 and 3 or more."""
        n1, n2, n3, n4 = self.stats.get(level, [0] * STATS)[:4]
        if not (n1 and n2 and n3 and n4):
            return np.array([0, 0.5, 1.0, 1.5])
        y = n1 / (n1 + 2 * n2)
        d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
        return np.array([0, *(min(max(x, 0.0), float(k + 1)) for k, x in enumerate(d))])

    @property
    def train_tokens(self) -> int:
        return self.stats.get(self.order, [0] * STATS)[5]

    @property
    def types(self) -> int:
        return self.stats.get(1, [0] * STATS)[4]


def train(texts: DataFrame, text_col: str = "text", order: int = 2, shards: int | None = None) -> Model:
    """Count all n-grams of all texts and write the model's files to the shared folder."""
    spark = texts.sparkSession
    src = texts.select(F.col(text_col).cast("string").alias("text"))
    if shards is None:
        shards = max(MIN_SHARDS, SHARDS_PER_SPLIT * src.rdd.getNumPartitions())
    bits = min(max(shards - 1, 0), MAX_SHARDS - 1).bit_length()
    path = qualified(spark, shared_dir(spark, "kneser-ney"))
    # one shard per task; rows of sums (shard -1) go with the first
    deal = lambda df: df.repartitionById(1 << bits, F.greatest(F.col("shard"), F.lit(0))).sortWithinPartitions("shard")
    words = deal(src.mapInArrow(lambda it: _count_words(it, bits), ROW)).mapInArrow(lambda it: _write_words(it, path), ROW)
    sizes = np.zeros(1 << bits, np.int64)
    for r in words.select("shard", F.col("stats")[0].alias("n")).collect():  # one number per shard
        sizes[r["shard"]] = r["n"]
    model = Model(path, order, bits, {}, {0: frozenset(np.flatnonzero(sizes).tolist())}, FIRST + np.cumsum(sizes) - sizes)
    rows = src.mapInArrow(lambda it: _count_texts(it, model), ROW)
    for level in range(order, 0, -1):
        rows = deal(rows).mapInArrow(lambda it, level=level: _reduce(it, level, bits, path), ROW)
    # one number per shard comes along: a file that is missing later is an error, not a shard without n-grams
    sums = rows.where("stats is not null").groupBy("level").agg(*[F.sum(F.col("stats")[k]).alias(f"s{k}") for k in range(STATS)],
                                                                F.collect_set(F.col("stats")[STATS]).alias("shards")).collect()
    return replace(model, stats={r["level"]: [int(r[f"s{k}"]) for k in range(STATS)] for r in sums},
                   written=model.written | {r["level"]: frozenset(r["shards"]) for r in sums})


def qualified(spark, path: str) -> str:
    """A path with the scheme that Spark takes it to have, so workers do not look for it on their own disks."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


# ---------------------------------------------------------------- scoring

class Reader:
    """Look-ups in the mapped files of a model, which are opened when first needed."""

    def __init__(self, model: Model):
        self.model, self.files = model, {}

    def shard(self, level: int, s: int) -> list[np.ndarray] | None:
        if (level, s) not in self.files:
            known = s in self.model.written.get(level, ())
            self.files[level, s] = map_arrays(f"{self.model.path}/{level}-{s}") if known else None
        return self.files[level, s]

    def by_shard(self, level: int, shards: np.ndarray) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
        """Shard, which of the look-ups go to it, and its arrays, for each shard that was written."""
        order = np.argsort(shards, kind="stable")
        dealt = shards[order]
        cuts = [*np.flatnonzero(np.append(True, dealt[1:] != dealt[:-1])).tolist(), dealt.size]
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            arrays = self.shard(level, int(dealt[s]))
            if arrays is not None:
                yield int(dealt[s]), order[s:e], arrays

    def words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and counts of words in the training texts."""
        numbers, counts = np.full(hashes.size, UNKNOWN), np.zeros(hashes.size, np.int64)
        for s, of, (known, count) in self.by_shard(0, shard_of(hashes, self.model.bits)):
            i = np.searchsorted(known, hashes[of])
            i[i == known.size] = 0
            hit = np.flatnonzero(known[i] == hashes[of])
            numbers[of[hit]] = self.model.first[s] + i[hit]
            counts[of[hit]] = count[i[hit]]
        return numbers, counts

    def counts(self, level: int, hashes: np.ndarray, contexts: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts of n-grams; the sums of counts and of discounts in their contexts, which are looked up first: no
        n-gram follows a context that is not there."""
        d = self.model.discounts(level)
        out, total, mass = np.zeros(hashes.size, np.int64), np.zeros(hashes.size), np.zeros(hashes.size)
        for _, of, a in self.by_shard(level, shard_of(hashes if contexts is None else contexts, self.model.bits)):
            if contexts is not None:
                (i, at), rest = _found(a[7], a[8], contexts[of])
                total[of[i]] = a[9][at]
                mass[of[i]] = d[1] * a[10][at] + d[2] * a[11][at] + d[3] * a[12][at]
                (j, _), _ = _found(a[5], a[6], contexts[of[rest]])
                total[of[rest[j]]], mass[of[rest[j]]] = 1, d[1]
                of = np.concatenate([of[i], of[rest[j]]])
            (i, at), rest = _found(a[2], a[3], hashes[of])
            out[of[i]] = a[4][at]
            (j, _), _ = _found(a[0], a[1], hashes[of[rest]])
            out[of[rest[j]]] = 1
        return out, total, mass

    def log_scores(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Per token: log10 probability and count in the training texts."""
        m = self.model
        words, ids = np.unique(np.concatenate(texts), return_inverse=True)
        numbers, raw = self.words(words)
        hashed = spread(np.append(BEGIN, numbers))
        columns = [hashed[c] for c in grams(ids + 1, [t.size for t in texts], m.order, 0)]
        word = columns[-1]
        n1, n2, n3, _, types, total = m.stats.get(1, [0] * STATS)
        n3 = types - n1 - n2
        d = m.discounts(1)
        left = self.counts(1, word, None)[0]
        rest = (d[1] * n1 + d[2] * n2 + d[3] * n3) / total if total else 1.0
        p = (np.maximum(left - d[np.minimum(left, 3)], 0) / total if total else 0.0) + rest / (types + 1)
        for level in range(2, m.order + 1):
            context = context_hash(columns[-level:-1])
            c, all_, mass = self.counts(level, mix(context, word), context)
            d = m.discounts(level)
            seen = all_ > 0
            all_[~seen] = 1
            p = np.where(seen, np.maximum(c - d[np.minimum(c, 3)], 0) / all_ + mass / all_ * p, p)
        return np.log10(p), raw[ids]


# ---------------------------------------------------------------- documents

def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        n_train, types = model.train_tokens, model.types

        def flush(ids, texts):
            log_p, count = reader.log_scores(texts)
            base = np.log10((count + 0.5) / (n_train + 0.5 * (types + 1)))
            sizes = np.array([t.size for t in texts], np.int64)
            at = np.cumsum(sizes) - sizes
            total = np.add.reduceat(log_p, at)
            return pa.record_batch(
                [pa.array(ids, pa.int64()), pa.array(sizes), pa.array(np.add.reduceat((count > 0).astype(np.int64), at)),
                 pa.array(np.full(sizes.size, n_train, np.int64)), pa.array(np.add.reduceat(base, at)), pa.array(total),
                 pa.array(10.0 ** np.minimum(-total / sizes, 300))],
                names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

        for b in batches:
            ids, texts, size = [], [], 0
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids.append(i)
                texts.append(token_hashes(t.as_py()))
                size += texts[-1].size
                if size >= SCORE_TOKENS:
                    yield flush(ids, texts)
                    ids, texts, size = [], [], 0
            if texts:
                yield flush(ids, texts)

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")


def score_held_out(docs: DataFrame, order: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Learn from the rows outside the held-out fold and score all rows."""
    held = F.coalesce(fold(id_col) == HELD_OUT, F.lit(False))
    scored = score(docs, train(docs.where(~held), text_col, order), id_col, text_col)
    return scored.withColumn("held_out", F.coalesce(fold("doc_id") == HELD_OUT, F.lit(False)))
