"""SimHash near-duplicates through an inverted index of byte positions with count filtering.

A 64-bit fingerprint is eight bytes by position. Two fingerprints that differ in at most ``max_bits`` bits
share at least ``8 - max_bits`` positional bytes. The index therefore lists fingerprints under every choice of
that many positions together with the bytes found there: a pair meets in a list exactly if its tally of
shared positional bytes reaches the guaranteed minimum. Pairs that meet are verified by their bit distance.

Equal fingerprints are one entry of the index. A list returns a spanning forest of its links, never the pairs
themselves. Lists far longer than the others are cut into blocks, and every pair of blocks is one piece of
work, so a list of any length is spread over many tasks.

Cases: a null or empty text, or one without words, has the fingerprint zero and is linked like any other;
repeated rows are one entry and give repeated results (``keep_one`` keeps one of them); null ids get a component like all other rows, and a
component that has only null ids has a null ``component_id``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehold.llm.common import fresh, maybe_among, stored
from lakehold.llm.components import connected_components

SHINGLE_WORDS, MAX_BITS, SEED = 4, 4, 42
BLOCK = 2048  # fingerprints per block of a long list
SLOTS_LOG2 = 16  # size of the table that finds long lists


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash over the shingles of ``words`` words (A-Z lower-cased, ASCII white space)."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    n = max(1, len(parts) - words + 1)
    starts = np.concatenate(([0], ends[:n - 1] + 1)).tolist()
    stops = ends[len(parts) - n:].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts, stops, strict=True)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 65536):
        ones += np.unpackbits(h[k:k + 65536].astype(">u8").view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", keys: tuple[str, ...] = ("doc_id",), words: int = SHINGLE_WORDS) -> DataFrame:
    """``keys`` and ``fp`` (the fingerprint as a signed long) per row."""
    src = docs.select(F.col(text_col).cast("string").alias("text"), *keys)
    out = src.drop("text").schema.add("fp", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py(), words) for t in b.column(0)), np.uint64, b.num_rows)
            yield pa.record_batch([*b.columns[1:], pa.array(fp.view(np.int64))], names=[*keys, "fp"])

    return src.mapInArrow(run, out)


def position_masks(shared: int) -> list[int]:
    """For each choice of ``shared`` of the eight byte positions, the mask of its bits."""
    return [sum(0xFF << (8 * p) for p in chosen) for chosen in combinations(range(8), shared)]


def shared_bytes(a: np.ndarray, b: np.uint64) -> np.ndarray:
    """Tally of positional bytes that each of ``a`` shares with ``b``."""
    return ((a ^ b).view(np.uint8).reshape(-1, 8) == 0).sum(1)


def _forest(fp: np.ndarray, max_bits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links (member, first member) that connect what is connected in ``fp`` by at most ``max_bits`` bits."""
    left, a, b = np.unique(fp), [], []
    while left.size > 1:
        first, left = left[0], left[1:]
        todo = [first]
        while todo and left.size:
            one = todo.pop()
            near = shared_bytes(left, one) >= 8 - max_bits
            near[near] = np.bitwise_count(left[near] ^ one) <= max_bits
            if near.any():
                found = left[near]
                left = left[~near]
                todo.extend(found)
                a.append(found)
                b.append(np.full(found.size, first))
    return a, b


def _slots(fp: np.ndarray, choice: int, mask: int) -> np.ndarray:
    """Slot of the size table that counts an index entry (chosen positions and the bytes there)."""
    h = ((fp & np.uint64(mask)) + np.uint64(choice)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    return ((h * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - SLOTS_LOG2)).astype(np.int64)


def list_blocks(fps: DataFrame, masks: list[int], block: int) -> np.ndarray:
    """Blocks per slot, from the number of index entries of each slot: one, unless a slot holds far more than
    the others. A list of the index is never longer than its slot's number, and the table's size is fixed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(1 << SLOTS_LOG2, np.int64)
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            for i, m in enumerate(masks):
                n += np.bincount(_slots(fp, i, m), minlength=n.size)
        used = np.flatnonzero(n)
        yield pa.record_batch([pa.array(used), pa.array(n[used])], names=["slot", "n"])

    sums = fps.select("fp").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    total, = sums.agg(F.sum("n")).first()
    limit = block + 4 * (total or 0) // (1 << SLOTS_LOG2)
    blocks = np.ones(1 << SLOTS_LOG2, np.int64)
    for r in sums.where(F.col("n") > limit).toLocalIterator():
        blocks[r["slot"]] = -(-r["n"] // limit)
    return blocks


def index_entries(fps: DataFrame, masks: list[int], blocks: np.ndarray) -> DataFrame:
    """``(tag, fp)``: each fingerprint under every choice of positions (``tag % 256``). A list of several
    blocks is one piece of work per pair of blocks (the rest of ``tag``), to which a fingerprint goes with its
    own block and each other one."""
    known = fps.sparkSession.sparkContext.broadcast(blocks)  # fixed size

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = known.value
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            tags, out = [], []
            for i, m in enumerate(masks):
                n = blocks[_slots(fp, i, m)]
                one = n == 1
                tags.append(np.full(int(one.sum()), i, np.int64))
                out.append(fp[one])
                many = fp[~one]
                if many.size:
                    n = n[~one]
                    h = many * np.uint64(0xD6E8FEB86659FD93)
                    own = ((h ^ h >> np.uint64(32)) % n.astype(np.uint64)).astype(np.int64)
                    other = np.concatenate([np.arange(k) for k in n])
                    own, many = np.repeat(own, n), np.repeat(many, n)
                    tags.append(i + (np.minimum(own, other) + 1 << 8) + (np.maximum(own, other) + 1 << 32))
                    out.append(many)
            yield pa.record_batch([pa.array(np.concatenate(tags)), pa.array(np.concatenate(out).view(np.int64))], names=["tag", "fp"])

    return fps.select("fp").mapInArrow(entries, "tag long, fp long")


def _forests(batches: Iterator[pa.RecordBatch], masks: list[int], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Forests of the index lists in a partition sorted by tag and masked fingerprint."""
    mask = np.array(masks, np.uint64)
    tag, fp = np.empty(0, np.int64), np.empty(0, np.uint64)

    def links(tag, fp, cuts):
        size = np.diff(cuts)
        a, b = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
        at = np.asarray(cuts[:-1])[size == 2]  # most lists have two entries: all at once
        x, y = np.minimum(fp[at], fp[at + 1]), np.maximum(fp[at], fp[at + 1])
        near = (x != y) & (np.bitwise_count(x ^ y) <= max_bits)
        a.append(y[near])
        b.append(x[near])
        for k in np.flatnonzero(size > 2).tolist():
            m, first = _forest(fp[cuts[k]:cuts[k + 1]], max_bits)
            a += m
            b += first
        return pa.record_batch([pa.array(np.concatenate(c).view(np.int64)) for c in (a, b)], names=["a", "b"])

    for batch in batches:
        tag = np.concatenate([tag, batch.column(0).to_numpy()])
        fp = np.concatenate([fp, batch.column(1).to_numpy().view(np.uint64)])
        shared = fp & mask[tag & 255]
        new = np.flatnonzero((tag[1:] != tag[:-1]) | (shared[1:] != shared[:-1])) + 1
        if new.size:
            yield links(tag, fp, np.array([0, *new.tolist()]))
            tag, fp = tag[new[-1]:].copy(), fp[new[-1]:].copy()
    if fp.size:
        yield links(tag, fp, np.array([0, fp.size]))


def links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints (column ``fp``) that span all links of at most
    ``max_bits`` bits. The index is shuffled once, as fingerprints with a choice of positions."""
    masks = position_masks(8 - max_bits)
    spread = fps.select("fp").repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    index = index_entries(spread, masks, list_blocks(fps, masks, block))
    signed = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m) for m in masks])
    shared = F.col("fp").bitwiseAND(F.element_at(signed, (F.col("tag").bitwiseAND(F.lit(255)) + 1).cast("int")))
    return (index.repartition(F.xxhash64("tag", shared)).sortWithinPartitions("tag", shared)
            .mapInArrow(lambda it: _forests(it, masks, max_bits), "a long, b long"))


def components(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(fp, root)`` for every fingerprint that is linked to a lesser one; ``root`` is the least of them."""
    return connected_components(links(fps.select("fp").distinct(), max_bits)).withColumnRenamed("node", "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """Per row: ``doc_id``, ``fingerprint`` (hexadecimal) and ``component_id`` (least id that it reaches)."""
    rows = stored(fingerprints(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), words=words), "simhash-rows")
    known = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    labelled = stored(known.join(components(known, max_bits), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "simhash-labels")
    ids = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    named = labelled.join(ids, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: that of the least id (null ids last, then the least digest).

    Rows are told apart by id and text, not by their place, which may change from one read to the next; of
    rows with equal id and text any one stays.
    """
    key = fresh(docs, "row_key")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    row_key = F.sha2(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.sha2(text, 256)), 256)
    keyed = docs.withColumn(key, row_key)
    rows = stored(fingerprints(keyed.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(key).alias("key")),
                               keys=("id", "key"), words=words), "simhash-rows")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "key")
    known = stored(rows.groupBy("fp").agg(F.min(order).alias("best")), "simhash-distinct")
    labelled = known.join(components(known, max_bits), "fp", "left").select(F.coalesce("root", "fp").alias("root"), "best")
    kept = stored(labelled.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.key").alias("key")), "simhash-kept")
    dropped = stored(rows.select("key").distinct().join(kept, "key", "left_anti"), "simhash-dropped")
    repeated = rows.groupBy("key").count().where("count > 1").select("key")
    # only rows that may be dropped or repeated are dealt out, the others stay where they are
    maybe = maybe_among(dropped.unionByName(repeated), "key")
    rest = keyed.where(maybe(F.col(key))).join(dropped.withColumnRenamed("key", key), key, "left_anti").dropDuplicates([key])
    return keyed.where(~maybe(F.col(key))).unionByName(rest.select(*keyed.columns)).select(*docs.columns)
