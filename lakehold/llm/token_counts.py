"""Token counts through a digest cache.

Counts are stored under (digest of the normalised content, digest of the tokenizer's version). A run joins its
texts' digests to the stored counts, encodes each distinct missing text once, appends the new counts to the
cache, and joins the counts back to the rows.

Normalisation must not change a count: a null text becomes the empty text, and content is its UTF-8 bytes.

Encoding gives what the ``tokenizers`` library gives for the vocabulary file. Texts of common Latin characters
without special strings go through ``tiktoken`` with the same vocabulary in rank form, which yields the same
tokens several times faster; all other texts go through ``tokenizers`` itself.

Cases: an empty text has 0 tokens; repeated rows share one encoding and keep their own result rows; appends of
several writers may repeat a cached count, which reading folds together; an empty table appends nothing.
"""

from __future__ import annotations

import base64
import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakehold.llm.common import worker_cache

CACHE_SCHEMA = "digest string, version string, n_tokens long"
METHOD = "counts-1"  # part of the version digest: raise it when counting changes
#: Characters on whose classes all regular-expression libraries agree.
COMMON = r"[\t\n\r\x20-\x7e\xa1-\xac\xae-ɏ]*"


def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary file, the library and the counting method."""
    import tokenizers

    h = hashlib.sha256(f"{METHOD}:{tokenizers.__version__}:".encode())
    with open(path, "rb") as f:
        h.update(f.read())
    return h.hexdigest()


class Counter:
    """Token counts of whole texts for one vocabulary."""

    def __init__(self, path: str, ranks_path: str | None, pattern: str | None):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            special = [t["content"] for t in json.load(f)["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.common = regex.compile(COMMON)
        self.ranked = None
        if ranks_path and pattern:
            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.ranked = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str | None) -> int:
        text = text or ""
        if self.ranked and self.common.fullmatch(text) and not (self.special and self.special.search(text)):
            return len(self.ranked.encode_ordinary(text))
        return len(self.library.encode(text, add_special_tokens=False))


def _counter(path: str, ranks_path: str | None, pattern: str | None) -> Counter:
    return worker_cache(("counter", path), lambda: Counter(path, ranks_path, pattern))


def cached(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Stored ``(digest, n_tokens)`` of a tokenizer version; a cache that does not exist yet is empty."""
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache)
    # grouped by both columns, so that a join by digest deals the counts out anew and can split hot digests
    return (spark.read.schema(CACHE_SCHEMA).parquet(cache).groupBy("digest", "version")
            .agg(F.max("n_tokens").alias("n_tokens")).where(F.col("version") == version).select("digest", "n_tokens"))


def count_tokens(docs: DataFrame, cache: str, path: str, ranks_path: str | None = None, pattern: str | None = None,
                 max_tokens: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_tokens, over_limit``; appends missing counts to the folder ``cache``."""
    spark, version = docs.sparkSession, tokenizer_version(path)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    keyed = src.withColumn("digest", F.sha2(F.encode("text", "UTF-8"), 256))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path, ranks_path, pattern)
        for b in batches:
            n = [count(t.as_py()) for t in b.column(1)]
            yield pa.record_batch([b.column(0), pa.array([version] * len(n), pa.string()), pa.array(n, pa.int64())],
                                  names=["digest", "version", "n_tokens"])

    # repeated texts are reduced on the map side first, so a hot text moves once per task, and the join
    # finds both sides dealt out by digest already
    misses = (keyed.groupBy("digest").agg(F.first("text").alias("text"))
              .join(cached(spark, cache, version), "digest", "left_anti"))
    misses.mapInArrow(encode, CACHE_SCHEMA).write.mode("append").parquet(cache)

    rows = keyed.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
    return rows.join(cached(spark, cache, version), "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > max_tokens).alias("over_limit"))
