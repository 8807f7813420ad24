"""BPE encoding and decoding with word ends, for a vocabulary file of the ``tokenizers`` JSON format.

Merging uses a priority queue of merge ranks over a doubly linked list of symbols; queue entries whose pair
has changed meanwhile are stale and skipped. Decoding puts the vocabulary strings together again.

Cases: a null text is the empty text (no ids, empty decoding); special strings of the vocabulary inside a
text become their ids, as the library has it; texts are encoded whole; repeated rows give repeated results;
columns other than id and text are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakehold.llm.common import worker_cache

ROWS_AT_A_TIME = 500
CACHED_WORDS = 200_000  # words per generation of a worker's cache; two generations are held
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


#: Texts of these characters are split by the file's pattern as it is; others by explicit character classes.
COMMON = re.compile(r"[\x00-ɏ\u2010-\u2027]*")
# Case pairs that the library knows and Python's tables do not have yet, as (first, last, distance).
NEWER_CASES = [(0x10D50, 0x10D65, 0x20), (0x16EA0, 0x16EB8, 0x1B), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1),
               (0xA7CE, 0xA7CE, 1), (0xA7D2, 0xA7D2, 1), (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC), (0x1C89, 0x1C89, 1)]
# Letters and numbers of Unicode 16, which the library knows and Python's tables do not have yet.
NEWER_CLASSES = {
    "L": [(0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
          (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1),
          (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF),
          (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0)],
    "N": [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)],
}
NEWER = {c: c + d for a, b, d in NEWER_CASES for c in range(a, b + 1)}


def character_class(major: str) -> str:
    """Ranges of all characters of a major category, as the inside of a regular expression's class."""
    newer = {c for a, b in NEWER_CLASSES[major] for c in range(a, b + 1)}
    codes = [c for c in range(0x110000) if unicodedata.category(chr(c))[0] == major or c in newer]
    ranges, start = [], None
    for c, after in zip(codes, [*codes[1:], None], strict=True):
        start = c if start is None else start
        if after != c + 1:
            ranges.append(f"\\U{start:08x}-\\U{c:08x}")
            start = None
    return "".join(ranges)


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class WordBpe:
    """Encoder and decoder of one vocabulary file (normaliser: NFC and lower case; words are split by the
    file's own pattern; the last symbol of a word carries the end-of-word suffix)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.text_of = {i: s for s, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text_of |= {i: s for s, i in self.special.items()}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = split["pattern"]["Regex"]
        self.words = regex.compile(self.pattern).findall
        self.exact_words = None
        self.specials = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        byte = byte_symbols()
        self.inner = [self.vocab.get(byte[b]) for b in range(256)]
        self.last = [self.vocab.get(byte[b] + self.suffix) for b in range(256)]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merged = [self.vocab[a + b] for a, b in pairs]
        self.rank = {}
        for r, (a, b) in enumerate(pairs):
            self.rank.setdefault(self.vocab[a] << 32 | self.vocab[b], r)

    def merge(self, word: str) -> list[int]:
        """Ids of one word."""
        data = word.encode("utf-8", "surrogatepass")
        sym = [self.inner[b] for b in data[:-1]]
        sym.append(self.last[data[-1]])
        sym = [s for s in sym if s is not None]
        n = len(sym)
        if n < 2:
            return sym
        rank, merged = self.rank, self.merged
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = []
        for i in range(n - 1):
            r = rank.get(sym[i] << 32 | sym[i + 1])
            if r is not None:
                queue.append((r, i))
        heapq.heapify(queue)
        while queue:
            r, i = heapq.heappop(queue)
            j = after[i]
            if sym[i] < 0 or j >= n or rank.get(sym[i] << 32 | sym[j]) != r:
                continue  # stale: a neighbour has been merged since
            sym[i], sym[j] = merged[r], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                q = rank.get(sym[i] << 32 | sym[k])
                if q is not None:
                    heapq.heappush(queue, (q, i))
            h = before[i]
            if h >= 0:
                q = rank.get(sym[h] << 32 | sym[i])
                if q is not None:
                    heapq.heappush(queue, (q, h))
        return [s for s in sym if s >= 0]

    def pieces(self, text: str) -> list[str]:
        """Words of a text without special strings, normalised."""
        if not text.isascii():
            # lower-casing goes character by character: no special form of sigma at the end of a word
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            if not COMMON.fullmatch(text):
                if self.exact_words is None:
                    classes = {r"\p{L}": character_class("L"), r"\p{N}": character_class("N")}
                    pattern = self.pattern
                    for name, inside in classes.items():
                        pattern = pattern.replace(name, inside)
                    self.exact_words = re.compile(pattern.replace(r"\s", r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000")).findall
                return self.exact_words(text.translate(NEWER).lower())
        return self.words(text.lower())

    def parts(self, text: str) -> list[str]:
        return self.specials.split(text) if self.specials else [text]

    def encode(self, text: str | None) -> list[int]:
        ids = []
        for part in self.parts(text or ""):
            if part in self.special:
                ids.append(self.special[part])
            else:
                for w in self.pieces(part):
                    ids.extend(self.merge(w))
        return ids

    def decode(self, ids: list[int]) -> str:
        """The vocabulary strings, put together with spaces (the file has no decoder of its own)."""
        return " ".join(self.text_of[i] for i in ids)


class Encoded(dict):
    """word -> (ids as text, decoded text, number of ids), for the words met last: two generations, bounded."""

    def __init__(self, bpe: WordBpe, limit: int):
        super().__init__()
        self.bpe, self.limit, self.old = bpe, limit, {}

    def __missing__(self, word: str) -> tuple[str, str, int]:
        got = self.old.get(word)
        if got is None:
            ids = self.bpe.merge(word)
            got = (" ".join(map(str, ids)), self.bpe.decode(ids), len(ids))
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[word] = got
        return got


def encoder(path: str, limit: int = CACHED_WORDS) -> Encoded:
    """The worker's encoder of ``path`` (made once per Python worker)."""
    return worker_cache(("bpe", path), lambda: Encoded(WordBpe(path), limit))


def encoded_text(words: Encoded, text: str | None) -> tuple[list[str], list[str], int]:
    """Ids as texts, decoded pieces and number of ids of a whole text."""
    bpe, ids, out, n = words.bpe, [], [], 0
    for part in bpe.parts(text or ""):
        if part in bpe.special:
            ids.append(str(bpe.special[part]))
            out.append(part)
            n += 1
        else:
            got = list(map(words.__getitem__, bpe.pieces(part)))
            if got:
                a, b, c = zip(*got, strict=True)
                n += sum(c)
                # a word whose bytes all miss from the vocabulary has no ids
                ids.extend(a if all(a) else filter(None, a))
                out.extend(b if all(b) else filter(None, b))
    return ids, out, n


def _src(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def encode_table(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, n_tokens, ids array<int>, decoded string``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        for b in sliced(batches):
            got = [encoded_text(words, t.as_py()) for t in b.column(1)]
            yield pa.record_batch([b.column(0), pa.array([n for _, _, n in got], pa.int64()), lists([numbers(i) for i, _, _ in got]),
                                   pa.array([" ".join(o) for _, o, _ in got], pa.string())], names=["doc_id", "n_tokens", "ids", "decoded"])

    return _src(docs, id_col, text_col).mapInArrow(encode, "doc_id long, n_tokens long, ids array<int>, decoded string")


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, fewer at a time, so that little of a batch's results is held at once."""
    for b in batches:
        for k in range(0, b.num_rows, ROWS_AT_A_TIME):
            yield b.slice(k, ROWS_AT_A_TIME)


def numbers(ids: list[str]) -> np.ndarray:
    """Ids as texts (several in one text, with spaces between) to numbers."""
    return np.array(" ".join(ids).split(), np.int32)


def lists(values: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *(v.size for v in values)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int32), *values])))


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Per row: ``doc_id, n_tokens, ids_sha256, decoded_sha256``, and ``ids`` if asked for; the decoded text
    itself does not leave the worker."""
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        digest = lambda parts: hashlib.sha256(" ".join(parts).encode("utf-8", "surrogatepass")).hexdigest()
        for b in sliced(batches):
            n, a, c, ids = [], [], [], []
            for t in b.column(1):
                i, out, k = encoded_text(words, t.as_py())
                n.append(k)
                a.append(digest(i))
                c.append(digest(out))
                if with_ids:
                    ids.append(numbers(i))
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(c, pa.string())]
            if with_ids:
                cols.append(lists(ids))
            yield pa.record_batch(cols, names=names)

    return _src(docs, id_col, text_col).mapInArrow(encode, RESULT + ", ids array<int>" * with_ids)
