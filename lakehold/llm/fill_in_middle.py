"""Fill-in-the-middle transformation of documents as one ``pyarrow.compute`` pipeline per batch.

A text is cut into units (``UNIT``: a word with the white space before it, or white space at the end). Two cuts
between units, drawn from a digest of the id, give prefix, middle and suffix, which are put out in the order of
the form: ``psm`` is ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, ``spm`` is ``<S>`` suffix ``<P>`` prefix
``<M>`` middle, ``plain`` is the text itself. No text becomes a Python string: units are split into list arrays,
flattened with the indices of their rows, numbered, filtered by role, gathered into lists again and joined.

Memory is bounded by ``SLICE_BYTES`` of text (or one longer text) at a time. A row depends on its id and text
alone, so rows may be recomputed anywhere.

Defined results: a null text counts as empty, a null id as an empty one in the digest. An empty text, and one that
has one of the marks in it, stay plain, so every output can be turned back (``restored``). White space alone is one
unit. Repeated rows and ids all stay, the same id and text giving the same output; other columns do not pass, so
they may have any name. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE, WORD = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]+"
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SLICE_BYTES = 4 << 20
RESULT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned numbers of 32 bits from the digest of seed and id."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(h, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def transform(docs: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``RESULT``: the units, the form, the lengths of prefix and middle in code points (null if plain)
    and the output. ``rate`` per cent of the texts are rearranged, ``spm_rate`` per cent of these as ``spm``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    h1, h2, h3, h4 = draws(F.col(id_col), seed)
    marked = F.contains(text, F.lit(PREFIX)) | F.contains(text, F.lit(SUFFIX)) | F.contains(text, F.lit(MIDDLE))
    form = F.when((text == "") | marked | (h3 % 100 >= rate), "plain").when(h4 % 100 < spm_rate, "spm").otherwise("psm")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), form.alias("form"), h1.alias("h1"), h2.alias("h2"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in by_size(b, 1, SLICE_BYTES):
                yield rearranged(part)

    return rows.mapInArrow(run, RESULT)


def by_size(batch: pa.RecordBatch, col: int, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of at most ``size`` bytes in a column, or one row."""
    ends = np.cumsum(pc.binary_length(batch.column(col)).to_numpy(zero_copy_only=False).astype(np.int64))
    k = 0
    while k < batch.num_rows:
        before = int(ends[k - 1]) if k else 0
        n = max(int(np.searchsorted(ends, before + size, side="right")) - k, 1)
        yield batch.slice(k, n)
        k += n


def rearranged(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Columns ``doc_id, text, form, h1, h2`` -> ``RESULT``."""
    doc_id, text, form, h1, h2 = batch.columns
    moved = pc.not_equal(form, "plain")
    n = pc.cast(pc.count_substring_regex(text, UNIT), pa.int64())
    pieces = split_at(text.filter(moved), h1.filter(moved).to_numpy(), h2.filter(moved).to_numpy())
    prefix, middle, suffix = pieces
    join = lambda *parts: pc.binary_join_element_wise(*parts, "")
    out = pc.if_else(pc.equal(form.filter(moved), "spm"), join(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle),
                     join(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    none = pa.nulls(batch.num_rows, pa.int64())
    length = lambda piece: pc.replace_with_mask(none, moved, pc.cast(pc.utf8_length(piece), pa.int64()))
    return pa.record_batch([doc_id, n, form, length(prefix), length(middle), pc.replace_with_mask(text, moved, out)],
                           names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def units(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All units of (non-empty) texts and the index of each one's text, in order."""
    gaps, words = pc.split_pattern_regex(text, WORD), pc.split_pattern_regex(text, SPACE)
    word = pc.list_flatten(words)
    word = word.filter(pc.not_equal(word, ""))
    gap, parent = pc.list_flatten(gaps), pc.list_parent_indices(gaps).to_numpy()
    # one word stands behind each gap but a text's last
    has_word = np.ones(len(gap), bool)
    has_word[np.cumsum(pc.list_value_length(gaps).to_numpy()) - 1] = False
    behind = pc.replace_with_mask(pa.array(np.full(len(gap), "", object), pa.string()), pa.array(has_word), word)
    unit = pc.binary_join_element_wise(gap, behind, "")
    real = pc.not_equal(unit, "")
    return unit.filter(real), parent[real.to_numpy(zero_copy_only=False)]


def split_at(text: pa.Array, h1: np.ndarray, h2: np.ndarray) -> list[pa.Array]:
    """Prefix, middle and suffix of each text, cut by two numbers modulo one more than its units."""
    rows = len(text)
    unit, parent = units(text)
    n = np.bincount(parent, minlength=rows)
    ordinal = np.arange(len(unit)) - np.repeat(np.cumsum(n) - n, n)
    a, b = h1 % (n + 1), h2 % (n + 1)
    role = (ordinal >= np.minimum(a, b)[parent]).astype(np.int8) + (ordinal >= np.maximum(a, b)[parent])
    out = []
    for k in range(3):
        mine = role == k
        offsets = np.concatenate([[0], np.cumsum(np.bincount(parent[mine], minlength=rows))]).astype(np.int32)
        out.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), unit.filter(pa.array(mine))), ""))
    return out


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    head, tail = F.substring_index(output, MIDDLE, 1), F.substring_index(output, MIDDLE, -1)
    first = lambda mark: F.substr(F.substring_index(head, mark, 1), F.lit(4))  # noqa: E731 - behind the first mark
    second = lambda mark: F.substring_index(head, mark, -1)
    return (F.when(form == "psm", F.concat(first(SUFFIX), tail, second(SUFFIX)))
            .when(form == "spm", F.concat(second(PREFIX), tail, first(PREFIX))).otherwise(output))
