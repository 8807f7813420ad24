"""Secret scans: fixed patterns plus sliding-window Shannon entropy, in DataFrame expressions only.

Base kinds are leftmost non-overlapping matches (``assign``, ``access``, ``hex``); the kind ``entropy`` adds
candidate strings with a window of high entropy for its character class. Entropy is kept by incremental
counts: moving the window by one raises the count of the entering character and lowers that of the leaving
one, and only those two terms change. The allow list suppresses candidates of words, numbers or UUIDs, and takes marked
pieces (``example``, a run of equal characters) out of others, whose rest is judged; base spans stay in any case. A span is
the whole candidate.

Cases: a null or empty text has no spans; positions are code points, end exclusive; repeated rows give
repeated results; texts are scanned whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The three base patterns and the least length of an assigned value.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # a run that starts with AKIA, 20 characters at least
HEX = r"[0-9a-f]{24,}"  # a whole run, 24 characters at least
MIN_ASSIGN = 6  # characters of the value; a shorter match is dropped, but has used up its text
KINDS = ["assign", "access", "hex", "entropy"]

# Candidate strings, window and thresholds (bits) per character class.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
HEX_ALPHABET = "0123456789abcdef"
BASE64_ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"
HEX_BITS, BASE64_BITS = 3.0, 3.6
# Allow list. Marked pieces and runs are cut out of a candidate, and what is left on either side is judged by
# itself; a rest that is made of words, numbers or a UUID alone is no credential.
# No pattern repeats a group or begins at every place of a piece: candidates may be very long.
MARKED = (r"(?i)(?<![A-Za-z0-9])[A-Za-z0-9]*(?:example|sample|placeholder|changeme|dummy|your[-_]?(?:api|key|token))[A-Za-z0-9]*"
          r"|0123456789|abcdefghij|(.)\1{7,}")
LETTERS = r"^[-_/+=A-Za-z]+$"  # words, paths and identifiers, unless the case changes as in no identifier
MIXED = r"[A-Z][a-z][A-Z](?![a-z])|[A-Z][a-z][A-Z][a-z][A-Z]"
NUMBERS = r"^[-_/+=0-9]+$"  # numbers, dates and telephone numbers
UUID = r"(?i)^[-_/+=]*[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}[-_/+=]*$"


def located(text: Column, pattern: str) -> Column:
    """array<struct<start, end, s>> of the leftmost non-overlapping matches, in code points.

    ``split`` gives the pieces between the same matches, so their lengths add up to the positions.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(hits, F.slice(gaps, 1, F.size(hits)), lambda s, g: F.struct(F.length(g).alias("gap"), s.alias("s")))
    none = F.expr("cast(array() as array<struct<start:int,end:int,s:string>>)")
    walk = F.aggregate(
        pairs, none,
        lambda acc, p: F.concat(acc, F.array(F.struct(
            (F.coalesce(F.try_element_at(acc, F.lit(-1))["end"], F.lit(0)) + p["gap"]).alias("start"),
            (F.coalesce(F.try_element_at(acc, F.lit(-1))["end"], F.lit(0)) + p["gap"] + F.length(p["s"])).alias("end"),
            p["s"].alias("s")))))
    return F.when(text.rlike(pattern), walk).otherwise(none)


def _bits(count: Column) -> Column:
    """c * log2(c), 0 for c = 0."""
    return F.when(count > 0, count * F.log2(count)).otherwise(F.lit(0.0))


def max_window_entropy(s: Column, alphabet: str, window: int = WINDOW) -> Column:
    """Largest Shannon entropy (bits) of ``window`` neighbouring characters of ``s``; 0 if it is shorter.

    The state is (the last characters, sum of c*log2 c, least sum): the counts of the character that enters and
    of the one that leaves are taken from the window, so a step costs a window's length whatever the class.
    Characters outside the class count as one.
    """
    inside = "".join(f"\\{c}" if c in "-/+_=" else c for c in alphabet)
    chars = F.split(F.regexp_replace(s, f"[^{inside}]", "\x01"), "")
    zero = F.struct(F.lit("").alias("w"), F.lit(0.0).alias("sum"), F.lit(float("inf")).alias("least"))
    count = lambda w, c: (F.length(w) - F.length(F.replace(w, c, F.lit("")))).cast("double")

    def step(acc, come):
        full, gone = F.length(acc["w"]) == window, F.substring(acc["w"], 1, 1)
        had = count(acc["w"], come)
        left = count(acc["w"], gone) + F.when(gone == come, 1.0).otherwise(0.0)
        total = acc["sum"] + _bits(had + 1) - _bits(had) - F.when(full, _bits(left) - _bits(left - 1)).otherwise(F.lit(0.0))
        w = F.concat(F.when(full, F.substring(acc["w"], 2, window)).otherwise(acc["w"]), come)
        return F.struct(w.alias("w"), total.alias("sum"),
                        F.when(F.length(w) == window, F.least(acc["least"], total)).otherwise(acc["least"]).alias("least"))

    # H = log2(W) - sum(c log2 c) / W, so the largest entropy is the least sum
    return F.aggregate(chars, zero, step,
                       lambda acc: F.when(acc["least"] < float("inf"), F.log2(F.lit(float(window))) - acc["least"] / window).otherwise(F.lit(0.0)))


def find_spans(df: DataFrame, text_col: str, out: str = "found", hex_bits: float = HEX_BITS,
               base64_bits: float = BASE64_BITS) -> DataFrame:
    """Add ``out``: array<struct<start, rank, end>> of all spans by start, then kind (rank in ``KINDS``)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    spans = lambda found, rank, keep: F.transform(F.filter(found, keep), lambda x: F.struct(
        x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end")))

    def random(r):
        plain = r.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")
        allowed = (r.rlike(LETTERS) & ~r.rlike(MIXED)) | r.rlike(NUMBERS) | r.rlike(UUID)
        bits = F.when(plain, max_window_entropy(F.lower(r), HEX_ALPHABET) >= hex_bits).otherwise(
            max_window_entropy(r, BASE64_ALPHABET) >= base64_bits)
        return (F.length(r) >= WINDOW) & ~allowed & bits

    def secret(x):
        return F.exists(F.split(F.regexp_replace(x["s"], MARKED, " "), " "), random)

    return df.withColumn(out, F.array_sort(F.concat(
        spans(located(text, ASSIGN), 0, lambda x: F.length(F.regexp_extract(x["s"], ASSIGN, 1)) >= MIN_ASSIGN),
        spans(located(text, ACCESS), 1, lambda x: F.lit(True)),
        spans(located(text, HEX), 2, lambda x: F.lit(True)),
        spans(located(text, CANDIDATE), 3, secret))))


def joined_spans(found: Column, ranks: list[int]) -> Column:
    """``kind:start:end`` of the spans of the given ranks, comma-joined in their order."""
    kind = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(
        F.filter(found, lambda x: x["rank"].isin(ranks)),
        lambda x: F.concat_ws(":", F.element_at(kind, x["rank"] + 1), x["start"], x["end"])), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, count per kind, ``base_sha256`` and ``spans`` (see the module's cases)."""
    found = find_spans(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text")
    count = lambda r: F.size(F.filter("found", lambda x: x["rank"] == r)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), count(3).alias("n_entropy"),
        F.sha2(F.encode(joined_spans(F.col("found"), [0, 1, 2]), "UTF-8"), 256).alias("base_sha256"),
        joined_spans(F.col("found"), [0, 1, 2, 3]).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with every found span of the text replaced by ``mark``, and the new length in ``length_col`` (if
    there is one); rows without a span are unchanged. Spans that overlap are replaced together."""
    from lakehold.llm.common import fresh

    f, text = fresh(docs, "found"), F.col(text_col)
    found = F.col(f)
    state = F.aggregate(  # spans by start: cut what lies between them, merge those that overlap
        found, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda acc, x: F.struct(
            F.when(x["start"] >= acc["at"], F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["start"] - acc["at"]), F.lit(mark)))
            .otherwise(acc["out"]).alias("out"), F.greatest(acc["at"], x["end"]).alias("at")),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    clean = F.when(F.size(found) > 0, state).otherwise(text)
    out = find_spans(docs, text_col, f).withColumn(text_col, clean)
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        out = out.withColumn(length_col, F.when(F.size(found) > 0, F.length(text_col).cast(kind)).otherwise(F.col(length_col)))
    return out.select(*docs.columns)
