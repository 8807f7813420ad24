"""Small dirty tables: nulls, empty and long texts, repeated rows, clashing extra columns."""

LONG = " ".join(f"word{k % 977} and{k}" for k in range(30_000))
DIRTY = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today"),
    (2, None), (3, ""), (4, " \t\n "), (None, "a text without any id at all in this table"), (None, None),
    (5, "Same words in a row"), (5, "Same words in a row"), (6, "Same words in a row"),
    (7, LONG), (8, "ÀÉ ß 漢字 😀 \x85\xa0 x"), (9, "one"),
]
EXTRA = ["fp", "key", "digest", "score", "row_no", "row_key", "text_key", "log_weight", "sample_key", "found", "size", "h", "at", "kept", "id", "good"]
DOCS_SCHEMA = "doc_id long, text string, " + ", ".join(f"{c} string" for c in EXTRA)


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, *(["x"] * len(EXTRA))) for i, t in rows], DOCS_SCHEMA)


def dirty(spark):
    return docs_of(spark, DIRTY)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def brute_words(text):
    import re

    return re.findall("[^\x20\x09-\x0d]+", text or "")
