import hashlib

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakehold.llm import bpe
from tests.llm.helpers import LONG, dirty

PATH = public_tokenizers.path("word_bpe_49k.json")
LIB = Tokenizer.from_file(PATH)
OWN = bpe.WordBpe(PATH)
WORDS = bpe.Encoded(OWN, 3)  # a tiny cache, so that generations turn over

TEXTS = ["", " ", "Hello <|endoftext|> world<|startoftext|>x", "it's I'LL 12345 ΣΑΣ ΟΔΟΣ", "İstanbul ß ﬁ 漢字 😀😀 \x85\xa0\x1c\x1f", "don't!!!???",
         "<|endoftext|>", "ǅ ſ K Å é", "a" * 3000, "\x00 b", LONG[:20_000]]


def test_same_as_the_library():
    for t in TEXTS:
        want = LIB.encode(t, add_special_tokens=False).ids
        assert OWN.encode(t) == want
        ids, out, n = bpe.encoded_text(WORDS, t)
        assert " ".join(ids).split() == list(map(str, want)) and n == len(want)
        assert " ".join(out) == OWN.decode(want) == LIB.decode(want, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text_as_the_library(t):
    assert OWN.encode(t) == LIB.encode(t, add_special_tokens=False).ids


def test_tables(spark):
    docs = dirty(spark)
    got = sorted(bpe.encode_digests(docs, PATH, with_ids=True).collect(), key=str)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = []
    for r in docs.collect():
        ids = LIB.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(LIB.decode(ids, skip_special_tokens=False)), ids))
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)
    full = bpe.encode_table(docs, PATH)
    assert full.count() == docs.count()
    assert all(LIB.decode(r.ids, skip_special_tokens=False) == r.decoded and len(r.ids) == r.n_tokens for r in full.collect())
    assert bpe.encode_digests(docs.limit(0), PATH).count() == 0
