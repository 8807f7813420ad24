from lakehold.llm import decontaminate as dc
from tests.llm.helpers import EXTRA, dirty, docs_of

ITEM = "If Tom has 12 apples and gives 5 apples to Mary then how many apples does Tom have left after 3 km?"


def items(spark, rows):
    return spark.createDataFrame([(i, t, 1) for i, t in rows], "item_id long, text string, size int")


def pairs(docs, bench, **kw):
    return {(r.doc_id, r.item_id): r for r in dc.contaminated(docs, bench, **kw).collect()}


def test_verbatim_and_reparameterised(spark):
    bench = items(spark, [(1, ITEM), (2, None), (3, "too short"), (4, ""), (9, ITEM)])
    other = ITEM.replace("Tom", "Jim").replace("Mary", "Anna").replace("12", "30").replace(" 5 ", " 7 ").replace("3 km", "4 miles")
    docs = docs_of(spark, [
        (1, "Intro text. " + ITEM + " And more."), (2, "Intro. " + other), (3, ITEM.lower()), (4, ITEM.upper()),
        (5, other.replace("does Jim", "does Bob")),  # one name stands for two: not the question
        (6, "word " * 2000 + ITEM + " word" * 2000), (7, "If Tom has 12 apples that is fine with all of us and nobody minds"), (8, None), (9, ""),
    ])
    got = pairs(docs, bench)
    assert set(got) == {(k, 1) for k in (1, 2, 3, 4, 6)}
    assert got[1, 1].changed_slots == 0 and got[2, 1].changed_slots == 6  # Tom, 12, 5, Mary, 3, km
    assert got[1, 1].covered_tokens == got[1, 1].item_tokens


def test_inconsistent_numbers_are_refused(spark):
    item = "take 40 grams of flour and mix 40 grams of sugar into it until the dough is smooth and firm"
    docs = docs_of(spark, [(1, item.replace("40", "55")), (2, item.replace("40", "55", 1).replace("40", "66"))])
    assert set(pairs(docs, items(spark, [(1, item)]))) == {(1, 1)}


def test_one_edit_does_not_hide_a_long_copy(spark):
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)]
    words[10] = words[50] = "5"
    words[20] = words[40] = "Tom"
    edited = lambda **new: " ".join(new.get(f"w{k}", w) for k, w in enumerate(words))
    docs = docs_of(spark, [
        (1, edited(w50="6")), (2, edited(w40="Tim")), (3, edited(w20="Tim", w50="6")),
        (4, edited(w10="6", w50="7", w20="Tim", w40="Tim")),  # the name is changed throughout, the number is mixed up
        (5, " ".join(words[:12] + ["6" if w == "5" else w for w in words[44:52]])),  # too little is copied beside the edit
    ])
    got = pairs(docs, items(spark, [(1, " ".join(words))]))
    assert {(k, got[k, 1].covered_tokens, got[k, 1].changed_slots) for k, _ in got} == {(1, 59, 0), (2, 59, 0), (3, 58, 0), (4, 58, 1)}


def test_verbatim_copies_of_numbers_are_found(spark):
    bench = items(spark, [
        (1, "Solve 3 x 4 + 5 x 6 = 42 and 7 x 8 = 56"), (2, "Compute 17 * 23"), (3, "Find the sum: 3, 7, 12, 19, 28, 41, 55, 70"),
        (4, "3 km 4 km 5 km 6 km 7 km"),
    ])
    texts = [r.text for r in bench.orderBy("item_id").collect()]
    docs = docs_of(spark, [(k + 1, f"Some text before. {t} And more.") for k, t in enumerate(texts)] + [
        (11, texts[0].replace("42", "43")), (12, "Compute 17 * 24"), (13, texts[2].replace("19", "20")), (14, texts[3].replace("5", "8")),
    ])
    got = pairs(docs, bench)
    assert set(got) == {(k, k) for k in (1, 2, 3, 4)}
    assert all(r.changed_slots == 0 and r.covered_tokens == r.item_tokens for r in got.values())


def test_partial_and_short_items(spark):
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)]
    bench = items(spark, [(1, " ".join(words)), (2, "alpha beta gamma delta epsilon")])
    docs = docs_of(spark, [(1, " ".join(words[:13])), (2, " ".join(words[:12])), (3, "so alpha beta gamma delta epsilon it is"), (4, "alpha beta gamma delta")])
    assert set(pairs(docs, bench)) == {(1, 1), (3, 2)}


def brute_windows(text, size=dc.WINDOW):
    t = dc.template([text])
    out = set()
    for names in (True, False):
        h, slot = t.typed(names)
        for i in range(h.size - size + 1):
            if (~slot[i:i + size]).sum() >= min(size, dc.MIN_LITERALS):
                out.add((i, tuple(h[i:i + size].tolist())))
    return out


def test_windows_over_many_texts_at_once():
    texts = [ITEM, None, "", "One. Two three 4 km of Road", ITEM + " " + ITEM]
    many = list(dc.windows_of(texts, [dc.WINDOW]))
    for k, t in enumerate(texts):
        assert sorted(w[1:] for w in many if w[0] == k) == sorted(w[1:] for w in dc.windows_of([t], [dc.WINDOW]))
        assert len({(w[3], w[1]) for w in many if w[0] == k}) == len(brute_windows(t))


def test_bit_table_holds_every_window(spark):
    import numpy as np

    got = dc.item_windows(items(spark, [(1, ITEM), (2, "a b c d e f g h i j k")]))
    bits = dc.bit_table(got)
    p = np.array([r.h for r in got.collect()], np.int64).view(np.uint64) >> np.uint64(64 - dc.BITS_LOG2)
    assert p.size and all(bits[int(x) >> 3] >> (int(x) & 7) & 1 for x in p)


def test_clean_drops_only_contaminated_rows(spark):
    docs = dirty(spark).unionByName(docs_of(spark, [(50, ITEM), (50, ITEM), (None, "x " + ITEM)]))
    out = dc.clean(docs, items(spark, [(1, ITEM)]))
    assert out.columns == ["doc_id", "text", *EXTRA]
    assert out.count() == dirty(spark).count()
    assert dc.contaminated(docs, items(spark, [(1, ITEM)])).count() == 3
    assert dc.clean(docs, items(spark, [])).count() == docs.count()
    assert dc.contaminated(docs.limit(0), items(spark, [(1, ITEM)])).count() == 0
    assert dc.contaminated(docs, items(spark, [(1, None), (2, "")])).count() == 0


def test_table_equals_plain_word_windows(spark):
    """Every passage of the synthetic benchmark that shares eight words in a row and half of the item."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    index = {}
    for r in bench.collect():
        w = r.text.lower().split()
        for k in range(len(w) - 7):
            index.setdefault(tuple(w[k:k + 8]), set()).add(r.item_id)
    want = set()
    for r in docs.collect():
        w = r.text.lower().split()
        want |= {(r.doc_id, i) for k in range(len(w) - 7) for i in index.get(tuple(w[k:k + 8]), ())}
    assert set(pairs(docs, bench)) == want
