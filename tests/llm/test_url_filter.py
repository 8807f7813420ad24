import random

from hypothesis import given, settings
from hypothesis import strategies as st

from lakehold.llm import queries, url_filter
from lakehold.llm.url_filter import Rule

RULES = queries.URL_RULES
URLS = [
    (1, "http://example.com/en/x", "block"), (2, "https://www.EXAMPLE.com/en/x", "allow"), (3, "http://a.www.example.com/en/", "allow"),
    (4, "http://shop.example.com/en/", "block"), (5, "http://example.com/english", "allow"), (6, "http://example.com/en", "allow"),
    (7, "http://example.com", None), (8, "http://x.net/es/1?q=/fr/", "block"), (9, "http://x.net/de/", None), (10, "http://notexample.com/en/", "allow"),
    (11, None, None), (12, "", None), (13, "no-scheme.com/en/", None), (14, "a://net/fr/#", "block"), (15, "http://com:80/", None),
    (16, "http://example.com?x=://y.net/es/", None), (17, "http:///en/", None), (18, "http://.com/", "allow"), (19, "http://com./", None),
    (1, "http://example.com/en/x", "block"), (None, "http://é.net/es/\n", "block"), (20, "http://" + "a." * 30_000 + "com/" + "b/" * 30_000, "allow"),
]


def brute(url, rules):
    """Every rule against the whole url."""
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([k for k in map(rest.find, "/?#") if k >= 0], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    rest = rest[cut:]
    path = rest[:min([k for k in map(rest.find, "?#") if k >= 0], default=len(rest))]
    best = None
    for r in rules:
        if (not r.host or host == r.host or host.endswith("." + r.host)) and path.startswith(r.path):
            key = (len(r.host.split(".")) if r.host else 0, len(r.path), r.verdict == "block")
            best = max(best, (key, r)) if best else (key, r)
    return host, path, best[1].host + best[1].path if best else None, best[1].verdict if best else "allow"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, "h", "p", "r", "v") for i, u in rows], "page_id long, url string, host string, path string, rule string, verdict string")


def test_both_ways_equal_brute_force(spark):
    df = pages(spark, [u[:2] for u in URLS])
    want = sorted(((i, *brute(u, RULES)) for i, u, _ in URLS), key=str)
    for most in (url_filter.MAX_RULES, 0):
        for rules in (RULES, spark.createDataFrame(RULES, url_filter.RULE_SCHEMA)):
            got = url_filter.judge(df, rules, max_rules=most).collect()
            assert sorted(map(tuple, got), key=str) == want
    verdicts = {i: v for i, _, v in URLS}
    assert all(r[3] is None if verdicts[r[0]] is None else r[4] == verdicts[r[0]] for r in want)


def test_no_rows_no_rules_and_blocking_by_default(spark):
    df = pages(spark, [u[:2] for u in URLS])
    assert url_filter.judge(df.limit(0), RULES).count() == 0
    for most in (10, -1):
        got = url_filter.judge(df, [], default="block", max_rules=most)
        assert got.where("rule is null and verdict = 'block'").count() == len(URLS)


def test_equal_rules_block(spark):
    rules = [Rule("a.com", "/x", "block"), Rule("a.com", "/x", "allow"), Rule("", "/", "allow")]
    for order in (rules, rules[::-1]):
        for most in (10, 0):
            got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(pages(spark, [(1, "h://a.com/xyz"), (2, "h://b/")]), order, max_rules=most).collect()}
            assert got == {1: ("a.com/x", "block"), 2: ("/", "allow")}


LABEL = st.sampled_from(["a", "b", "c", "", "www"])
HOST = st.lists(LABEL, min_size=0, max_size=4).map(".".join)
PATH = st.lists(st.sampled_from(["a", "b", "ab", ""]), min_size=0, max_size=4).map(lambda p: "/" + "/".join(p) if p else "")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(HOST, PATH, st.sampled_from(["allow", "block"])), max_size=8), HOST, PATH)
def test_trie_equals_brute_force(rules, host, path):
    rules = [Rule(*r) for r in rules]
    _, _, rule, verdict = brute(f"x://{host}{path}", rules)
    assert url_filter.UrlTrie(rules).match(host, path) == (None if rule is None else (rule, verdict))


def test_join_equals_trie_on_many_rules(spark):
    rnd = random.Random(5)
    part = lambda n: [rnd.choice("abcd") for _ in range(rnd.randint(1, n))]
    rules = [Rule(".".join(part(4)), "/" + "/".join(part(3)), rnd.choice(["allow", "block"])) for _ in range(300)]
    df = pages(spark, [(k, f"http://{'.'.join(part(6))}/{'/'.join(part(5))}") for k in range(1000)] + [(k, "http://a.b.c/a/b") for k in range(1000, 2000)])
    rows = lambda most: sorted(map(tuple, url_filter.judge(df, rules, max_rules=most).collect()))
    assert rows(10_000) == rows(0)
