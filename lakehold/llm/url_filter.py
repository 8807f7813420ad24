"""URL filter: a trie over reversed host labels and path segments, longest match wins.

A rule has a host, a path and a verdict (``allow`` or ``block``). It fits its host and all subdomains, if the
url's path starts with the rule's. Of several that fit, the longest host wins, then the longest path; ``block``
wins over ``allow`` for the same host and path. Urls that no rule fits get the default verdict.

Two ways give the same rows. Rules up to ``MAX_RULES`` and ``MAX_RULE_BYTES`` (both measured) are compiled into a
trie that goes to the workers; a url then costs a walk over its labels and segments, no deeper than the rules. Rules
beyond that stay a table: distinct urls are joined on host suffix and complete path segments, no more of them than
the deepest rule has, and the verdicts are joined back, so that repeated urls and hot hosts are joined once.

Defined results: the host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower
case, port and user name included; the path goes on up to ``?``, ``#`` or the end. A null url, or one without
``://``, has an empty host and an empty path. An empty path starts with no rule's path but an empty one. An empty
rule host fits every url. Repeated rows and ids all stay; only the id and the four result columns come out, so
other columns of the table may have any name. An empty table gives no rows, no rules give the default verdict.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
MAX_RULES, MAX_RULE_BYTES = 200_000, 16 << 20  # of a trie that goes to every worker
RULE_SCHEMA = "host string, path string, verdict string"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The two parts that rules look at; both empty for a null url or one without ``://``."""
    at = F.locate("://", url)
    rest = F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(raw) + 1), "^[^?#]*", 0)
    return F.translate(raw, _UPPER, _LOWER), path


class UrlTrie:
    """Host labels from the last to the first, then complete path segments; at a node of segments, the rules'
    last, possibly unfinished segments in order of falling length."""

    def __init__(self, rules: Sequence[Rule]):
        self.root: list = [{}, None]  # labels below, segments' root
        self.labels = self.segments = 0
        for host, path, verdict in rules:
            host = host.translate(str.maketrans(_UPPER, _LOWER))
            node = self.root
            names = host.split(".")[::-1] if host else []
            for name in names:
                node = node[0].setdefault(name, [{}, None])
            if node[1] is None:
                node[1] = [{}, {}]  # segments below, rules that end here
            at = node[1]
            *whole, last = path.split("/")
            for seg in whole:
                at = at[0].setdefault(seg, [{}, {}])
            if at[1].get(last, (None, ALLOW))[1] != BLOCK:
                at[1][last] = (host + path, verdict)
            self.labels, self.segments = max(self.labels, len(names)), max(self.segments, len(whole))
        self._order(self.root)

    def _order(self, top: list) -> None:
        todo = [top]
        while todo:
            node = todo.pop()
            if node is None:
                continue
            if isinstance(node[1], dict):
                node[1] = sorted(node[1].items(), key=lambda e: -len(e[0]))
            else:
                todo.append(node[1])
            todo.extend(node[0].values())

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, verdict) of the longest match."""
        node, found = self.root, []
        if node[1] is not None:
            found.append(node[1])
        if host:
            for name in reversed(host.rsplit(".", self.labels)):
                node = node[0].get(name)
                if node is None:
                    break
                if node[1] is not None:
                    found.append(node[1])
        if not found:
            return None
        segments = path.split("/", self.segments)
        last = len(segments) - 1
        for at in reversed(found):
            best = None
            for k, seg in enumerate(segments):
                for begin, rule in at[1]:
                    if seg.startswith(begin):
                        best = rule
                        break
                # only a segment with a slash behind it is a complete one
                at = at[0].get(seg) if k < last else None
                if at is None:
                    break
            if best is not None:
                return best
        return None


def judge(pages: DataFrame, rules: Sequence[Rule] | DataFrame, default: str = ALLOW, id_col: str = "page_id",
          url_col: str = "url", max_rules: int = MAX_RULES, max_rule_bytes: int = MAX_RULE_BYTES) -> DataFrame:
    """Per row: the id, ``host, path, rule, verdict``; ``rule`` is null where none fits."""
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(F.col(id_col), host.alias("__host"), path.alias("__path"))
    if isinstance(rules, DataFrame):
        rules = _cleaned(rules)
        size = rules.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("host") + F.octet_length("path")).alias("b")).first()
        small = size["n"] <= max_rules and (size["b"] or 0) <= max_rule_bytes
        rules = [Rule(*r) for r in rules.collect()] if small else rules
    else:
        small = len(rules) <= max_rules and sum(len((r[0] + r[1]).encode()) for r in rules) <= max_rule_bytes
        if not small:
            rules = _cleaned(pages.sparkSession.createDataFrame([tuple(r) for r in rules], RULE_SCHEMA))
    return _by_trie(urls, UrlTrie(rules), default, id_col) if small else _by_join(urls, rules, default, id_col)


def _cleaned(rules: DataFrame) -> DataFrame:
    """Host in lower case, nulls as empty texts, ``allow`` unless ``block``."""
    return rules.select(F.translate(F.coalesce("host", F.lit("")), _UPPER, _LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"),
                        F.when(F.col("verdict") == BLOCK, BLOCK).otherwise(ALLOW).alias("verdict"))


def _by_trie(urls: DataFrame, trie: UrlTrie, default: str, id_col: str) -> DataFrame:
    known = urls.sparkSession.sparkContext.broadcast(trie)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match, nothing = known.value.match, (None, default)
        for b in batches:
            got = [match(h.as_py(), p.as_py()) or nothing for h, p in zip(b.column(1), b.column(2), strict=True)]
            yield pa.record_batch([*b.columns, pa.array([r for r, _ in got], pa.string()), pa.array([v for _, v in got], pa.string())],
                                  names=[id_col, "host", "path", "rule", "verdict"])

    kind = urls.schema[id_col].dataType.simpleString()
    return urls.mapInArrow(look_up, f"`{id_col}` {kind}, host string, path string, rule string, verdict string")


def _by_join(urls: DataFrame, rules: DataFrame, default: str, id_col: str) -> DataFrame:
    # a rule: its host, its complete segments, the rest of its path
    whole = F.regexp_extract("path", "^(?s:.*)/", 0)
    r = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict")).select(  # block > allow
        F.col("host").alias("r_host"), F.col("path").alias("r_path"), "verdict", whole.alias("r_whole"),
        F.when(F.col("host") == "", 0).otherwise(F.size(F.split("host", "\\."))).alias("labels"), F.regexp_count("path", F.lit("/")).alias("segments"))
    deep = r.agg(F.coalesce(F.max("labels"), F.lit(0)).alias("labels"), F.coalesce(F.max("segments"), F.lit(0)).alias("segments")).first()
    per_url = urls.select("__host", "__path").distinct()
    # suffixes of the host and complete beginnings of the path, as deep as the rules go
    names = F.split("__host", "\\.")
    labels = F.when(F.col("__host") == "", 0).otherwise(F.least(F.size(names), F.lit(deep["labels"])))
    suffix = lambda k: F.array_join(F.slice(names, F.size(names) - k + 1, k), ".")
    by_host = per_url.withColumn("r_host", F.explode(F.transform(F.sequence(F.lit(0), labels), lambda k: F.when(k == 0, "").otherwise(suffix(k)))))
    by_host = by_host.join(r.select("r_host").distinct(), "r_host", "left_semi")
    parts = F.split("__path", "/")
    slashes = F.least(F.size(parts) - 1, F.lit(deep["segments"]))
    begin = lambda k: F.concat(F.array_join(F.slice(parts, 1, k), "/"), F.lit("/"))
    keys = by_host.withColumn("r_whole", F.explode(F.transform(F.sequence(F.lit(0), slashes), lambda k: F.when(k == 0, "").otherwise(begin(k)))))
    fits = keys.join(r, ["r_host", "r_whole"]).where(F.startswith("__path", "r_path"))
    best = fits.groupBy("__host", "__path").agg(F.max_by(F.struct(F.concat("r_host", "r_path").alias("rule"), "verdict"),
                                                         F.struct("labels", F.length("r_path"))).alias("best"))
    return urls.join(best, ["__host", "__path"], "left").select(
        id_col, F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
