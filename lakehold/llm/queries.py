"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakehold.llm import (
    bpe,
    conversation_repair,
    decontaminate,
    fill_in_middle,
    kneser_ney,
    quality_rules,
    resample,
    secret_scan,
    simhash,
    token_counts,
    toxicity,
    url_filter,
    warc,
)
from lakehold.llm.common import table
from lakehold.session import shared_dir


def op1_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The importance sample of all documents, with weights and sampling keys."""
    docs = table(spark, sf_dir, "documents")
    sampler, rows = resample.learn(docs, table(spark, sf_dir, "labels"))
    return rows.where(F.col("sample_key") >= F.lit(sampler.least)).withColumn("kept", F.lit(True))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages, read the archive back: one row per page."""
    path = shared_dir(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path)


def op3_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents under a model learnt outside the held-out fold."""
    return kneser_ney.score_held_out(table(spark, sf_dir, "documents"), order=3)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and the components of their links of at most four bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, max_bits=4)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and entropy spans of all documents."""
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt from the labelled rows outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("passages").alias("n_passages"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents with the 50k byte vocabulary, through a cache of this run."""
    return token_counts.count_tokens(
        table(spark, sf_dir, "documents"), shared_dir(spark, "token-cache"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, max_tokens=1024)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rule and learnt decision list over all documents."""
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded with the 49k word vocabulary."""
    return bpe.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of document and benchmark item, for all documents and items."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents transformed, and turned back from the output."""
    out = fill_in_middle.transform(table(spark, sf_dir, "documents"), seed=42, rate=50, spm_rate=80)
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
                      sha(fill_in_middle.restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    rows = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.summary(conversation_repair.repaired(rows))


#: The rules of the registered query.
URL_RULES = [
    url_filter.Rule("com", "/", "allow"),
    url_filter.Rule("example.com", "/en/", "block"),
    url_filter.Rule("www.example.com", "/en/", "allow"),
    url_filter.Rule("net", "/es/", "block"),
    url_filter.Rule("net", "/fr/", "block"),
]


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all urls of the pages."""
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES, default=url_filter.ALLOW)


QUERIES = {
    "op1_resample": op1_resample,
    "op2_warc": op2_warc,
    "op3_kneser_ney": op3_kneser_ney,
    "op4_simhash": op4_simhash,
    "op5_secret_scan": op5_secret_scan,
    "op6_toxicity": op6_toxicity,
    "op7_token_counts": op7_token_counts,
    "op8_quality_rules": op8_quality_rules,
    "op9_bpe": op9_bpe,
    "op10_decontaminate": op10_decontaminate,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_url_filter": op13_url_filter,
}

ORACLES = {
    # base 32 of the 160 bits: 32 digits of five bits, from 10-digit pieces of the hexadecimal digest
    "op2_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        d AS (SELECT page_id, strlen(body) AS payload_bytes, sha256(body) AS k, sha1(body) AS h,
                     min(page_id) OVER (PARTITION BY sha256(body)) AS lead FROM p)
        SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
               list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + ((('0x' || substr(h, 1 + 10 * (i // 8)::INT, 10))::BIGINT >> (35 - 5 * (i % 8))::INT) & 31)::INT, 1)),
                   'string_agg', '') AS payload_digest,
               CASE WHEN page_id = lead THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> lead THEN lead END AS refers_to
        FROM d""",
    "op11_fill_in_middle": r"""
        WITH t AS (SELECT doc_id, coalesce(text, '') AS s, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
        u AS (SELECT doc_id, s, regexp_extract_all(s, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
                     list_transform(range(0, 4), lambda k: ('0x' || substr(h, (1 + 8 * k)::INT, 8))::BIGINT) AS d FROM t),
        c AS (SELECT doc_id, s, units, len(units) AS n,
                     CASE WHEN s = '' OR contains(s, '<P>') OR contains(s, '<S>') OR contains(s, '<M>') OR d[3] % 100 >= 50 THEN 'plain'
                          WHEN d[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
                     least(d[1] % (len(units) + 1), d[2] % (len(units) + 1)) AS a, greatest(d[1] % (len(units) + 1), d[2] % (len(units) + 1)) AS b FROM u),
        p AS (SELECT doc_id, s, n, form, array_to_string(units[1:a], '') AS pre, array_to_string(units[a + 1:b], '') AS mid,
                     array_to_string(units[b + 1:], '') AS suf FROM c)
        SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END::BIGINT AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(mid) END::BIGINT AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN s WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                      ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(s) AS restored_sha256
        FROM p""",
    "op13_url_filter": """
        WITH r(rule_host, rule_path, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
             ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
        u AS (SELECT row_number() OVER () AS k, page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS s FROM pages),
        h AS (SELECT k, page_id, s, regexp_extract(s, '^[^/?#]*') AS raw FROM u),
        p AS (SELECT k, page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                     regexp_extract(substr(s, length(raw) + 1), '^[^?#]*') AS path FROM h)
        SELECT any_value(page_id) AS page_id, any_value(host) AS host, any_value(path) AS path,
               arg_max(rule_host || rule_path, length(rule_host) * 1000 + length(rule_path)) AS rule,
               coalesce(arg_max(verdict, length(rule_host) * 1000 + length(rule_path)), 'allow') AS verdict
        FROM p LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        GROUP BY k""",
    # checksum bit by bit; then one pass over the turns that holds the cheapest, ASCII-least repair for each state
    "op12_conversation_repair": r"""
        WITH RECURSIVE raw AS (SELECT conv_id, coalesce(conv_id::VARCHAR, ' ') AS k, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
        crc AS (SELECT *, xor(list_reduce(list_transform(string_split(name, ''), lambda x: ascii(x)::BIGINT),
                 lambda h, b: list_reduce(range(0, 8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, xor(h, b)),
                 4294967295::BIGINT), 4294967295) % 20 AS kind FROM raw),
        hurt AS (SELECT k, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                 CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                 unnest(range(0, CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM crc),
        put AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, text, copy) AS pos, left(role, 1) AS i,
                 row_number() OVER (PARTITION BY k, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
                 regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS tail FROM hurt),
        w AS (SELECT *, tail = '' AS blank, tail <> '' AND again AS dup, tail <> '' AND NOT again AND tail NOT IN ('.', '!', '?') AS cut,
                 lag(i) OVER (PARTITION BY k ORDER BY pos) AS before FROM put),
        counts AS (SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(dup) AS duplicate,
                 count_if(cut) AS truncated, count_if(before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM w GROUP BY k),
        dp AS (
            SELECT DISTINCT k, 0::BIGINT AS pos, {'c': 0, 'a': '', 'o': ''} AS s0, {'c': 999999, 'a': '', 'o': ''} AS s1,
                   {'c': 999999, 'a': '', 'o': ''} AS s2, {'c': 999999, 'a': '', 'o': ''} AS s3 FROM raw
            UNION ALL
            SELECT k, pos, {'c': s0.c + 3, 'a': s0.a || 'D', 'o': s0.o},
                   list_sort([{'c': s1.c + 3, 'a': s1.a || 'D', 'o': s1.o}, {'c': s0.c + late + CASE WHEN i = 's' THEN 0 ELSE 999999 END, 'a': s0.a || 'K', 'o': s0.o || line}])[1],
                   list_sort([{'c': u1.c + 3, 'a': u1.a || 'D', 'o': u1.o},
                       {'c': s0.c + late + not_u, 'a': s0.a || 'K', 'o': s0.o || line}, {'c': s0.c + late + 2, 'a': s0.a || 'R', 'o': s0.o || as_u},
                       {'c': s1.c + late + not_u, 'a': s1.a || 'K', 'o': s1.o || line}, {'c': s1.c + late + 2, 'a': s1.a || 'R', 'o': s1.o || as_u},
                       {'c': a1.c + late + not_u, 'a': a1.a || 'K', 'o': a1.o || line}, {'c': a1.c + late + 2, 'a': a1.a || 'R', 'o': a1.o || as_u}])[1],
                   list_sort([{'c': a1.c + 3, 'a': a1.a || 'D', 'o': a1.o}, {'c': u1.c + late + CASE WHEN i = 'a' THEN 0 ELSE 999999 END, 'a': u1.a || 'K', 'o': u1.o || line},
                       {'c': u1.c + late + 2, 'a': u1.a || 'R', 'o': u1.o || as_a}])[1]
            FROM (
                SELECT w.k, w.pos, i, s0, s1, u1, list_sort([s3, {'c': u1.c + 2, 'a': u1.a || 'I', 'o': u1.o || chr(10) || 'assistant:'}])[1] AS a1,
                       CASE WHEN blank OR dup THEN 999999 WHEN cut THEN 1 ELSE 0 END AS late, CASE WHEN i = 'u' THEN 0 ELSE 999999 END AS not_u,
                       chr(10) || role || ':' || text AS line, chr(10) || 'user:' || text AS as_u, chr(10) || 'assistant:' || text AS as_a
                FROM (SELECT k, pos, s0, s1, s3, list_sort([s2, {'c': s0.c + 2, 'a': s0.a || 'I', 'o': s0.o || chr(10) || 'user:'},
                          {'c': s1.c + 2, 'a': s1.a || 'I', 'o': s1.o || chr(10) || 'user:'}, {'c': s3.c + 2, 'a': s3.a || 'I', 'o': s3.o || chr(10) || 'user:'}])[1] AS u1 FROM dp) x
                JOIN w ON w.k = x.k AND w.pos = x.pos + 1)),
        done AS (SELECT k, list_sort([s0, s3, {'c': s2.c + 2, 'a': s2.a || 'I', 'o': s2.o || chr(10) || 'assistant:'},
                     {'c': s1.c + 4, 'a': s1.a || 'II', 'o': s1.o || chr(10) || 'user:' || chr(10) || 'assistant:'}])[1] AS best
                 FROM dp LEFT JOIN counts USING (k) WHERE pos = coalesce(n, 0))
        SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
               coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, best.c::BIGINT AS cost, best.a AS audit,
               sha256(substr(best.o, 2)) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id, k FROM raw) JOIN done USING (k) LEFT JOIN counts USING (k)""",
}
