"""The registered queries of the corpus operators and their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martline.llm import (balltree, chat, decontaminate, html, merkle, mixing, packing, quality, repair, runindex, simhash,
                          tokens, toxicity)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.top_k(_table(spark, sf_dir, "embeddings"))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_format(_table(spark, sf_dir, "conversations"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(_table(spark, sf_dir, "pages"))


def op8_run_length_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runindex.repeat_report(_table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(_table(spark, sf_dir, "conversations"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(_table(spark, sf_dir, "documents"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_simhash_dedup": op1_simhash_dedup,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_exact_topk": op3_exact_topk,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_mix_sources": op5_mix_sources,
    "op6_decontaminate": op6_decontaminate,
    "op7_html_extraction": op7_html_extraction,
    "op8_run_length_dedup": op8_run_length_dedup,
    "op9_token_counts": op9_token_counts,
    "op10_toxicity": op10_toxicity,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_packing": op13_packing,
}

#: CRC-32 (unsigned, reflected, polynomial 0xEDB88320) of an ASCII text ``s``, bit by bit.
_CRC32 = """xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, length(s) + 1), lambda i: ord(s[i])::BIGINT),
                lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""

ORACLES: dict[str, str] = {
    "op3_exact_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.vec_id AS query_id, b.vec_id,
                   CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
            WHERE a.vec_id % 50 = 0)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id, score
        FROM s QUALIFY rank <= 5""",
    "op4_chat_formatting": """
        WITH t AS (
            SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
        c AS (
            SELECT conv_id, list({'r': role, 't': text} ORDER BY turn, role, text) AS turns, count(*) AS n_turns
            FROM t GROUP BY conv_id),
        k AS (
            SELECT * FROM c a
            WHERE NOT EXISTS (
                SELECT 1 FROM c b
                WHERE b.n_turns >= a.n_turns AND list_slice(b.turns, 1, a.n_turns) = a.turns
                  AND (b.n_turns > a.n_turns OR b.conv_id < a.conv_id)))
        SELECT k.conv_id, CAST(0 AS INTEGER) AS part, k.n_turns,
               (SELECT count(*) - 1 FROM c b
                WHERE b.n_turns <= k.n_turns AND list_slice(k.turns, 1, b.n_turns) = b.turns) AS n_collapsed,
               array_to_string(list_transform(k.turns, lambda x: '<|im_start|>' || replace(x.r, '<|', '< |') || chr(10)
                                              || replace(x.t, '<|', '< |') || '<|im_end|>' || chr(10)), '') AS text
        FROM k""",
    # every window of a document against the seeds of every item; the comparison counts changed tokens
    "op6_decontaminate": r"""
        WITH d AS (
            SELECT DISTINCT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS tokens FROM documents),
        b AS (
            SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS tokens FROM benchmark),
        i AS (SELECT item_id, tokens, least(len(tokens), 13) AS width FROM b WHERE len(tokens) > 0),
        iw AS (
            SELECT item_id, width, unnest(list_transform(range(1, len(tokens) - width + 2),
                                                         lambda p: tokens[p:p + width - 1])) AS w FROM i),
        dw AS (
            SELECT doc_id, unnest(range(0, len(tokens))) AS pos, tokens FROM d),
        dx AS (
            SELECT doc_id, pos, width, tokens[pos + 1:pos + width] AS w
            FROM dw, (SELECT DISTINCT width FROM i) WHERE pos + width <= len(tokens)),
        m AS (
            SELECT unnest([0, 1, 2]) AS g),
        ik AS (
            SELECT DISTINCT item_id, width, w, g,
                   CASE WHEN width = 13 THEN list_filter(w, lambda x, n: (n - 1) % 3 = g) ELSE w END AS seed
            FROM iw, m WHERE width = 13 OR g = 0),
        dk AS (
            SELECT doc_id, pos, width, w, g,
                   CASE WHEN width = 13 THEN list_filter(w, lambda x, n: (n - 1) % 3 = g) ELSE w END AS seed
            FROM dx, m WHERE width = 13 OR g = 0),
        hits AS (
            SELECT dk.doc_id, ik.item_id, dk.pos, dk.width,
                   len(list_filter(list_zip(dk.w, ik.w), lambda p: p[1] <> p[2])) AS changed
            FROM dk JOIN ik ON dk.width = ik.width AND dk.g = ik.g AND dk.seed = ik.seed)
        SELECT doc_id, item_id, count(DISTINCT pos) AS n_windows, CAST(min(pos) AS INTEGER) AS first_token,
               CAST(max(pos + width) - 1 AS INTEGER) AS last_token, CAST(min(changed) AS INTEGER) AS least_changed
        FROM hits WHERE changed <= CASE WHEN width = 13 THEN 2 ELSE 0 END
        GROUP BY doc_id, item_id""",
    # all strings of 400 bytes by their digest; runs of covered bytes by gaps between starts
    "op8_run_length_dedup": """
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS t FROM documents),
        w AS (
            SELECT r, p, md5(array_slice(t, p + 1, p + 400)) AS m
            FROM (SELECT r, t, unnest(range(0, octet_length(t) - 399)) AS p FROM d WHERE octet_length(t) >= 400)),
        s AS (SELECT r, p FROM w WHERE m IN (SELECT m FROM w GROUP BY m HAVING count(*) > 1)),
        g AS (
            SELECT r, p, CASE WHEN p - lag(p) OVER (PARTITION BY r ORDER BY p) <= 400 THEN 0 ELSE 1 END AS new FROM s),
        i AS (SELECT r, p, sum(new) OVER (PARTITION BY r ORDER BY p) AS run FROM g),
        c AS (SELECT r, min(p) AS a, max(p) + 400 AS b FROM i GROUP BY r, run),
        k AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS done FROM c),
        x AS (
            SELECT k.r, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS done,
                   string_agg(CASE WHEN a > k.done THEN hex(array_slice(t, k.done + 1, a)) ELSE '' END, '' ORDER BY a) AS kept
            FROM k JOIN d ON k.r = d.r GROUP BY k.r)
        SELECT doc_id, CAST(octet_length(t) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
               coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(kept, '') || CASE WHEN octet_length(t) > coalesce(done, 0)
                                                       THEN hex(array_slice(t, coalesce(done, 0) + 1, octet_length(t)))
                                                       ELSE '' END)) AS kept_sha256,
               -- whole characters of what remains: a cut may have split some
               decode(unhex(array_to_string(list_filter(regexp_extract_all(
                   coalesce(kept, '') || CASE WHEN octet_length(t) > coalesce(done, 0)
                                              THEN hex(array_slice(t, coalesce(done, 0) + 1, octet_length(t))) ELSE '' END,
                   '[0-7].|(?:C[2-9A-F]|D.)[89AB].|E0[AB].[89AB].|(?:E[1-9ABCEF](?:[89AB].){2})|ED[89].[89AB].|'
                   || 'F0[9AB].(?:[89AB].){2}|F[1-3](?:[89AB].){3}|F48.(?:[89AB].){2}|..'),
                   lambda c: length(c) > 2 OR c < '80'), ''))) AS text
        FROM d LEFT JOIN x ON d.r = x.r""",
    # levels by grouped recursion, then every leaf up its language's tree and up the tree of subroots
    "op12_merkle_manifest": """
        WITH RECURSIVE d AS (
            SELECT row_number() OVER () AS r, doc_id, lang, text, CAST(doc_id AS VARCHAR) AS s,
                   concat_ws('', coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'),
                             coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
                             coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head
            FROM documents),
        l AS (
            SELECT r, doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                                          'abcdefghijklmnopqrstuvwxyz'), '-')) AS lowered,
                   coalesce(CRC32_OF_S % 3 = 0, false) AS tampered FROM d),
        p AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS idx,
                   count(*) OVER (PARTITION BY lang) AS width FROM l),
        n(lang, level, idx, width, h, kids) AS (
            SELECT lang, 0, idx, width, leaf, CAST([] AS VARCHAR[]) FROM p
            UNION ALL
            SELECT lang, max(level) + 1, idx // 8, (max(width) + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)),
                   list(h ORDER BY idx) FROM n WHERE width > 1 GROUP BY lang, idx // 8),
        s AS (
            SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS width
            FROM n WHERE width = 1),
        u(level, idx, width, h, kids) AS (
            SELECT 0, idx, width, subroot, CAST([] AS VARCHAR[]) FROM s
            UNION ALL
            SELECT max(level) + 1, idx // 8, (max(width) + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)),
                   list(h ORDER BY idx) FROM u WHERE width > 1 GROUP BY idx // 8),
        c(r, lang, level, idx, h, proof) AS (
            SELECT r, lang, 0, idx, CASE WHEN tampered THEN lowered ELSE leaf END, '' FROM p
            UNION ALL
            SELECT r, c.lang, n.level, n.idx,
                   sha256(array_to_string(n.kids[:c.idx % 8] || [c.h] || n.kids[c.idx % 8 + 2:], '')),
                   proof || array_to_string(n.kids[:c.idx % 8] || n.kids[c.idx % 8 + 2:], '')
            FROM c JOIN n ON c.lang IS NOT DISTINCT FROM n.lang AND n.level = c.level + 1 AND n.idx = c.idx // 8),
        at_subroot AS (
            SELECT r, c.h, proof, s.idx FROM c JOIN n USING (level, idx) JOIN s ON s.lang IS NOT DISTINCT FROM c.lang
            WHERE n.lang IS NOT DISTINCT FROM c.lang AND n.width = 1),
        t(r, level, idx, h, proof) AS (
            SELECT r, 0, idx, h, proof FROM at_subroot
            UNION ALL
            SELECT r, u.level, u.idx, sha256(array_to_string(u.kids[:t.idx % 8] || [t.h] || u.kids[t.idx % 8 + 2:], '')),
                   proof || array_to_string(u.kids[:t.idx % 8] || u.kids[t.idx % 8 + 2:], '')
            FROM t JOIN u ON u.level = t.level + 1 AND u.idx = t.idx // 8)
        SELECT p.doc_id, p.leaf, s.subroot, u.h AS root, sha256(t.proof) AS proof_sha256, t.h AS folded_root,
               t.h = u.h AS verified
        FROM p JOIN s ON s.lang IS NOT DISTINCT FROM p.lang JOIN t ON t.r = p.r
        JOIN u ON u.width = 1 AND u.level = t.level""".replace("CRC32_OF_S", _CRC32),
    # rows one by one: the best (cost, audit, text) of each state; states: 0 nothing yet, 1 system, 2 user, 3 assistant
    "op11_conversation_repair": r"""
        WITH RECURSIVE k AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s FROM conversations),
        g AS (SELECT *, CRC32_OF_S % 20 AS kind FROM k),
        d AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM g),
        o AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                                         md5(strlen(role) || ':' || role || text), copy) AS i,
                   left(role, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
            FROM d),
        f AS (
            SELECT *, body = '' AS blank,
                   body <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS duplicate,
                   lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS previous FROM o),
        e AS (
            SELECT *, NOT blank AND NOT duplicate AND right(body, 1) NOT IN ('.', '!', '?') AS truncated FROM f),
        ins(state, label, cost, lines, here) AS (
            VALUES (0, '', 0, '', 0), (0, 'I', 2, 'user:' || chr(10), 2), (0, 'II', 4, 'user:' || chr(10) || 'assistant:' || chr(10), 3),
                   (1, '', 0, '', 1), (1, 'I', 2, 'user:' || chr(10), 2), (1, 'II', 4, 'user:' || chr(10) || 'assistant:' || chr(10), 3),
                   (2, '', 0, '', 2), (2, 'I', 2, 'assistant:' || chr(10), 3), (3, '', 0, '', 3), (3, 'I', 2, 'user:' || chr(10), 2)),
        r(conv_id, i, state, best) AS (
            SELECT DISTINCT conv_id, 0::BIGINT, 0, {'c': 0, 'a': '', 't': ''} FROM conversations
            UNION ALL
            SELECT r.conv_id, r.i + 1,
                   CASE op WHEN 'D' THEN here WHEN 'K' THEN CASE initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END
                           ELSE CASE here WHEN 2 THEN 3 ELSE 2 END END AS after,
                   min({'c': best.c + ins.cost + CASE op WHEN 'D' THEN 3 WHEN 'K' THEN 0 ELSE 2 END
                             + CASE WHEN op <> 'D' AND truncated THEN 1 ELSE 0 END,
                        'a': best.a || label || op,
                        't': best.t || lines || CASE op WHEN 'D' THEN '' WHEN 'K' THEN role || ':' || text || chr(10)
                             ELSE CASE here WHEN 2 THEN 'assistant:' ELSE 'user:' END || text || chr(10) END})
            FROM r JOIN e ON e.conv_id IS NOT DISTINCT FROM r.conv_id AND e.i = r.i + 1 JOIN ins USING (state),
                 (VALUES ('D'), ('K'), ('R')) AS ops(op)
            WHERE op = 'D' OR NOT blank AND NOT duplicate
                  AND (op = 'R' OR initial = 's' AND here = 0 OR initial = 'u' AND here IN (0, 1, 3) OR initial = 'a' AND here = 2)
            GROUP BY r.conv_id, r.i, after),
        n AS (
            SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count_if(blank) AS blank,
                   count_if(duplicate) AS duplicate, count_if(truncated) AS truncated,
                   count_if(i > 1 AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
            FROM e GROUP BY conv_id),
        x AS (
            SELECT r.conv_id, min({'c': best.c + CASE state WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 0 END,
                                   'a': best.a || CASE state WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
                                   't': best.t || CASE state WHEN 1 THEN 'user:' || chr(10) || 'assistant:' || chr(10)
                                                  WHEN 2 THEN 'assistant:' || chr(10) ELSE '' END}) AS best
            FROM r LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM r.conv_id WHERE r.i = coalesce(n.n, 0) GROUP BY r.conv_id)
        SELECT x.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
               CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
               CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(best.c AS BIGINT) AS cost, best.a AS audit,
               sha256(CASE WHEN best.t = '' THEN '' ELSE left(best.t, length(best.t) - 1) END) AS repaired_sha256
        FROM x LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM x.conv_id""".replace("CRC32_OF_S", _CRC32),
}
