"""The queries of the training-data operators, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from quillgrid.llm import chat, clusters, jaccard, language, media, merkle, mixing, pieces, quality_model, quality_rules, repeats, toxicity, url_filters
from quillgrid.llm.common import read


def op1_sentencepiece(spark, sf_dir):
    return pieces.round_trip_digest(pieces.sentencepiece_round_trip(read(spark, sf_dir, "documents")))


def op2_media_columns(spark, sf_dir):
    return media.media_digest(read(spark, sf_dir, "documents"))


def op3_language_id(spark, sf_dir):
    return language.language_predictions(read(spark, sf_dir, "documents"))


def op4_ngram_jaccard(spark, sf_dir):
    return jaccard.ngram_components(read(spark, sf_dir, "documents"))


def op5_chat_formatting(spark, sf_dir):
    return chat.chat_digest(chat.format_chats(chat.with_conflict(read(spark, sf_dir, "conversations"))))


def op6_url_filters(spark, sf_dir):
    return url_filters.url_verdicts(read(spark, sf_dir, "pages"), url_filters.rules_frame(spark))


def op7_quality_rules(spark, sf_dir):
    return quality_rules.quality_verdicts(read(spark, sf_dir, "documents"))


def op8_mixing(spark, sf_dir):
    return mixing.mixture(read(spark, sf_dir, "documents"))


def op9_toxicity(spark, sf_dir):
    return toxicity.toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_quality_classifier(spark, sf_dir):
    return quality_model.quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_suffix_dedup(spark, sf_dir):
    return repeats.repeats_digest(repeats.without_repeats(read(spark, sf_dir, "documents")))


def op12_merkle_manifest(spark, sf_dir):
    return merkle.manifest_proofs(read(spark, sf_dir, "documents"))


def op13_centroid_clustering(spark, sf_dir):
    return clusters.cluster_distances(read(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_sentencepiece, op2_media_columns, op3_language_id, op4_ngram_jaccard, op5_chat_formatting, op6_url_filters, op7_quality_rules, op8_mixing, op9_toxicity,
        op10_quality_classifier, op11_suffix_dedup, op12_merkle_manifest, op13_centroid_clustering,
    )
}

ORACLES = {
    "op5_chat_formatting": r"""
        WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        e AS (SELECT *, length(regexp_replace(text, '\[(\\*)(/?INST\])|<(\\*)(/?s>)', '.\0', 'g')) AS escaped,
                     CASE WHEN role = 'assistant' THEN 8 ELSE 14 END + length(role) AS marks FROM t)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
               sum(escaped + marks)::BIGINT AS formatted_chars
        FROM e GROUP BY conv_id
    """,
    "op6_url_filters": r"""
        WITH u AS (SELECT page_id, lower(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1)) AS host,
                          regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
        r(verdict, rule, rhost, rpath) AS (VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
                          ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')),
        m AS (SELECT u.page_id, r.rule, r.verdict, row_number() OVER (PARTITION BY u.page_id ORDER BY length(r.rule) DESC) AS k
              FROM u JOIN r ON (u.host = r.rhost OR ends_with(u.host, '.' || r.rhost)) AND starts_with(u.path, r.rpath))
        SELECT u.page_id, u.host, u.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
        FROM u LEFT JOIN m ON m.page_id = u.page_id AND m.k = 1
    """,
    "op7_quality_rules": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
        lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
                         count(*) FILTER (regexp_matches(line, '(\.\.\.|…)[\x20\x09-\x0D]*\z')) AS n_ellipsis_lines, count(*) FILTER (regexp_matches(line, '^[\x20\x09-\x0D]*[-*•]')) AS n_bullet_lines
                  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
        g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
        c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g),
        p AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM c, (VALUES (0), (1), (2)) AS o(k) WHERE n >= 2 GROUP BY doc_id),
        m AS (SELECT w.doc_id, len(w.w)::BIGINT AS n_words, length(array_to_string(w.w, ''))::BIGINT AS word_chars,
                     (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
                     coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
                     coalesce(n_ellipsis_lines, 0) AS n_ellipsis_lines, coalesce(n_bullet_lines, 0) AS n_bullet_lines,
                     len(regexp_extract_all(text, '[^\x20\x09-\x0D]*\p{L}[^\x20\x09-\x0D]*')) AS n_letter_words
              FROM w LEFT JOIN lines ON lines.doc_id = w.doc_id LEFT JOIN p ON p.doc_id = w.doc_id),
        b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND NOT (10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 2 * n_dup_lines > n_lines
                                    OR 10 * n_letter_words < 3 * n_words OR 10 * n_ellipsis_lines > 6 * n_lines OR 10 * n_bullet_lines > 9 * n_lines) AS kept
        FROM b
    """,
    "op12_merkle_manifest": r"""
        WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, source, text, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
                    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda c, x:
                        list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: xor(a >> 1, (a & 1) * 3988292384)))) % 5 = 0 AS hit FROM documents),
        leaves AS (SELECT r, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                          CASE WHEN hit AND text IS NOT NULL THEN sha256(head || strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) END AS changed FROM d),
        placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n FROM leaves),
        up AS (SELECT source, 0 AS lvl, idx, n, leaf AS h FROM placed
               UNION ALL SELECT source, lvl + 1, idx // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY idx)) FROM up WHERE n > 1 GROUP BY source, lvl, idx // 16, n),
        subs AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM up WHERE n = 1),
        over_ AS (SELECT 0 AS lvl, idx, n, subroot AS h FROM subs
               UNION ALL SELECT lvl + 1, idx // 16, (n + 15) // 16, sha256(string_agg(h, '' ORDER BY idx)) FROM over_ WHERE n > 1 GROUP BY lvl, idx // 16, n),
        root AS (SELECT h AS root FROM over_ WHERE n = 1),
        runs AS (SELECT source, lvl, idx // 16 AS run, list(h ORDER BY idx) AS hs FROM up WHERE n > 1 GROUP BY source, lvl, idx // 16),
        top_runs AS (SELECT lvl, idx // 16 AS run, list(h ORDER BY idx) AS hs FROM over_ WHERE n > 1 GROUP BY lvl, idx // 16),
        climb AS (SELECT p.r, p.source, 0 AS lvl, p.idx, p.n, '' AS sib, coalesce(p.changed, p.leaf) AS h FROM placed p
               UNION ALL SELECT c.r, c.source, c.lvl + 1, c.idx // 16, (c.n + 15) // 16,
                      c.sib || array_to_string(list_concat(g.hs[:c.idx % 16], g.hs[c.idx % 16 + 2:]), ''),
                      sha256(array_to_string(list_concat(list_append(g.hs[:c.idx % 16], c.h), g.hs[c.idx % 16 + 2:]), ''))
               FROM climb c JOIN runs g ON g.source IS NOT DISTINCT FROM c.source AND g.lvl = c.lvl AND g.run = c.idx // 16 WHERE c.n > 1),
        climb2 AS (SELECT c.r, 0 AS lvl, s.idx, s.n, c.sib, c.h, s.subroot FROM climb c JOIN subs s ON s.source IS NOT DISTINCT FROM c.source WHERE c.n = 1
               UNION ALL SELECT c.r, c.lvl + 1, c.idx // 16, (c.n + 15) // 16, c.sib || array_to_string(list_concat(g.hs[:c.idx % 16], g.hs[c.idx % 16 + 2:]), ''),
                      sha256(array_to_string(list_concat(list_append(g.hs[:c.idx % 16], c.h), g.hs[c.idx % 16 + 2:]), '')), c.subroot
               FROM climb2 c JOIN top_runs g ON g.lvl = c.lvl AND g.run = c.idx // 16 WHERE c.n > 1)
        SELECT p.doc_id, p.leaf, c.subroot, root.root, sha256(c.sib) AS proof_sha256, c.h AS folded_root, c.h = root.root AS verified
        FROM placed p JOIN climb2 c ON c.r = p.r AND c.n = 1, root
    """,
}
