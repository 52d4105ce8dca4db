"""DuckDB counterparts of the queries that SQL can state.

Byte-pair ids, trained models, template trees and hashed fingerprints are beyond it; their queries are
held against brute force in tests/llm.
"""

from __future__ import annotations

from leaguelake.llm import licenses

A_Z = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex({A_Z}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
    FROM documents
),
sets AS (
    SELECT doc_id, CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
    END AS s
    FROM words
),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
items AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
shared AS (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common
    FROM items a JOIN items b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
),
links AS (
    SELECT u, v FROM shared JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v
    WHERE 100 * common >= 75 * (a.n + b.n - common)
),
reach AS (
    SELECT doc_id, doc_id AS node FROM sizes
    UNION
    SELECT reach.doc_id, v FROM reach JOIN links ON node = u
),
lowest AS (SELECT doc_id, min(node) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept
FROM sizes JOIN lowest USING (doc_id)
"""


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_TEMPLATES = ", ".join(
    f"('{name}', {_list(licenses.template_words(text))})" for name, text in licenses.TEMPLATES.items()
)
_PAIRS = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"

OP5 = f"""
WITH templates(licence, w) AS (VALUES {_TEMPLATES}),
known AS (SELECT licence, {_PAIRS} AS b FROM templates),
texts AS (SELECT doc_id, coalesce(text, '') AS t, {A_Z} AS normal FROM documents),
units AS (
    SELECT doc_id, unnest(string_split(normal, E'\\n')) AS unit FROM texts
    UNION ALL
    SELECT doc_id, unnest(string_split_regex(normal, '\\n\\n+')) FROM texts WHERE contains(normal, E'\\n\\n')
    UNION ALL
    SELECT doc_id, normal FROM texts WHERE contains(normal, E'\\n')
),
listed AS (
    SELECT doc_id, string_split(trim(regexp_replace(unit, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') AS w FROM units
),
sets AS (SELECT doc_id, {_PAIRS} AS a FROM listed WHERE len(w) > 1),
compared AS (
    SELECT doc_id, licence, 2 * len(list_intersect(a, b)) / (len(a) + len(b)) AS dice
    FROM sets JOIN known ON len(a) * 1.2 >= len(b) * 0.8 AND len(b) * 1.2 >= len(a) * 0.8
),
matches AS (SELECT * FROM compared WHERE dice >= {licenses.THRESHOLD}),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, licence) AS place,
        count(*) OVER (PARTITION BY doc_id) AS n
    FROM matches
)
SELECT texts.doc_id, licence, dice, coalesce(n, 0) AS n_matches
FROM texts LEFT JOIN (SELECT * FROM ranked WHERE place = 1) best ON best.doc_id = texts.doc_id
"""

OP8 = f"""
WITH hashed AS (SELECT doc_id, {A_Z} AS normal FROM documents),
groups AS (SELECT normal, max(doc_id) AS keep_id, count(*) AS group_size FROM hashed GROUP BY normal)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(normal) AS text_sha256
FROM hashed JOIN groups USING (normal)
"""

OP10 = """
WITH replies AS (SELECT conv_id, max(turn) AS last FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
earlier AS (
    SELECT conv_id, last,
        coalesce(arg_max(text, turn) FILTER (role = 'assistant'), arg_max(text, turn)) AS other
    FROM conversations JOIN replies USING (conv_id) WHERE turn < last GROUP BY conv_id, last
),
turns AS (
    SELECT conv_id, turn, turn = last AND text <> other AS differs,
        '<|im_start|>' || role || E'\\n' || text || E'<|im_end|>\\n' AS chosen,
        '<|im_start|>' || role || E'\\n' || other || E'<|im_end|>\\n' AS rejected,
        length(text) + length('<|im_end|>') AS n_chosen, length(other) + length('<|im_end|>') AS n_rejected
    FROM conversations JOIN earlier USING (conv_id) WHERE turn <= last
)
SELECT conv_id, count(*) FILTER (NOT differs) AS prompt_turns,
    sha256(coalesce(string_agg(chosen, '' ORDER BY turn) FILTER (NOT differs), '')) AS prompt_sha256,
    sha256(coalesce(string_agg(chosen, '') FILTER (differs), '')) AS chosen_sha256,
    sha256(coalesce(string_agg(rejected, '') FILTER (differs), '')) AS rejected_sha256,
    coalesce(sum(n_chosen) FILTER (differs), 0)::BIGINT AS chosen_trained,
    coalesce(sum(n_rejected) FILTER (differs), 0)::BIGINT AS rejected_trained
FROM turns GROUP BY conv_id
"""

OP13 = """
WITH valid AS MATERIALIZED (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x, row_number() OVER () AS uid
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
),
scored AS (
    SELECT a.uid AS anchor, a.vec_id AS anchor_id, b.uid, b.vec_id, a.label = b.label AS alike,
        list_dot_product(a.x, b.x)::BIGINT AS score
    FROM valid a JOIN valid b ON a.uid <> b.uid
    WHERE a.vec_id % 100 = 0
),
positives AS (
    SELECT anchor, anchor_id, vec_id AS positive_id, score AS positive_score,
        row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, uid) AS place
    FROM scored WHERE alike
    QUALIFY place <= 5
),
negatives AS (
    SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor, place ORDER BY score DESC, vec_id, uid) AS rank
    FROM positives p JOIN scored s ON s.anchor = p.anchor AND NOT alike
    WHERE 80 * positive_score <= 100 * score AND score <= positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= 5
"""

ORACLE_SQL = {
    "op3_minhash_near_dedup": OP3,
    "op5_license_scan": OP5,
    "op8_exact_dedup": OP8,
    "op10_preference_format": OP10,
    "op13_hard_negatives": OP13,
}
