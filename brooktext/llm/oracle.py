"""SQL for the queries of this folder that SQL can express."""

from __future__ import annotations

# A separator-free word, as in the operators.
WORD = r"[^\x20\x09-\x0D]+"

ORACLES: dict[str, str] = {
    "op1_substring_dedup": rf"""
        WITH texts AS (
            SELECT doc_id, coalesce(regexp_extract_all(text, '{WORD}'), []) AS words FROM documents
        ), windows AS (
            SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS w
            FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 12)) AS i FROM texts)
        ), found AS (
            SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY w) AS least FROM windows)
            WHERE least < doc_id
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS i FROM found
        ), lists AS (
            SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id
        )
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
            sha256(array_to_string(list_filter(words, lambda x, i: NOT coalesce(list_contains(gone, i), false)), ' '))
                AS kept_sha256
        FROM texts LEFT JOIN lists USING (doc_id)
    """,
    "op7_near_dedup": rf"""
        WITH RECURSIVE texts AS (
            SELECT doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS words
            FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE
                WHEN len(words) >= 2 THEN [words[i] || ' ' || words[i + 1] FOR i IN generate_series(1, len(words) - 1)]
                ELSE words END) AS shingle
            FROM texts
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), common AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
            FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY ALL
        ), links AS (
            SELECT a, b FROM common JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
            WHERE 100 * shared >= 80 * (s.n + t.n - shared)
        ), either AS (
            SELECT a, b FROM links UNION ALL SELECT b, a FROM links
        ), reached(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM reached r JOIN either e ON e.a = r.other
        ), named AS (
            SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
        )
        SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, component_id = doc_id AS kept
        FROM named LEFT JOIN sizes USING (doc_id)
    """,
    "op6_line_dedup": rf"""
        WITH RECURSIVE lines AS (
            SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i
            FROM documents
        ), long AS (
            SELECT doc_id, i, regexp_replace(lower(line), '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS line,
                regexp_replace(lower(line), '^[\x20\x09-\x0D]+', '') AS tailed,
                len(regexp_extract_all(line, '{WORD}')) AS n_words
            FROM lines
        ), distinct_lines AS (
            SELECT line, tailed, n_words, row_number() OVER (ORDER BY min(doc_id), min(i)) AS id FROM long
            WHERE line <> '' GROUP BY ALL
        ), shingles AS (
            SELECT DISTINCT id, substr(tailed, p, 8) AS shingle
            FROM (SELECT id, tailed, unnest(range(1, length(tailed) + 1)) AS p FROM distinct_lines WHERE n_words >= 3)
            WHERE regexp_matches(substr(tailed, p, 1), '{WORD}')
                AND (p = 1 OR NOT regexp_matches(substr(tailed, p - 1, 1), '{WORD}'))
            UNION
            SELECT id, chr(10) || substr(line, p, 8)
            FROM (SELECT id, line, unnest(range(1, greatest(length(line) - 7, 1) + 1)) AS p FROM distinct_lines WHERE n_words < 3)
        ), sizes AS (
            SELECT id, count(*) AS n FROM shingles GROUP BY id
        ), common AS (
            SELECT x.id AS a, y.id AS b, count(*) AS shared
            FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.id < y.id GROUP BY ALL
        ), links AS (
            SELECT a, b FROM common JOIN sizes s ON s.id = a JOIN sizes t ON t.id = b
            WHERE 100 * shared >= 80 * (s.n + t.n - shared)
        ), either AS (
            SELECT a, b FROM links UNION ALL SELECT b, a FROM links
        ), reached(id, other) AS (
            SELECT id, id FROM distinct_lines UNION SELECT r.id, e.b FROM reached r JOIN either e ON e.a = r.other
        ), named AS (
            SELECT id, min(other) AS component FROM reached GROUP BY id
        ), placed AS (
            SELECT doc_id, i, component FROM long JOIN distinct_lines USING (line, tailed, n_words) JOIN named USING (id)
        ), judged AS (
            SELECT doc_id, i, row_number() OVER (PARTITION BY component ORDER BY doc_id, i) > 1 AS gone FROM placed
        ), told AS (
            SELECT l.doc_id, l.i, line, coalesce(gone, false) AS gone
            FROM lines l LEFT JOIN judged j ON j.doc_id = l.doc_id AND j.i = l.i
        )
        SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_removed,
            sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
        FROM told GROUP BY doc_id
    """,
    "op13_hard_negatives": """
        WITH usable AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
                AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
        ), scored AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
                list_dot_product(a.x, b.x)::BIGINT AS score
            FROM usable a JOIN usable b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
        ), positives AS (
            SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
        )
        SELECT p.anchor_id, positive_id,
            row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
            other_id AS negative_id, positive_score, score AS negative_score
        FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
            AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) <= 3
    """,
}
