"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

#: Links by counting common shingles of all pairs that have any, then the transitive closure.
NGRAM_JACCARD = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(words) >= 4 THEN list_distinct([array_to_string(words[i:i + 3], ' ') FOR i IN range(1, len(words) - 2)]) WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END AS shingles FROM w),
each AS (SELECT doc_id, unnest(shingles) AS shingle FROM sets),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM each a JOIN each b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM common JOIN sets a ON a.doc_id = x JOIN sets b ON b.doc_id = y WHERE 100 * n >= 85 * (len(a.shingles) + len(b.shingles) - n)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT reach.a, ways.y FROM reach JOIN ways ON ways.x = reach.b)
SELECT sets.doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, least AS component_id FROM sets JOIN (SELECT a, min(b) AS least FROM reach GROUP BY 1) ON a = sets.doc_id"""

ORACLE_SQL: dict[str, str] = {"op5_ngram_jaccard": NGRAM_JACCARD}
