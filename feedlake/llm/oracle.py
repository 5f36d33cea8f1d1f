"""DuckDB counterparts of the queries that SQL can express."""

from __future__ import annotations

LINE_DEDUP = """
WITH split AS (
    SELECT doc_id, pos, line, len(regexp_extract_all(line, '[^ \\t-\\r]+')) AS words
    FROM (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
            generate_subscripts(string_split(text, chr(10)), 1) AS pos
        FROM documents WHERE text IS NOT NULL
    )
), lines AS (
    SELECT *, count(*) FILTER (words > 0) OVER (PARTITION BY doc_id ORDER BY pos) AS so_far FROM split
), numbered AS (
    SELECT doc_id, pos, line, words, row_number() OVER along AS seq, sum(words) OVER along AS after
    FROM lines WHERE words > 0 WINDOW along AS (PARTITION BY doc_id ORDER BY pos)
), spans AS (
    SELECT i.doc_id, i.seq AS a, min(j.seq) AS z FROM numbered i
    JOIN numbered j ON j.doc_id = i.doc_id AND j.seq >= i.seq AND j.after - i.after + i.words >= 50
    GROUP BY ALL
    UNION
    SELECT j.doc_id, max(i.seq) AS a, j.seq AS z FROM numbered j
    JOIN numbered i ON j.doc_id = i.doc_id AND j.seq >= i.seq AND j.after - i.after + i.words >= 50
    GROUP BY j.doc_id, j.seq
), runs AS (
    SELECT s.doc_id, s.a, s.z, string_agg(n.line, chr(10) ORDER BY n.seq) AS body
    FROM spans s JOIN numbered n ON n.doc_id = s.doc_id AND n.seq BETWEEN s.a AND s.z
    GROUP BY s.doc_id, s.a, s.z
), firsts AS (
    SELECT body, min((doc_id, a)) AS place FROM runs GROUP BY body HAVING count(*) > 1
), cuts AS (
    SELECT doc_id, a, z FROM runs JOIN firsts USING (body) WHERE (doc_id, a) > place
), cut AS (
    SELECT DISTINCT n.doc_id, n.seq FROM numbered n JOIN cuts c ON c.doc_id = n.doc_id AND n.seq BETWEEN c.a AND c.z
), gone AS (
    SELECT l.doc_id, l.pos FROM lines l JOIN cut c ON c.doc_id = l.doc_id AND c.seq = l.so_far
    WHERE l.words > 0 OR EXISTS (SELECT 1 FROM cut d WHERE d.doc_id = l.doc_id AND d.seq = l.so_far + 1)
), rest AS (
    SELECT l.doc_id, coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (g.pos IS NULL), '') AS text,
        count(g.pos) AS n_deleted_lines
    FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.pos = l.pos GROUP BY l.doc_id
)
SELECT d.doc_id, r.text, coalesce(r.n_deleted_lines, 0) AS n_deleted_lines
FROM documents d LEFT JOIN rest r ON r.doc_id = d.doc_id
"""


MERKLE_AUDIT = """
WITH body AS (
    SELECT page_id, coalesce(page_id, -1) // 1000 AS file,
        'WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: ' || coalesce(url, '')
        || '\r\nWARC-Record-ID: <urn:record:' || coalesce(page_id::VARCHAR, '')
        || '>\r\nContent-Type: text/html\r\nContent-Length: ' || strlen(coalesce(html, ''))::VARCHAR
        || '\r\n\r\n' || coalesce(html, '') || '\r\n\r\n' AS record
    FROM pages
), master AS (
    SELECT page_id, file, record, strlen(record) AS length,
        sum(strlen(record)) OVER (PARTITION BY file ORDER BY page_id ROWS UNBOUNDED PRECEDING) - strlen(record) AS place
    FROM body
), replica AS (
    SELECT page_id, file, place, length,
        CASE WHEN page_id % 97 = 5 THEN '!' || substr(record, 2) ELSE record END AS record
    FROM master WHERE page_id % 211 != 7
    UNION ALL
    SELECT page_id, file, place + 1, length,
        CASE WHEN page_id % 97 = 5 THEN '!' || substr(record, 2) ELSE record END
    FROM master WHERE page_id % 307 = 9
)
SELECT coalesce(m.file, r.file)::BIGINT AS file, coalesce(m.place, r.place)::BIGINT AS "offset",
    coalesce(m.length, r.length)::BIGINT AS length, coalesce(m.page_id, r.page_id) AS page_id,
    CASE WHEN m.file IS NULL THEN 'extra' WHEN r.file IS NULL THEN 'missing' ELSE 'changed' END AS state
FROM master m FULL JOIN replica r ON m.file = r.file AND m.place = r.place
WHERE m.record IS DISTINCT FROM r.record
"""

URL_FILTERS = """
WITH split AS (
    SELECT page_id, lower(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1)) AS host,
        regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path
    FROM (
        SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
        FROM pages
    )
), rules(rule_host, rule_path, verdict) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
        ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), best AS (
    SELECT page_id, max((length(rule_host || rule_path), rule_host || rule_path, verdict)) AS r
    FROM split JOIN rules ON ('.' || host).ends_with('.' || rule_host) AND path.starts_with(rule_path)
    GROUP BY page_id
)
SELECT page_id, host, path, r[2] AS rule, coalesce(r[3], 'allow') AS verdict
FROM split LEFT JOIN best USING (page_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op6_line_dedup": LINE_DEDUP, "op7_merkle_audit": MERKLE_AUDIT, "op8_url_filters": URL_FILTERS}
