"""Training-data queries as DuckDB SQL, where SQL can express them and runs over the whole tables."""

from __future__ import annotations

WORDS = r"'[^\x20\x09-\x0D]+'"
REPEATS = f"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {WORDS}) AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM w)),
rep AS (SELECT t FROM win GROUP BY t HAVING count(*) > 1),
cov AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS k FROM win JOIN rep USING (t)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM w),
kept AS (SELECT doc_id, count(cov.k) AS n_removed, string_agg(word, ' ' ORDER BY words.k) FILTER (cov.k IS NULL) AS t FROM words LEFT JOIN cov USING (doc_id, k) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)"""
PASSAGES = f"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {WORDS}) AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i + 1:i + 50], ' ') AS t FROM (SELECT doc_id, w, unnest(range(0, len(w) - 49)) AS i FROM w)),
own AS (SELECT doc_id, i, min({{'d': doc_id, 'i': i}}) OVER (PARTITION BY t) AS f FROM win),
gone AS (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS begins FROM own WHERE f.d <> doc_id OR f.i <> i),
g AS (SELECT *, sum(begins) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM gone)
SELECT doc_id, min(i) AS start_word, max(i) + 50 - min(i) AS n_words, arg_min(f.d, i) AS first_doc_id, arg_min(f.i, i) AS first_start_word FROM g GROUP BY doc_id, n"""
LINKS = f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {WORDS}) AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s FROM w),
n AS (SELECT doc_id, count(s.s) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, reached) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.reached = e.a)
SELECT doc_id, any_value(n.n) AS n_shingles, min(reached) AS component_id FROM r JOIN n USING (doc_id) GROUP BY doc_id"""
ARCHIVE = """WITH own AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT page_id, t, array_to_string(list_transform(range(0, 8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda b: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(h, 1 + 5 * i, 5) AS BIGINT) >> b) & 31 AS INT), 1)), '')), '') AS digest, max(page_id) OVER (PARTITION BY t) AS top FROM own)
SELECT page_id, strlen(t) AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to FROM d"""
