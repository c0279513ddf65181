"""The queries of the catalogue as DuckDB SQL. Fixed strings, put together from the adapters' views."""

from __future__ import annotations

LINES = r"""lines AS (
  SELECT doc_id, source, reading_order, 1 + (reading_order - 1) // 8 AS page_number, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS text
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS raw, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS reading_order FROM documents)
  WHERE regexp_replace(raw, '^\s+|\s+$', '', 'g') <> '')"""
TURNS = "turns AS (SELECT conv_id AS document_id, CAST(1 AS BIGINT) AS page_number, CAST(turn AS BIGINT) AS reading_order, 'b' || turn AS id, CASE WHEN role = 'user' THEN 'heading' ELSE 'body' END AS role, text FROM conversations)"
BOXES = """boxes AS (
  SELECT l_orderkey AS document_id, CAST(l_linenumber % 2 + 1 AS BIGINT) AS page_number,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS seq,
    CASE l_returnflag WHEN 'R' THEN 'figure' WHEN 'A' THEN 'caption' ELSE 'text' END AS kind,
    l_partkey % 500 AS x, l_suppkey % 700 AS y, CAST(l_quantity + 20 AS BIGINT) AS w, CAST(l_linenumber * 7 + 10 AS BIGINT) AS h, l_extendedprice AS score
  FROM lineitem)"""
REFS = """refs AS (
  SELECT l_suppkey AS document_id, l_orderkey % 30 AS page_number,
    row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_shipdate) AS block_id,
    'F' || (l_partkey % 40) AS label, l_linenumber = 1 AS is_figure, CAST(l_partkey % 500 AS DOUBLE) AS cx, l_quantity AS cy
  FROM lineitem)"""
CELLS = """own AS (
  SELECT l_orderkey AS table_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) - 1 AS row,
    CAST(0 AS BIGINT) AS col, CAST(1 AS BIGINT) AS row_span, CAST(1 AS BIGINT) AS col_span, CAST(l_partkey AS VARCHAR) AS text, CAST(l_quantity AS BIGINT) AS q
  FROM lineitem),
other AS (
  SELECT table_id, CASE WHEN q % 13 = 0 THEN row + 100 ELSE row END AS row, col, row_span, CAST(CASE WHEN q % 11 = 0 THEN 2 ELSE 1 END AS BIGINT) AS col_span,
    CASE WHEN q % 5 = 0 THEN text || 'x' ELSE text END AS text
  FROM own WHERE q % 7 <> 0)"""
ENTRIES = (
    "WITH "
    + TURNS
    + """, marked AS (
  SELECT *, role = 'heading' OR row_number() OVER (PARTITION BY document_id ORDER BY page_number, reading_order, id) = 1 AS start FROM turns),
numbered AS (SELECT *, CAST(sum(CAST(start AS INT)) OVER (PARTITION BY document_id ORDER BY page_number, reading_order, id) AS BIGINT) AS position FROM marked),
entries AS (
  SELECT document_id, document_id || '_' || arg_min(id, reading_order) AS entry_id, position, min(page_number) AS page_number,
    CASE WHEN arg_min(role, reading_order) = 'heading' THEN arg_min(text, reading_order) ELSE 'Page ' || min(page_number) END AS job_title,
    string_agg(text, chr(10) || chr(10) ORDER BY reading_order) AS content, count(*) AS n_blocks, 'text' AS kind, string_agg(id, ',' ORDER BY reading_order) AS block_ids
  FROM numbered GROUP BY document_id, position)"""
)
ENTRIES_HEADING = f"{ENTRIES} SELECT * FROM entries"
ENTRIES_PAGE = f"""WITH {LINES}
SELECT doc_id AS document_id, doc_id || '_b' || min(reading_order) AS entry_id, row_number() OVER (PARTITION BY doc_id ORDER BY page_number) AS position, page_number,
  'Page ' || page_number AS job_title, string_agg(text, chr(10) || chr(10) ORDER BY reading_order) AS content, count(*) AS n_blocks, 'text' AS kind, string_agg('b' || reading_order, ',' ORDER BY reading_order) AS block_ids
FROM lines GROUP BY doc_id, page_number"""
#: Entries as a machine that walks a document's blocks one by one and knows its current entry, that entry's page, whether
#: the page at hand has a host, and how many entries are complete; what waits for a host is joined afterwards.
MIXED = """WITH RECURSIVE raw AS (
  SELECT l_suppkey AS d, l_orderkey % 97 + 1 AS page, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_shipdate) AS n,
    CASE WHEN l_partkey % 10 <= 1 THEN 'heading' WHEN l_partkey % 10 <= 4 THEN 'legend' WHEN l_partkey % 10 = 5 THEN 'artifact' ELSE 'body' END AS role, CASE WHEN l_quantity = 7 THEN '' ELSE 'p' || l_partkey END AS text,
    CASE WHEN l_linenumber = 3 THEN 'T' WHEN l_linenumber >= 5 THEN 'F' ELSE 'S' END AS type, l_suppkey % 2 = l_linenumber % 2 AND l_quantity <= 40 AS ready, CASE WHEN l_partkey % 10 < 7 THEN '|t|' ELSE '' END AS md
  FROM lineitem),
b AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY page, n) AS i FROM (SELECT d, page, n, text, ready, md, role = 'heading' AND type = 'S' AS head, CASE WHEN type = 'S' AND role = 'legend' THEN 'U' ELSE type END AS c FROM raw WHERE type <> 'S' OR role <> 'artifact')),
pages AS (SELECT d, page, bool_or(c IN ('S', 'T')) AS hosted, bool_or(c = 'F' AND ready) AS pictured FROM b GROUP BY d, page),
alone AS (SELECT d, page FROM pages WHERE pictured AND NOT hosted),
walk AS (
  SELECT d, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS entry, CAST(0 AS BIGINT) AS entry_page, CAST(0 AS BIGINT) AS page, FALSE AS has, FALSE AS starts FROM b GROUP BY d
  UNION ALL
  SELECT d, i, entry + CAST(starts AS INT), CASE WHEN starts THEN page ELSE entry_page END, page, has OR starts OR c = 'S', starts FROM (
    SELECT w.d, b.i, b.page, b.c, w.entry, w.entry_page, w.has AND w.page = b.page AS has,
      CASE WHEN b.c = 'S' THEN {start} WHEN b.c = 'T' THEN w.entry = 0 OR w.entry_page <> b.page ELSE FALSE END AS starts
    FROM walk w JOIN b ON b.d = w.d AND b.i = w.i + 1)),
placed AS (SELECT b.*, w.entry, w.starts, b.c IN ('S', 'T') OR w.has AND w.entry_page = b.page AS stays FROM walk w JOIN b USING (d, i)),
hosts AS (SELECT d, page, i, entry FROM placed WHERE c IN ('S', 'T')),
waiting AS (SELECT p.d, p.i, min(h.i) AS host FROM placed p JOIN hosts h ON h.d = p.d AND h.page = p.page AND h.i > p.i WHERE NOT p.stays GROUP BY p.d, p.i),
member AS (
  SELECT d, entry, CAST(NULL AS BIGINT) AS fpage, i AS spot, 2 AS tier, i, n, page, c, head, starts, text, md FROM placed WHERE stays
  UNION ALL SELECT p.d, h.entry, NULL, w.host, CASE p.c WHEN 'U' THEN 0 ELSE 1 END, p.i, p.n, p.page, p.c, p.head, p.starts, p.text, p.md FROM placed p JOIN waiting w USING (d, i) JOIN hosts h ON h.d = p.d AND h.i = w.host
  UNION ALL SELECT p.d, greatest(p.entry - 1, 0), p.page, p.i, 2, p.i, p.n, p.page, p.c, p.head, FALSE, p.text, p.md FROM placed p JOIN alone USING (d, page) WHERE p.c = 'F' AND p.ready),
grouped AS (
  SELECT d, entry, fpage, arg_min(n, i) FILTER (starts OR fpage IS NOT NULL) AS n, arg_min(page, i) FILTER (starts OR fpage IS NOT NULL) AS page, arg_min(CASE WHEN head THEN text ELSE 'Page ' || page END, i) FILTER (starts OR fpage IS NOT NULL) AS title,
    CASE WHEN fpage IS NOT NULL THEN 'figure' WHEN bool_or(c = 'T') THEN 'table' ELSE 'text' END AS kind, count(*) AS n_blocks, string_agg('b' || n, ',' ORDER BY spot, tier, i) AS block_ids,
    coalesce(list(CASE c WHEN 'S' THEN text ELSE md END ORDER BY i) FILTER (c = 'S' OR c = 'T' AND md <> ''), []) AS parts
  FROM member GROUP BY d, entry, fpage)
SELECT g.d AS document_id, g.d || '_b' || g.n AS entry_id, CASE WHEN fpage IS NULL THEN g.entry ELSE g.entry + 1 END + (SELECT count(*) FROM alone a WHERE a.d = g.d AND a.page < g.page) AS position, g.page AS page_number, kind, title AS job_title,
  coalesce(array_to_string(parts[nullif(list_position(list_transform(parts, lambda x: x <> ''), TRUE), 0):], chr(10) || chr(10)), '') AS content, n_blocks, block_ids
FROM grouped g"""
MIXED_HEADING = MIXED.replace("{start}", "b.head OR w.entry = 0")
MIXED_PAGE = MIXED.replace("{start}", "w.entry = 0 OR w.entry_page <> b.page")
PROJECTION = "SELECT conv_id, turn, CASE role WHEN 'system' THEN 'supporting' WHEN 'user' THEN 'excluded' ELSE 'searchable' END AS projection FROM conversations"
READING_ORDER = f"WITH {BOXES} SELECT document_id, page_number, seq, row_number() OVER (PARTITION BY document_id, page_number ORDER BY y // 4 * 4, x, seq) AS reading_order FROM boxes"
DOCUMENT_ORDER = f"""WITH {BOXES} SELECT document_id, page_number, seq,
  row_number() OVER (PARTITION BY document_id, page_number ORDER BY CASE kind WHEN 'text' THEN 2 ELSE 4 END, CASE WHEN x < 250 THEN 0 ELSE 1 END, y, x, seq) AS document_order FROM boxes"""
GUTTERS = f"""WITH {BOXES}, a AS (SELECT document_id // 10 AS document_id, page_number, document_id * 100 + seq AS seq, x, y, w, h FROM boxes),
p AS (SELECT document_id, page_number, max(x + w) - min(x) AS width FROM a GROUP BY 1, 2 HAVING count(*) >= 6 AND max(x + w) - min(x) >= 200),
own AS (SELECT a.*, width FROM a JOIN p USING (document_id, page_number) WHERE w <= width * 0.62),
g AS (
  SELECT *, max(x + w) OVER b AS reach, count(*) OVER (PARTITION BY document_id, page_number) AS n, row_number() OVER (PARTITION BY document_id, page_number ORDER BY x, seq) - 1 AS lefts,
    least(max(y + h) OVER b, max(y + h) OVER f) - greatest(min(y) OVER b, min(y) OVER f) AS beside FROM own
  WINDOW b AS (PARTITION BY document_id, page_number ORDER BY x, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), f AS (PARTITION BY document_id, page_number ORDER BY x, seq ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY document_id, page_number ORDER BY x - reach DESC, x) AS r FROM g WHERE n >= 6 AND x - reach > width * 0.01)
SELECT document_id, page_number, x - reach AS gap, x - (x - reach) / 2.0 AS gutter_x FROM ranked WHERE r = 1 AND x - reach >= greatest(12, width * 0.03) AND lefts >= 3 AND n - lefts >= 3 AND beside > 0"""
HEADING_CONTEXT = f"""WITH {TURNS}, own AS (
  SELECT document_id, reading_order, id, CASE WHEN role = 'heading' THEN reading_order % 3 END AS level FROM turns),
last AS (
  SELECT *, max(CASE WHEN level = 0 THEN reading_order END) OVER w AS u, max(CASE WHEN level = 1 THEN reading_order END) OVER w AS s, max(CASE WHEN level = 2 THEN reading_order END) OVER w AS t
  FROM own WINDOW w AS (PARTITION BY document_id ORDER BY reading_order))
SELECT document_id, reading_order, concat_ws(' / ', CASE WHEN u IS NOT NULL THEN 'b' || u END, CASE WHEN s > coalesce(u, -1) THEN 'b' || s END, CASE WHEN t > coalesce(u, -1) AND t > coalesce(s, -1) THEN 'b' || t END) AS path FROM last"""
NUMBERED_SPLITS = f"""WITH {BOXES}, own AS (SELECT document_id AS entry_id, seq, CASE WHEN kind <> 'text' THEN x END AS number FROM boxes),
rises AS (SELECT *, number IS NULL OR coalesce(number > max(number) OVER (PARTITION BY entry_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS up FROM own)
SELECT entry_id, seq, CASE WHEN bool_and(up) OVER (PARTITION BY entry_id) AND count(number) OVER (PARTITION BY entry_id) >= 2 THEN count(number) OVER (PARTITION BY entry_id ORDER BY seq) ELSE 0 END AS part FROM rises"""
COALESCE_PAGES = f"{ENTRIES} SELECT document_id, CAST(1 AS BIGINT) AS page_number, min(position) AS position, CAST(sum(n_blocks) AS BIGINT) AS n_blocks, string_agg(content, chr(10) ORDER BY position) AS content FROM entries GROUP BY document_id"
CONTINUATIONS = f"""WITH {BOXES}, own AS (SELECT document_id, seq AS position, x % 3 + seq AS n FROM boxes),
f AS (SELECT *, CASE WHEN n = lag(n) OVER (PARTITION BY document_id ORDER BY position) + 1 THEN 0 ELSE 1 END AS new FROM own),
c AS (SELECT *, sum(new) OVER (PARTITION BY document_id ORDER BY position) AS chain FROM f)
SELECT document_id, position, min(position) OVER (PARTITION BY document_id, chain) AS merged_into FROM c"""
RANK_CONSISTENCY = f"""WITH {BOXES}, r AS (
  SELECT document_id, seq, count(*) OVER (PARTITION BY document_id) AS n, percent_rank() OVER (PARTITION BY document_id ORDER BY seq) AS a,
    percent_rank() OVER (PARTITION BY document_id ORDER BY score * 1000 + seq) AS b FROM boxes)
SELECT document_id, seq, round(CASE WHEN n <= 1 THEN 0.0 ELSE greatest(0.0, 1.0 - abs(a - b)) END, 6) AS order_score FROM r"""
INSERTION = f"""WITH {BOXES} SELECT document_id, seq, greatest(0, least(5, (row_number() OVER (PARTITION BY document_id ORDER BY seq) * 5 - 1) // count(*) OVER (PARTITION BY document_id))) AS slot FROM boxes"""
NEXT_INDEXES = f"""WITH {BOXES}, known AS (SELECT document_id, page_number, count(*) AS top FROM boxes WHERE kind = 'figure' GROUP BY ALL)
SELECT b.document_id AS entry_id, b.page_number, b.seq, coalesce(k.top, 0) + row_number() OVER (PARTITION BY b.document_id, b.page_number ORDER BY b.seq) AS idx
FROM boxes b LEFT JOIN known k USING (document_id, page_number) WHERE b.kind = 'caption'"""
COMPACT = r"regexp_replace(text, '[\s\-_—–~〜·•,，.。:：;；|/\\（）()]+', '', 'g')"
REPEATED_LINES = f"""WITH {LINES}, own AS (SELECT DISTINCT source AS document_id, doc_id AS page_number, {COMPACT} AS line FROM lines WHERE {COMPACT} <> ''),
pages AS (SELECT source AS document_id, count(DISTINCT doc_id) AS pages FROM lines GROUP BY 1)
SELECT document_id, line, count(*) AS n_pages FROM own JOIN pages USING (document_id) GROUP BY document_id, line, pages HAVING count(*) >= greatest(3, least(12, (pages + 9) // 10))"""
WATERMARKS = """WITH lines AS (SELECT event_type AS document_id, event_id % 50 AS page_number, 'No' || lpad(CAST(user_id % 400 AS VARCHAR), 4, '0') || 'copy' AS line FROM events),
pages AS (SELECT document_id, count(DISTINCT page_number) AS pages FROM lines GROUP BY 1)
SELECT document_id, line, count(DISTINCT page_number) AS n_pages FROM lines JOIN pages USING (document_id) GROUP BY document_id, line, pages HAVING count(DISTINCT page_number) >= greatest(3, least(12, (pages + 9) // 10))"""
ZONED = LINES + r""", zoned AS (
  SELECT source AS document_id, doc_id AS page_number, text, CASE WHEN reading_order = 1 THEN 'top' WHEN reading_order % 7 = 0 THEN 'bottom' END AS zone, regexp_replace(text, '\s+', '', 'g') AS packed FROM lines),
pages AS (SELECT document_id, count(DISTINCT page_number) AS pages FROM zoned GROUP BY 1),
sigs AS (
  SELECT document_id, zone || '|' || regexp_replace(packed, '[0-9]+', '#', 'g') AS signature, count(DISTINCT page_number) AS n_pages
  FROM zoned JOIN pages USING (document_id) WHERE zone IS NOT NULL AND length(packed) BETWEEN 1 AND 40 AND pages > 2
  GROUP BY document_id, signature, pages HAVING count(DISTINCT page_number) >= greatest(3, least(40, (pages + 4) // 5)))"""
SIGNATURES = f"WITH {ZONED} SELECT * FROM sigs"
RUNNING_HEADS = """WITH own AS (SELECT event_type AS document_id, event_id % 50 AS page, CASE event_id % 3 WHEN 0 THEN 'top' WHEN 1 THEN 'bottom' END AS zone, 'Part#of' || substr('abcdefghij', user_id % 10 + 1, 1) || '#' AS sig FROM events),
pages AS (SELECT document_id, count(DISTINCT page) AS pages FROM own GROUP BY 1)
SELECT document_id, zone || '|' || sig AS signature, count(DISTINCT page) AS n_pages FROM own JOIN pages USING (document_id) WHERE zone IS NOT NULL AND pages > 2 GROUP BY document_id, zone, sig, pages HAVING count(DISTINCT page) >= greatest(3, least(40, (pages + 4) // 5))"""
PLAUSIBLE = r"""length(line) BETWEEN 5 AND 24 AND NOT regexp_matches(text, '[。！？!?；;]') AND length(regexp_replace(line, '[^0-9]', '', 'g')) >= 3 AND regexp_matches(line, '[A-Za-z一-鿿]')
  AND length(regexp_replace(line, '[^一-鿿]', '', 'g')) <= 10"""
WITHOUT_ARTIFACTS = f"""WITH {ZONED}, lined AS (SELECT *, {COMPACT} AS line FROM zoned),
marks AS (SELECT document_id, line FROM lined JOIN pages USING (document_id) WHERE {PLAUSIBLE} GROUP BY document_id, line, pages HAVING count(DISTINCT page_number) >= greatest(3, least(12, (pages + 9) // 10)))
SELECT document_id, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM lined l
WHERE packed <> '' AND NOT (length(packed) <= 24 AND (regexp_matches(packed, '^[·•∙⋅・][0-9]{{1,4}}[·•∙⋅・]$|^[-—–_]+[0-9]{{1,4}}[-—–_]+$|^第[0-9]{{1,4}}页$|^(?i:p[.]|page)[0-9]{{1,4}}$|^[0-9]{{1,4}}/[0-9]{{1,4}}$') OR zone IS NOT NULL AND regexp_matches(packed, '^[0-9]{{1,4}}$')))
  AND NOT EXISTS (SELECT 1 FROM marks m WHERE m.document_id = l.document_id AND (m.line = l.line OR contains(m.line, l.line) AND length(l.line) >= greatest(5, floor(length(m.line) * 0.45)) OR regexp_matches(l.line, '^[一-鿿A-Za-z]+$') AND starts_with(m.line, l.line) AND length(l.line) >= 3
    OR contains(l.line, m.line) AND length(m.line) >= 5 AND length(l.line) - length(m.line) <= 2
    OR length(regexp_replace(l.line, '[^0-9]', '', 'g')) >= 3 AND contains(regexp_replace(m.line, '[^0-9]', '', 'g'), regexp_replace(l.line, '[^0-9]', '', 'g')) AND length(l.line) <= 8 AND regexp_matches(l.line, '[一-鿿A-Za-z]')))
  AND NOT EXISTS (SELECT 1 FROM sigs s WHERE s.document_id = l.document_id AND s.signature = l.zone || '|' || regexp_replace(l.packed, '[0-9]+', '#', 'g'))
GROUP BY document_id"""
NORMAL = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(nfc_normalize(coalesce(text, '')), '[^\p{L}\p{N}\n]', ' ', 'g'), ' +', ' ', 'g'), ' *\n *', chr(10), 'g'), '^\s+|\s+$', '', 'g')"
SEARCH_NORMAL = f"SELECT doc_id, md5({NORMAL}) AS digest, length({NORMAL}) AS n FROM documents"
FINGERPRINT = r"""SELECT doc_id, regexp_replace('2' || regexp_replace(coalesce(text, ''), '[^\p{L}\p{N}]', '', 'g'), '^X', '') AS fingerprint, '图11' AS anchor FROM documents"""
PATH_SAFE = r"""SELECT page_id, array_to_string(list_filter(list_transform(string_split(replace(url, chr(92), '/'), '/'), lambda p: lower(regexp_replace(regexp_replace(p, '[^\p{L}\p{N}_]+', '_', 'g'), '^_+|_+$', '', 'g'))), lambda p: p <> ''), '/') AS path,
  list_last(string_split(regexp_replace(url, '[?#].*$', ''), '/')) AS base FROM pages"""
SIMILARITY = """WITH own AS (SELECT p_partkey, p_name AS a, coalesce(lag(p_name) OVER (PARTITION BY p_brand ORDER BY p_partkey), '') AS b FROM part)
SELECT p_partkey, round(CASE WHEN a = '' OR b = '' THEN 0.0 WHEN levenshtein(a, b) > floor(greatest(length(a), length(b)) * (1.0 - 0.4)) + 1 THEN 0.0 ELSE 1.0 - levenshtein(a, b) / greatest(length(a), length(b)) END, 6) AS similarity FROM own"""
TOKENS = rf"""WITH own AS (SELECT doc_id, list_filter(string_split(regexp_replace({NORMAL}, '\s+', ' ', 'g'), ' '), lambda t: length(t) >= 2) AS t FROM documents)
SELECT doc_id, CAST(len(t) AS BIGINT) AS n, CAST(len(list_distinct(t)) AS BIGINT) AS n_distinct FROM own"""
NUMERAL = "SELECT p_partkey, CAST((p_size % 9 + 1) * 100 + (p_partkey % 9 + 1) * 10 + p_size % 9 + 1 AS BIGINT) AS value, CAST(p_size AS BIGINT) AS size FROM part"
HEADINGS = r"""WITH own AS (SELECT p_partkey, p_size % 20 AS a, p_partkey % 30 AS b, p_name AS t FROM part),
ok AS (SELECT *, length(regexp_replace(t, '\s+', '', 'g')) BETWEEN 1 AND 36 AND NOT regexp_matches(t, '^[\p{P}\p{S}]') AND NOT regexp_matches(t, '[/\\。；;！？!?]') AND regexp_matches(t, '^[^\s0-9）\)]..*$') AS fits FROM own)
SELECT p_partkey, CASE WHEN fits THEN 'section' END AS level, CASE WHEN fits THEN a || '.' || b END AS number, CASE WHEN fits THEN t END AS title, CAST(a * 10000 + b * 100 AS BIGINT) AS item FROM ok"""
ALLOWED = r"，。；：？！、,.:;!?%（）()\[\]【】<>《》“”‘’+\-—_/\\|=~*&@#·…'" + "\""
SUSPICION = rf"""WITH own AS (SELECT doc_id, regexp_replace(text, '\s+', '', 'g') AS t, text AS raw FROM documents),
n AS (SELECT *, greatest(length(t), 1) AS len, length(regexp_replace(t, '[^\p{{C}}]', '', 'g')) AS control, length(regexp_replace(t, '[^¦¤§□■]', '', 'g')) AS odd,
  length(regexp_replace(t, '[\p{{L}}\p{{N}}{ALLOWED.replace("'", "''")}]', '', 'g')) AS weird, length(regexp_replace(t, '[\p{{L}}\p{{N}}]', '', 'g')) AS symbols FROM own),
r AS (SELECT *, [control > 0, odd >= 2, weird / len >= 0.08, symbols / len >= 0.35 AND length(t) >= 10, regexp_matches(t, '[:：；;]{{2,}}|[·•]{{2,}}|-{{3,}}'), regexp_matches(raw, '(?:^|[\s（(])[A-Za-z][）)]'),
  regexp_matches(t, '!{{3,}}|"{{3,}}|#{{3,}}|\${{3,}}|%{{3,}}|&{{3,}}|''{{3,}}|\({{3,}}|\){{3,}}|\*{{3,}}|\+{{3,}}|,{{3,}}|-{{3,}}|\.{{3,}}|/{{3,}}|:{{3,}}|;{{3,}}|<{{3,}}|={{3,}}|>{{3,}}|\?{{3,}}|@{{3,}}|\[{{3,}}|\\{{3,}}|\]{{3,}}|\^{{3,}}|`{{3,}}|\{{{{3,}}|\|{{3,}}|\}}{{3,}}|~{{3,}}')] AS f FROM n),
s AS (SELECT *, round((CASE WHEN f[1] THEN least(4.0, control * 2.0) ELSE 0 END) + (CASE WHEN f[2] THEN least(4.0, odd * 0.8) ELSE 0 END) + f[3]::INT * 2.0 + f[4]::INT * 1.5 + f[5]::INT * 2.0 + f[6]::INT * 1.5 + f[7]::INT * 1.5, 3) AS score FROM r)
SELECT doc_id, CAST(score AS DOUBLE) AS score, concat_ws(',', CASE WHEN f[1] THEN 'control_char' END, CASE WHEN f[2] THEN 'garbled_symbol_cluster' END, CASE WHEN f[3] THEN 'unexpected_symbol_ratio' END, CASE WHEN f[4] THEN 'symbol_heavy' END,
  CASE WHEN f[5] THEN 'abnormal_punctuation_cluster' END, CASE WHEN f[6] THEN 'single_letter_subfigure_marker' END, CASE WHEN f[7] THEN 'repeated_symbol_run' END) AS reasons,
  length(t) AS n, length(t) >= 4 AND score >= 4.0 AS needs_correction FROM s"""
CHARS = r"coalesce(length(regexp_replace(text, '\s+', '', 'g')), 0)"
PAGE_ROUTE = f"SELECT doc_id, {CHARS} AS native_chars, CASE WHEN {CHARS} >= 32 THEN 'native' ELSE 'ocr' END AS route FROM documents"
COVERAGE = f"SELECT source, count(*) AS pages, round(avg(CAST({CHARS} > 0 AS INT)), 9) AS coverage FROM documents GROUP BY source"
PAIRS = "greatest(0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) * greatest(0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y))"
OVERLAP_PAIRS = f"""WITH {BOXES}, p AS (
  SELECT a.document_id, a.page_number, a.seq AS a_seq, b.seq AS b_seq, {PAIRS} / greatest(1, a.w * a.h) AS a_ratio, {PAIRS} / greatest(1, b.w * b.h) AS b_ratio
  FROM boxes a JOIN boxes b USING (document_id, page_number) WHERE a.kind = 'figure' AND b.kind = 'text')
SELECT document_id, page_number, a_seq, b_seq, round(a_ratio, 6) AS a_ratio, round(b_ratio, 6) AS b_ratio FROM p WHERE a_ratio >= 0.1 OR b_ratio >= 0.1"""
BEST_OVERLAP = f"""WITH {BOXES}, p AS (
  SELECT a.document_id, a.page_number, a.seq, b.seq AS match_seq, {PAIRS} / greatest(1, b.w * b.h) AS ratio FROM boxes a JOIN boxes b USING (document_id, page_number) WHERE a.kind = 'figure' AND b.kind = 'text'),
r AS (SELECT *, row_number() OVER (PARTITION BY document_id, page_number, seq ORDER BY ratio DESC, match_seq) AS r FROM p WHERE ratio > 0)
SELECT document_id, page_number, seq, match_seq, round(ratio, 6) AS ratio FROM r WHERE r = 1"""
WIDE = "greatest(0, least(a.x + a.w, b.x + b.w * 4) - greatest(a.x, b.x)) * greatest(0, least(a.y + a.h, b.y + b.h * 4) - greatest(a.y, b.y)) / greatest(1, a.w * a.h)"
SUPPRESSED = f"""WITH {BOXES} SELECT document_id, page_number, seq FROM boxes a WHERE kind = 'text'
  AND NOT EXISTS (SELECT 1 FROM boxes b WHERE b.kind = 'figure' AND b.document_id = a.document_id AND b.page_number = a.page_number AND {WIDE} >= 0.5)"""
EXCLUSION = f"""WITH {BOXES}, o AS (SELECT *, seq % 5 = 0 AS m, w / 8 AS bw, (w / 8) * h / (550.0 * 120.0) AS share FROM boxes)
SELECT document_id, seq, CASE WHEN w - 22 <= 0 OR h <= 0 THEN 'invalid_pixel_size' WHEN (w - 22 < 8 OR h < 8) AND NOT m THEN 'tiny_decoration' WHEN share >= 0.9 AND NOT m THEN 'full_page_background' WHEN bw * h < 120 AND NOT m THEN 'tiny_decoration'
  WHEN (y + h <= 9.6 OR y >= 110.4) AND NOT m AND share < 0.05 THEN 'edge_icon' ELSE 'kept' END AS reason FROM o"""
ASSOCIATION = f"""WITH {BOXES}, p AS (
  SELECT a.document_id, a.page_number, a.seq AS a_seq, b.seq AS b_seq, CASE WHEN b.kind = 'text' THEN 1 ELSE 0 END AS kind_rank, b.y - (a.y + a.h) AS gap, abs((a.x + a.w / 2.0) - (b.x + b.w / 2.0)) AS center,
    greatest(0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) AS inter, a.w AS fw, b.w AS tw, b.y >= a.y + a.h * 0.5 AS below
  FROM boxes a JOIN boxes b USING (document_id, page_number) WHERE a.kind = 'figure' AND b.kind <> 'figure')
SELECT document_id, page_number, a_seq, b_seq, kind_rank, CAST(greatest(0, gap) AS DOUBLE) AS gap, round(center, 6) AS center FROM p
WHERE gap >= -4 AND gap <= CASE kind_rank WHEN 1 THEN 40 ELSE 48 END AND below AND (inter / fw >= 0.2 OR inter / tw >= 0.2 OR center <= 0.35 * fw)"""
CONTAINERS = f"""WITH {BOXES}, o AS (
  SELECT document_id // 10 AS document_id, page_number, document_id * 100 + seq AS seq, x, y, w * CASE WHEN seq % 4 = 0 THEN 5 ELSE 2 END AS w, h * CASE WHEN seq % 4 = 0 THEN 6 ELSE 2 END AS h FROM boxes),
p AS (SELECT a.document_id, a.page_number, a.seq, a.w AS aw, a.h AS ah, a.w * a.h AS area, {PAIRS} AS inter, b.x + b.w * 0.5 AS cx, b.y + b.h * 0.5 AS cy
  FROM o a JOIN o b USING (document_id, page_number) WHERE a.seq <> b.seq AND b.w * b.h < a.w * a.h * 0.9 AND {PAIRS} >= a.w * a.h * 0.18),
g AS (SELECT document_id, page_number, seq FROM p GROUP BY ALL HAVING count(*) >= 2 AND sum(inter) >= max(area) * 0.88 AND (max(cy) - min(cy) >= greatest(90.0, max(ah) * 0.18) OR max(cx) - min(cx) >= greatest(90.0, max(aw) * 0.18)))
SELECT document_id, page_number, seq FROM o ANTI JOIN g USING (document_id, page_number, seq)"""
NEAREST_CAPTION = f"""WITH {BOXES}, c AS (SELECT document_id, seq, '图' || (x % 9) || ' name' AS caption FROM boxes WHERE kind = 'caption' AND x % 3 <> 0),
v AS (SELECT document_id, seq, lag(seq) OVER w AS above, lead(seq) OVER w AS below FROM boxes WHERE kind = 'figure' WINDOW w AS (PARTITION BY document_id ORDER BY seq)),
p AS (SELECT v.document_id, v.seq, coalesce((SELECT max(c.seq) FROM c WHERE c.document_id = v.document_id AND c.seq < v.seq AND c.seq > coalesce(above, -1)), (SELECT min(c.seq) FROM c WHERE c.document_id = v.document_id AND c.seq > v.seq AND c.seq < coalesce(below, 1000000000))) AS caption_seq FROM v)
SELECT p.document_id AS entry_id, p.seq, caption_seq, caption FROM p JOIN c ON c.document_id = p.document_id AND c.seq = caption_seq"""
EDGES = f"""WITH {BOXES}, o AS (
  SELECT document_id, seq, round_even(x / 2.0, 0) AS l, round_even(y / 4.0, 0) AS t, round_even((x + w) / 2.0, 0) AS r, round_even((y + h) / 4.0, 0) AS b FROM boxes),
c AS (SELECT document_id, seq, greatest(0, least(l, 199)) AS x, greatest(0, least(t, 24)) AS y, greatest(1, r - l) AS w, greatest(1, b - t) AS h FROM o)
SELECT document_id, seq, CAST(x AS BIGINT) AS x, CAST(y AS BIGINT) AS y, CAST(greatest(1, least(w, greatest(1, 200 - x))) AS BIGINT) AS w, CAST(greatest(1, least(h, greatest(1, 25 - y))) AS BIGINT) AS h FROM c"""
RESOLVED = f"""WITH {REFS}, figs AS (SELECT *, count(*) OVER (PARTITION BY document_id, label) AS n FROM refs WHERE is_figure),
p AS (
  SELECT r.document_id, r.block_id, r.label, r.page_number, f.block_id AS t_id, f.page_number AS t_page, f.n, CASE WHEN f.page_number = r.page_number THEN 0 ELSE 1 END AS other,
    CASE WHEN f.n = 1 THEN 0.0 WHEN f.page_number = r.page_number THEN sqrt((r.cx - f.cx) * (r.cx - f.cx) + (r.cy - f.cy) * (r.cy - f.cy)) ELSE abs(f.page_number - r.page_number) END AS far
  FROM refs r JOIN figs f USING (document_id, label) WHERE NOT r.is_figure),
k AS (SELECT *, rank() OVER (PARTITION BY document_id, block_id ORDER BY other, far) AS k FROM p),
w AS (SELECT document_id, block_id, max(n) AS n, min(other) AS other, count(*) AS ties, min(t_id) AS t_id, min(t_page) AS t_page FROM k WHERE k = 1 GROUP BY ALL),
resolved AS (
  SELECT r.document_id, r.block_id, r.label, CASE WHEN ties IS NULL THEN 'unresolved' WHEN ties = 1 THEN 'resolved' ELSE 'ambiguous' END AS status, CASE WHEN ties = 1 THEN w.t_id ELSE -1 END AS target_id,
    CASE WHEN ties IS NULL THEN 'no_label_in_index' WHEN n = 1 THEN 'unique_target' WHEN ties = 1 THEN CASE WHEN other = 0 THEN 'nearest_same_page' ELSE 'nearest_page' END
      ELSE CASE WHEN other = 0 THEN 'tied_same_page_distance:' ELSE 'tied_page_distance:' END || ties END AS reason, CASE WHEN ties = 1 THEN w.t_page - r.page_number ELSE 0 END AS page_delta
  FROM refs r LEFT JOIN w USING (document_id, block_id) WHERE NOT r.is_figure)"""
RESOLVE = f"{RESOLVED} SELECT * FROM resolved"
REFERENCED_BY = f"{RESOLVED} SELECT document_id, target_id, count(*) AS n_refs, count(DISTINCT block_id) AS n_blocks, min(block_id) AS first_block FROM resolved WHERE status = 'resolved' GROUP BY document_id, target_id"
UNREFERENCED = f"{RESOLVED} SELECT f.document_id, f.block_id, f.label, f.page_number FROM figs f WHERE NOT EXISTS (SELECT 1 FROM resolved r WHERE r.document_id = f.document_id AND r.target_id = f.block_id)"
MERGED_LABELS = """WITH own AS (SELECT user_id AS document_id, event_id % 5 AS block_id, event_type AS key, CAST(event_id AS VARCHAR) AS raw, CASE WHEN event_id % 3 = 0 THEN 'native' ELSE 'ocr' END AS source, event_id FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY document_id, block_id, key ORDER BY CASE source WHEN 'native' THEN 0 ELSE 1 END, event_id) AS r FROM own)
SELECT document_id, block_id, key, raw, source FROM r WHERE r = 1"""
CLUSTERS = """WITH own AS (
  SELECT l_suppkey % 50 AS title, 'F' || (l_partkey % 40) AS label, l_orderkey % 97 AS page_number, min(l_orderkey) AS entry_no, count(*) AS n_images, count(*) FILTER (l_returnflag = 'A') AS n_captions FROM lineitem GROUP BY 1, 2, 3),
f AS (SELECT *, CASE WHEN page_number - lag(page_number) OVER (PARTITION BY title, label ORDER BY page_number, entry_no) > 2 THEN 1 ELSE 0 END AS new FROM own),
c AS (SELECT *, 1 + sum(new) OVER (PARTITION BY title, label ORDER BY page_number, entry_no) AS cluster FROM f)
SELECT title, label, CAST(cluster AS BIGINT) AS cluster, count(*) AS members, min(page_number) AS first_page, max(page_number) AS last_page, first(entry_no ORDER BY n_images DESC, n_captions DESC, page_number, entry_no) AS anchor_entry FROM c GROUP BY title, label, cluster"""
PAGE_WINDOW = f"""WITH {BOXES}, own AS (SELECT document_id // 100 AS doc, document_id % 100 + 1 AS page, document_id * 100 + seq AS item_id, kind FROM boxes)
SELECT i.item_id, count(*) AS candidates, CAST(sum(CASE WHEN i.page = e.page THEN 90 WHEN abs(i.page - e.page) <= 2 THEN 40 ELSE 15 END) AS BIGINT) AS bonus
FROM own i JOIN own e ON i.doc = e.doc AND abs(i.page - e.page) <= 3 WHERE i.kind = 'figure' AND e.kind = 'text' GROUP BY i.item_id"""
FRAGMENT_MATCHES = rf"""WITH n AS (SELECT conv_id, turn, role, trim(regexp_replace({NORMAL}, '\s+', ' ', 'g')) AS line FROM conversations),
w AS (SELECT *, replace(line, ' ', '') AS whole, list_filter(string_split(line, ' '), lambda x: length(x) >= 2) AS found FROM n),
t AS (SELECT conv_id, turn, unnest(CASE WHEN len(found) > 0 THEN found WHEN length(whole) >= 6 THEN [whole] ELSE [] END) AS token FROM w WHERE role = 'user'),
h AS (SELECT t.conv_id, t.turn AS fragment_id, e.turn AS entry_id, CAST(count(*) AS BIGINT) AS hits, sum(least(length(token), 12)) + CASE WHEN t.turn <= 0 OR e.turn <= 0 THEN 0 WHEN abs(t.turn - e.turn) <= 1 THEN 6 WHEN abs(t.turn - e.turn) <= 3 THEN 3 WHEN abs(t.turn - e.turn) <= 6 THEN 1 ELSE 0 END AS score
  FROM t JOIN w e ON e.conv_id = t.conv_id AND e.role <> 'user' AND contains(e.whole, token) GROUP BY t.conv_id, t.turn, e.turn),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, fragment_id ORDER BY score DESC, hits DESC, entry_id) AS r FROM h)
SELECT conv_id AS document_id, fragment_id, entry_id, CAST(score AS BIGINT) AS score, hits FROM r WHERE r = 1 AND (hits >= 2 OR score >= 10)"""
DOMINANT_PAGE = """WITH n AS (SELECT l_suppkey AS entry_id, l_orderkey % 30 AS page_number, count(*) AS n FROM lineitem WHERE l_orderkey % 30 > 0 GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY entry_id ORDER BY n DESC, page_number) AS r FROM n) SELECT entry_id, page_number FROM r WHERE r = 1"""
FILLED_ANCHORS = f"""WITH {BOXES}, o AS (SELECT *, CASE WHEN seq % 2 = 0 THEN 'a' || (x % 2) END AS anchor FROM boxes),
g AS (SELECT document_id, page_number, kind, min(anchor) AS one FROM o GROUP BY ALL HAVING count(DISTINCT anchor) = 1)
SELECT o.document_id, o.seq, coalesce(o.anchor, g.one) AS anchor FROM o LEFT JOIN g USING (document_id, page_number, kind)"""
LINKED_TITLES = "SELECT p_partkey, p_type AS title, max(p_partkey) OVER (PARTITION BY p_type) AS entry_id FROM part"
GRAMS = r"""grams AS (SELECT key, g AS gram, count(*) AS tf FROM (
  SELECT key, unnest(list_concat(list_concat(list_transform(range(1, length(t)), lambda i: substr(t, i, 2)), list_transform(range(1, length(t) - 1), lambda i: substr(t, i, 3))), list_transform(range(1, length(t) - 2), lambda i: substr(t, i, 4)))) AS g
  FROM (SELECT key, regexp_replace(lower(t), '\s\s+', ' ', 'g') AS t FROM texts)) GROUP BY 1, 2),
idf AS (SELECT gram, ln((1.0 + (SELECT count(*) FROM part)) / (1.0 + count(*))) + 1.0 AS idf FROM grams WHERE key >= 0 GROUP BY gram),
x AS (SELECT key, gram, tf * idf AS x FROM grams JOIN idf USING (gram)),
v AS (SELECT key, gram, x / sqrt(sum(x * x) OVER (PARTITION BY key)) AS x FROM x)"""
TFIDF = f"WITH texts AS (SELECT p_partkey AS key, p_name AS t FROM part), {GRAMS} SELECT key, count(*) AS grams, round(max(x), 6) AS top FROM v GROUP BY key"
TOP_K = f"""WITH texts AS (SELECT p_partkey AS key, p_name AS t FROM part UNION ALL SELECT -1 - n_nationkey, n_name FROM nation), {GRAMS},
s AS (SELECT -1 - q.key AS query, d.key, round(sum(d.x * q.x), 9) AS score FROM v d JOIN v q USING (gram) WHERE d.key >= 0 AND q.key < 0 GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, key) AS r FROM s)
SELECT query, key, round(score, 6) AS score FROM r WHERE r <= 20"""
KB_METRICS = rf"""{ENTRIES}, c AS (SELECT regexp_replace(regexp_replace(content, '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g') AS t, page_number FROM entries)
SELECT 'entries' AS name, CAST(count(*) AS DOUBLE) AS value FROM c UNION ALL SELECT 'pages', count(DISTINCT page_number) FROM c UNION ALL SELECT 'text_chars', sum(length(t)) FROM c UNION ALL SELECT 'empty_entries', count(*) FILTER (t = '') FROM c
UNION ALL SELECT 'blocks', count(*) FROM turns UNION ALL SELECT 'headings', count(*) FILTER (role = 'heading') FROM turns UNION ALL SELECT 'bodies', count(*) FILTER (role = 'body') FROM turns
UNION ALL SELECT 'assets', count(event_type) FROM events UNION ALL SELECT 'distinct_assets', count(DISTINCT event_type) FROM events UNION ALL SELECT 'repeated_assets', count(event_type) - count(DISTINCT event_type) FROM events"""
ENTRY_QUALITY = rf"{ENTRIES} SELECT document_id, position, CAST(round(least(0.98, 0.35 + CAST(trim(job_title) <> '' AS INT) * 0.30 + CAST(length(regexp_replace(content, '^\s+|\s+$', '', 'g')) >= 8 AS INT) * 0.25 + 0.10), 3) AS DOUBLE) AS quality FROM entries"
STRUCTURE = rf"{ENTRIES} SELECT document_id, round(least(0.99, 0.1 + 0.55 * avg(CAST(job_title NOT LIKE 'Page %' AS INT)) + 0.35 * avg(CAST(length(regexp_replace(content, '^\s+|\s+$', '', 'g')) >= 8 AS INT))), 6) AS confidence, count(*) AS entries FROM entries GROUP BY document_id"
DIGEST = rf"{ENTRIES} SELECT document_id, sha256(string_agg(regexp_replace(regexp_replace(content, '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g'), chr(10) ORDER BY position)) AS sha256 FROM entries GROUP BY document_id"
TABLE_GEOMETRY = f"WITH {CELLS} SELECT table_id, max(row + row_span) AS rows, max(col + col_span) AS cols, count(*) AS physical, count(*) FILTER (row_span > 1 OR col_span > 1) AS spanned, count(*) FILTER (text <> '') AS nonempty FROM other GROUP BY table_id"
KEYED_DIFF = f"""WITH {CELLS}, b AS (
  SELECT coalesce(o.table_id, n.table_id) AS table_id, coalesce(o.row, n.row) AS row, coalesce(o.col, n.col) AS col, o.text AS old_text, n.text AS new_text,
    concat_ws(',', CASE WHEN o.row_span <> n.row_span THEN 'row_span' END, CASE WHEN o.col_span <> n.col_span THEN 'col_span' END, CASE WHEN o.text <> n.text THEN 'text' END) AS f
  FROM own o FULL JOIN other n ON o.table_id = n.table_id AND o.row = n.row AND o.col = n.col),
s AS (SELECT *, CASE WHEN new_text IS NULL THEN 'only_old' WHEN old_text IS NULL THEN 'only_new' WHEN f = '' THEN 'same' ELSE 'changed' END AS status FROM b)
SELECT table_id, row, col, status, CASE WHEN status = 'changed' THEN f END AS fields, old_text, new_text FROM s"""
MARKDOWN = f"""WITH {CELLS} SELECT table_id, string_agg('| ' || text || ' |' || CASE WHEN row = 0 THEN chr(10) || '| --- |' ELSE '' END, chr(10) ORDER BY row) AS markdown, count(*) AS n_rows FROM own GROUP BY table_id"""
WORD_LINES = f"""WITH {BOXES} SELECT document_id AS figure_id, page_number AS line_num, string_agg('w' || seq, ' ' ORDER BY x, y, 'w' || seq) AS text, round(avg(CASE WHEN score % 100 - 5 >= 0 THEN score % 100 - 5 END), 6) AS mean_confidence,
  min(x) AS x, min(y) AS y, max(x + w) - min(x) AS w, max(y + h) - min(y) AS h FROM boxes GROUP BY document_id, page_number"""
ADJUDICATED = """WITH own AS (SELECT user_id AS figure_id, CASE WHEN event_type = 'view' THEN '' ELSE event_type END AS label, event_id % 101 AS confidence, event_id % 7 AS roi, event_id AS psm FROM events),
g AS (SELECT figure_id, count(DISTINCT CASE WHEN confidence >= 60 AND label <> '' THEN label END) AS labels, first(label ORDER BY confidence DESC, roi, psm) AS best, count(*) AS attempts FROM own GROUP BY figure_id),
s AS (SELECT *, CASE WHEN labels > 1 THEN 'ambiguous_multiple_labels' WHEN best = '' THEN 'empty' WHEN labels = 1 THEN 'linked' ELSE 'rejected' END AS status FROM g)
SELECT figure_id, status, CASE WHEN status = 'linked' THEN best END AS label, attempts FROM s"""
SHADOW = """WITH a AS (SELECT o_orderpriority AS name, CAST(count(*) AS DOUBLE) AS v FROM orders GROUP BY 1 HAVING name NOT LIKE '1%'), b AS (SELECT o_orderpriority AS name, CAST(count(*) FILTER (o_orderstatus = 'O') AS DOUBLE) AS v FROM orders GROUP BY 1 HAVING name NOT LIKE '5%')
SELECT coalesce(a.name, b.name) AS name, a.v AS old, b.v AS new, b.v - a.v AS delta, a.v IS NOT NULL AND b.v IS NOT NULL AS compared FROM a FULL JOIN b ON a.name = b.name"""
MISMATCHES = "WITH n AS (SELECT CAST(l_suppkey AS VARCHAR) AS name, count(*) AS c FROM lineitem GROUP BY 1) SELECT name, c + 1 AS reported, c AS counted FROM n WHERE c % 3 = 0"
VIOLATIONS = """SELECT c_custkey, unnest(list_filter([CASE WHEN NOT c_acctbal >= 0 THEN 'balance' END, CASE WHEN NOT length(c_name) > 0 THEN 'name' END, CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN 'segment' END, CASE WHEN NOT c_nationkey < 20 THEN 'nation' END], lambda r: r IS NOT NULL)) AS rule FROM customer"""
FIRST_BY_KEY = f"WITH {BOXES}, r AS (SELECT *, row_number() OVER (PARTITION BY document_id, kind ORDER BY page_number, seq) AS r FROM boxes) SELECT document_id, kind, seq FROM r WHERE r = 1"
BUDGET = "WITH r AS (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rank FROM part) SELECT * FROM r WHERE rank <= 5"
PRELIMINARY = r"""WITH own AS (
  SELECT doc_id, doc_id % 6 + 1 AS page, len(regexp_extract_all(text, '[.·…]{4,}\s*[0-9]+')) >= 3 AS toc, len(list_filter(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g') <> '')) AS n, regexp_matches(text, '(?m)^[0-9]{1,3}[.、)]') AS numbered FROM documents),
p AS (SELECT doc_id, toc, NOT numbered AND (toc OR page <= 3 AND n <= 2) AS preliminary FROM own)
SELECT doc_id, preliminary, CAST(CASE WHEN preliminary AND toc THEN 0.0 WHEN preliminary THEN 0.15 ELSE 1.0 END AS DOUBLE) AS search_weight FROM p"""
IN_SCOPE = "SELECT p_partkey FROM part WHERE (contains(p_brand, '1') OR contains(p_brand, '2')) AND (contains(p_name, 'a') OR contains(p_name, 'e')) AND (CAST(p_partkey AS VARCHAR) LIKE '1%' OR CAST(p_partkey AS VARCHAR) LIKE '3%')"
EFFECTIVE = rf"""WITH {LINES}, o AS (
  SELECT doc_id, reading_order, text, length(regexp_replace(text, '[^0-9A-Za-z]', '', 'g')) AS alnum, length(regexp_replace(text, '[\p{{L}}\p{{N}}_一-鿿]', '', 'g')) AS odd FROM lines)
SELECT doc_id AS document_id, reading_order, text NOT IN ('[]', '{{}}', 'null', 'None', 'nan', 'N/A') AND length(text) > 1 AND (regexp_matches(text, '[一-鿿]') OR alnum >= 3 AND odd <= greatest(2, length(text) // 2)) AS ok FROM o"""
FALLBACK = r"""WITH n AS (SELECT *, trim(regexp_replace(regexp_replace(p_name, '[^\p{L}\p{N}]', ' ', 'g'), ' +', ' ', 'g')) AS name, trim(regexp_replace(regexp_replace(p_type, '[^\p{L}\p{N}]', ' ', 'g'), ' +', ' ', 'g')) AS kind,
  trim(regexp_replace(regexp_replace(string_split(p_name, ' ')[1], '[^\p{L}\p{N}]', ' ', 'g'), ' +', ' ', 'g')) AS key FROM part),
p AS (SELECT i.p_partkey AS item_id, e.p_partkey AS entry_id, e.p_size AS position, e.p_size % 30 = i.p_partkey % 30 AS dominant,
  floor((CASE WHEN i.key <> '' AND contains(e.name, i.key) THEN 120 ELSE 0 END + CASE WHEN i.key <> '' AND contains(e.kind, i.key) THEN 60 ELSE 0 END) * CASE WHEN length(i.key) < 3 THEN 0.5 ELSE 1 END) AS score
  FROM n i JOIN n e ON i.p_partkey // 90 = e.p_partkey // 90 AND i.p_partkey % 30 = e.p_partkey % 30),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, dominant DESC, position, entry_id) AS r FROM p)
SELECT item_id, entry_id, CASE WHEN score > 0 THEN 'heading' WHEN dominant THEN 'dominant_page' ELSE 'position' END AS method FROM r WHERE r = 1"""
PAGE_OWNERS = f"""WITH {BOXES}, o AS (SELECT o_orderkey % 500 AS doc, o_orderkey % 7 AS page, max(o_orderkey) AS owner FROM orders GROUP BY 1, 2),
b AS (SELECT boxes.document_id AS entry_id, abs(x % 9 - boxes.document_id % 7) > 1 AND owner IS NOT NULL AND owner <> boxes.document_id AS moved, owner FROM boxes LEFT JOIN o ON boxes.document_id % 500 = doc AND x % 9 = page)
SELECT CASE WHEN moved THEN owner ELSE entry_id END AS entry_id, count(*) AS n, count(*) FILTER (moved) AS n_moved FROM b GROUP BY 1"""
ATTACHED = f"""WITH {BOXES}, m AS (SELECT document_id, seq AS block_seq, row_number() OVER (PARTITION BY document_id ORDER BY seq) AS n FROM boxes WHERE kind = 'text' AND x % 3 <> 0),
s AS (SELECT document_id, seq, CAST(x AS VARCHAR) AS uri, row_number() OVER (PARTITION BY document_id ORDER BY seq) AS n FROM boxes WHERE kind = 'figure')
SELECT s.document_id AS entry_id, s.seq, s.uri, coalesce(m.block_seq, -1) AS block_seq FROM s LEFT JOIN m USING (document_id, n)"""
WEIGHTED = r"""WITH t AS (SELECT p_brand AS key, regexp_replace(lower(p_name), '\s\s+', ' ', 'g') AS t, CASE p_size % 4 WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 1 END AS w FROM part WHERE p_size % 4 <> 2),
g AS (SELECT key, w, unnest(list_concat(list_concat(list_transform(range(1, length(t)), lambda i: substr(t, i, 2)), list_transform(range(1, length(t) - 1), lambda i: substr(t, i, 3))), list_transform(range(1, length(t) - 2), lambda i: substr(t, i, 4)))) AS gram FROM t)
SELECT key, count(DISTINCT gram) AS grams, CAST(sum(w) AS BIGINT) AS weight FROM g GROUP BY key"""
NEXT_NUMBERS = """SELECT p_partkey, p_size || '.' || CASE WHEN p_partkey % 2 = 0 THEN p_partkey % 30 + 1 ELSE 1 END AS next, p_size || '.' || (p_partkey % 9) || '.2' AS clause FROM part"""
STYLE = rf"""WITH {LINES}, n AS (
  SELECT doc_id AS document_id, count(*) FILTER (regexp_matches(text, '^[AT]')) AS articles, count(*) FILTER (regexp_matches(text, '^[EO]n')) AS appendices, count(*) FILTER (regexp_matches(text, '(?i)^the ')) AS chapters, count(*) FILTER (regexp_matches(text, '[0-9]')) AS sections FROM lines GROUP BY 1)
SELECT *, CASE WHEN articles >= 3 AND appendices >= 1 THEN 'table_appended_regulatory' WHEN articles >= 3 OR chapters >= 1 OR sections >= 2 THEN 'rule_provisions' ELSE 'standard_text' END AS style FROM n"""
CLUSTER_KEYS = "SELECT p_partkey, replace(p_type, ' ', '') AS key FROM part"

# fixed texts, each with what the rules make of it; parts stand for their rows
TEXTS = ("Cafe\u0301，图 1-2 与表３", "图1.1 图11 附图二", "检查 设备 隔离开关\u3000的A\u030a", "\uf900\n  - x", "")


def literal(values: tuple) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" if isinstance(v, str) else f"{v}::DOUBLE" if isinstance(v, float) else str(v) for v in values) + "]"


def picked(*lists: tuple, table: str = "part") -> str:
    columns = ", ".join(f"{literal(v)}[1 + p_partkey % {len(v)}] AS c{i}" for i, v in enumerate(lists))
    return f"SELECT p_partkey, {columns} FROM {table}"


CHINESE_NORMAL = picked(("Café 图 1 2 与表３", "图1 1 图11 附图二", "检查 设备 隔离开关 的Å", "豈\nx", ""), ("Café图12与表３", "图11图11附图二", "检查设备隔离开关的Å", "豈x", ""), ("图12", "图11,附图二", "", "", ""), ("Café,与表３", "图1,图11,附图二", "隔离开关,的Å", "", ""))
CHINESE_NORMAL = f"SELECT p_partkey, c0 AS normal, c1 AS anchor, c2 AS labels, c3 AS tokens FROM ({CHINESE_NORMAL})"
ANCHORS = """SELECT p_partkey, ['none', 'article', 'appendix', 'none'][1 + p_partkey % 4] AS kind, CAST(CASE WHEN p_partkey % 4 IN (1, 2) THEN p_size % 20 + 1 ELSE 0 END AS BIGINT) AS value, ['', '规定', '说明', ''][1 + p_partkey % 4] AS rest FROM part"""
BLOCK_TEXTS = ("铁路电力管理规则", "2用于变电所倒闸作业", "5.1一般规定", "规程另发单行本。", "图1 系统结构", "第三章总则", "-2-", "DN100", "附注", "The quick brown fox jumps over the lazy dog again", "（1）检查", "", "铁路电力管理规则")
BLOCK_SIZES = (21.95, 11.0, 12.0, 11.0, 11.0, 11.0, 11.0, 11.0, 11.0, 11.0, 11.0, 11.0, 10.0)
_ROLES = ("heading", "body", "heading", "body", "caption", "heading", "figure_callout", "figure_callout", "table_note", "artifact", "body", "artifact", "body")
_PLAIN = ("body", *_ROLES[1:])
_DOCUMENT = ("body", "heading", "heading", "body", "caption", "heading", "figure_callout", "figure_callout", "table_note", "body", "figure_callout", "artifact", "body")
PAGE_ROLES = f"SELECT p_partkey, c0 AS role, c1 AS plain_role, c2 AS document_role FROM ({picked(_ROLES, _PLAIN, _DOCUMENT)})"
MARK_TEXTS = ("·2·", "第 2 页", "Page 2", "-2-", "2", "2", "１２３", "12/30", "第二页", "p.7", "Page 1 of 10")
MARK_PLACES = (180.0, 180.0, 180.0, 180.0, 320.0, 180.0, 10.0, 180.0, 180.0, 180.0, 180.0)
_MARKED = (True, True, True, True, True, False, True, True, False, True, False)
_LOOSE = (True, True, True, True, False, False, True, True, False, False, True)
PAGE_MARKERS = f"SELECT p_partkey, c0 AS marker, c1 AS loose FROM ({picked(_MARKED, _LOOSE)})"
CAPTION_TEXTS = ("图 12 示意图其中开关", "图3", "说明文字图3", "前面很长的说明图3", "图4 布置 ① 开关", "图5 简图", "表6 明细当时", "图7 甲。乙", "附图 八 结构：其中")
CAPTIONS = f"SELECT p_partkey, c0 AS figure, c1 AS \"table\" FROM ({picked(('图12 示意图', '图3', '图3', '', '图4 布置', '图5 简图', '', '图7', '附图八 结构'), ('', '', '', '', '', '', '表6 明细', '', ''))})"
APPROVED = """WITH a AS (SELECT p_partkey, p_size % 3 AS c, p_name AS t, string_split(p_name, ' ')[1] AS f FROM part),
b AS (SELECT *, CASE WHEN c > 1 AND f <> '' THEN 'FIRST' || substr(t, length(f) + 1) ELSE t END AS t1 FROM a),
d AS (SELECT *, CASE WHEN c + 1 > 1 AND contains(t1, 'FIRST') THEN replace(t1, 'FIRST', 'once') ELSE t1 END AS t2 FROM b)
SELECT p_partkey AS entry_id, CASE WHEN c > 1 AND contains(t2, 'e') THEN substr(t2, 1, instr(t2, 'e') - 1) || 'E' || substr(t2, instr(t2, 'e') + 1) ELSE t2 END AS content,
  c > 1 AND f <> '' OR c + 1 > 1 AND contains(t1, 'FIRST') OR c > 1 AND contains(t2, 'e') AS fixed FROM d"""


def soft_wrapped(own: str, key: str) -> str:
    """Lines of own(key, t) as rows key, line, in one table `joined` of the lines that stay apart."""
    return rf"""cut AS (SELECT {key}, unnest(range(1, len(string_split(t, chr(10))) + 1)) AS i, unnest(string_split(t, chr(10))) AS raw FROM ({own})),
kept AS (SELECT {key}, i, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS line FROM cut WHERE regexp_replace(raw, '^\s+|\s+$', '', 'g') <> ''),
marked AS (SELECT *, lag(line) OVER (PARTITION BY {key} ORDER BY i) AS before FROM kept),
broken AS (SELECT *, sum(CASE WHEN before IS NULL OR regexp_matches(before, '[。！？!?；;：:.]$') OR regexp_matches(line, '^([0-9]+[.、)）]|[-•·])') THEN 1 ELSE 0 END) OVER (PARTITION BY {key} ORDER BY i) AS n FROM marked),
joined AS (SELECT {key}, n, string_agg(line, ' ' ORDER BY i) AS line FROM broken GROUP BY {key}, n)"""


SOFT_WRAPPED = f"""WITH {soft_wrapped("SELECT doc_id, coalesce(text, '') AS t FROM documents", "doc_id")}
SELECT d.doc_id, count(line) AS n_lines, coalesce(string_agg(line, chr(10) ORDER BY n), '') AS text FROM documents d LEFT JOIN joined USING (doc_id) GROUP BY d.doc_id"""
CLEANED = r"""SELECT page_id, regexp_replace(regexp_replace(url || ' a' || chr(10) || 'b c' || chr(10) || html, '(?i)学兔兔|www\.bzfxw\.com|标准分享网|建设工程教育网|建筑标准库|工标网', '', 'g'), '(?i)(https?://\S+)|(www\.\S+\.\S+)', '', 'g') AS t FROM pages"""
CLEAN_TEXT = f"""WITH {soft_wrapped(CLEANED, "page_id")} SELECT p.page_id, coalesce(string_agg(line, chr(10) ORDER BY n), '') AS text FROM pages p LEFT JOIN joined USING (page_id) GROUP BY p.page_id"""
HTML_BLOCKS = r"""WITH f AS (SELECT page_id, regexp_extract_all(html, '(?s)<(?:h1|p|nav|footer)[ >].*?</(?:h1|p|nav|footer)>') AS f FROM pages),
r AS (SELECT page_id, unnest(f) AS raw, unnest(range(1, len(f) + 1)) AS reading_order FROM f)
SELECT page_id AS document_id, CAST(1 AS BIGINT) AS page_number, reading_order, CASE regexp_extract(raw, '^<([a-z0-9]+)', 1) WHEN 'h1' THEN 'heading' WHEN 'p' THEN 'body' ELSE 'artifact' END AS role,
  regexp_replace(regexp_replace(regexp_replace(raw, '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'), '^ | $', '', 'g') AS text FROM r"""
SHARED = "greatest(0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) * greatest(0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y))"
KEPT = f"""WITH RECURSIVE {BOXES}, r AS (SELECT *, row_number() OVER (PARTITION BY document_id, page_number ORDER BY (order)) AS n FROM boxes),
walk AS (
  SELECT document_id, page_number, CAST(0 AS BIGINT) AS n, CAST([] AS BIGINT[]) AS kept, FALSE AS stays FROM boxes GROUP BY document_id, page_number
  UNION ALL
  SELECT document_id, page_number, n, CASE WHEN gone THEN kept ELSE list_append(kept, n) END, NOT gone FROM (
    SELECT w.document_id, w.page_number, w.n + 1 AS n, w.kept, EXISTS (SELECT 1 FROM r b WHERE b.document_id = w.document_id AND b.page_number = w.page_number AND list_contains(w.kept, b.n) AND (drops)) AS gone
    FROM walk w JOIN r a ON a.document_id = w.document_id AND a.page_number = w.page_number AND a.n = w.n + 1))
SELECT r.document_id, r.page_number, r.seq, r.kind, r.x, r.y, r.w, r.h, r.score FROM r JOIN walk USING (document_id, page_number, n) WHERE stays"""
UNION_SHARE = f"({SHARED}) / CAST(a.w * a.h + b.w * b.h - {SHARED} AS DOUBLE)"
WITHIN = "a.x >= b.x - {0} AND a.y >= b.y - {0} AND a.x + a.w <= b.x + b.w + {0} AND a.y + a.h <= b.y + b.h + {0}"
NMS = KEPT.replace("(order)", "score DESC, seq").replace("(drops)", f"{UNION_SHARE} >= 0.2")
PRUNED = KEPT.replace("(order)", "w * h DESC, y, x, seq").replace("(drops)", f"({UNION_SHARE} >= 0.82 OR {WITHIN.format(8)})")
NESTED = KEPT.replace("(order)", "w * h DESC, y, x, seq").replace("(drops)", f"{WITHIN.format(18)} AND a.w * a.h <= 0.8 * greatest(1, b.w * b.h)")
FIRST_FIT = """q AS (SELECT *, row_number() OVER (PARTITION BY document_id, page_number ORDER BY (order)) AS n FROM p),
walk AS (
  SELECT document_id, page_number, CAST(0 AS BIGINT) AS n, CAST([] AS BIGINT[]) AS left_used, CAST([] AS BIGINT[]) AS right_used, FALSE AS taken FROM p GROUP BY document_id, page_number
  UNION ALL
  SELECT document_id, page_number, n, CASE WHEN ok AND counts THEN list_append(left_used, a_seq) ELSE left_used END, CASE WHEN ok THEN list_append(right_used, b_seq) ELSE right_used END, ok FROM (
    SELECT w.*, q.a_seq, q.b_seq, (counts) AS counts, NOT list_contains(w.right_used, q.b_seq) AND NOT ((counts) AND list_contains(w.left_used, q.a_seq)) AS ok, q.n AS m FROM walk w JOIN q ON q.document_id = w.document_id AND q.page_number = w.page_number AND q.n = w.n + 1)
    t(document_id, page_number, n0, left_used, right_used, taken, a_seq, b_seq, counts, ok, n)),
link AS (SELECT q.* FROM q JOIN walk USING (document_id, page_number, n) WHERE taken)"""
ASSOCIATE = ASSOCIATION.replace("WITH boxes", "WITH RECURSIVE boxes").replace("p AS (", "p0 AS (", 1).replace("center FROM p\n", "center FROM p0\n").replace("\nSELECT document_id, page_number, a_seq", ",\np AS (SELECT document_id, page_number, a_seq", 1).replace("round(center, 6) AS center", "center")
ASSOCIATE = ASSOCIATE + "),\n" + FIRST_FIT.replace("(order)", "kind_rank, gap, center, a_seq, b_seq").replace("(counts)", "q.kind_rank = 0") + "\nSELECT document_id, page_number, a_seq AS figure_seq, b_seq AS text_seq, CASE kind_rank WHEN 1 THEN 'legend' ELSE 'caption' END AS kind FROM link"
OVERLAPPING = f"p AS (SELECT a.document_id, a.page_number, a.seq AS a_seq, b.seq AS b_seq FROM boxes a JOIN boxes b USING (document_id, page_number) WHERE a.kind = 'figure' AND b.kind = '(kind)' AND ({SHARED} >= (least) * greatest(1, a.w * a.h) OR {SHARED} >= (least) * greatest(1, b.w * b.h)))"
MERGED_TABLES = f"""WITH RECURSIVE {BOXES}, {OVERLAPPING.replace("(kind)", "caption").replace("(least)", "0.1")},
{FIRST_FIT.replace("(order)", "a_seq, b_seq").replace("(counts)", "TRUE")}
SELECT a.document_id, a.page_number, a.seq, CASE WHEN b.w * b.h > a.w * a.h THEN b.x ELSE a.x END AS x, CASE WHEN b.w * b.h > a.w * a.h THEN b.y ELSE a.y END AS y, CASE WHEN b.w * b.h > a.w * a.h THEN b.w ELSE a.w END AS w, CASE WHEN b.w * b.h > a.w * a.h THEN b.h ELSE a.h END AS h,
  'structured' AS status, b.seq IS NOT NULL AS visual_matched
FROM boxes a LEFT JOIN link l ON l.document_id = a.document_id AND l.page_number = a.page_number AND l.a_seq = a.seq LEFT JOIN boxes b ON b.document_id = a.document_id AND b.page_number = a.page_number AND b.seq = l.b_seq WHERE a.kind = 'figure'
UNION ALL SELECT b.document_id, b.page_number, b.seq, b.x, b.y, b.w, b.h, 'image_only', TRUE FROM boxes b LEFT JOIN link l ON l.document_id = b.document_id AND l.page_number = b.page_number AND l.b_seq = b.seq WHERE b.kind = 'caption' AND l.b_seq IS NULL"""
VERSIONS = f"""WITH RECURSIVE {BOXES}, o AS (SELECT *, row_number() OVER (PARTITION BY document_id, page_number ORDER BY seq) AS n FROM boxes WHERE kind = 'figure'),
v AS (SELECT *, row_number() OVER (PARTITION BY document_id, page_number ORDER BY seq) AS n FROM boxes WHERE kind = 'text'),
walk AS (
  SELECT document_id, page_number, CAST(0 AS BIGINT) AS n, CAST([] AS BIGINT[]) AS used, CAST(NULL AS BIGINT) AS match, '' AS method FROM o GROUP BY document_id, page_number
  UNION ALL
  SELECT document_id, page_number, n, CASE WHEN hit IS NOT NULL THEN list_append(used, hit) WHEN same THEN list_append(used, n) ELSE used END, CASE WHEN hit IS NOT NULL THEN hit WHEN same THEN n END, CASE WHEN hit IS NOT NULL THEN 'page+bbox' WHEN same THEN 'page+order' ELSE 'unmatched' END FROM (
    SELECT w.document_id, w.page_number, a.n, w.used, (SELECT min(b.n) FROM v b WHERE b.document_id = a.document_id AND b.page_number = a.page_number AND NOT list_contains(w.used, b.n) AND ({SHARED} > 0 AND ({SHARED} >= 0.3 * greatest(1, a.w * a.h) OR {SHARED} >= 0.3 * greatest(1, b.w * b.h)))) AS hit,
      EXISTS (SELECT 1 FROM v c WHERE c.document_id = a.document_id AND c.page_number = a.page_number AND c.n = a.n) AND NOT list_contains(w.used, a.n) AS same
    FROM walk w JOIN o a ON a.document_id = w.document_id AND a.page_number = w.page_number AND a.n = w.n + 1)),
taken AS (SELECT w.document_id, w.page_number, o.seq AS old_seq, v.seq AS new_seq, w.method FROM walk w JOIN o USING (document_id, page_number, n) LEFT JOIN v ON v.document_id = w.document_id AND v.page_number = w.page_number AND v.n = w.match)
SELECT document_id, page_number, old_seq, coalesce(new_seq, -1) AS new_seq, method FROM taken
UNION ALL SELECT document_id, page_number, -1, seq, 'unmatched' FROM v WHERE NOT EXISTS (SELECT 1 FROM taken t WHERE t.document_id = v.document_id AND t.page_number = v.page_number AND t.new_seq = v.seq)"""
FRAGMENTS = f"""WITH RECURSIVE {BOXES}, e AS (
  SELECT a.document_id, a.page_number, a.seq AS i, b.seq AS j FROM boxes a JOIN boxes b USING (document_id, page_number) WHERE a.seq = b.seq OR {SHARED} >= 0.3 * greatest(1, a.w * a.h) OR {SHARED} >= 0.3 * greatest(1, b.w * b.h)
    OR greatest(0, least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y)) / greatest(1, least(a.h, b.h)) >= 0.28 AND greatest(a.x, b.x) - least(a.x + a.w, b.x + b.w) <= 18
    OR greatest(0, least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x)) / greatest(1, least(a.w, b.w)) >= 0.38 AND greatest(a.y, b.y) - least(a.y + a.h, b.y + b.h) <= 18),
reach AS (SELECT document_id, page_number, i, j FROM e UNION SELECT r.document_id, r.page_number, r.i, e.j FROM reach r JOIN e ON e.document_id = r.document_id AND e.page_number = r.page_number AND e.i = r.j),
g AS (SELECT document_id, page_number, i AS seq, min(j) AS group_seq FROM reach GROUP BY document_id, page_number, i)
SELECT document_id, page_number, group_seq, count(*) AS members, min(x) - 6 AS x, min(y) - 6 AS y, max(x + w) + 12 - min(x) AS w, max(y + h) + 12 - min(y) AS h FROM g JOIN boxes USING (document_id, page_number, seq) GROUP BY document_id, page_number, group_seq"""

BLOCK_COUNTERS = f"""{RESOLVED}, src AS (SELECT row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_shipdate) AS n, l_linenumber = 3 AS t, l_linenumber >= 5 AS p, l_suppkey % 2 = l_linenumber % 2 AS uri, l_quantity > 40 AS gone, l_partkey % 10 < 7 AS structured,
  l_partkey AS figure, l_linenumber % 2 = 0 AS caption, l_quantity % 3 = 0 AS ocr FROM lineitem),
counted AS (SELECT count(*) FILTER (t) AS tables, count(*) FILTER (t AND structured) AS tables_structured, count(*) FILTER (t AND NOT structured) AS tables_image_only, coalesce(sum(n % 5) FILTER (t AND structured), 0) AS table_cells, count(*) FILTER (t AND NOT uri) AS table_assets_missing,
  count(*) FILTER (p) AS images, count(*) FILTER (p AND (gone OR NOT uri)) AS images_missing, count(*) FILTER (p AND uri AND NOT gone AND n % 3 = 0) AS images_embedded, count(*) FILTER (p AND uri AND NOT gone AND n % 3 = 1) AS images_cropped,
  least(1, count(*) FILTER (p AND uri AND NOT gone)) AS image_uris, greatest(0, count(*) FILTER (p AND uri AND NOT gone) - 1) AS image_uris_repeated,
  count(DISTINCT figure) FILTER (caption AND NOT ocr) AS figures_with_native_caption, count(*) FILTER (caption AND NOT ocr) AS native_captions_linked, count(DISTINCT figure) FILTER (NOT caption AND NOT ocr) AS figures_with_native_legend, count(*) FILTER (NOT caption AND NOT ocr) AS native_legends_linked,
  count(DISTINCT figure) FILTER (caption AND ocr) AS figures_with_ocr_caption, count(*) FILTER (caption AND ocr) AS ocr_captions_linked FROM src),
kinds AS (SELECT count(*) AS "references", count(*) FILTER (status = 'resolved') AS references_resolved, count(*) FILTER (status = 'unresolved') AS references_unresolved, count(*) FILTER (status = 'ambiguous') AS references_ambiguous, count(DISTINCT (document_id, target_id)) FILTER (status = 'resolved') AS referenced_figures FROM resolved),
found AS (SELECT name, CAST(value AS DOUBLE) AS value FROM (UNPIVOT (SELECT COLUMNS(*)::DOUBLE FROM counted) ON COLUMNS(*) INTO NAME name VALUE value))
SELECT name, value FROM found UNION ALL SELECT name, value FROM (UNPIVOT (SELECT COLUMNS(*)::DOUBLE FROM kinds) ON COLUMNS(*) INTO NAME name VALUE value)"""

HEADING_HINTS = f"""WITH RECURSIVE {BOXES}, h AS (SELECT document_id AS d, seq AS page, seq, 't' || seq AS heading, kind FROM boxes WHERE kind = 'text'),
c AS (SELECT document_id AS d, seq AS page, seq, kind, row_number() OVER (PARTITION BY document_id ORDER BY seq) AS n FROM boxes WHERE kind <> 'text'),
walk AS (
  SELECT d, CAST(0 AS BIGINT) AS n, CAST([] AS BIGINT[]) AS used, CAST(NULL AS BIGINT) AS pick FROM c GROUP BY d
  UNION ALL
  SELECT d, n, CASE WHEN pick IS NULL THEN used ELSE list_append(used, pick) END, pick FROM (
    SELECT w.d, c.n, w.used, (SELECT min(CASE WHEN h.kind <> c.kind THEN 1000000000000 ELSE 0 END + abs(h.page - c.page) * 1000000000 + h.page * 1000000 + h.seq) FROM h WHERE h.d = c.d AND abs(h.page - c.page) <= 2 AND NOT list_contains(w.used, h.seq)) % 1000000 AS pick
    FROM walk w JOIN c ON c.d = w.d AND c.n = w.n + 1))
SELECT c.d AS document_id, c.page AS page_number, c.seq, h.page AS hint_page, h.heading FROM walk w JOIN c USING (d, n) JOIN h ON h.d = w.d AND h.seq = w.pick"""
CELL_DIFF = f"""{KEYED_DIFF[: KEYED_DIFF.rindex("SELECT table_id")].replace("WITH ", "WITH RECURSIVE ", 1).rstrip()},
k AS (SELECT *, row_number() OVER (PARTITION BY table_id ORDER BY row, col) AS i FROM s),
walk AS (
  SELECT table_id, CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS old_used, CAST([] AS BIGINT[]) AS new_used, FALSE AS taken, CAST(NULL AS BIGINT) AS free FROM k GROUP BY table_id
  UNION ALL
  SELECT table_id, i, list_concat(old_used, CASE WHEN status <> 'only_new' THEN [i] WHEN free IS NOT NULL THEN [free] ELSE [] END), list_concat(new_used, CASE WHEN status <> 'only_old' THEN [i] WHEN free IS NOT NULL THEN [free] ELSE [] END), taken, free FROM (
    SELECT *, CASE WHEN taken THEN NULL WHEN status = 'only_old' THEN (SELECT min(x.i) FROM k x WHERE x.table_id = t.table_id AND x.new_text = t.old_text AND NOT list_contains(t.new_used, x.i)) WHEN status = 'only_new' THEN (SELECT min(x.i) FROM k x WHERE x.table_id = t.table_id AND x.old_text = t.new_text AND NOT list_contains(t.old_used, x.i)) END AS free FROM (
      SELECT w.table_id, k.i, w.old_used, w.new_used, k.status, k.old_text, k.new_text, k.status = 'only_old' AND list_contains(w.old_used, k.i) OR k.status = 'only_new' AND list_contains(w.new_used, k.i) AS taken FROM walk w JOIN k ON k.table_id = w.table_id AND k.i = w.i + 1) t))
SELECT k.table_id, k.row, k.col, CASE WHEN w.taken THEN 'taken' WHEN w.free IS NOT NULL THEN 'moved' ELSE k.status END AS status, CASE WHEN w.free IS NOT NULL THEN 'position' WHEN k.status = 'changed' THEN k.f END AS fields, k.old_text, k.new_text, x.row || ',' || x.col AS moved_to
FROM k JOIN walk w USING (table_id, i) LEFT JOIN k x ON x.table_id = k.table_id AND x.i = w.free"""
