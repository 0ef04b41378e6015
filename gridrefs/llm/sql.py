"""DuckDB SQL of the operators' queries, where SQL can express them.

Compression scores, tokenizers and boosted trees have no SQL, nor have spans of patterns that look
behind; those queries are tested against brute force.
"""

from .mixing import MAX_EPOCHS, SEED, SHARE, WEIGHTS

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_SHINGLES = "list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))"

OP1 = f"""
WITH d AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
i AS (SELECT DISTINCT item_id, {_WORDS.format(_LOWER)} AS w FROM benchmark),
ds AS (SELECT doc_id, unnest(range(len(w) - 4)) AS pos, unnest({_SHINGLES}) AS sh, len(w) - 4 AS total FROM d WHERE len(w) >= 5),
bs AS (SELECT item_id, sh, count(*) AS n FROM (SELECT item_id, unnest({_SHINGLES}) AS sh FROM i WHERE len(w) >= 5) GROUP BY 1, 2),
size AS (SELECT item_id, sum(n) AS size FROM bs GROUP BY 1),
hits AS (SELECT doc_id, item_id, pos, ds.sh, total, size, b.n AS need FROM ds JOIN bs b USING (sh) JOIN size USING (item_id)),
pairs AS (SELECT doc_id, item_id, any_value(total) AS total, any_value(size) AS size, min(pos) AS low, max(pos) AS high FROM hits GROUP BY 1, 2),
windows AS (SELECT doc_id, item_id, total, size, unnest(range(greatest(0, low - CAST(size AS BIGINT) + 1), high + 1)) AS start FROM pairs),
common AS (SELECT w.doc_id, w.item_id, w.start, w.total, w.size, h.sh, least(count(*), any_value(h.need)) AS n
  FROM windows w JOIN hits h ON h.doc_id = w.doc_id AND h.item_id = w.item_id AND h.pos >= w.start AND h.pos < w.start + w.size GROUP BY 1, 2, 3, 4, 5, 6),
sim AS (SELECT doc_id, item_id, start, sum(n) / (any_value(least(size, total - start)) + any_value(size) - sum(n)) AS similarity FROM common GROUP BY 1, 2, 3)
SELECT doc_id, item_id, round(max(similarity), 6) AS similarity FROM sim WHERE similarity >= 0.75 GROUP BY 1, 2"""

OP4 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN {_SHINGLES} WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS sh FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY 1, 2, na.n, nb.n HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
reach(node, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.seen)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT node AS doc_id, min(seen) AS component_id FROM reach GROUP BY 1) c USING (doc_id)"""

_CASES = " ".join(f"WHEN {k} THEN {w}" for k, w in enumerate(WEIGHTS))
OP5 = f"""
WITH d AS (SELECT doc_id, source, coalesce(len({_WORDS.format("text")}), 0) AS size, md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(WEIGHTS)} {_CASES} END AS weight FROM s),
r AS (SELECT *, CAST({MAX_EPOCHS} * source_size AS DOUBLE) AS cap, CAST({MAX_EPOCHS} * source_size AS DOUBLE) / weight AS ratio FROM w),
l AS (SELECT *, (CAST({SHARE} * sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER e, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER e, 0)) AS level
  FROM r WINDOW e AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, max(CASE WHEN ratio > level THEN level END) OVER () AS fill FROM l),
t AS (SELECT source, source_size, CASE WHEN fill IS NULL OR ratio <= fill THEN cap ELSE fill * weight END AS target FROM f),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
k AS (SELECT d.source, d.key, sum(d.size) AS size FROM d GROUP BY 1, 2),
c AS (SELECT k.source, k.key, coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + k.size / 2 <= p.target - p.whole * p.source_size AS more
  FROM k JOIN p ON p.source IS NOT DISTINCT FROM k.source)
SELECT d.doc_id, d.size, p.source_size, p.target, CAST(d.size * (p.whole + CASE WHEN c.more THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN p ON p.source IS NOT DISTINCT FROM d.source JOIN c ON c.source IS NOT DISTINCT FROM d.source AND c.key = d.key"""

_BASE32 = "array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS INTEGER) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER) + 1, 1)), '')"
OP6 = f"""
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS h, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
g AS (SELECT h, max(page_id) AS top FROM p GROUP BY 1)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to FROM p JOIN g USING (h)"""

OP7 = f"""
WITH d AS (SELECT doc_id, {_LOWER} AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM d JOIN g USING (norm)"""

SQL = {"op1_decontamination": OP1, "op4_near_duplicates": OP4, "op5_mixing": OP5, "op6_warc": OP6, "op7_exact_dedup": OP7}
