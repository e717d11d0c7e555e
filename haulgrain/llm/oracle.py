"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_WORD = r"'[^\x20\x09-\x0D]+'"
_ITEM_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

OP1 = f"""
WITH item AS (
  SELECT item_id, regexp_extract_all({_LOWER.format("text")}, {_ITEM_WORD}) AS w FROM benchmark WHERE text IS NOT NULL),
started AS (
  SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM item WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS x FROM started),
doc AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_ITEM_WORD}) AS w FROM documents),
sized AS (SELECT doc_id, w, n FROM doc CROSS JOIN (SELECT DISTINCT n FROM windows) AS lengths WHERE len(w) >= n),
placed AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM sized),
found AS (
  SELECT p.doc_id, p.s, p.n, windows.item_id
  FROM (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS x FROM placed) AS p
  JOIN windows ON p.n = windows.n AND p.x = windows.x),
hit AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS pos FROM found) AS h GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) AS i GROUP BY doc_id)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit ON doc.doc_id = hit.doc_id LEFT JOIN items ON doc.doc_id = items.doc_id
"""

OP6 = f"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_WORD}) AS w FROM documents),
started AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s FROM doc WHERE len(w) > 0),
shingle AS (SELECT DISTINCT doc_id, array_to_string(w[s:s + 4], ' ') AS x FROM started),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingle AS a JOIN shingle AS b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS (
  SELECT a, b FROM shared JOIN size AS sa ON sa.doc_id = a JOIN size AS sb ON sb.doc_id = b
  WHERE 100 * shared.n >= 75 * (sa.n + sb.n - shared.n)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
component AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc.doc_id, CAST(coalesce(size.n, 0) AS BIGINT) AS n_shingles, component_id
FROM doc LEFT JOIN size ON doc.doc_id = size.doc_id JOIN component ON doc.doc_id = component.a
"""

# Points of the schedule are multiples of the golden ratio's inverse modulo 2^40.
OP7 = f"""
WITH doc AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), {_WORD})) AS BIGINT) AS size FROM documents),
per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CAST([3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS DOUBLE) AS weight
  FROM doc GROUP BY source),
levels AS (
  SELECT *, 2.0 * source_size AS most,
    (1.5 * sum(source_size) OVER ()
      - coalesce(sum(2.0 * source_size) OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM per),
goal AS (
  SELECT source, source_size,
    least(most, coalesce((SELECT level FROM levels AS l WHERE level * weight <= most ORDER BY most / weight, source NULLS LAST LIMIT 1)
      * weight, most)) AS target
  FROM levels),
edges AS (
  SELECT source,
    CASE WHEN lead(source_size) OVER (ORDER BY source NULLS LAST) IS NULL THEN 1099511627776.0
      ELSE floor(sum(target) OVER (ORDER BY source NULLS LAST ROWS UNBOUNDED PRECEDING)
        / (SELECT sum(target) FROM goal) * 1099511627776.0) END AS upto
  FROM goal WHERE target > 0),
ranges AS (SELECT source, coalesce(lag(upto) OVER (ORDER BY source NULLS LAST), 0.0) AS since, upto FROM edges),
slots AS (
  SELECT n, CAST((CAST(n AS HUGEINT) * 679535556991) % 1099511627776 AS DOUBLE) AS point
  FROM range(CAST(floor((SELECT 1.5 * sum(size) FROM doc) / 64) AS BIGINT)) AS t(n)),
ranked AS (
  SELECT source, row_number() OVER (PARTITION BY source ORDER BY n) - 1 AS rank
  FROM slots JOIN ranges ON point >= since AND point < upto),
times AS (
  SELECT r.source, r.rank % ((g.source_size + 63) // 64) AS block, count(*) AS times
  FROM ranked AS r JOIN goal AS g ON r.source IS NOT DISTINCT FROM g.source
  WHERE r.rank < 2 * ((g.source_size + 63) // 64) GROUP BY 1, 2),
line AS (
  SELECT doc_id, source, size, CAST(sum(size) OVER (PARTITION BY source
      ORDER BY md5(CAST(doc_id AS VARCHAR) || ':' || CAST(size AS VARCHAR)), doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
  FROM doc WHERE size > 0),
pieces AS (
  SELECT doc_id, source, upto - size AS since, upto, unnest(range((upto - size) // 64, (upto - 1) // 64 + 1)) AS block FROM line),
got AS (
  SELECT doc_id, sum((least(p.upto, (p.block + 1) * 64) - greatest(p.since, p.block * 64)) * t.times) AS taken
  FROM pieces AS p JOIN times AS t ON p.source IS NOT DISTINCT FROM t.source AND p.block = t.block GROUP BY doc_id)
SELECT doc.doc_id, doc.size, goal.source_size, goal.target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM doc JOIN goal ON doc.source IS NOT DISTINCT FROM goal.source LEFT JOIN got ON doc.doc_id = got.doc_id
"""
OP9 = f"""
WITH doc AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos FROM doc),
keyed AS (SELECT doc_id, line, pos, {_LOWER.format(f"trim(line, {_SPACE})")} AS key FROM line),
shared AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT keyed.*, shared.key IS NOT NULL AS dropped FROM keyed LEFT JOIN shared ON keyed.key = shared.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP11 = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    coalesce(list_sum(list_transform(range(1, least(len(q.v), len(c.v)) + 1), lambda i: q.v[i] * c.v[i])), 0) AS score
  FROM usable AS q JOIN usable AS c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 20
"""


def _crc_table() -> list[int]:
    """Remainders of the checksum's polynomial for each byte."""
    found = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        found.append(byte)
    return found


OP13 = f"""
WITH RECURSIVE run AS (
  SELECT doc_id, {_LOWER.format("r")} AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS r FROM documents) AS x GROUP BY 1, 2),
coded AS (SELECT *, hex(encode(CAST(doc_id AS VARCHAR) || ':' || run)) AS code FROM run WHERE length(run) >= 6),
keyed AS (
  SELECT run, n, xor(4294967295, list_reduce(
      list_transform(range(0, length(code) // 2), lambda i: CAST('0x' || substr(code, 2 * i + 1, 2) AS BIGINT)),
      lambda c, b: xor(c >> 8, ({_crc_table()})[xor(c & 255, b) + 1]), CAST(4294967295 AS BIGINT))) AS h
  FROM coded),
spoilt AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2)
    ELSE run END AS word, n FROM keyed),
word AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spoilt WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
less AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, CAST(unnest(range(1, length(word) + 1)) AS INT) AS i FROM word) AS x),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM less AS a JOIN less AS b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT less.word, word.word, word.n FROM less JOIN word ON less.rest = word.word
  UNION SELECT word.word, less.word, less.n FROM less JOIN word ON less.rest = word.word),
best AS (
  SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM near GROUP BY word),
form AS (
  SELECT word.word, word.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * n THEN near END AS form,
    CASE WHEN near_n >= 5 * n THEN near_n END AS form_n
  FROM word LEFT JOIN best ON word.word = best.word),
step AS (
  SELECT word, word AS at, form AS next FROM form
  UNION ALL SELECT step.word, form.word, form.form FROM step JOIN form ON step.next = form.word)
SELECT form.word, form.form, step.at AS root, n, n_near, form_n FROM form JOIN step ON form.word = step.word AND step.next IS NULL
"""

ORACLE: dict[str, str] = {
    "op1_decontamination": OP1,
    "op6_jaccard_join": OP6,
    "op7_source_mix": OP7,
    "op9_line_dedup": OP9,
    "op11_topk_search": OP11,
    "op13_spelling_variants": OP13,
}
