"""SQL of the queries that SQL can express; the others are tested by brute force."""

from __future__ import annotations

# crc32 bit by bit over the characters of a key of digits; then the faults, and the
# cheapest edits row by row: at each row the least (cost, letters) for every state.
_REPAIR = """WITH RECURSIVE
crc AS (
  SELECT key, xor(list_reduce(
      flatten(list_transform(string_split(key, ''), lambda c: list_concat([ascii(c)::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda state, op: CASE WHEN op >= 0 THEN xor(state, op)
        ELSE xor(state >> 1, CASE WHEN state & 1 = 1 THEN 3988292384 ELSE 0 END) END,
      4294967295::BIGINT), 4294967295) % 20 AS fault
  FROM (SELECT DISTINCT coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations)
),
damaged AS (
  SELECT conv_id, turn,
    CASE WHEN fault = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(coalesce(text, ' '), '.!?', '') ELSE coalesce(text, ' ') END AS text,
    unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM conversations JOIN crc ON key = coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')
  WHERE fault <> 0
),
judged AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS initial,
    row_number() OVER conversation AS place,
    lag(left(role, 1)) OVER conversation AS before,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS rest,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen
  FROM damaged
  WINDOW conversation AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)
),
faulty AS (
  SELECT *, CASE WHEN rest = '' THEN 1 WHEN seen THEN 2 WHEN right(rest, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault
  FROM judged
),
edges AS (
  SELECT q AS before, i.ins AS inserted, i.at AS at, e.letter AS letter,
    CASE e.letter WHEN 'D' THEN i.at WHEN 'K' THEN e.after ELSE CASE i.at WHEN 2 THEN 3 ELSE 2 END END AS after,
    CASE e.letter WHEN 'K' THEN e.initial ELSE NULL END AS needs
  FROM range(4) AS states(q),
    LATERAL (SELECT NULL AS ins, q AS at UNION ALL
             SELECT CASE q WHEN 2 THEN 'assistant' ELSE 'user' END, CASE q WHEN 2 THEN 3 ELSE 2 END) AS i,
    (VALUES ('D', NULL, NULL), ('R', NULL, NULL), ('K', 's', 1), ('K', 'u', 2), ('K', 'a', 3)) AS e(letter, initial, after)
  WHERE e.letter <> 'K' OR (e.initial = 's' AND i.at = 0) OR (e.initial = 'u' AND i.at <> 2) OR (e.initial = 'a' AND i.at = 2)
),
paths(conv_id, place, state, best) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 0::BIGINT, {'cost': 0::BIGINT, 'audit': '', 'lines': ''} FROM conversations
  UNION ALL
  SELECT p.conv_id, f.place, e.after,
    min({'cost': p.best.cost + CASE WHEN e.inserted IS NULL THEN 0 ELSE 2 END
           + CASE e.letter WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END
           + CASE WHEN f.fault = 3 AND e.letter <> 'D' THEN 1 ELSE 0 END,
         'audit': p.best.audit || CASE WHEN e.inserted IS NULL THEN '' ELSE 'I' END || e.letter,
         'lines': p.best.lines || CASE WHEN e.inserted IS NULL THEN '' ELSE e.inserted || ':' || chr(10) END
           || CASE e.letter WHEN 'D' THEN '' WHEN 'K' THEN f.role || ':' || f.text || chr(10)
              ELSE CASE e.after WHEN 2 THEN 'user' ELSE 'assistant' END || ':' || f.text || chr(10) END})
  FROM paths p
  JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.place = p.place + 1
  JOIN edges e ON e.before = p.state AND (e.needs IS NULL OR e.needs = f.initial) AND (e.letter = 'D' OR f.fault NOT IN (1, 2))
  GROUP BY p.conv_id, f.place, e.after
),
sizes AS (
  SELECT conv_id, count(*) AS n, count_if(fault = 1) AS blank, count_if(fault = 2) AS duplicate, count_if(fault = 3) AS truncated,
    count_if(place > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps
  FROM faulty GROUP BY conv_id
),
ends AS (
  SELECT p.conv_id,
    min({'cost': p.best.cost + CASE p.state WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 0 END,
         'audit': p.best.audit || CASE p.state WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
         'lines': p.best.lines || CASE p.state WHEN 1 THEN 'user:' || chr(10) || 'assistant:' || chr(10) WHEN 2 THEN 'assistant:' || chr(10) ELSE '' END}) AS best
  FROM paths p LEFT JOIN sizes s ON s.conv_id IS NOT DISTINCT FROM p.conv_id
  WHERE p.place = coalesce(s.n, 0)
  GROUP BY p.conv_id
)
SELECT e.conv_id, coalesce(s.gaps, 0)::BIGINT AS gaps, coalesce(s.blank, 0)::BIGINT AS blank,
  coalesce(s.duplicate, 0)::BIGINT AS duplicate, coalesce(s.truncated, 0)::BIGINT AS truncated,
  coalesce(s.illegal, 0)::BIGINT AS illegal, e.best.cost::BIGINT AS cost, e.best.audit AS audit,
  sha256(left(e.best.lines, greatest(length(e.best.lines) - 1, 0))) AS repaired_sha256
FROM ends e LEFT JOIN sizes s ON s.conv_id IS NOT DISTINCT FROM e.conv_id
"""

# Distinct shingles of every class of equal sets, shared shingles counted by an
# equality join, and the least document within reach of each class.
_JACCARD = """
WITH RECURSIVE
words AS (
  SELECT row_number() OVER () AS row, doc_id,
    list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
  FROM documents
),
sets AS (
  SELECT row, doc_id, list_sort(list_distinct(CASE
      WHEN len(words) = 0 THEN []
      WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
      ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END)) AS shingles
  FROM words
),
classes AS (
  SELECT row_number() OVER () AS class, shingles, len(shingles) AS n, count(*) AS copies, min(doc_id) AS least
  FROM sets WHERE len(shingles) > 0 GROUP BY shingles
),
entries AS (SELECT class, unnest(shingles) AS shingle FROM classes),
shared AS (
  SELECT a.class AS a, b.class AS b, count(*) AS common FROM entries a JOIN entries b ON a.shingle = b.shingle AND a.class < b.class
  GROUP BY a.class, b.class
),
one_way AS (
  SELECT a, b FROM shared JOIN classes x ON x.class = a JOIN classes y ON y.class = b
  WHERE 100 * common >= 80 * (x.n + y.n - common)
),
links AS (SELECT a, b FROM one_way UNION ALL SELECT b, a FROM one_way),
reach(class, other) AS (
  SELECT class, class FROM classes UNION SELECT r.class, l.b FROM reach r JOIN links l ON l.a = r.other
),
component AS (SELECT r.class, min(c.least) AS least FROM reach r JOIN classes c ON c.class = r.other GROUP BY r.class),
degree AS (SELECT l.a AS class, sum(c.copies) AS links FROM links l JOIN classes c ON c.class = l.b GROUP BY l.a)
SELECT s.doc_id, len(s.shingles)::BIGINT AS n_shingles, coalesce(c.copies - 1 + coalesce(d.links, 0), 0)::BIGINT AS n_links,
  CASE WHEN c.class IS NULL THEN s.doc_id ELSE k.least END AS component_id
FROM sets s LEFT JOIN classes c ON c.shingles = s.shingles LEFT JOIN component k ON k.class = c.class LEFT JOIN degree d ON d.class = c.class
"""

# Every window of 20 words by its digest; words under a window that also starts earlier go.
_REPEATS = """
WITH
words AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
  FROM documents
),
windows AS (
  SELECT doc_id, w.place AS place, w.digest AS digest FROM (
    SELECT doc_id, unnest(list_transform(range(1, len(words) - 18),
      lambda i: {'place': i, 'digest': md5(array_to_string(words[i:i + 19], ' '))})) AS w
    FROM words WHERE len(words) >= 20)
),
late AS (
  SELECT doc_id, place FROM (
    SELECT doc_id, place, row_number() OVER (PARTITION BY digest ORDER BY doc_id, place) AS n FROM windows)
  WHERE n > 1
),
gone AS (SELECT DISTINCT doc_id, unnest(range(place, place + 20)) AS place FROM late),
single AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM words),
kept AS (
  SELECT s.doc_id, string_agg(word, ' ' ORDER BY s.place) AS kept, count(*) AS n
  FROM single s LEFT JOIN gone g ON g.doc_id = s.doc_id AND g.place = s.place WHERE g.place IS NULL GROUP BY s.doc_id
)
SELECT w.doc_id, len(w.words)::BIGINT AS n_words, (len(w.words) - coalesce(k.n, 0))::BIGINT AS n_removed,
  sha256(coalesce(k.kept, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON k.doc_id = w.doc_id
"""

SQL: dict[str, str] = {
    "op5_super_kmers": _REPEATS,
    "op11_grouped_prefix_join": _JACCARD,
    "op13_scalar_repair": _REPAIR,
}
