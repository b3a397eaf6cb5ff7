"""DuckDB SQL of the corpus queries that SQL can express on small tables."""

from __future__ import annotations

from . import quality_rules as q

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

JACCARD = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {WORDS.format(f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')")} AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i+4], ' ')) END) AS s
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id),
e AS (SELECT c.a, c.b FROM c JOIN n x ON x.doc_id = c.a JOIN n y ON y.doc_id = c.b
      WHERE 100 * c.k >= 75 * (x.n + y.n - c.k)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) m ON m.a = d.doc_id
"""

_BINS = ", ".join(f"'{w}'" for w in q.WORD_BINS)
_PUNCTUATION = r"[.,;:!?''\"()\[\]\-]".replace('\\"', '"')


def _count(column: str, cls: str) -> str:
    return f"len(regexp_extract_all({column}, '{cls}'))"


QUALITY = f"""
WITH w AS (
  SELECT doc_id, lang, coalesce(text, '') AS text, {WORDS.format("coalesce(text, '')")} AS words FROM documents),
j AS (SELECT *, array_to_string(words, '') AS joined, regexp_replace(array_to_string(words, ''), '\\p{{Ll}}', '', 'g') AS rest,
  len(words) AS n_words FROM w),
b AS (SELECT doc_id, coalesce(lang, '*') AS lang, words, n_words, CAST(length(joined) AS BIGINT) AS word_chars,
  {_count("rest", "[#*$%&|<>]")} AS n_symbols,
  len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))
    - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')))) AS n_dup_lines,
  length(joined) - length(rest) AS c_lower, {_count("rest", "[\\p{Lu}]")} AS c_upper, {_count("rest", "[\\p{N}]")} AS c_digit,
  {_count("rest", _PUNCTUATION)} AS c_punct, length(rest) AS c_rest FROM j),
win AS (SELECT doc_id, i, words[i] || ' ' || words[i+1] || ' ' || words[i+2] AS s
  FROM (SELECT doc_id, words, unnest(range(1, n_words - 1)) AS i FROM b WHERE n_words >= 3)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS k FROM win) WHERE k > 1),
rep AS (SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words FROM twice, range(0, 3) t(o) GROUP BY doc_id),
ch AS (SELECT doc_id, lang, unnest(['l', 'u', 'd', 'p', 's', 'o']) AS bin,
  unnest([c_lower, c_upper, c_digit, c_punct, n_symbols, c_rest - c_upper - c_digit - c_punct - n_symbols]) AS k FROM b),
each AS (SELECT doc_id, lang, n_words, unnest(words) AS x FROM b),
wh AS (SELECT doc_id, lang, CASE WHEN x IN ({_BINS}) THEN x ELSE '' END AS bin, count(*) AS k FROM each GROUP BY ALL),
h AS (SELECT 'c' AS kind, * FROM ch WHERE k > 0 UNION ALL SELECT 'w', * FROM wh),
ref AS (SELECT kind, lang, bin, sum(k) AS k FROM h GROUP BY ALL),
refn AS (SELECT *, k / sum(k) OVER (PARTITION BY kind, lang) AS q FROM ref),
p AS (SELECT *, k / sum(k) OVER (PARTITION BY kind, doc_id) AS p FROM h),
dist AS (
  SELECT kind, doc_id, sqrt(greatest(0, 0.5 * sum(t) + 0.5 * (any_value(1.0) - sum(q)) )) AS d FROM (
    SELECT p.kind, p.doc_id, refn.q,
      p.p * log2(p.p / ((p.p + refn.q) / 2)) + refn.q * log2(refn.q / ((p.p + refn.q) / 2)) AS t
    FROM p JOIN refn ON refn.kind = p.kind AND refn.lang = p.lang AND refn.bin = p.bin) GROUP BY kind, doc_id),
f AS (
  SELECT b.doc_id, CAST(b.n_words AS BIGINT) AS n_words, b.word_chars, CAST(b.n_symbols AS BIGINT) AS n_symbols,
    CAST(b.n_dup_lines AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CASE WHEN b.word_chars >= {q.CHAR_GUARD} THEN round(dc.d, 6) END AS char_distance,
    CASE WHEN b.n_words >= {q.WORD_GUARD} THEN round(dw.d, 6) END AS word_distance
  FROM b LEFT JOIN rep ON rep.doc_id = b.doc_id
  LEFT JOIN dist dc ON dc.doc_id = b.doc_id AND dc.kind = 'c'
  LEFT JOIN dist dw ON dw.doc_id = b.doc_id AND dw.kind = 'w')
SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
  AND coalesce(char_distance, 0) <= CASE WHEN word_chars < {q.SHORT_CHARS} THEN {q.SHORT_CHAR_DISTANCE}
                                         ELSE {q.MAX_CHAR_DISTANCE} END
  AND coalesce(word_distance, 0) <= CASE WHEN n_words < {q.SHORT_WORDS} THEN {q.SHORT_WORD_DISTANCE}
                                         ELSE {q.MAX_WORD_DISTANCE} END AS kept
FROM f
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms(column: str) -> str:
    return f"unnest(regexp_extract_all(translate(coalesce({column}, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_TERM}'))"


SEARCH = f"""
WITH t AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, {_terms("text")} AS term FROM documents)
           GROUP BY doc_id, term),
n AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM t GROUP BY doc_id),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
d AS (SELECT term, count(*) AS df FROM t GROUP BY term),
q AS (SELECT DISTINCT item_id, {_terms("text")} AS term FROM benchmark),
s AS (
  SELECT q.item_id, t.doc_id, CAST(sum(
    CAST(floor(1000 * ln((2 * c.docs + 2)::DOUBLE / (2 * d.df + 1)::DOUBLE)) AS BIGINT)
    * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (100 - 90 + (90 * n.n * c.docs) // c.terms)))) AS BIGINT) AS score
  FROM q JOIN t ON t.term = q.term JOIN d ON d.term = q.term JOIN n ON n.doc_id = t.doc_id, c
  GROUP BY q.item_id, t.doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
WHERE rank <= 10
"""

_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT)),
  lambda c, b: xor(c >> 8, {1}[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)"""

REPAIR = f"""
WITH RECURSIVE z AS (SELECT list(v ORDER BY n) AS z FROM (
  SELECT n, list_reduce(list_concat([n::BIGINT], range(8)),
    lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS v FROM range(256) t(n))),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {_CRC.format("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')", "z.z")} % 20 AS k FROM conversations, z),
e AS (SELECT coalesce(conv_id::VARCHAR, '') AS conv, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
  CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy FROM k WHERE k <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM e),
f AS (SELECT *, left(role, 1) AS init, lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY i) AS before,
  CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 1
       WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 2
       WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 3 ELSE 0 END AS fault FROM o),
ins(q, label, cost, lines, q1) AS (VALUES
  (0, '', 0, '', 0), (0, 'I', 5, 'user:' || chr(10), 2), (0, 'II', 10, 'user:' || chr(10) || 'assistant:' || chr(10), 3),
  (1, '', 0, '', 1), (1, 'I', 5, 'user:' || chr(10), 2), (1, 'II', 10, 'user:' || chr(10) || 'assistant:' || chr(10), 3),
  (2, '', 0, '', 2), (2, 'I', 5, 'assistant:' || chr(10), 3), (3, '', 0, '', 3), (3, 'I', 5, 'user:' || chr(10), 2)),
act(q1, letter, init, cost, name, q2) AS (
  SELECT q, 'D', NULL::VARCHAR, 2, NULL::VARCHAR, q FROM range(4) t(q) UNION ALL
  VALUES (0, 'R', NULL, 1, 'user', 2), (1, 'R', NULL, 1, 'user', 2), (2, 'R', NULL, 1, 'assistant', 3),
    (3, 'R', NULL, 1, 'user', 2), (0, 'K', 's', 0, NULL, 1), (0, 'K', 'u', 0, NULL, 2), (1, 'K', 'u', 0, NULL, 2),
    (3, 'K', 'u', 0, NULL, 2), (2, 'K', 'a', 0, NULL, 3)),
st AS (
  SELECT DISTINCT conv, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS q, {{'c': CAST(0 AS BIGINT), 'a': '', 'o': ''}} AS s FROM f
  UNION ALL
  SELECT st.conv, f.i, CAST(act.q2 AS BIGINT), min({{
    'c': st.s.c + ins.cost + act.cost + CASE WHEN f.fault = 3 AND letter <> 'D' THEN 5 ELSE 0 END,
    'a': st.s.a || ins.label || act.letter,
    'o': st.s.o || ins.lines || CASE letter WHEN 'D' THEN '' WHEN 'K' THEN f.role || ':' || f.text || chr(10)
                                            ELSE act.name || ':' || f.text || chr(10) END}})
  FROM st JOIN f ON f.conv = st.conv AND f.i = st.i + 1 JOIN ins ON ins.q = st.q
  JOIN act ON act.q1 = ins.q1 AND (letter = 'D' OR f.fault NOT IN (1, 2)) AND (act.init IS NULL OR act.init = f.init)
  GROUP BY st.conv, f.i, act.q2),
n AS (SELECT conv, max(i) AS n, count_if(fault = 1) AS blank, count_if(fault = 2) AS duplicate,
  count_if(fault = 3) AS truncated, count_if(before IS NOT NULL AND before || init NOT IN ('su', 'ua', 'au')) AS illegal,
  coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps FROM f GROUP BY conv),
best AS (SELECT st.conv, min({{'c': st.s.c + ins.cost, 'a': st.s.a || ins.label, 'o': st.s.o || ins.lines}}) AS s
  FROM st JOIN n ON n.conv = st.conv AND n.n = st.i JOIN ins ON ins.q = st.q AND ins.q1 IN (0, 3) GROUP BY st.conv)
SELECT c.conv_id, CAST(coalesce(n.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(n.blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(n.duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(n.truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(n.illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(best.s.c, 0) AS BIGINT) AS cost,
  coalesce(best.s.a, '') AS audit, sha256(CASE WHEN coalesce(best.s.o, '') = '' THEN '' ELSE left(best.s.o, -1) END) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN n ON n.conv = coalesce(c.conv_id::VARCHAR, '') LEFT JOIN best ON best.conv = n.conv
"""
