"""SQL for the queries of this subpackage that SQL can express, for DuckDB."""

from __future__ import annotations

WORDS_4 = "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"

OP4 = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS_4} AS w FROM benchmark),
bench AS (
  SELECT DISTINCT item, least(13, len(w)) AS length, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)
),
lengths AS (SELECT DISTINCT length FROM bench),
docs AS (SELECT doc_id, {WORDS_4} AS w FROM documents),
places AS (
  SELECT doc_id, length, i, array_to_string(w[i : i + length - 1], ' ') AS win
  FROM (SELECT doc_id, w, length, unnest(range(1, len(w) - length + 2)) AS i FROM docs, lengths)
),
found AS (SELECT doc_id, i, p.length, item FROM places p JOIN bench b ON p.win = b.win AND p.length = b.length),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + length)) AS j FROM found) GROUP BY 1),
named AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS digest
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY 1
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(digest, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs d LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)
"""

ORACLES = {"op4_decontamination": OP4}

#: Links of every pair that shares a shingle, and the smallest id that they reach.
OP3 = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN w ELSE w[i : i + 2] END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM words WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_common FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * n_common >= 85 * (x.n + y.n - n_common)
),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a
),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

ORACLES["op3_near_dedup"] = OP3

WORDS_11 = "list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

#: Every document walks through every order; nothing here knows of coalitions.
OP11 = f"""
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
flags AS (
  SELECT doc_id, part,
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM (SELECT doc_id, part, t, {WORDS_11} AS w FROM texts)
),
marks AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY 1),
kinds AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM flags LEFT JOIN marks USING (doc_id) GROUP BY 1, 2
),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
steps AS (SELECT filter_order, step, substr(filter_order, step, 1) AS f FROM orders, range(1, 6) r(step)),
walked AS (
  SELECT part, filter_order, fails, n, good, toxic,
    coalesce(list_min([strpos(filter_order, f) for f in string_split(fails, '') if f <> '']), 99) AS gone
  FROM kinds, orders
),
counts AS (
  SELECT part, filter_order, step, f,
    sum(n) FILTER (WHERE gone > step) AS kept, sum(n) FILTER (WHERE gone = step) AS removed,
    sum(n) FILTER (WHERE gone < step AND contains(fails, f)) AS redundant, sum(n) FILTER (WHERE fails = f) AS unique_fails,
    sum(good) FILTER (WHERE gone = step) AS good_lost, sum(toxic) FILTER (WHERE gone = step) AS toxic_lost
  FROM walked JOIN steps USING (filter_order) GROUP BY 1, 2, 3, 4
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
  CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
  CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
  CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counts
"""

OP12 = """
WITH texts AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY t)
"""



def _edit(state: str, cost: str, letter: str, out: str, allowed: str = "true") -> str:
    """A state with one edit more: [nine digits of cost and the letters, the result]; null where it cannot be."""
    total = f"lpad(CAST(CAST({state}[1][1:9] AS INTEGER) + {cost} AS VARCHAR), 9, '0') || {state}[1][10:] || '{letter}'"
    return f"CASE WHEN {allowed} AND {state} IS NOT NULL THEN [{total}, {state}[2] || {out}] END"


def _insert(state: str, role: str) -> str:
    return _edit(state, "2", "I", f"chr(10) || '{role}:'")


def _stay(state: str, initial: str, role: str) -> str:
    """Rerole or keep a row."""
    rerole = _edit(state, "2 + late", "R", f"chr(10) || '{role}:' || text", "NOT gone")
    return f"{rerole}, {_edit(state, 'late', 'K', KEPT, f"NOT gone AND initial = '{initial}'")}"


KEPT = "chr(10) || role || ':' || text"
#: Cost and letters as one string per state of the pattern, carried from row to row; the least string wins.
OP13 = f"""
WITH RECURSIVE base AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS place
  FROM conversations
),
fates AS (
  SELECT *, xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(place, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))
  )) % 20 AS fate
  FROM base
),
rows AS (
  SELECT conv_id, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM fates
),
placed AS (
  SELECT *, substr(role, 1, 1) AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i
  FROM rows
),
judged AS (
  SELECT conv_id, turn, role, text, initial, i, blank, NOT blank AND seen AS duplicate, NOT blank AND NOT seen AND cut AS truncated,
    blank OR seen AS gone, CASE WHEN cut THEN 1 ELSE 0 END AS late, i > 1 AND before || initial NOT IN ('su', 'ua', 'au') AS illegal
  FROM (
    SELECT *, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank, NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') AS cut,
      row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
      lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before
    FROM placed
  )
),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
    count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate,
    count(*) FILTER (WHERE truncated) AS truncated, count(*) FILTER (WHERE illegal) AS illegal
  FROM judged GROUP BY 1
),
walk AS (
  SELECT conv_id, 0::BIGINT AS i, ['000000000', ''] AS s0, NULL::VARCHAR[] AS s1, NULL::VARCHAR[] AS s2, NULL::VARCHAR[] AS s3
  FROM counts
  UNION ALL
  SELECT conv_id, i, {_edit("o0", "3", "D", "''")},
    least({_edit("o1", "3", "D", "''")}, {_edit("o0", "late", "K", KEPT, "NOT gone AND initial = 's'")}),
    least({_edit("o2", "3", "D", "''")}, {_stay("o0", "u", "user")}, {_stay("o1", "u", "user")}, {_stay("o3", "u", "user")}),
    least({_edit("o3", "3", "D", "''")}, {_stay("o2", "a", "assistant")})
  FROM (
    SELECT j.*, s0 AS o0, s1 AS o1, least(s2, {_insert("s0", "user")}, {_insert("s1", "user")}, {_insert("s3", "user")}) AS o2,
      least(s3, {_insert("s2", "assistant")}) AS o3
    FROM walk w JOIN judged j ON w.conv_id IS NOT DISTINCT FROM j.conv_id AND j.i = w.i + 1
  )
),
ends AS (
  SELECT conv_id, least(s0, s3, {_insert("s2", "assistant")}) AS s
  FROM walk w JOIN counts c USING (conv_id) WHERE i = n
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(s[1][1:9], '0') AS BIGINT) AS cost,
  coalesce(s[1][10:], '') AS audit, sha256(coalesce(s[2][2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts USING (conv_id) LEFT JOIN ends USING (conv_id)
"""

ORACLES["op13_conversation_repair"] = OP13
ORACLES["op11_filter_audit"] = OP11
ORACLES["op12_exact_dedup"] = OP12
