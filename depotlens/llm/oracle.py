"""DuckDB texts of the operators that SQL can express."""

from __future__ import annotations

# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of a text whose A-Z are lower case
_LETTERED = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP10 = f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS r, coalesce({_LETTERED.format('text')}, []) AS w FROM documents),
items AS (SELECT item_id, coalesce({_LETTERED.format('text')}, []) AS w FROM benchmark WHERE item_id IS NOT NULL),
strings AS (
  SELECT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
  FROM items, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
places AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM docs, (SELECT DISTINCT n FROM strings) AS lengths, unnest(range(1, len(w) - n + 2)) AS t(i)),
found AS (SELECT DISTINCT r, n, i, item_id FROM places JOIN strings USING (n, s)),
hits AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM found, unnest(range(0, n)) AS t(k) GROUP BY r),
ids AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN ids USING (r)
"""

# SHA-1 as 40 hex digits; five of them are four characters of base 32
OP4 = """
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
named AS (
  SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, h,
    array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((CAST(list_sum(
      [CAST(strpos('0123456789abcdef', substr(h, (k // 4) * 5 + j, 1)) - 1 AS BIGINT) << (4 * (5 - j)) for j in range(1, 6)]
      ) AS BIGINT) >> ((3 - k % 4) * 5)) & 31) AS BIGINT), 1) for k in range(0, 32)], '') AS payload_digest
  FROM hashed),
latest AS (SELECT payload_digest, payload_bytes, max(page_id) AS l FROM named GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id < l THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < l THEN l END AS refers_to
FROM named JOIN latest USING (payload_digest, payload_bytes)
"""

OP1 = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM docs, unnest(range(1, greatest(len(w) - 3, 2))) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 85 * (p.n + q.n - c)),
reached(x, y) AS (
  SELECT x, y FROM (SELECT x, y FROM links UNION SELECT y, x FROM links)
  UNION SELECT r.x, l.y FROM reached r JOIN (SELECT x, y FROM links UNION SELECT y, x FROM links) l ON r.y = l.x),
lowest AS (SELECT x, min(y) AS y FROM reached GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(y, doc_id)) AS component_id,
  doc_id = least(doc_id, coalesce(y, doc_id)) AS kept
FROM docs LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest ON x = doc_id
"""

OP2 = """
WITH rows AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, r.vec_id,
    CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(r.v AS DOUBLE[])) AS BIGINT) AS score
  FROM rows q, rows r WHERE q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id AND len(q.v) = len(r.v)),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

# crc32 of a text of ASCII characters, bit by bit
_CRC32 = """xor(4294967295, list_reduce(
  list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split({}, ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, bit: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)))"""

# ways on: from a state by inserts (``pre``) to one that keeps, reroles or deletes the row;
# states are 0: nothing yet, 1: after s, 2: after u, 3: after a
OP12 = rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_CRC32.format("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS kind
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM keyed, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copies(n)),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS place,
    left(role, 1) AS initial, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z', 1) AS closing
  FROM damaged),
faulty AS (
  SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY place) || initial AS pair,
    CASE WHEN closing = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
      WHEN closing NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'sound' END AS fault
  FROM numbered),
inserts(i, pre, added, j) AS (VALUES
  (0, '', [], 0), (0, 'I', ['user:'], 2), (0, 'II', ['user:', 'assistant:'], 3),
  (1, '', [], 1), (1, 'I', ['user:'], 2), (1, 'II', ['user:', 'assistant:'], 3),
  (2, '', [], 2), (2, 'I', ['assistant:'], 3), (3, '', [], 3), (3, 'I', ['user:'], 2)),
edits(j, e, wanted, name, k, price) AS (VALUES
  (0, 'D', '', '', 0, 4), (1, 'D', '', '', 1, 4), (2, 'D', '', '', 2, 4), (3, 'D', '', '', 3, 4),
  (0, 'K', 's', '', 1, 0), (0, 'K', 'u', '', 2, 0), (1, 'K', 'u', '', 2, 0), (3, 'K', 'u', '', 2, 0), (2, 'K', 'a', '', 3, 0),
  (0, 'R', '', 'user', 2, 3), (1, 'R', '', 'user', 2, 3), (3, 'R', '', 'user', 2, 3), (2, 'R', '', 'assistant', 3, 3)),
ways AS (
  SELECT list({{'i': i, 'pre': pre || e, 'added': added, 'e': e, 'wanted': wanted, 'name': name, 'k': k, 'price': price + 3 * len(pre)}}) AS ways
  FROM inserts JOIN edits USING (j)),
sizes AS (SELECT conv_id, max(place) AS n FROM faulty GROUP BY conv_id),
fold AS (
  SELECT conv_id, n AS place, [
    {{'c': 0, 's': '', 't': CAST([] AS VARCHAR[])}}, {{'c': 6, 's': 'II', 't': ['user:', 'assistant:']}},
    {{'c': 3, 's': 'I', 't': ['assistant:']}}, {{'c': 0, 's': '', 't': CAST([] AS VARCHAR[])}}] AS best
  FROM sizes
  UNION ALL
  SELECT f.conv_id, f.place - 1, list_transform([0, 1, 2, 3], lambda x: list_min(list_transform(
    list_filter(ways, lambda w: w.i = x AND (w.e = 'D' OR (fault NOT IN ('blank', 'duplicate') AND (w.e = 'R' OR w.wanted = initial)))),
    lambda w: {{'c': best[w.k + 1].c + w.price + CASE WHEN fault = 'truncated' AND w.e <> 'D' THEN 3 ELSE 0 END,
      's': w.pre || best[w.k + 1].s,
      't': list_concat(list_concat(w.added, CASE w.e WHEN 'D' THEN [] WHEN 'K' THEN [role || ':' || text] ELSE [w.name || ':' || text] END), best[w.k + 1].t)}})))
  FROM fold f JOIN faulty r ON r.conv_id IS NOT DISTINCT FROM f.conv_id AND r.place = f.place, ways),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id)
SELECT i.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best[1].c, 0) AS BIGINT) AS cost,
  coalesce(best[1].s, '') AS audit, sha256(coalesce(array_to_string(best[1].t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN fold f ON f.conv_id IS NOT DISTINCT FROM i.conv_id AND f.place = 0
"""

OP13 = """
WITH rows AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
met AS (
  SELECT a.r, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
positives AS (
  SELECT r, anchor_id, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS place
  FROM met WHERE same QUALIFY place <= 5),
ranked AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY p.r, place ORDER BY score DESC, vec_id) AS rank
  FROM positives p JOIN met m USING (r, anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
  QUALIFY rank <= 3)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked
"""

ORACLE: dict[str, str] = {
    "op1_minhash_dedup": OP1,
    "op2_bit_sliced_topk": OP2,
    "op4_zip_archive": OP4,
    "op10_decontamination": OP10,
    "op12_turn_repair": OP12,
    "op13_hard_negatives": OP13,
}
