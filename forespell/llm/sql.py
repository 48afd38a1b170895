"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def near_duplicates(size: int, percent: int) -> str:
    """Shingle sets as rows, all pairs that share one, components by recursion."""
    return f"""WITH RECURSIVE worded AS (
  SELECT doc_id, list_filter(regexp_split_to_array({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < {size} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - {size} + 2), lambda i: array_to_string(w[i:i + {size} - 1], ' ')) END) AS gram
  FROM worded),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
near AS (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * c >= {percent} * (x.n + y.n - c)),
links AS (SELECT a, b FROM near UNION SELECT b, a FROM near),
reached AS (
  SELECT a AS doc_id, a AS other FROM links
  UNION SELECT r.doc_id, b FROM reached r JOIN links ON other = a),
lowest AS (SELECT doc_id, min(other) AS low FROM reached GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(low, d.doc_id) AS component_id,
       coalesce(low, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest USING (doc_id)"""


def archive_records() -> str:
    """Digests in base32, and for equal payloads the smallest page_id."""
    return """WITH bodies AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
named AS (
  SELECT page_id, body, CAST(unhex(sha1(body)) AS BIT)::VARCHAR AS bits,
         min(page_id) OVER (PARTITION BY body) AS first FROM bodies)
SELECT page_id, octet_length(encode(body)) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1
    + 16 * CAST(substr(bits, 5 * i + 1, 1) AS INTEGER) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INTEGER)
    + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INTEGER) + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INTEGER)
    + CAST(substr(bits, 5 * i + 5, 1) AS INTEGER) AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM named"""


def substring_dedup(size: int) -> str:
    """Every window as text, and the least document it starts in."""
    return f"""WITH worded AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
starts AS (
  SELECT r, doc_id, i, array_to_string(w[i:i + {size - 1}], ' ') AS span FROM (SELECT *, unnest(range(1, len(w) - {size - 2})) AS i FROM worded)),
least AS (SELECT span, min(doc_id) AS low FROM starts GROUP BY span),
gone AS (SELECT DISTINCT r, i + k AS p FROM (SELECT r, i FROM starts JOIN least USING (span) WHERE doc_id > low), range({size}) x(k)),
listed AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM worded),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) FILTER (g.p IS NULL) AS kept, count(g.p) AS n
  FROM listed l LEFT JOIN gone g USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM worded LEFT JOIN kept USING (r)"""


def conversation_repair() -> str:
    """crc32 from its definition, faults as windows, and the cheapest edits row by row for all conversations together."""
    return r"""WITH RECURSIVE bits AS (
  SELECT list(list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)),
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
hashed AS (
  SELECT named.*, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(name) + 1), lambda k: CAST(ord(substr(name, CAST(k AS INTEGER), 1)) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[CAST((xor(c, b) & 255) + 1 AS INTEGER)])), 4294967295) % 20 AS fault
  FROM named, bits),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hashed WHERE fault <> 0),
lined AS (
  SELECT *, row_number() OVER w AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare, left(role, 1) AS c, lag(left(role, 1)) OVER w AS was
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(CAST(length(role) AS VARCHAR) || ':' || role || text), copy)),
marked AS (
  SELECT *, CASE WHEN bare = '' THEN 'b' WHEN seen > 1 THEN 'd' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault FROM lined),
best AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, '' AS state, CAST(0 AS BIGINT) AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS lines FROM damaged
  UNION ALL
  SELECT conv_id, i, state, min(cost), arg_min(audit, (cost, audit)), arg_min(lines, (cost, audit)) FROM (
    SELECT conv_id, i, e.state, e.cost, e.audit, e.lines FROM (
      SELECT m.conv_id, m.i, unnest([
        {'state': p.state, 'cost': p.cost + 3, 'audit': p.audit || 'D', 'lines': p.lines, 'ok': true},
        {'state': p.next, 'cost': p.cost + 2 + more, 'audit': p.audit || 'R', 'lines': list_append(p.lines, p.role || ':' || m.text), 'ok': fault NOT IN ('b', 'd')},
        {'state': m.c, 'cost': p.cost + more, 'audit': p.audit || 'K', 'lines': list_append(p.lines, m.role || ':' || m.text),
         'ok': fault NOT IN ('b', 'd') AND (m.c = p.next OR (m.c = 's' AND p.state = ''))}]) AS e
      FROM (SELECT *, CASE WHEN fault = 't' THEN 1 ELSE 0 END AS more FROM marked) m JOIN (
        SELECT conv_id, i, state, cost, audit, lines, CASE WHEN state = 'u' THEN 'a' ELSE 'u' END AS next, CASE WHEN state = 'u' THEN 'assistant' ELSE 'user' END AS role FROM (
          SELECT conv_id, i, unnest([
            {'state': state, 'cost': cost, 'audit': audit, 'lines': lines},
            {'state': CASE WHEN state = 'u' THEN 'a' ELSE 'u' END, 'cost': cost + 2, 'audit': audit || 'I', 'lines': list_append(lines, CASE WHEN state = 'u' THEN 'assistant:' ELSE 'user:' END)},
            {'state': CASE WHEN state = 'u' THEN 'u' ELSE 'a' END, 'cost': cost + 4, 'audit': audit || 'II',
             'lines': lines || CASE WHEN state = 'u' THEN ['assistant:', 'user:'] ELSE ['user:', 'assistant:'] END}], max_depth := 2)
          FROM best)) p ON m.conv_id IS NOT DISTINCT FROM p.conv_id AND m.i = p.i + 1) WHERE e.ok) GROUP BY conv_id, i, state),
ended AS (
  SELECT conv_id, min(cost + plus) AS cost, arg_min(audit || repeat('I', plus // 2), (cost + plus, audit || repeat('I', plus // 2))) AS audit,
    arg_min(lines || CASE plus WHEN 2 THEN ['assistant:'] WHEN 4 THEN ['user:', 'assistant:'] ELSE [] END, (cost + plus, audit || repeat('I', plus // 2))) AS lines
  FROM (SELECT *, CASE state WHEN 's' THEN 4 WHEN 'u' THEN 2 ELSE 0 END AS plus,
          max(i) OVER (PARTITION BY conv_id) AS last FROM best) WHERE i = last GROUP BY conv_id),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (i > 1 AND was || c NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY conv_id)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
  CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted x ON o.conv_id IS NOT DISTINCT FROM x.conv_id
LEFT JOIN ended y ON o.conv_id IS NOT DISTINCT FROM y.conv_id"""


def all_sql() -> dict[str, str]:
    return {"op2_near_duplicates": near_duplicates(3, 85), "op6_warc": archive_records(), "op11_substring_dedup": substring_dedup(13), "op12_conversation_repair": conversation_repair()}
