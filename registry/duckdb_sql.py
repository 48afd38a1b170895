"""DuckDB SQL with the same results as ``spark_queries``, on the same tables."""

from __future__ import annotations

from registry.spark_queries import LARGE_K, MIXED_CASE, PREFIXES, WORD_STARTS

FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

WORDS = """words AS (
  SELECT w AS text, count(*) AS weight
  FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents) WHERE w <> '' GROUP BY w)"""
FOLDED = f"folded AS (SELECT text, weight, {FOLD.format('text')} AS folded FROM words)"
PARTS = "parts AS (SELECT p_name AS text, count(*) AS weight FROM part GROUP BY p_name)"
PART_SIZES = "part_sizes AS (SELECT p_name AS text, CAST(p_size AS BIGINT) AS weight FROM part)"
URLS = "urls AS (SELECT DISTINCT url AS text, CAST(strlen(url) AS BIGINT) AS weight FROM pages)"
CUSTOMERS = """customers AS (
  SELECT c_name AS text, count(*) AS weight
  FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name)"""
TALKS = "talks AS (SELECT text, count(*) AS weight FROM conversations GROUP BY text)"
TYPED = """typed AS (
  SELECT conv_id * 1000 + turn AS qid, left(string_split(text, ' ')[-1], 3) AS q,
         CAST(turn % 7 + 1 AS INTEGER) AS k
  FROM conversations)"""
TYPED_WORDS = """typed_words AS (
  SELECT qid, left(w, CAST(qid % 12 + 1 AS INTEGER)) AS q, CAST(turn % 7 + 1 AS INTEGER) AS k
  FROM (SELECT turn, w, (conv_id * 1000 + turn) * 10000 + place - 1 AS qid
        FROM (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS w,
                     generate_subscripts(string_split(text, ' '), 1) AS place FROM conversations))
  WHERE w <> '')"""
EVENT_PREFIXES = """event_prefixes AS (
  SELECT event_id AS qid, left(event_type, CAST(event_id % 4 + 1 AS INTEGER)) AS q, 3 AS k FROM events)"""
ORDER_RANGES = """ranges AS (
  SELECT rid, lb, lb + CASE WHEN rid % 97 = 0 THEN 50000 ELSE rid % 400 - 20 END AS rb,
         coalesce(CASE WHEN rid % 11 <> 0 THEN rid % 9 + 1 END, 10) AS k
  FROM (SELECT o_orderkey AS rid, (o_custkey * 7 + o_orderkey) % 60000 AS lb FROM orders))"""
LINES = """lines AS (
  SELECT CASE (l_orderkey + l_linenumber) % 9
    WHEN 0 THEN name || chr(9) || weight
    WHEN 1 THEN name
    WHEN 2 THEN name || chr(9)
    WHEN 3 THEN name || chr(9) || weight || 'abc'
    WHEN 4 THEN name || chr(9) || '-' || weight
    WHEN 5 THEN name || chr(9) || name || chr(9) || weight
    WHEN 6 THEN name || chr(9) || ' ' || weight || chr(13)
    WHEN 7 THEN ''
    ELSE name || chr(9) || weight || '99999999999999999999' END AS line
  FROM (SELECT *, l_returnflag || '-' || l_orderkey || '-' || l_linenumber AS name,
               CAST(l_suppkey AS VARCHAR) AS weight FROM lineitem)),
fields AS (
  SELECT line, instr(line, chr(9)) AS tab, substr(line, instr(line, chr(9)) + 1) AS field FROM lines),
judged AS (
  SELECT line, field, CASE WHEN tab > 0 THEN substr(line, 1, tab - 1) END AS text,
    CASE WHEN line = '' THEN 'blank line'
         WHEN tab = 0 THEN 'no tab'
         WHEN NOT regexp_matches(field, '^[ \\t]*\\+?[0-9]+\\r?$') THEN 'weight is not a whole number'
         WHEN try_cast(trim(field, ' ' || chr(13)) AS BIGINT) IS NULL THEN 'weight out of range'
    END AS reason
  FROM fields)"""
REQUESTS = """requests AS (
  SELECT event_id AS qid, coalesce(CASE WHEN event_type <> 'error' THEN event_type END, '') AS q,
         coalesce(CASE WHEN user_id % 3 <> 0 THEN CAST(json_extract_string(props, '$.k') AS INTEGER) - 10 END, 10) AS k
  FROM events)"""
BALANCES = """balances AS (
  SELECT CASE WHEN c_nationkey <> 5 THEN c_name END AS text,
         CASE WHEN c_nationkey <> 3 THEN CAST(floor(c_acctbal) AS BIGINT) END AS weight
  FROM customer),
judged AS (
  SELECT text, weight, CASE WHEN text IS NULL THEN 'null text' WHEN weight IS NULL THEN 'null weight'
                            WHEN weight < 0 THEN 'negative weight' END AS reason
  FROM balances)"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def literal(prefixes: list[str], k: int = 5) -> str:
    rows = ", ".join(f"({i}, '{q}', {k})" for i, q in enumerate(prefixes))
    return f"asked(qid, q, k) AS (SELECT CAST(c0 AS BIGINT), c1, c2 FROM (VALUES {rows}) v(c0, c1, c2))"


def ranked(words: str, queries: str, case_sensitive: bool = True) -> str:
    """CTEs ``pairs`` (distinct prefix with its matches) and ``ranked``."""
    key, q = ("text", "q") if case_sensitive else (FOLD.format("text"), FOLD.format("q"))
    return f"""prefixes AS (SELECT DISTINCT {q} AS prefix FROM {queries}),
keyed AS (SELECT text, weight, {key} AS key FROM {words}),
pairs AS (SELECT prefix, key, text, weight FROM prefixes JOIN keyed ON starts_with(key, prefix)),
ranked AS (
  SELECT prefix, text, weight, CAST(row_number() OVER (
    PARTITION BY prefix ORDER BY weight DESC, key DESC, text DESC) AS INTEGER) AS rank
  FROM pairs)"""


def ranked_by_length(words: str, queries: str, most: int) -> str:
    """``ranked`` for prefixes of 1 to ``most`` characters, by equality."""
    return f"""ranked AS (
  SELECT prefix, text, weight, CAST(row_number() OVER (
    PARTITION BY prefix ORDER BY weight DESC, text DESC) AS INTEGER) AS rank
  FROM (SELECT DISTINCT q AS prefix FROM {queries})
  JOIN (SELECT left(text, n) AS start, text, weight FROM {words}
        JOIN (SELECT CAST(range AS INTEGER) AS n FROM range(1, {most + 1})) ON n <= length(text)) ON start = prefix)"""


def batch(words: str, queries: str, case_sensitive: bool = True) -> str:
    q = "q" if case_sensitive else FOLD.format("q")
    return f"""SELECT qid, rank, text, weight FROM {queries} JOIN ranked ON {q} = prefix WHERE rank <= k"""


def one(source: str, condition: str, k: int, key: str = "text") -> str:
    order = f"weight DESC, {key} DESC, text DESC"
    return f"""SELECT CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS rank, text, weight
FROM {source} WHERE {condition} ORDER BY {order} LIMIT {k}"""


def table_rows(max_len: int, k: int, case_sensitive: bool = True) -> str:
    key = "text" if case_sensitive else FOLD.format("text")
    return with_(WORDS) + f"""SELECT prefix, rank, text, weight FROM (
  SELECT prefix, text, weight, CAST(row_number() OVER (
    PARTITION BY prefix ORDER BY weight DESC, key DESC, text DESC) AS INTEGER) AS rank
  FROM (SELECT left(key, n) AS prefix, key, text, weight
        FROM (SELECT *, {key} AS key FROM words)
        JOIN (SELECT CAST(range AS INTEGER) AS n FROM range({max_len + 1})) ON n <= length(key)))
WHERE rank <= {k}"""


def scan(source: str, k: str, keys: str) -> str:
    """The scan tie rule on all rows of ``source``: needs ``pos`` and group columns ``keys``."""
    return f"""first_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY weight DESC, pos DESC) AS r FROM {source}),
threshold AS (
  SELECT *, min(CASE WHEN r <= {k} THEN weight END) OVER (PARTITION BY {keys}) AS t FROM first_ranked),
scanned AS (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY pos) AS f FROM threshold WHERE weight >= t),
kept AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY {keys} ORDER BY weight DESC, pos DESC) AS INTEGER) AS rank
  FROM scanned WHERE weight > t OR f <= {k})"""


def positions(source: str) -> str:
    return f"positioned AS (SELECT text, weight, row_number() OVER (ORDER BY text) - 1 AS pos FROM {source})"


def documents(queries: str, k: int) -> str:
    return f"""SELECT qid, CAST(to_json({{'suggestions': coalesce(
  list({{'value': text, 'data': CAST(rank - 1 AS VARCHAR)}} ORDER BY rank) FILTER (WHERE rank IS NOT NULL), [])}})
  AS VARCHAR) AS json
FROM {queries} LEFT JOIN (SELECT * FROM ranked WHERE rank <= {k}) ON q = prefix GROUP BY qid"""


def dictionary_sql() -> dict[str, str]:
    def survivor(order: str) -> str:
        return with_(WORDS, FOLDED) + f"""SELECT text, weight, folded FROM (
  SELECT *, row_number() OVER (PARTITION BY folded ORDER BY {order}) AS place FROM folded) WHERE place = 1"""

    def dedup(aggregate: str) -> str:
        return with_(PART_SIZES) + (
            f"SELECT text, CAST({aggregate}(weight) AS BIGINT) AS weight FROM part_sizes GROUP BY text"
        )

    return {
        "dictionary_words": with_(WORDS) + "SELECT text, weight FROM words",
        "dictionary_counts": with_(PARTS) + "SELECT text, weight FROM parts",
        "dictionary_rows": with_(PART_SIZES) + "SELECT text, weight FROM part_sizes",
        "dictionary_customers": with_(CUSTOMERS) + "SELECT text, weight FROM customers",
        "split_valid_entries": with_(LINES)
        + "SELECT text, CAST(trim(field, ' ' || chr(13)) AS BIGINT) AS weight FROM judged WHERE reason IS NULL",
        "split_valid_quarantine": with_(LINES) + "SELECT line, reason FROM judged WHERE reason IS NOT NULL",
        "split_valid_lenient": with_(LINES)
        + """SELECT text, CAST(weight AS VARCHAR) AS weight FROM (
  SELECT text, try_cast(regexp_extract(field, '^[ \\t]*\\+?([0-9]+)', 1) AS DECIMAL(20, 0)) AS weight
  FROM judged WHERE text IS NOT NULL) WHERE weight IS NOT NULL""",
        "split_pairs_entries": with_(BALANCES) + "SELECT text, weight FROM judged WHERE reason IS NULL",
        "split_pairs_quarantine": with_(BALANCES) + "SELECT text, weight, reason FROM judged WHERE reason IS NOT NULL",
        "tsv_round_trip": with_(URLS) + "SELECT text, weight FROM urls",
        "gz_round_trip": with_(CUSTOMERS) + "SELECT text, weight FROM customers",
        "query_lines": with_(TYPED)
        + "SELECT q, 5 AS k, count(*) AS n FROM typed WHERE NOT contains(q, chr(10)) GROUP BY q",
        "normalise_queries": with_(REQUESTS) + "SELECT qid, q, k FROM requests WHERE k >= 1",
        "refused_queries": with_(REQUESTS)
        + """SELECT qid, q, k, CASE WHEN k < 1 THEN 'k below 1' ELSE 'prefix too short' END AS reason
FROM requests WHERE k < 1 OR length(q) < 5""",
        "sort_dictionary": with_(PART_SIZES) + "SELECT text, weight FROM part_sizes ORDER BY text, weight",
        "sort_dictionary_ci": with_(WORDS, FOLDED) + "SELECT text, weight FROM folded ORDER BY folded, text, weight",
        "dedup_min": dedup("min"),
        "dedup_max": dedup("max"),
        "dedup_sum": dedup("sum"),
        "dedup_ci": survivor("text, weight"),
        "dedup_ci_max": survivor("weight DESC, text"),
        "dedup_ci_sum": with_(WORDS, FOLDED)
        + "SELECT min(text) AS text, CAST(sum(weight) AS BIGINT) AS weight, folded FROM folded GROUP BY folded",
        "row_counts": with_(PART_SIZES)
        + "SELECT count(*) AS rows_read, count(DISTINCT text) AS rows_unique FROM part_sizes",
        "row_counts_ci": with_(WORDS, FOLDED)
        + "SELECT count(*) AS rows_read, count(DISTINCT folded) AS rows_unique FROM folded",
        "input_stats": with_(WORDS)
        + """SELECT count(*) AS entries, CAST(sum(strlen(text)) AS BIGINT) AS text_bytes,
max(weight) AS max_weight FROM words""",
        "with_position_copies": with_(PART_SIZES)
        + "SELECT text, weight, row_number() OVER (ORDER BY text, weight) - 1 AS pos FROM part_sizes",
        "with_position": with_(WORDS, positions("words")) + "SELECT text, weight, pos FROM positioned",
        "with_position_ci": with_(WORDS, FOLDED)
        + "SELECT text, weight, row_number() OVER (ORDER BY folded, text, weight) - 1 AS pos FROM folded",
    }


def edges(key: str) -> str:
    """Nodes from neighbours, parents and counts by all prefixes of the keys."""
    return with_(WORDS) + f""", keyed AS (SELECT {key} AS key, weight FROM words),
paired AS (SELECT key AS a, lead(key) OVER (ORDER BY key) AS b FROM keyed),
forks AS (
  SELECT DISTINCT left(a, list_max(list_filter(range(0, least(length(a), length(b)) + 1), lambda i: left(a, i) = left(b, i)))) AS fork
  FROM paired WHERE b IS NOT NULL UNION SELECT ''),
nodes AS (SELECT fork AS node FROM forks UNION SELECT key FROM keyed),
cut AS (SELECT node, left(node, n) AS start, n FROM nodes, unnest(range(0, length(node))) u(n)),
parents AS (SELECT node, arg_max(start, n) AS parent FROM cut JOIN forks ON start = fork GROUP BY node),
inside AS (
  SELECT node, count(*) AS matches, max(weight) AS max_weight, bool_or(key = node) AS ends
  FROM (SELECT key, weight, left(key, n) AS start FROM keyed, unnest(range(0, length(key) + 1)) u(n)) JOIN nodes ON start = node GROUP BY node)
SELECT parent, substr(node, length(parent) + 1) AS label, matches, max_weight, ends FROM parents JOIN inside USING (node)"""


def lookup_sql() -> dict[str, str]:
    folded_words = with_(WORDS, FOLDED)
    common = """left(a, list_max(list_filter(range(0, least(length(a), length(b)) + 1),
  lambda i: left(a, i) = left(b, i))))"""
    survivors = """survivors AS (
  SELECT text, weight, folded FROM (
    SELECT *, row_number() OVER (PARTITION BY folded ORDER BY text, weight) AS place FROM folded) WHERE place = 1)"""

    def counted(queries_cte: str, queries: str, case_sensitive: bool) -> str:
        q = "q" if case_sensitive else FOLD.format("q")
        return with_(WORDS, queries_cte, ranked("words", queries, case_sensitive)) + f""", inside AS (SELECT prefix, count(*) AS n FROM pairs GROUP BY prefix)
SELECT qid, coalesce(n, 0) AS matches FROM {queries} LEFT JOIN inside ON {q} = prefix"""

    def bounds(queries_cte: str, queries: str, case_sensitive: bool) -> str:
        q = "q" if case_sensitive else FOLD.format("q")
        return with_(WORDS, queries_cte, ranked("words", queries, case_sensitive)) + f""",
below AS (
  SELECT prefix, count(key) AS lb FROM prefixes LEFT JOIN keyed ON key < prefix GROUP BY prefix),
inside AS (SELECT prefix, count(*) AS n FROM pairs GROUP BY prefix)
SELECT qid, lb, lb + coalesce(n, 0) AS rb
FROM {queries} JOIN below ON {q} = below.prefix LEFT JOIN inside ON below.prefix = inside.prefix"""

    pick = "ORDER BY weight DESC, pos DESC LIMIT"
    starts = literal(WORD_STARTS)
    return {
        "stored_plain_read_ci": with_(WORDS, FOLDED) + one("folded", "starts_with(folded, 'th')", 10, "folded"),
        "stored_decimal_weights": with_(WORDS, literal(PREFIXES), ranked("words", "asked"))
        + "SELECT qid, rank, text, CAST(CAST(weight AS HUGEINT) + 9223372036854775808 AS VARCHAR) AS weight"
        " FROM asked JOIN ranked ON q = prefix WHERE rank <= k",
        "stored_dictionary": with_(WORDS) + "SELECT text, weight FROM words WHERE starts_with(text, 'th')",
        "stored_dictionary_ci": with_(WORDS, FOLDED, survivors)
        + one("survivors", "starts_with(folded, 'th')", 20, "folded"),
        "load_or_build_check": "SELECT name AS text, count(*) AS weight FROM (SELECT p_name AS name FROM part UNION ALL SELECT c_name FROM customer) GROUP BY name",
        "prefix_edges": edges("text"),
        "prefix_edges_ci": edges(FOLD.format("text")),
        "load_or_build": with_(WORDS)
        + """SELECT count(*) AS entries, CAST(sum(strlen(text)) AS BIGINT) AS text_bytes,
max(weight) AS max_weight FROM words""",
        "prefix_filter": with_(WORDS) + "SELECT text, weight FROM words WHERE starts_with(text, 'th')",
        "prefix_filter_ci": folded_words + "SELECT text, weight FROM folded WHERE starts_with(folded, 'th')",
        "prefix_filter_urls": with_(URLS) + "SELECT text, weight FROM urls WHERE starts_with(text, 'https://')",
        "prefix_range": with_(WORDS)
        + """SELECT count(*) FILTER (WHERE text < 'th') AS lb,
count(*) FILTER (WHERE text < 'th' OR starts_with(text, 'th')) AS rb FROM words""",
        "prefix_ranges": bounds(TYPED, "typed", True),
        "prefix_ranges_ci": bounds(literal(MIXED_CASE), "asked", False),
        "match_count": with_(WORDS) + "SELECT count(*) AS matches FROM words WHERE starts_with(text, 'th')",
        "match_counts": counted(TYPED, "typed", True),
        "match_counts_ci": counted(TYPED, "typed", False),
        "match_entries": with_(WORDS, literal(PREFIXES))
        + "SELECT qid, text, weight FROM asked JOIN words ON starts_with(text, q)",
        "range_filter": with_(PARTS, positions("parts"))
        + "SELECT text, weight, pos FROM positioned WHERE pos >= 10 AND pos < 40",
        "range_argmax": with_(PARTS, positions("parts"))
        + f"SELECT text, weight, pos FROM positioned WHERE pos BETWEEN 10 AND 39 {pick} 1",
        "stored_positions_ci": with_(WORDS, FOLDED)
        + "SELECT text, weight, folded, row_number() OVER (ORDER BY folded, text, weight) - 1 AS pos FROM folded",
        "heaviest_in_ranges": with_(WORDS, positions("words"), ORDER_RANGES)
        + """SELECT rid, rank, pos, text, weight FROM (
  SELECT rid, k, pos, text, weight, CAST(row_number() OVER (PARTITION BY rid ORDER BY weight DESC, pos DESC) AS INTEGER) AS rank
  FROM (SELECT rid, k, unnest(range(lb, rb)) AS pos FROM ranges) JOIN positioned USING (pos)) WHERE rank <= k""",
        "heaviest_in_ranges_scan": with_(
            WORDS,
            positions("words"),
            ORDER_RANGES,
            "inside AS (SELECT * FROM (SELECT rid, k, unnest(range(lb, rb)) AS pos FROM ranges) JOIN positioned USING (pos))",
            scan("inside", "k", "rid, k"),
        )
        + "SELECT rid, rank, pos, text, weight FROM kept WHERE rank <= k",
        "range_argmaxes": with_(WORDS, positions("words"), ORDER_RANGES)
        + """SELECT rid, pos, text, weight FROM (
  SELECT rid, pos, text, weight, row_number() OVER (PARTITION BY rid ORDER BY weight DESC, pos DESC) AS place
  FROM (SELECT rid, unnest(range(lb, rb + 1)) AS pos FROM ranges) JOIN positioned USING (pos)) WHERE place = 1""",
        "heaviest_in_range": with_(PARTS, positions("parts"))
        + f"""SELECT CAST(row_number() OVER (ORDER BY weight DESC, pos DESC) AS INTEGER) AS rank, pos, text, weight
FROM positioned WHERE pos >= 5 AND pos < 60 {pick} 12""",
        "heaviest_in_range_scan": with_(
            PARTS,
            positions("parts"),
            "inside AS (SELECT *, 0 AS g FROM positioned WHERE pos >= 5 AND pos < 60)",
            scan("inside", "12", "g"),
        )
        + "SELECT rank, pos, text, weight FROM kept WHERE rank <= 12",
        "word_start_filter": with_(TALKS)
        + "SELECT text, weight FROM talks WHERE regexp_matches(text, '(?i)(^|[^A-Za-z0-9_])the')",
        "word_start_matches": with_(TALKS, starts)
        + f"""SELECT qid, text, weight FROM asked JOIN talks
ON regexp_matches({FOLD.format('text')}, '(^|[^A-Za-z0-9_])' || {FOLD.format('q')})""",
        "next_char_facets": with_(WORDS)
        + """SELECT substr(text, 3, 1) AS next, count(*) AS matches, max(weight) AS max_weight
FROM words WHERE starts_with(text, 'th') GROUP BY 1""",
        "next_char_facets_batch": with_(WORDS, TYPED, ranked("words", "typed"))
        + """, facets AS (
  SELECT prefix, substr(key, length(prefix) + 1, 1) AS next, count(*) AS matches, max(weight) AS max_weight
  FROM pairs GROUP BY 1, 2)
SELECT qid, next, matches, max_weight FROM typed JOIN facets ON q = prefix""",
        "common_extension": with_(URLS)
        + f"""SELECT {common} AS extension
FROM (SELECT min(text) AS a, max(text) AS b FROM urls WHERE starts_with(text, 'https://w'))""",
        "common_extensions": with_(CUSTOMERS, literal(["", "C", "Cust", "Customer#00000012", "x"]))
        + f""", ends AS (
  SELECT qid, min(text) AS a, max(text) AS b FROM asked LEFT JOIN customers ON starts_with(text, q) GROUP BY qid)
SELECT qid, {common} AS extension FROM ends""",
    }


def completion_sql() -> dict[str, str]:
    ask = literal(PREFIXES)
    ask10 = literal(PREFIXES, 10)
    rows = ", ".join(f"({i}, '{q}', {k})" for i, q, k in LARGE_K)
    large = f"asked(qid, q, k) AS (SELECT CAST(c0 AS BIGINT), c1, c2 FROM (VALUES {rows}) v(c0, c1, c2))"
    typed_batch = with_(WORDS, TYPED, ranked("words", "typed"))
    event_batch = with_(WORDS, EVENT_PREFIXES, ranked("words", "event_prefixes")) + batch("words", "event_prefixes")
    ten = with_(WORDS, ask10, ranked("words", "asked"))
    return {
        "complete": with_(WORDS) + one("words", "starts_with(text, 'th')", 10),
        "complete_ci": with_(WORDS, FOLDED) + one("folded", "starts_with(folded, 'th')", 10, "folded"),
        "complete_empty_prefix": with_(WORDS) + one("words", "true", 50),
        "complete_no_match": with_(WORDS) + one("words", "starts_with(text, 'the the')", 5),
        "complete_ties": with_(PARTS) + one("parts", "true", 20),
        "complete_scan_ties": with_(
            WORDS,
            positions("words"),
            "inside AS (SELECT *, 0 AS g FROM positioned WHERE starts_with(text, 'th'))",
            scan("inside", "300", "g"),
        )
        + "SELECT rank, text, weight FROM kept WHERE rank <= 300",
        "complete_batch": with_(WORDS, ask, ranked("words", "asked")) + batch("words", "asked"),
        "complete_batch_ci": with_(WORDS, literal(MIXED_CASE, 10), ranked("words", "asked", False))
        + batch("words", "asked", False),
        "complete_batch_per_k": typed_batch + batch("words", "typed"),
        "complete_batch_heavy_first": typed_batch + batch("words", "typed"),
        "complete_batch_dup_queries": event_batch,
        "complete_batch_unmatched": with_(WORDS, ask, ranked("words", "asked"))
        + """SELECT qid, rank, text, weight FROM asked
LEFT JOIN (SELECT * FROM ranked WHERE rank <= 5) ON q = prefix""",
        "complete_batch_scan_ties": with_(
            WORDS,
            positions("words"),
            TYPED,
            "wanted AS (SELECT DISTINCT q, k FROM typed)",
            "inside AS (SELECT wanted.q, wanted.k, positioned.* FROM wanted JOIN positioned ON starts_with(text, q))",
            scan("inside", "k", "q, k"),
        )
        + """SELECT qid, rank, text, weight FROM typed
JOIN kept ON typed.q = kept.q AND typed.k = kept.k WHERE rank <= typed.k""",
        "completion_table": table_rows(4, 3),
        "completion_rollup": table_rows(4, 3),
        "completion_rollup_long": table_rows(12, 2),
        "completion_table_ci": table_rows(3, 5, case_sensitive=False),
        "completion_table_packed": table_rows(2, 10),
        "stored_completion_table": table_rows(3, 5) + " AND length(prefix) = 2",
        "suggestions_rows": ten
        + """SELECT qid, text AS value, CAST(rank - 1 AS VARCHAR) AS data
FROM asked JOIN ranked ON q = prefix WHERE rank <= k""",
        "suggestions_json": ten + documents("asked", 10),
        "result_lines": typed_batch
        + "SELECT qid, rank, text || '  ' || weight AS line FROM typed JOIN ranked ON q = prefix WHERE rank <= k",
        "complete_stream": event_batch,
        "complete_stream_json": with_(WORDS, EVENT_PREFIXES, ranked("words", "event_prefixes"))
        + documents("event_prefixes", 3),
        "complete_stream_batch": event_batch,
        "complete_stream_ci": with_(WORDS, EVENT_PREFIXES, ranked("words", "event_prefixes", False))
        + batch("words", "event_prefixes", False),
        "complete_stream_long": with_(WORDS, TYPED_WORDS, ranked_by_length("words", "typed_words", 12))
        + "SELECT qid, rank, text, weight FROM typed_words LEFT JOIN ranked ON q = prefix AND rank <= k",
        "complete_stream_stored": with_(WORDS, TYPED_WORDS, ranked_by_length("words", "typed_words", 12))
        + """SELECT qid, rank, text, weight FROM typed_words
LEFT JOIN ranked ON q = prefix AND rank <= CASE WHEN qid % 3 <> 0 THEN k ELSE 10 END""",
        "complete_batch_null_q": with_(
            WORDS,
            TYPED,
            "asked AS (SELECT qid, CASE WHEN qid % 3 <> 0 THEN q ELSE '' END AS q, k FROM typed)",
            ranked("words", "asked"),
        )
        + batch("words", "asked"),
        "complete_batch_large_k": with_(WORDS, large, ranked("words", "asked")) + batch("words", "asked"),
        "complete_batch_whole_texts": with_(
            TALKS,
            """asked AS (
  SELECT conv_id * 1000 + turn AS qid, CASE WHEN turn % 3 = 0 THEN left(text, length(text) // 2) ELSE text END AS q, 3 AS k FROM conversations)""",
            ranked("talks", "asked"),
        )
        + batch("talks", "asked"),
        "complete_batch_long": with_(
            URLS, "asked AS (SELECT page_id AS qid, url AS q, 3 AS k FROM pages)", ranked("urls", "asked")
        )
        + batch("urls", "asked"),
    }


#: Queries on a stored form, and those that ask the same of the tables themselves.
STORED = {
    "stored_positions": "with_position",
    "stored_prefix_range": "prefix_range",
    "stored_match_count": "match_count",
    "stored_common_extension": "common_extension",
    "stored_word_starts": "word_start_matches",
}


def all_sql() -> dict[str, str]:
    found = {**dictionary_sql(), **lookup_sql(), **completion_sql()}
    return found | {name: found[same] for name, same in STORED.items()}
