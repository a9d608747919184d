"""DuckDB SQL twins of the named queries (the correctness oracle).

Each statement reads the same parquet tables (registered as views) and
returns the same column names and types as the Spark query.
"""

from __future__ import annotations

# Access-log lines from events: ip, path, raw time text, epoch seconds.  Parts
# are joined the way concat_ws does (NULL parts skipped), so an event without
# a type or a time makes a two-token line, which the parser rejects: ``g``
# holds the lines that parse, ``ga`` all of them.
_G = """ga AS (
  SELECT concat_ws('.', '10', '0', CAST(user_id // 256 AS VARCHAR),
                   CAST(user_id % 256 AS VARCHAR)) AS ip,
         '/' || event_type AS path,
         strftime(ts, '%Y_%m_%d__%H_%M_%S_%g') AS seen,
         epoch_us(ts) // 1000000 AS es,
         epoch_us(ts) // 1000 AS ets_ms
  FROM events),
g AS (SELECT * FROM ga WHERE path IS NOT NULL AND seen IS NOT NULL)"""

_G_LINE = "concat_ws(' ', ip, path, seen)"

# Lines of every document.
_L = """l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS value FROM documents)"""

# JVM String.split(" "): trailing empty tokens dropped.
_JSPLIT = ("CASE WHEN value <> '' AND rtrim(value, ' ') = '' THEN []::VARCHAR[] "
           "ELSE string_split(rtrim(value, ' '), ' ') END")

_TOKENS = f"""t AS (SELECT doc_id, unnest({_JSPLIT}) AS word FROM l)"""

_LEN = ("length(value) + len(regexp_extract_all(value, '[\\x{10000}-\\x{10FFFF}]'))")

_KW = """kw AS (
  SELECT doc_id, lower(tok) AS keyword
  FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '[ /,;()]')) AS tok FROM documents)
  WHERE length(tok) > 0 AND NOT regexp_matches(tok, '[0-9._-]+'))"""

_PROPS_K = "json_extract_string(props, '$.k')"


def _windows(length_s: int, slide_s: int) -> str:
    n = length_s // slide_s
    return f"""WITH {_G},
w AS (SELECT (es // {slide_s}) * {slide_s} - k * {slide_s} AS window_start, ip, seen
      FROM g, range(0, {n}) r(k))
SELECT window_start, window_start + {length_s} AS window_end, ip,
       count(*) AS hits, max(seen) AS last_seen
FROM w GROUP BY window_start, ip"""


def _top50(by: str) -> str:
    base = _windows(3 * 86400, 86400)
    if by == "hits":
        return f"""SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY hits DESC, ip DESC) AS rank
  FROM ({base})) WHERE rank <= 50"""
    return f"""SELECT * EXCLUDE (kr) FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY hits DESC, ip DESC) AS rank
  FROM (SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY ip DESC) AS kr
        FROM ({base})) WHERE kr <= 50)"""


def _snapshot(by: str, delay_ms: int = 0) -> str:
    return f"""WITH b AS ({_top50(by)}),
x AS (WITH {_G} SELECT max(ets_ms) - {delay_ms} AS upto FROM g),
n AS (SELECT * FROM b WHERE window_end = (SELECT max(window_end) FROM b, x WHERE window_end * 1000 <= upto))
SELECT window_end,
       CAST(to_json({{'id': CAST(window_end AS VARCHAR), 'key': 'dataPush',
                     'data': list({{'ip': ip, 'hits': hits, 'last_seen': last_seen}} ORDER BY rank)}})
            AS VARCHAR) AS message
FROM n GROUP BY window_end"""


_DAY = 86400
_W3D = _windows(3 * _DAY, _DAY)
_W5D_MIN5 = f"SELECT * FROM ({_windows(5 * _DAY, _DAY)}) WHERE hits >= 5"

ORACLE = {
    "text_scan": f"WITH {_L} SELECT value FROM l",
    "tokenize_lines": f"WITH {_L}, {_TOKENS} SELECT doc_id, word FROM t",
    "word_count": f"WITH {_L}, {_TOKENS} SELECT word, count(*) AS n FROM t GROUP BY word",
    "word_count_sorted": f"WITH {_L}, {_TOKENS} SELECT word, count(*) AS n FROM t "
                         "GROUP BY word ORDER BY n DESC, word",
    "line_lengths": f"WITH {_L} SELECT doc_id, value AS line, {_LEN} AS len FROM l",
    "longest_line": f"WITH {_L} SELECT value AS line, {_LEN} AS len FROM l "
                    "ORDER BY len DESC, line ASC LIMIT 1",
    "broadcast_filter": "SELECT event_id, event_type FROM events "
                        "WHERE event_type IN ('click', 'view', 'purchase')",
    "isin_filter": "SELECT event_id, event_type FROM events "
                   "WHERE event_type IN ('click', 'view', 'purchase')",
    "regex_full_match": f"SELECT event_id, {_PROPS_K} AS k FROM events "
                        f"WHERE regexp_full_match({_PROPS_K}, '1\\d+')",
    "acc_sum": "SELECT CAST(coalesce(sum(l_linenumber), 0) AS BIGINT) AS total FROM lineitem",
    "observe_sum": "SELECT 'linenumber_sum' AS name, CAST(coalesce(sum(l_linenumber), 0) AS BIGINT) AS value "
                   "FROM lineitem",
    "acc_concat": "SELECT event_id // 1000 AS chunk, string_agg(event_type, '' ORDER BY event_id) AS text "
                  "FROM events GROUP BY 1",
    "parse_access_log": f"WITH {_G} SELECT ip, path, seen, ets_ms FROM g",
    "access_log_rejects": f"""WITH {_G}, {_L},
m AS (SELECT {_G_LINE} AS value FROM ga UNION ALL SELECT value FROM l),
s AS (SELECT value, {_JSPLIT} AS tok FROM m)
SELECT value,
       CASE WHEN len(tok) < 3 THEN 'fewer than 3 tokens'
            WHEN try_strptime(tok[3], '%Y_%m_%d__%H_%M_%S_%g') IS NULL THEN 'bad timestamp' END AS reason
FROM s
WHERE len(tok) < 3 OR try_strptime(tok[3], '%Y_%m_%d__%H_%M_%S_%g') IS NULL""",
    "hits_by_ip": f"WITH {_G} SELECT ip, count(*) AS hits, max(seen) AS last_seen FROM g GROUP BY ip",
    "hits_min10": f"WITH {_G} SELECT ip, count(*) AS hits, max(seen) AS last_seen FROM g GROUP BY ip "
                  "HAVING count(*) >= 10",
    "hits_window_30s_10s": _windows(30, 10),
    "hits_window_20s_4s": _windows(20, 4),
    "hits_window_3d_1d": _W3D,
    "hits_min5_window": _W5D_MIN5 + " ORDER BY hits DESC, ip DESC",
    "top50_by_key": _top50("key"),
    "top50_by_hits": _top50("hits"),
    "snapshot_json": _snapshot("hits"),
    "tumbling_counts": """WITH c AS (SELECT (epoch_us(ts) // 1000000) // 86400 AS slot, count(*) AS n
           FROM events GROUP BY 1),
b AS (SELECT unnest(range(min(slot), max(slot) + 1)) AS slot FROM c UNION ALL SELECT NULL FROM c WHERE slot IS NULL)
SELECT b.slot * 86400 AS window_start, coalesce(c.n, 0) AS n,
       'received ' || CAST(coalesce(c.n, 0) AS VARCHAR) || ' events' AS message
FROM b LEFT JOIN c ON b.slot IS NOT DISTINCT FROM c.slot""",
    "agent_keywords": f"WITH {_KW} SELECT doc_id, keyword FROM kw",
    "agent_keyword_freq": f"WITH {_KW} SELECT keyword, count(*) AS freq FROM kw GROUP BY keyword",
    "agent_distinct_keywords": f"WITH {_KW} SELECT DISTINCT doc_id, keyword FROM kw",
    "agent_top50_keywords": f"""WITH {_KW},
f AS (SELECT keyword, count(*) AS freq FROM kw GROUP BY keyword),
p AS (SELECT DISTINCT doc_id, keyword FROM kw),
r AS (SELECT p.doc_id, p.keyword, f.freq,
             row_number() OVER (PARTITION BY p.doc_id ORDER BY f.freq DESC, p.keyword ASC) AS rank
      FROM p JOIN f USING (keyword))
SELECT doc_id, keyword, freq, rank FROM r WHERE rank <= 50""",
    "agents_of_ip": "SELECT source, text FROM documents WHERE source = 'src1' ORDER BY source, text",
    # Streams are checked against the batch query they must equal.
    "stream_hits_kafka": _W3D,
    "stream_hits_socket": _W5D_MIN5,
    "stream_snapshot_kafka": _snapshot("key", 60_000),
    # One file of the table per batch: the given tables are one file.
    "stream_batch_counts": "SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS n, "
                           "'received ' || CAST(count(*) AS VARCHAR) || ' events' AS message FROM events",
    "late_data_dropped": _W3D,
}

# Same results, other implementations.
ORACLE["udf_predicate"] = ORACLE["regex_full_match"]
ORACLE["udf_partition_resource"] = ORACLE["regex_full_match"]
ORACLE["udaf_concat"] = ORACLE["acc_concat"]
ORACLE["udaf_span"] = "SELECT event_type, max(event_id) - min(event_id) AS span FROM events GROUP BY event_type"
ORACLE["udaf_span_nulls"] = """SELECT CASE WHEN user_id % 5 <> 0 THEN 9007199254740993 + user_id END AS key,
  max(CASE WHEN event_id % 7 <> 0 THEN event_id END) - min(CASE WHEN event_id % 7 <> 0 THEN event_id END) AS span FROM events GROUP BY 1"""

ORACLE["stream_hits_panes"] = _W3D
ORACLE["stream_push_newest"] = ORACLE["stream_snapshot_kafka"]
ORACLE["stream_latest_event"] = """SELECT user_id, event_type FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL AND event_type IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type DESC) = 1"""
ORACLE["stream_late_rows"] = f"""WITH {_G},
o AS (SELECT ip, seen, (es // 86400) * 86400 AS day FROM g ORDER BY seen, {_G_LINE} LIMIT 1),
x AS (SELECT max(ets_ms) - 60000 AS upto FROM g)
SELECT ip, day * 1000000 AS pane, CAST(1 AS BIGINT) AS hits, seen AS last_seen,
       CAST(len(list_filter([1, 2, 3], lambda k: (day + k * 86400) * 1000 <= upto)) AS INTEGER) AS missed
FROM o, x WHERE (day + 86400) * 1000 <= upto"""
ORACLE["acc_concat_pieces"] = """WITH o AS (SELECT event_id, event_type,
  CAST(coalesce(sum(strlen(event_type)) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS pos
  FROM events WHERE event_type IS NOT NULL)
SELECT min(pos) AS "offset", string_agg(event_type, '' ORDER BY event_id) AS text FROM o GROUP BY pos // 4096"""
