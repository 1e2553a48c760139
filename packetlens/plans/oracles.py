"""SQL for the checking database, one text per query.

The texts follow the definitions step by step (self joins, outer joins, unions), not the
way the Spark jobs compute them, so the two sides check each other.
"""

from __future__ import annotations

from packetlens.sources.derived import DUCKDB_TEXT, TOPIC_PARTITIONS


# Fixed values, written out here so that they check those of the code.
_VERBS = "'Standard', 'Dynamic', 'Zone', 'Server', 'Inverse', 'DNS'"
_RECORD_TYPES = "'CNAME', 'NS'"
_STATUS, _RESPONSE = "'Server status'", "'Server status request response'"
_ERROR = "'Error/Unknown operation'"
_CATEGORY = """CASE
  WHEN regexp_matches(name, 'google|msn|yahoo|bing|ucweb|scorecardresearch') THEN 'search'
  WHEN regexp_matches(name, 'apple|cloud|windows|cloudfront|amazonaws|android|ksmobile|microsoft|msftncsi|flurry|gmail|appsflyer|doubleclick|truecaller') THEN 'tech'
  WHEN regexp_matches(name, 'facebook|whatsapp|youtube|skype|twitter|instagram') THEN 'social'
  WHEN contains(name, 'amazon') THEN 'e-commerce'
  WHEN regexp_matches(name, 'akamai|fbcdn') THEN 'cdn'
  WHEN regexp_matches(name, 'porn|virus') THEN 'danger'
  ELSE 'other' END"""

# raw: packets as derived. pk: packets as parsed, where info ends at its first comma.
_PACKETS = f"""
raw AS ({DUCKDB_TEXT}),
line AS (SELECT *, concat_ws(',', src, dst, protocol, CAST(length AS VARCHAR), info) AS message
         FROM raw),
pk AS (SELECT seq, ts, src, dst, protocol, length, split_part(info, ',', 1) AS info, message,
              string_split(split_part(info, ',', 1), ' ') AS t FROM line)
"""


def _records(source: str = "pk", columns: str = "seq, ts, src, protocol, message") -> str:
    return f"""
std AS (SELECT * FROM {source} WHERE t[1] = 'Standard'),
asked AS (SELECT {columns}, string_split(t[-1], '.') AS l FROM std WHERE t[3] <> 'response'),
answered AS (SELECT {columns}, t, unnest(range(1, len(t))) AS i FROM std WHERE t[3] = 'response'),
rec AS (
  SELECT {columns}, 'A' AS type,
         CASE WHEN len(l) > 1 THEN concat(l[-2], '.', l[-1]) ELSE l[-1] END AS name FROM asked
  UNION ALL
  SELECT {columns}, t[i] AS type, t[i + 1] AS name FROM answered WHERE t[i] IN ({_RECORD_TYPES})
)"""


_RECORDS = _records()

_DIRECTED = """
d AS (SELECT src, dst, CAST(sum(length) AS BIGINT) AS total, count(*) AS n FROM pk
      WHERE protocol = 'DNS' GROUP BY src, dst),
m AS (SELECT d.src, d.dst, d.total, d.n, r.total AS r_total, r.n AS r_n
      FROM d LEFT JOIN d r ON d.src = r.dst AND d.dst = r.src)"""

_OCTETS = "list_transform(string_split({0}, '.'), lambda x: CAST(x AS INTEGER))"
_NUMERIC = f"{_OCTETS.format('src')} < {_OCTETS.format('dst')}"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in (_PACKETS, *ctes)) + "\n"


def _pairs(leads: str, self_pairs: bool = True, avg: str = "total / n") -> str:
    """Mirror join, then keep a pair seen both ways only where ``leads`` holds."""
    own = """UNION ALL SELECT src, dst, total, n FROM m WHERE src = dst""" if self_pairs else ""
    return _with(_DIRECTED, f"""
p AS (SELECT src, dst, total, n FROM m WHERE r_n IS NULL
      UNION ALL SELECT src, dst, total + r_total, n + r_n FROM m
      WHERE r_n IS NOT NULL AND src <> dst AND {leads} {own})""") + f"""
SELECT src AS address_a, dst AS address_b, total, {avg} AS avg, n AS count FROM p"""


_TWO_DECIMALS = "CAST(printf('%.2f', total / n) AS DOUBLE)"

# A pair met from both sides counts from its larger address; a self pair meets itself.
_AVERAGES = _with(_DIRECTED) + """
SELECT src, dst, (total + coalesce(r_total, 0)) / (n + coalesce(r_n, 0)) AS average,
       CAST(n + coalesce(r_n, 0) AS DOUBLE) AS tot
FROM m WHERE r_n IS NULL OR src >= dst"""


def _hosts(where: str, columns: str) -> str:
    return _with(_RECORDS) + f"""
SELECT {columns} FROM (SELECT DISTINCT type, name, src FROM rec WHERE {where})
GROUP BY type, name"""


_NAME_COUNT = "type, name AS request_response, count(*) AS count"

# Nameservers: certain evidence left-joined with possible evidence, then both other branches.
_QUERY = """((t[1] IN ('Standard', 'Inverse') AND t[3] <> 'response')
             OR (t[1] = 'DNS' AND t[5] <> 'response'))"""
_NAMESERVERS = f"""
q AS (SELECT src, dst, {_QUERY} AS query FROM pk WHERE t[1] IN ('Standard', 'DNS', 'Inverse')),
certain AS (SELECT CASE WHEN query THEN dst ELSE src END AS address,
                   sum(CASE WHEN query THEN 0 ELSE 1 END) AS s,
                   sum(CASE WHEN query THEN 1 ELSE 0 END) AS r FROM q GROUP BY 1),
possible AS (SELECT CASE WHEN query THEN src ELSE dst END AS address,
                    sum(CASE WHEN query THEN 1 ELSE 0 END) AS s,
                    sum(CASE WHEN query THEN 0 ELSE 1 END) AS r FROM q GROUP BY 1),
branch_queries AS (SELECT c.address, c.s + coalesce(p.s, 0) AS s, c.r + coalesce(p.r, 0) AS r
                   FROM certain c LEFT JOIN possible p ON c.address = p.address),
branch_updates AS (SELECT src AS address, 1 AS s, 0 AS r FROM pk WHERE t[1] IN ('Dynamic', 'Zone')
                   UNION ALL SELECT dst, 0, 1 FROM pk WHERE t[1] IN ('Dynamic', 'Zone')),
branch_status AS (
  SELECT CASE WHEN starts_with(info, {_RESPONSE}) THEN src ELSE dst END AS address,
         CASE WHEN starts_with(info, {_RESPONSE}) THEN 1 ELSE 0 END AS s,
         CASE WHEN starts_with(info, {_RESPONSE}) THEN 0 ELSE 1 END AS r
  FROM pk WHERE starts_with(info, {_STATUS}))"""


def _nameservers(*branches: str) -> str:
    union = " UNION ALL ".join(f"SELECT address, s, r FROM branch_{b}" for b in branches)
    return f"""
SELECT address, CAST(sum(s) AS BIGINT) AS packets_sent, CAST(sum(r) AS BIGINT) AS packets_received
FROM ({union}) GROUP BY address"""


_ALL_BRANCHES = _nameservers("queries", "updates", "status")

_CANDIDATES = """
c AS (SELECT * FROM pk WHERE NOT contains(protocol, 'TCP') AND NOT contains(protocol, 'IP'))"""

_TALK = """
talk AS (SELECT seq, ts, CASE WHEN t[3] <> 'response' THEN t[3] ELSE t[4] END AS query_id,
                CASE WHEN t[3] <> 'response' THEN src ELSE dst END AS client,
                CASE WHEN t[3] <> 'response' THEN dst ELSE src END AS server,
                concat(info, ' src: ', src, ' dest: ', dst) AS message
         FROM pk WHERE t[1] = 'Standard'),
sized AS (SELECT *, count(*) OVER (PARTITION BY query_id, client, server) AS n_messages FROM talk)"""

_CONVERSATIONS = _with(_TALK) + """
SELECT query_id, client, server, n_messages, CAST(0 AS BIGINT) AS part,
       string_agg(message, chr(10) ORDER BY ts, seq) AS messages
FROM sized WHERE n_messages > 1 GROUP BY query_id, client, server, n_messages"""

_CONVERSATIONS_GAP = _with(_TALK, """
paused AS (SELECT *, CASE WHEN ts - lag(ts) OVER k > INTERVAL 1 DAY THEN 1 ELSE 0 END AS begins
           FROM talk WINDOW k AS (PARTITION BY query_id, client, server ORDER BY ts, seq)),
runs AS (SELECT *, sum(begins) OVER (PARTITION BY query_id, client, server ORDER BY ts, seq) AS run
         FROM paused)""") + """
SELECT query_id, client, server, min(ts) AS start, count(*) AS n_messages,
       string_agg(message, chr(10) ORDER BY ts, seq) AS messages
FROM runs GROUP BY query_id, client, server, run HAVING count(*) > 1"""

_SLICE = "least((day(ts) - 1) // 10, 2)"

_CONVERSATIONS_PER_BATCH = _with(_TALK, f"""
batch AS (SELECT query_id, client, server, {_SLICE} AS k, count(*) AS n_messages,
                 string_agg(message, chr(10) ORDER BY ts, seq) AS messages
          FROM talk GROUP BY 1, 2, 3, 4 HAVING count(*) > 1)""") + """
SELECT query_id, client, server, CAST(0 AS BIGINT) AS part, n_messages, messages FROM batch
QUALIFY row_number() OVER (PARTITION BY query_id, client, server ORDER BY k DESC) = 1"""


def _bounds(width: str) -> str:
    start = f"time_bucket(INTERVAL {width}, ts)"
    return f'{start} AS "start", {start} + INTERVAL {width} AS "end"'


_DAY = "1 DAY"
_SHORT = "20 SECONDS"


def _window_bytes(width: str) -> str:
    return _with() + f"""
SELECT {_bounds(width)}, CAST(sum(length) AS BIGINT) AS bytes, count(*) AS packets
FROM pk GROUP BY 1, 2"""


def _window_exchanged(width: str) -> str:
    return _with() + f"""
SELECT "start", "end", address, CAST(sum(s) AS BIGINT) AS packets_sent,
       CAST(sum(r) AS BIGINT) AS packets_received
FROM (SELECT {_bounds(width)}, src AS address, 1 AS s, 0 AS r FROM pk WHERE protocol = 'DNS'
      UNION ALL
      SELECT {_bounds(width)}, dst AS address, 0 AS s, 1 AS r FROM pk WHERE protocol = 'DNS')
GROUP BY "start", "end", address"""


def _window_types(width: str, counted: str = "count(*)") -> str:
    return _with() + f"""
SELECT {_bounds(width)}, concat_ws(' ', t[1], t[2]) AS type, {counted} AS count
FROM pk WHERE protocol = 'DNS' GROUP BY 1, 2, 3"""


def _window_names(width: str) -> str:
    return _with(_RECORDS) + f"""
SELECT {_bounds(width)}, type, name AS request_response, count(*) AS requests
FROM rec GROUP BY 1, 2, 3, 4"""


_BYTES_DISTINCT = _with(f"""
g AS (SELECT {_bounds(_DAY)}, message, length, count(*) AS n FROM pk GROUP BY 1, 2, 3, 4)""") + """
SELECT "start", "end", CAST(sum(length) AS BIGINT) AS bytes, CAST(sum(n) AS BIGINT) AS packets
FROM g GROUP BY 1, 2"""

# Every fifth packet was sent twice: its line counts once, its packet twice.
_BYTES_SENT_TWICE = _with(f"""
g AS (SELECT {_bounds(_DAY)}, message, length, sum(CASE WHEN seq % 5 = 0 THEN 2 ELSE 1 END) AS n
      FROM pk GROUP BY 1, 2, 3, 4)""") + """
SELECT "start", "end", CAST(sum(length) AS BIGINT) AS bytes, CAST(sum(n) AS BIGINT) AS packets
FROM g GROUP BY 1, 2"""

_NAMES_DISTINCT = _with(
    f"once AS (SELECT DISTINCT {_bounds(_DAY)}, message, t FROM pk)",
    _records("once", '"start", "end"'),
) + """
SELECT "start", "end", type, name AS request_response, count(*) AS requests
FROM rec GROUP BY 1, 2, 3, 4"""

# Late rows: each seventh packet arrives one slice late and is lost when its window had
# closed before the last packet of the slices that came earlier.
_LATE = _with(f"""
a AS (SELECT *, {_SLICE} AS own,
             CASE WHEN seq % 7 = 0 THEN least({_SLICE} + 1, 2) ELSE {_SLICE} END AS k FROM pk),
seen AS (SELECT k, max(max(ts)) OVER (ORDER BY k) AS upto FROM a GROUP BY k),
kept AS (SELECT a.* FROM a LEFT JOIN seen ON seen.k = a.k - 1
         WHERE a.protocol = 'DNS'
           AND (seen.upto IS NULL
                OR time_bucket(INTERVAL 1 DAY, a.ts) + INTERVAL 1 DAY > seen.upto))""") + f"""
SELECT {_bounds(_DAY)}, concat_ws(' ', t[1], t[2]) AS type, count(*) AS count
FROM kept GROUP BY 1, 2, 3"""

_NAME_COUNTS = _with(_RECORDS) + """
SELECT name AS request_response, type, count(*) AS requests FROM rec GROUP BY name, type"""

_REPLACED = _with(_RECORDS, """
old AS (SELECT name, type, count(*) AS n FROM rec WHERE day(ts) <= 15 GROUP BY name, type),
new AS (SELECT name, type, count(*) AS n FROM rec WHERE day(ts) > 15 GROUP BY name, type)""") + """
SELECT coalesce(new.name, old.name) AS request_response, coalesce(new.type, old.type) AS type,
       coalesce(new.n, old.n) AS requests
FROM old FULL JOIN new ON old.name = new.name AND old.type = new.type"""

_MESSAGE_TYPES = _with(_CANDIDATES) + f"""
SELECT CASE WHEN t[1] IN ({_VERBS}) THEN concat_ws(' ', t[1], t[2]) ELSE {_ERROR} END AS type,
       count(*) AS packets
FROM c GROUP BY 1"""

_ERRORS = _with(_CANDIDATES) + f"""
SELECT src AS address, count(*) AS errors FROM c WHERE t[1] NOT IN ({_VERBS}) GROUP BY src"""

_CATEGORIES = _with(_RECORDS, """
per_name AS (SELECT name, count(*) AS n FROM rec WHERE type = 'A' GROUP BY name)""") + f"""
SELECT {_CATEGORY} AS category, CAST(sum(n) AS BIGINT) AS requests FROM per_name GROUP BY 1"""

_SHARED = " UNION ALL ".join(
    f"SELECT '{table}' AS served, {key} AS item, {value} AS n FROM ({sql})"
    for table, key, value, sql in (
        ("message_types", "type", "packets", _MESSAGE_TYPES),
        ("errors", "address", "errors", _ERRORS),
        ("categories", "category", "requests", _CATEGORIES),
    )
)

def _checked(no_record: str) -> str:
    return f"""
WITH judged AS (
  SELECT event_id AS seq, CASE
    WHEN {no_record} THEN 'no record' WHEN event_id % 17 = 0 OR event_id % 11 = 0 THEN 'too few fields'
    WHEN event_id % 13 = 0 THEN 'length'
    -- The blank text is gone with the end of the line, and an empty one is left.
    WHEN event_id % 19 = 0 THEN 'no text' END AS reason FROM events)
SELECT seq, CASE WHEN reason IS NULL THEN 'parsed' ELSE 'quarantined' END AS state, reason,
       count(*) OVER () AS n_read, count(*) FILTER (reason IS NULL) OVER () AS n_parsed,
       count(reason) OVER () AS n_quarantined
FROM judged"""


_NO_TEXT, _NO_NUMBER = "CAST(NULL AS VARCHAR)", "CAST(NULL AS BIGINT)"
_WINDOW_TOTALS = " UNION ALL ".join(
    f"""SELECT '{kind}' AS kind, "start", "end", {key} AS key, {name} AS name, {a} AS a, {b} AS b FROM ({sql})"""
    for kind, key, name, a, b, sql in (
        ("window_bytes_packets", _NO_TEXT, _NO_TEXT, "bytes", "packets", _window_bytes(_DAY)),
        ("window_exchanged_packets", "address", _NO_TEXT, "packets_sent", "packets_received",
         _window_exchanged(_DAY)),
        ("window_message_types", "type", _NO_TEXT, "count", _NO_NUMBER, _window_types(_DAY)),
        ("window_names", "type", "request_response", "requests", _NO_NUMBER, _window_names(_DAY)),
    )
)

_HOSTS_DNS = _hosts("protocol = 'DNS'", _NAME_COUNT)
_HOSTS = _hosts("true", _NAME_COUNT)
_NAMESERVER_ACTIVITY = _with(_NAMESERVERS) + _ALL_BRANCHES
_ROUNDED = _pairs("src < dst", avg=_TWO_DECIMALS)

ORACLES: dict[str, str] = {
    "parse_packets": _with() + "SELECT seq, src, dst, protocol, length, info FROM pk",
    "parse_stream_envelope": _with() + f"""
SELECT CAST(seq % {TOPIC_PARTITIONS} AS INTEGER) AS partition, seq // {TOPIC_PARTITIONS} AS "offset",
       message FROM pk""",
    "parse_slice_envelope": _with(r"""
js AS (SELECT seq, concat('{"message":"', replace(message, '"', '\"'), '"}') AS value FROM pk)
""") + "SELECT seq, substring(value, 13, length(value) - 14) AS message FROM js",
    "query_domains": _with(_RECORDS) + "SELECT seq, name AS domain FROM rec WHERE type = 'A'",
    "response_records": _with(_RECORDS) + """
SELECT seq, type, name AS request_response FROM rec WHERE type <> 'A'""",
    "query_direction": _with() + f"""
SELECT seq, CASE WHEN {_QUERY} THEN 'query' ELSE 'response' END AS direction
FROM pk WHERE t[1] IN ('Standard', 'DNS', 'Inverse')""",
    "chunk_assign": """
SELECT event_id AS seq, (row_number() OVER (ORDER BY event_id) - 1) // 4000 AS chunk_id
FROM events""",
    "parse_checked": _checked("false"),
    "stream_parse_checked": _checked("event_id % 23 = 0"),
    "directed_traffic": _with(_DIRECTED) + "SELECT src, dst, total, n AS count FROM d",
    "pair_traffic": _pairs(_NUMERIC),
    "pair_traffic_join": _pairs(_NUMERIC, self_pairs=False),
    "pair_traffic_no_self": _pairs(_NUMERIC, self_pairs=False),
    "pair_traffic_rounded": _ROUNDED,
    "tsv_output": _ROUNDED,
    "tsv_single_file": _ROUNDED,
    "pair_traffic_from_table": _pairs(_NUMERIC),
    "pair_average_ranked": _AVERAGES,
    "unique_hosts": _HOSTS,
    "unique_hosts_ranked": _HOSTS,
    "unique_hosts_dns": _HOSTS_DNS,
    "hive_style_views": _hosts("true", "type, name, count(*) AS n"),
    "hive_pair_views": _AVERAGES,
    # Files by the hour, rows in capture order within.
    "capture_chunks": _with() + """
SELECT (row_number() OVER (ORDER BY hour(ts), seq) - 1) // 4000 AS chunk, src, dst, protocol,
       CAST(length AS VARCHAR) AS length, r.info
FROM pk JOIN (SELECT seq AS s, info FROM raw) r ON pk.seq = r.s""",
    "host_pairs": _with(_RECORDS) + """
SELECT DISTINCT type, name AS request_response, src AS host FROM rec""",
    "host_lists": _hosts("true", f"""{_NAME_COUNT}, CAST(0 AS BIGINT) AS part,
       string_agg(src, ',' ORDER BY src) AS hosts"""),
    "find_hosts": _with(_NAMESERVERS, f"ns AS ({_ALL_BRANCHES})", """
everyone AS (SELECT src AS address FROM pk UNION SELECT dst FROM pk)""") + """
SELECT everyone.address AS host FROM everyone LEFT JOIN ns ON everyone.address = ns.address
WHERE ns.address IS NULL""",
    "find_hosts_served": _with(_NAMESERVERS, f"ns AS ({_ALL_BRANCHES})") + """
SELECT address AS host FROM (SELECT src AS address FROM pk UNION SELECT dst FROM pk)
WHERE address NOT IN (SELECT address FROM ns)""",
    "find_hosts_join": _with(_NAMESERVERS, f"ns AS ({_ALL_BRANCHES})") + """
SELECT DISTINCT p.address AS host FROM (SELECT src AS address FROM pk UNION SELECT dst FROM pk) AS p
WHERE NOT EXISTS (SELECT 1 FROM ns WHERE ns.address = p.address)""",
    "host_list_parts": _with(_RECORDS, """
hosts AS (SELECT DISTINCT type, name, src FROM rec)""") + """
SELECT type, name AS request_response, src AS host,
       count(*) OVER (PARTITION BY type, name) AS count FROM hosts""",
    "message_types": _MESSAGE_TYPES,
    "error_sources": _ERRORS,
    "nameserver_activity": _NAMESERVER_ACTIVITY,
    "nameserver_queries_only": _with(_NAMESERVERS) + _nameservers("queries"),
    "nameserver_updates_only": _with(_NAMESERVERS) + _nameservers("updates"),
    "nameserver_status_only": _with(_NAMESERVERS) + _nameservers("status"),
    "name_counts": _NAME_COUNTS,
    "category_counts": _CATEGORIES,
    "conversations": _CONVERSATIONS,
    "conversation_parts": _with(_TALK) + """
SELECT query_id, client, server, n_messages, CAST(floor(epoch(ts) / 86400) AS BIGINT) AS part, message,
       row_number() OVER (PARTITION BY query_id, client, server, floor(epoch(ts) / 86400)
                          ORDER BY ts, seq) - 1 AS place
FROM sized WHERE n_messages > 1""",
    "conversations_gap": _CONVERSATIONS_GAP,
    "conversation_messages": _with(_TALK) + """
SELECT query_id, client, server, n_messages, seq, message FROM sized WHERE n_messages > 1""",
    "window_bytes_packets": _window_bytes(_DAY),
    "window_exchanged_packets": _window_exchanged(_DAY),
    "window_message_types": _window_types(_DAY),
    "window_names": _window_names(_DAY),
    "window_bytes_packets_20s": _window_bytes(_SHORT),
    "window_exchanged_packets_20s": _window_exchanged(_SHORT),
    "window_message_types_20s": _window_types(_SHORT),
    "window_names_20s": _window_names(_SHORT),
    "window_bytes_packets_distinct": _BYTES_DISTINCT,
    "window_message_types_distinct": _window_types(_DAY, "count(DISTINCT message)"),
    "window_names_distinct": _NAMES_DISTINCT,
    "upsert_replace": _REPLACED,
    "upsert_add": _NAME_COUNTS,
    "upsert_replay": _NAME_COUNTS,
    "upsert_restart": _NAME_COUNTS,
    "serving_compact": _NAME_COUNTS,
    "serving_nameservers": _NAMESERVER_ACTIVITY,
    "serving_lookup": _with(_RECORDS) + """
SELECT name AS request_response, type, count(*) AS requests
FROM rec WHERE name = 'google.com' AND type = 'A' GROUP BY name, type""",
    "stream_message_types": _MESSAGE_TYPES,
    "stream_errors": _ERRORS,
    "stream_nameservers": _NAMESERVER_ACTIVITY,
    "stream_nameservers_from_evidence": _NAMESERVER_ACTIVITY,
    "stream_name_counts": _NAME_COUNTS,
    "stream_categories": _CATEGORIES,
    "stream_shared": _SHARED,
    "stream_conversations": _CONVERSATIONS,
    "stream_conversations_gap": _CONVERSATIONS_GAP,
    "stream_conversations_per_batch": _CONVERSATIONS_PER_BATCH,
    "stream_window_bytes_packets": _window_bytes(_DAY),
    "stream_window_exchanged_packets": _window_exchanged(_DAY),
    "stream_window_message_types": _window_types(_DAY),
    "stream_window_names": _window_names(_DAY),
    "stream_conversations_closed": _CONVERSATIONS_GAP,
    "stream_window_bytes_packets_distinct": _BYTES_SENT_TWICE,
    "stream_window_message_types_distinct": _window_types(_DAY, "count(DISTINCT message)"),
    "stream_window_names_distinct": _NAMES_DISTINCT,
    "stream_window_totals": _WINDOW_TOTALS,
    "stream_resume": _window_names(_DAY),
    "late_rows_dropped": _LATE,
    "archive_roundtrip": _with() + "SELECT src, dst, protocol, length, info FROM pk",
    # Lines with a comma in a field are quoted; a quote before a field changes only these texts.
    "csv_to_conversations": _with("""
quoted AS (SELECT * REPLACE (CASE WHEN contains(message, '"') THEN concat('"', info) ELSE info END AS info)
                  FROM pk),
again AS (SELECT * REPLACE (string_split(info, ' ') AS t) FROM quoted)""",
        _TALK.replace("FROM pk", "FROM again")) + """
SELECT query_id, client, server, n_messages, message FROM sized WHERE n_messages > 1""",
    # A field with a comma is quoted in the chunk file, and the quote stays with the text.
    "csv_ingest_roundtrip": _with() + """
SELECT src, dst, protocol, length,
       CASE WHEN contains(message, '"') THEN concat('"', info) ELSE info END AS info FROM pk""",
}
