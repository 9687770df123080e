"""The registered queries as DuckDB SQL, over whole tables."""

from __future__ import annotations

from millrace.operators.policy import RollPolicy
from millrace.plans.queries import (
    AS_OF,
    FILE_POLICY,
    FIRST_INSTANT_US,
    FRESH_S,
    LAND_POLICY,
    MAX_FILE_BYTES,
    ONE_BUCKET,
    POLICY,
)


def iso(ts: str) -> str:
    return (
        f"strftime({ts}, '%Y-%m-%dT%H:%M:%S') || "
        f"CASE WHEN epoch_us({ts}) % 1000000 = 0 THEN '' "
        f"WHEN epoch_us({ts}) % 1000 = 0 THEN strftime({ts}, '.%g') "
        f"ELSE strftime({ts}, '.%f') END || 'Z'"
    )


def line(index: str, ts: str) -> str:
    return f"'Record-' || {index} || ': Data from foams column at ' || {iso(ts)}"


def bucket(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d--%H')"


RECORDS = f"""
r AS (
  SELECT event_id AS index, ts, epoch_us(ts) AS us, event_type,
         {line("event_id", "ts")} AS foams, {bucket("ts")} AS bucket
  FROM events
)"""


def parts(parallelism: int, policy: RollPolicy = POLICY) -> str:
    """The rolling rule as a recursion over the row number within (bucket, subtask)."""
    due = (
        f"s.us - g.open >= {policy.age_us} OR s.us - g.us >= {policy.idle_us} "
        f"OR g.held > {policy.size}"
    )
    return f"""
WITH RECURSIVE {RECORDS},
s AS (
  SELECT bucket, CAST(index % {parallelism} AS BIGINT) AS subtask, index, us,
         octet_length(encode(foams)) + 1 AS size,
         row_number() OVER (PARTITION BY bucket, index % {parallelism} ORDER BY us, index) AS rn
  FROM r
),
g AS (
  SELECT bucket, subtask, index, us, size, rn,
         CAST(0 AS BIGINT) AS part, us AS open, size AS held
  FROM s WHERE rn = 1
  UNION ALL
  SELECT s.bucket, s.subtask, s.index, s.us, s.size, s.rn,
         CASE WHEN {due} THEN g.part + 1 ELSE g.part END,
         CASE WHEN {due} THEN s.us ELSE g.open END,
         CASE WHEN {due} THEN s.size ELSE g.held + s.size END
  FROM g JOIN s ON s.bucket = g.bucket AND s.subtask = g.subtask AND s.rn = g.rn + 1
),
p AS (
  SELECT bucket, subtask, part, count(*) AS records, CAST(sum(size) AS BIGINT) AS bytes,
         min(us) AS opened_us, max(us) AS closed_us
  FROM g GROUP BY bucket, subtask, part
)"""


def scorecard(before: str, largest: str, limit: int) -> str:
    """The six checks; ``before`` defines the records, ``largest`` the size of the largest file."""
    return f"""{before},
f AS (
  SELECT count(*) AS records, count(DISTINCT index) AS n, min(index) AS lo, max(index) AS hi,
         max(us) AS newest, {largest} AS largest
  FROM r
),
c AS (
  SELECT 'table_not_empty' AS "check", records > 0 AS ok FROM f
  UNION ALL SELECT 'lines_match', (SELECT bool_and(regexp_matches(foams,
    '^Record-\\d+: Data from foams column at \\d{{4}}-\\d\\d-\\d\\dT\\d\\d:\\d\\d:\\d\\d(\\.\\d{{3,9}})?Z$'))
    FROM r) FROM f
  UNION ALL SELECT 'no_duplicates', n = records FROM f
  UNION ALL SELECT 'no_gaps', hi - lo + 1 = n FROM f
  UNION ALL SELECT 'fresh',
    newest >= epoch_us(TIMESTAMP '{AS_OF}') - {FRESH_S * 1_000_000} FROM f
  UNION ALL SELECT 'file_sizes', largest <= {limit} FROM f
),
t AS (SELECT CAST(count(*) FILTER (ok) AS INTEGER) AS score FROM c)
SELECT "check", CAST(ok AS INTEGER) AS passed, score,
       CASE WHEN score = 6 THEN 'ok' WHEN score >= 4 THEN 'partial' ELSE 'failed' END AS verdict
FROM c, t"""


SECOND_HALF_MARKED = f"""
WITH {RECORDS}, m AS (SELECT floor(avg(us)) AS middle FROM r)
SELECT foams || CASE WHEN us > middle THEN '#2' ELSE '' END AS foams, bucket FROM r, m"""

GENERATED = """
g AS (
  SELECT range AS index, make_timestamp({first} + range * 500000) AS ts
  FROM range(0, (SELECT count(*) FROM lineitem))
)""".format(first=FIRST_INSTANT_US)

RECENT = "ts >= (SELECT max(ts) FROM events) - INTERVAL 1 DAY"

ORACLES = {
    "generate_records": f"""
WITH {GENERATED}
SELECT index, {line("index", "ts")} AS foams, {bucket("ts")} AS bucket FROM g""",
    "format_event_records": f"WITH {RECORDS} SELECT index, foams, bucket FROM r",
    "parse_records": "SELECT event_id AS index, epoch_us(ts) AS ts_us FROM events",
    "hourly_bucket_counts": f"""
WITH {RECORDS} SELECT bucket, count(*) AS records FROM r GROUP BY bucket""",
    "text_sink_roundtrip": f"WITH {RECORDS} SELECT foams, bucket FROM r",
    "stream_generated": """
WITH n AS (SELECT count(*) AS n FROM events),
g AS (SELECT event_id AS index, (event_id * 1000000) // n AS passed_us FROM events, n)
SELECT passed_us // 100000 AS slot, count(*) AS records,
       min(index) AS first_index, max(index) AS last_index
FROM g GROUP BY slot""",
    "restart_exactly_once": f"WITH {RECORDS} SELECT foams, bucket FROM r",
    "csv_text_roundtrip": "SELECT doc_id, text FROM documents",
    "own_render": f"""
WITH {RECORDS} SELECT index, index || '|' || bucket AS foams, bucket FROM r""",
    "key_pattern_count": """
SELECT count(*) AS records FROM events WHERE extract(hour FROM ts) < 6""",
    "external_table_count": "SELECT count(*) AS records FROM events",
    "scan_one_bucket": f"""
WITH {RECORDS} SELECT foams, bucket FROM r WHERE bucket = '{ONE_BUCKET}'""",
    "limit_records": f"""
WITH {RECORDS} SELECT foams, bucket FROM r ORDER BY index LIMIT 10""",
    "csv_scan_limit": f"WITH {RECORDS} SELECT foams FROM r ORDER BY index LIMIT 10",
    "roll_by_inactivity": f"""
WITH {RECORDS},
l AS (
  SELECT bucket, index, us,
         CASE WHEN us - lag(us) OVER (PARTITION BY bucket ORDER BY us, index)
              >= {POLICY.idle_us} THEN 1 ELSE 0 END AS paused
  FROM r
)
SELECT bucket, index,
       CAST(sum(paused) OVER (PARTITION BY bucket ORDER BY us, index
            ROWS UNBOUNDED PRECEDING) AS BIGINT) AS part
FROM l""",
    "assign_parts": f"{parts(1)} SELECT bucket, subtask, index, part FROM g",
    "part_summary": f"""{parts(2)}
SELECT bucket, subtask, part, records, bytes, opened_us, closed_us FROM p""",
    "recent_parts": f"""{parts(2)}
SELECT bucket || '/part-' || subtask || '-' || part AS name, records, bytes
FROM p ORDER BY bucket DESC, subtask DESC, part DESC LIMIT 5""",
    "layout_summary": f"""{parts(2)}
SELECT count(*) AS parts, CAST(sum(records) AS BIGINT) AS records,
       CAST(sum(bytes) AS BIGINT) AS bytes FROM p""",
    "rolled_files": f"""{parts(2, FILE_POLICY)}
SELECT bucket, subtask, part, records, bytes FROM p""",
    "last_rolled_files": f"""{parts(2, FILE_POLICY)}
SELECT bucket || '/part-' || subtask || '-' || part AS name, records, bytes
FROM p ORDER BY bucket DESC, subtask DESC, part DESC LIMIT 5""",
    "rolled_layout": f"""{parts(2, FILE_POLICY)}
SELECT count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes FROM p""",
    "file_inventory": f"""
WITH {RECORDS}
SELECT bucket, CAST(sum(octet_length(encode(foams)) + 1) AS BIGINT) AS bytes
FROM r GROUP BY bucket""",
    "rows_per_file": f"""
WITH {RECORDS} SELECT bucket, count(*) AS records FROM r GROUP BY bucket""",
    "recent_events": f"SELECT event_id, event_type FROM events WHERE {RECENT}",
    "last_events": f"""
SELECT event_id, event_type FROM events WHERE {RECENT}
ORDER BY ts DESC, event_id DESC LIMIT 10""",
    "error_events": """
SELECT event_id, event_type FROM events WHERE contains(event_type, 'error')""",
    "pattern_events": """
SELECT event_id, event_type FROM events
WHERE regexp_matches(event_type, 'SIGN|ERROR', 'i')""",
    "pattern_counts": r"""
SELECT count(*) FILTER (regexp_matches(props, '"k": \d\d?\}')) AS matching,
       count(*) FILTER (NOT regexp_matches(props, '"k": \d\d?\}')) AS other
FROM events""",
    "table_size": f"""
WITH {RECORDS}
SELECT count(*) AS records, CAST(sum(octet_length(encode(foams)) + 1) AS BIGINT) AS bytes
FROM r""",
    "health_scorecard": scorecard(parts(2), "(SELECT max(bytes) FROM p)", MAX_FILE_BYTES),
    "foreign_layout": f"""
WITH {RECORDS} SELECT bucket, count(*) AS records FROM r GROUP BY bucket""",
    "redeploy": SECOND_HALF_MARKED,
    "restore_savepoint": SECOND_HALF_MARKED,
    "progress_rows": """
SELECT count(*) AS rows_read, CAST(1 AS BIGINT) AS failures, CAST(2 AS BIGINT) AS finished
FROM events""",
    "live_parts": f"{parts(1)} SELECT bucket, subtask, index, part FROM g",
    "facts_per_hour": f"""
WITH {RECORDS}
SELECT bucket, count(*) AS records,
       CAST(sum(octet_length(encode(foams)) + 1) AS BIGINT) AS bytes
FROM r GROUP BY bucket""",
    "recent_by_facts": f"WITH {RECORDS} SELECT index, foams FROM r WHERE {RECENT}",
    # A file holds lines of one hour, and no hour reaches the limit.
    "grown_scorecard": scorecard(
        f"WITH {RECORDS}",
        "(SELECT max(b) FROM (SELECT sum(octet_length(encode(foams)) + 1) AS b FROM r GROUP BY bucket))",
        LAND_POLICY.max_bytes,
    ),
    "listing_scorecard": scorecard(
        parts(2, FILE_POLICY), "(SELECT max(bytes) FROM p)", FILE_POLICY.max_bytes + 82
    ),
}
