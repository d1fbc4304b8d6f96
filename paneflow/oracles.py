"""SQL over the same tables that gives what each query should return."""

from __future__ import annotations

MINUTE, HOUR, DAY = 60_000, 3_600_000, 86_400_000
DELAY, LATENESS, EARLY = 10 * MINUTE, 20 * MINUTE, 10 * MINUTE
PART, SHORT_PART = 100_000, 40
BATCH = 6 * HOUR

EVENTS = """
ev AS (
  SELECT event_id, user_id, event_type, value, props, epoch_us(ts) // 1000 AS ms FROM events
)"""

ARRIVALS = EVENTS + f""",
ar AS (
  SELECT *, ms + ((event_id * 7919) % 97) * {MINUTE} + dup * {5 * MINUTE} AS arr
  FROM (SELECT *, 0 AS dup FROM ev
        UNION ALL SELECT *, 1 AS dup FROM ev WHERE event_id % 10 = 3)
)"""


def _windows(source: str, ms: str, size: int, name: str = "win") -> str:
    return f"""
{name} AS (
  SELECT *, {ms} - {ms} % {size} AS w_start, {ms} - {ms} % {size} + {size} AS w_end
  FROM {source}
)"""


SEEN = ARRIVALS + "," + _windows("ar", "ms", HOUR) + f""",
wms AS (
  SELECT *, max(ms) OVER (ORDER BY arr, event_id, dup
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {DELAY} AS wm
  FROM win
),
seen AS (
  SELECT *, CASE WHEN wm >= w_end - 1 + {LATENESS} THEN 'late'
                 WHEN wm >= w_end - 1 THEN 'allowed' ELSE 'on_time' END AS status
  FROM wms
)"""


def _distinct(source: str, key: str, name: str = "firsts", extra: str = "") -> str:
    """First arrival of each distinct record of a key and window."""
    return f"""
{name} AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY {key}, w_start, event_id, event_type, value, props, ms
      ORDER BY arr, event_id, dup) AS nth
    FROM {source}) WHERE nth = 1
)"""


def _placed(source: str, key: str, order: str, part_rows: int, name: str = "placed") -> str:
    return f"""
{name} AS (
  SELECT *, (row_number() OVER (PARTITION BY {key}, w_start ORDER BY {order}) - 1)
            // {part_rows} AS part
  FROM {source}
)"""


BY_EVENT = "ms, arr, event_id, dup"
BY_ARRIVAL = "arr, event_id, dup"


def _listed(source: str, key: str, order: str, columns: str, where: str = "") -> str:
    return f"""
SELECT {key}, w_start, w_end, part{columns}, count(*) AS n,
       string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY {order}) AS ids
FROM {source} {where} GROUP BY ALL"""


def _distinct_lists(ctes: str, source: str, key: str, part_rows: int = PART) -> str:
    return (
        "WITH " + ctes + "," + _distinct(source, key) + ","
        + _placed("firsts", key, BY_EVENT, part_rows) + _listed("placed", key, BY_EVENT, "")
    )


def _concat_lists(ms: str, key: str, size: int, part_rows: int = PART) -> str:
    return (
        "WITH " + ARRIVALS + "," + _windows("ar", ms, size) + ","
        + _placed("win", key, BY_ARRIVAL, part_rows) + _listed("placed", key, BY_ARRIVAL, "")
    )


# Event-time job: accepted rows, their lists, and what each fire shows of them.
ACCEPTED = SEEN + """,
acc AS (SELECT * FROM seen WHERE status <> 'late'),""" + _distinct("acc", "user_id") + "," + _placed(
    "firsts", "user_id", BY_EVENT, PART
)

ON_TIME = """
SELECT user_id, w_start, w_end, part, 0 AS pane, 'on_time' AS kind, count(*) AS n,
       string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY ms, arr, event_id, dup) AS ids
FROM placed WHERE status = 'on_time' GROUP BY ALL"""

REFIRE = """
SELECT p.user_id, p.w_start, p.w_end, p.part, t.pane, 'refire' AS kind, count(*) AS n,
       string_agg(CAST(p.event_id AS VARCHAR), ',' ORDER BY p.ms, p.arr, p.event_id, p.dup) AS ids
FROM (
  SELECT user_id, w_start, arr, event_id, dup,
         row_number() OVER (PARTITION BY user_id, w_start ORDER BY arr, event_id, dup) AS pane
  FROM acc WHERE status = 'allowed') t
JOIN placed p ON p.user_id = t.user_id AND p.w_start = t.w_start
  AND (p.arr, p.event_id, p.dup) <= (t.arr, t.event_id, t.dup)
GROUP BY ALL"""


# Re-fires over rows of one event type: lists cut into short parts, and single records.
TYPE_ACCEPTED = SEEN + """,
acc AS (SELECT * FROM seen WHERE status <> 'late'),""" + _distinct("acc", "event_type")

TYPE_MARKS = """
(SELECT event_type, w_start, w_end, arr, event_id, dup,
        row_number() OVER (PARTITION BY event_type, w_start ORDER BY arr, event_id, dup) AS pane
 FROM acc WHERE status = 'allowed')"""

FULL_SMALL_PARTS = f"""
WITH {TYPE_ACCEPTED},
shown AS (
  SELECT event_type, w_start, w_end, 0 AS pane, 'on_time' AS kind, ms, arr, event_id, dup
  FROM firsts WHERE status = 'on_time'
  UNION ALL
  SELECT p.event_type, p.w_start, p.w_end, t.pane, 'refire', p.ms, p.arr, p.event_id, p.dup
  FROM {TYPE_MARKS} t JOIN firsts p ON p.event_type = t.event_type AND p.w_start = t.w_start
    AND (p.arr, p.event_id, p.dup) <= (t.arr, t.event_id, t.dup)
), cut AS (
  SELECT *, (row_number() OVER (PARTITION BY event_type, w_start, pane, kind
             ORDER BY ms, arr, event_id, dup) - 1) // 2 AS part FROM shown
)
SELECT event_type, w_start, w_end, part, pane, kind, count(*) AS n,
       string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY ms, arr, event_id, dup) AS ids
FROM cut GROUP BY ALL"""

DELTAS = f"""
WITH {TYPE_ACCEPTED}
SELECT event_type, w_start, w_end, 0 AS part, pane, 'refire_delta' AS kind, 1 AS n,
       CAST(event_id AS VARCHAR) AS ids
FROM {TYPE_MARKS}"""


def _late(source: str, where: str) -> str:
    return f"""
SELECT user_id, w_start, w_end, 0 AS part, 0 AS pane, 'late' AS kind, 1 AS n,
       CAST(event_id AS VARCHAR) AS ids
FROM {source} WHERE {where}"""


# Custom-window job; `clock` is the arrival time or the watermark a row met.
def _custom(clock: str) -> str:
    return SEEN + f""",
clk AS (SELECT *, {clock} AS clock FROM seen),
acc AS (SELECT * FROM clk WHERE clock IS NULL OR clock < w_end + {LATENESS}),""" + _distinct(
        "acc", "user_id"
    ) + "," + _placed("firsts", "user_id", BY_EVENT, PART)


def _early(instants: str, condition: str = "") -> str:
    return f"""
SELECT user_id, w_start, w_end, part, b // {EARLY} - w_start // {EARLY} AS pane,
       'early' AS kind, count(*) AS n,
       string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY ms, arr, event_id, dup) AS ids
FROM placed p, {instants} WHERE (p.clock IS NULL OR p.clock < g.b) AND g.b < p.w_end
GROUP BY ALL"""


ALIGNED = f"""
LATERAL (SELECT unnest(generate_series(w_start, w_end - 1, {EARLY})) AS b) g"""

# Instants at which the watermark fires: of several passed in one step, the first.
PASSED = f"""
(SELECT DISTINCT wm - wm % {EARLY} + {EARLY} AS b FROM seen
 WHERE wm IS NOT NULL AND ms - {DELAY} >= wm - wm % {EARLY} + {EARLY}) g"""

FINAL = f"""
SELECT user_id, w_start, w_end, part,
       (w_end + {EARLY - 1}) // {EARLY} - w_start // {EARLY} AS pane, 'final' AS kind,
       count(*) AS n,
       string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY ms, arr, event_id, dup) AS ids
FROM placed GROUP BY ALL"""

CUSTOM_LATE = _late("clk", f"clock >= w_end + {LATENESS}")

PAYLOADS = EVENTS + """,
pay AS (
  SELECT event_id, CASE WHEN event_id % 17 = 0 THEN left(props, length(props) - 1)
                        WHEN event_id % 19 = 0 THEN '{"k": null}'
                        WHEN event_id % 23 = 0 THEN '{}' ELSE props END AS value
  FROM ev
),
judged AS (
  SELECT *, CASE WHEN NOT json_valid(value) THEN 'malformed payload'
                 WHEN json_extract_string(value, '$.k') IS NULL
                 THEN 'missing required field: k' END AS reason
  FROM pay
)"""

COMPANIES = ARRIVALS + f""",
sent AS (
  SELECT event_id, dup, arr, user_id, ms,
    '{{"id": ' || user_id || ', "companyName": "skyknight", "tradeLicenseNumber": '
    || CASE WHEN event_id % 13 = 0 THEN '' ELSE '"' END || event_type
    || '", "match": false, "eventTime": '
    || CASE WHEN event_id % 2 = 0
            THEN '"' || strftime(epoch_ms(ms + {4 * HOUR}), '%Y-%m-%dT%H:%M:%S.%g') || '+04:00"'
            ELSE CAST(ms AS VARCHAR) END
    || ', "shareHolders": [{{"id": ' || event_id || ', "cif": '
    || CASE WHEN event_id % 29 = 0 THEN 'null' ELSE '"cif"' END
    || ', "firstName": "Ben", "lastName": "Stone", "match": false}}]}}' AS value
  FROM ar
),
judged AS (
  SELECT *, CASE WHEN NOT json_valid(value) THEN 'malformed payload'
                 WHEN json_extract_string(value, '$.shareHolders[0].cif') IS NULL
                 THEN 'missing required field: shareHolders[].cif' END AS reason
  FROM sent
),
fine AS (
  SELECT *, json_extract_string(value, '$.eventTime') AS raw,
         TRY_CAST(json_extract_string(value, '$.eventTime') AS BIGINT) AS num
  FROM judged WHERE reason IS NULL
),
good AS (
  SELECT event_id, dup, arr, CAST(json_extract(value, '$.id') AS BIGINT) AS id,
    json_extract_string(value, '$.companyName') AS company_name,
    json_extract_string(value, '$.tradeLicenseNumber') AS trade_license_number,
    CAST(json_extract(value, '$.match') AS BOOLEAN) AS match,
    coalesce(num, CAST(date_diff('millisecond', TIMESTAMP '1970-01-01',
             strptime(left(raw, 23), '%Y-%m-%dT%H:%M:%S.%g')) AS BIGINT) - {4 * HOUR}) AS event_time,
    CAST(json_array_length(value, '$.shareHolders') AS BIGINT) AS n_share_holders,
    CAST(json_extract(value, '$.shareHolders[0].id') AS BIGINT) AS holder_id,
    json_extract_string(value, '$.shareHolders[0].cif') || '||'
      || json_extract_string(value, '$.shareHolders[0].firstName') || '|'
      || json_extract_string(value, '$.shareHolders[0].lastName') || '|' AS holder
  FROM fine
)"""

# Streaming jobs: arrivals in equal stretches of the arrival clock, one watermark per batch.
MICRO_BATCHES = 5
STREAM_LATENESS = 6 * HOUR
HELD_BACK = ARRIVALS + f""",
held AS (SELECT * REPLACE (arr + event_id % 7 * {2 * HOUR} AS arr) FROM ar)"""


def _micro(source: str, ms: str, name: str = "mb") -> str:
    """Rows of `source` with their batch and the watermark it met; the last watermark."""
    return f"""
{name}_of AS (
  SELECT *, (arr - (SELECT min(arr) FROM held)) * {MICRO_BATCHES}
            // (SELECT max(arr) - min(arr) + 1 FROM held) AS batch FROM {source}
),
{name}_tops AS (SELECT batch, max({ms}) AS top FROM {name}_of GROUP BY batch),
{name}_wms AS (
  SELECT batch, max(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING
                               AND 1 PRECEDING) - {DELAY} AS wm FROM {name}_tops
),
{name} AS (SELECT o.*, w.wm FROM {name}_of o JOIN {name}_wms w USING (batch)),
ended AS (SELECT max({ms}) - {DELAY} AS wm_end FROM {source})"""


STATUS = f"""CASE WHEN wm >= w_end - 1 + {STREAM_LATENESS} THEN 'late'
             WHEN wm >= w_end - 1 THEN 'allowed' ELSE 'on_time' END"""
STREAM_SEEN = HELD_BACK + "," + _micro("held", "ms") + "," + _windows("mb", "ms", HOUR) + f""",
seen AS (SELECT *, {STATUS} AS status FROM win)"""
STREAM_ACCEPTED = STREAM_SEEN + """,
acc AS (SELECT * FROM seen WHERE status <> 'late'),""" + _distinct("acc", "user_id") + "," + _placed(
    "firsts", "user_id", BY_EVENT, PART
)
STREAM_ON_TIME = ON_TIME.replace("status = 'on_time'", "status = 'on_time' AND w_end - 1 <= (SELECT wm_end FROM ended)")
STREAM_CUSTOM = STREAM_SEEN + f""",
clk AS (SELECT *, wm AS clock FROM seen),
acc AS (SELECT * FROM clk WHERE clock IS NULL OR clock < w_end + {STREAM_LATENESS}),""" + _distinct(
    "acc", "user_id"
) + "," + _placed("firsts", "user_id", BY_EVENT, PART)
STREAM_PASSED = f"""
(SELECT DISTINCT wm - wm % {EARLY} + {EARLY} AS b FROM mb_wms, ended
 WHERE wm IS NOT NULL AND wm_end >= wm - wm % {EARLY} + {EARLY}) g"""
STREAM_FINAL = FINAL.replace("FROM placed", f"FROM placed WHERE w_end + {STREAM_LATENESS} <= (SELECT wm_end FROM ended)")

COMPANY_STREAM = COMPANIES.replace(ARRIVALS, HELD_BACK).replace("FROM ar\n)", "FROM held\n)") + "," + _micro("good", "event_time") + "," + _windows("mb", "event_time", HOUR) + f""",
seen AS (SELECT *, {STATUS} AS status FROM win),
acc AS (SELECT * FROM seen WHERE status <> 'late'),
firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id, w_start, holder_id, event_time,
      trade_license_number ORDER BY arr, event_id, dup) AS nth FROM acc) WHERE nth = 1
),
marks AS (
  SELECT *, row_number() OVER (PARTITION BY id, w_start ORDER BY arr, event_id, dup) AS pane
  FROM acc WHERE status = 'allowed'
),
shown AS (
  SELECT 'on_time' AS kind, id, w_start, 0 AS pane, holder_id, event_time, arr, event_id, dup
  FROM firsts WHERE status = 'on_time' AND w_end - 1 <= (SELECT wm_end FROM ended)
  UNION ALL
  SELECT 'refire', f.id, f.w_start, m.pane, f.holder_id, f.event_time, f.arr, f.event_id, f.dup
  FROM marks m JOIN firsts f ON f.id = m.id AND f.w_start = m.w_start
    AND (f.arr, f.event_id, f.dup) <= (m.arr, m.event_id, m.dup)
)"""

ORACLES: dict[str, str] = {
    "event_window_distinct_sorted": _distinct_lists(
        ARRIVALS + "," + _windows("ar", "ms", HOUR), "win", "user_id"
    ),
    "ingest_window_concat": _concat_lists("arr", "user_id", HOUR),
    "ingestion_time_results": _concat_lists("arr", "event_type", HOUR),
    "aligned_window_30s": _distinct_lists(
        ARRIVALS + "," + _windows("ar", "ms", 30_000), "win", "event_type"
    ),
    "window_lists_in_parts": _distinct_lists(
        ARRIVALS + "," + _windows("ar", "ms", DAY), "win", "event_type", SHORT_PART
    ),
    "concat_lists_in_parts": _concat_lists("arr", "event_type", DAY, SHORT_PART),
    "watermark_trace": f"""
WITH {ARRIVALS}
SELECT arr, event_id, dup, ms,
       max(ms) OVER (ORDER BY arr, event_id, dup
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {DELAY} AS wm
FROM ar""",
    "micro_batch_watermark": f"""
WITH {ARRIVALS},
b AS (SELECT arr // {BATCH} AS batch, max(ms) AS top FROM ar GROUP BY 1),
p AS (SELECT batch, max(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING
                                   AND 1 PRECEDING) - {DELAY} AS wm FROM b)
SELECT p.batch, event_id, dup, wm FROM ar JOIN p ON ar.arr // {BATCH} = p.batch""",
    "row_lateness_status": f"WITH {SEEN} SELECT event_id, dup, w_end, wm, status FROM seen",
    "window_results_final": _distinct_lists(
        SEEN + ", acc AS (SELECT * FROM seen WHERE status <> 'late')", "acc", "user_id"
    ),
    "late_side_output": f"""
WITH {SEEN}
SELECT user_id, w_start, w_end, event_id, dup, event_type, value, props, ms
FROM seen WHERE status = 'late'""",
    "late_counter": f"""
WITH {SEEN} SELECT arr // {DAY} AS day, count(*) AS late FROM seen WHERE status = 'late' GROUP BY 1""",
    "on_time_results": f"WITH {ACCEPTED} {ON_TIME}",
    "allowed_late_refires": f"WITH {ACCEPTED} {REFIRE}",
    "refires_full_small_parts": FULL_SMALL_PARTS,
    "refires_delta": DELTAS,
    "event_time_results": f"""
WITH {ACCEPTED} {ON_TIME} UNION ALL {REFIRE} UNION ALL {_late("seen", "status = 'late'")}""",
    "early_fire_panes": f"WITH {_custom('arr')} {_early(ALIGNED)}",
    "early_fire_panes_event_time": f"WITH {_custom('wm')} {_early(PASSED)}",
    "final_fire_at_lateness": f"WITH {_custom('arr')} {FINAL}",
    "custom_window_results": f"""
WITH {_custom('arr')} {_early(ALIGNED)} UNION ALL {FINAL} UNION ALL {CUSTOM_LATE}""",
    "custom_window_results_event_time": f"""
WITH {_custom('wm')} {_early(PASSED)} UNION ALL {FINAL} UNION ALL {CUSTOM_LATE}""",
    "dead_letter_split": f"""
WITH {PAYLOADS} SELECT event_id, reason, value FROM judged WHERE reason IS NOT NULL""",
    "valid_split": f"""
WITH {PAYLOADS} SELECT event_id, CAST(json_extract(value, '$.k') AS BIGINT) AS k
FROM judged WHERE reason IS NULL""",
    "company_payloads": f"""
WITH {COMPANIES}
SELECT event_id, dup, id, company_name, trade_license_number, match, event_time,
       n_share_holders, holder_id, holder FROM good""",
    "company_dead_letters": f"""
WITH {COMPANIES}
SELECT event_id, reason, CAST(strlen(value) AS BIGINT) AS payload_bytes
FROM judged WHERE reason IS NOT NULL""",
    "company_aggregates": f"""
WITH {COMPANIES},
firsts AS (
  SELECT id, event_time, holder_id, min((arr, event_id, dup)) AS first_at,
         event_time - event_time % {HOUR} AS w_start
  FROM good GROUP BY id, company_name, trade_license_number, match, event_time,
                     n_share_holders, holder_id, holder
),
placed AS (
  SELECT *, (row_number() OVER (PARTITION BY id, w_start ORDER BY event_time, first_at) - 1)
            // {PART} AS part
  FROM firsts
)
SELECT id, w_start, part, count(*) AS n,
       string_agg(holder_id || '@' || event_time, ',' ORDER BY event_time, first_at) AS companies
FROM placed GROUP BY ALL""",
    "wrap_single": f"""
WITH {EVENTS} SELECT user_id, 1 AS n, CAST(event_id AS VARCHAR) AS ids FROM ev""",
    "iso_event_time": f"""
WITH {EVENTS}
SELECT event_id, strftime(epoch_ms(ms), '%Y-%m-%dT%H:%M:%S.%gZ') AS iso, ms AS back_ms FROM ev""",
    "next_early_instant": f"""
WITH {ARRIVALS} SELECT event_id, dup, (arr // {EARLY} + 1) * {EARLY} AS next_ms FROM ar""",
    "synthetic_events": """
SELECT c_custkey AS id, 'Skynight Inc' AS companyName, 'Trd4534rF' AS tradeLicenseNumber,
       false AS match, 1704067200000 + i * 2000 AS eventTime,
       'Cf123/Ada Stone;Cf789/Ben Stone' AS share_holders
FROM customer, generate_series(0, 9) AS s(i)""",
    "synthetic_rounds": """
SELECT i AS id, 'Skynight Inc' AS companyName, 'Trd4534rF' AS tradeLicenseNumber,
       false AS match, 1704067200000 + (event_id * 10 + i) * 500 AS eventTime,
       'Cf123/Ada Stone;Cf789/Ben Stone' AS share_holders
FROM events, generate_series(0, 9) AS s(i)""",
    "stream_event_time_results": f"""
WITH {EVENTS}, {_windows("ev", "ms", HOUR)}
SELECT user_id, w_start, w_end, 'on_time' AS kind, count(*) AS n,
       string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY ms, event_id) AS ids
FROM (SELECT DISTINCT * FROM win)
GROUP BY ALL""",
    "stream_ingestion_results": f"""
WITH {EVENTS}, {_windows("ev", "ms", HOUR)}
SELECT user_id, w_start, w_end, 'final' AS kind, count(*) AS n,
       string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY ms, event_id) AS ids
FROM win
GROUP BY ALL""",
    "stream_fired_panes": f"""
WITH {STREAM_ACCEPTED} {STREAM_ON_TIME} UNION ALL {REFIRE} UNION ALL {_late("seen", "status = 'late'")}""",
    "stream_refires": f"""
WITH {STREAM_SEEN},
acc AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, w_start, event_id, event_type, value, props, ms
                               ORDER BY arr, event_id, dup) = 1 AS fresh
  FROM seen WHERE status <> 'late'
)
SELECT user_id, w_start, w_end, event_id, dup, fresh FROM acc WHERE status = 'allowed'""",
    "stream_late_rows": f"""
WITH {STREAM_SEEN}
SELECT user_id, w_start, w_end, event_id, dup, event_type, value, props, ms
FROM seen WHERE status = 'late'""",
    "stream_late_counter": f"""
WITH {STREAM_SEEN} SELECT count(*) AS late FROM seen WHERE status = 'late'""",
    "stream_custom_window_results": f"""
WITH {STREAM_CUSTOM} {_early(STREAM_PASSED)} UNION ALL {STREAM_FINAL}
UNION ALL {_late("clk", f"clock >= w_end + {STREAM_LATENESS}")}""",
    "stream_ingestion_lists": f"""
WITH {HELD_BACK}, {_windows("held", "arr", HOUR)}, {_placed("win", "user_id", BY_ARRIVAL, PART)}
SELECT user_id, w_start, w_end, part, 0::BIGINT AS pane, 'final' AS kind, count(*) AS n,
       string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY arr, event_id, dup) AS ids
FROM placed WHERE w_end - 1 <= (SELECT max(arr) FROM held) GROUP BY ALL""",
    "stream_ingestion_stamps": f"""
WITH {HELD_BACK}, {_micro("held", "ms")}
SELECT user_id, event_id, dup, row_number() OVER (PARTITION BY user_id
         ORDER BY batch, user_id % 3, event_id * 2 + dup) AS nth
FROM mb""",
    "job_with_dead_letters": f"""
WITH {COMPANY_STREAM}
SELECT kind, id, w_start, pane, string_agg(holder_id || '@' || event_time, ','
         ORDER BY event_time, arr, event_id, dup) AS companies,
       NULL::VARCHAR AS reason, NULL::BIGINT AS "offset"
FROM shown GROUP BY ALL
UNION ALL
SELECT 'late', id, w_start, 0, holder_id || '@' || event_time, NULL, NULL FROM seen WHERE status = 'late'
UNION ALL
SELECT 'dead_letter', NULL, NULL, NULL, NULL, reason, event_id * 2 + dup FROM judged WHERE reason IS NOT NULL""",
}
