"""DuckDB oracle SQL for the registered queries (same column names, same data).

Written as plain relational SQL (distinct counts, self-joins, ``EXISTS``,
joins against the login days) rather than mirroring the Spark plans, so the
two sides check each other. The derived formats (game log, tab lines) are re-derived here from
``events`` with DuckDB's own functions.
"""

from __future__ import annotations

from tessera.schemas import CN_WEEKDAYS, EVENT_TYPES, HEALING_ITEM, RATE_COLUMNS

BASE = "2024-01-10"
FIRST_OPEN = "2024-01-08"
REPORT_DATES = [f"2024-01-{d:02d}" for d in range(8, 18)]
SPLIT = "2024-01-15"
AS_OF = "2024-01-31"
DAYS = 7
MAX_AVG_MS = 6 * 3600 * 1000

_WEEKDAYS = "[" + ", ".join(f"'{w}'" for w in CN_WEEKDAYS) + "]"
_K = r"CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER)"

# ---------------------------------------------------------------- derived formats

GLOG = f"""
SELECT event_id, ts, value,
  CASE WHEN value >= 1.0 THEN CAST(user_id AS VARCHAR) END AS userName,
  CASE event_type WHEN 'signup' THEN '1' WHEN 'view' THEN '2' WHEN 'error' THEN '3'
                  WHEN 'purchase' THEN '12' WHEN 'click' THEN '11' END AS eventType,
  CASE WHEN value > 480.0 THEN 'not a time'
       ELSE strftime(ts, '%Y年%-m月%-d日') || ',' || {_WEEKDAYS}[dayofweek(ts) + 1] || ','
            || CASE WHEN k % 4 = 1 THEN strftime(ts, '%-H:%-M:%-S') || '.5' ELSE strftime(ts, '%H:%M:%S') END
  END AS time,
  CASE WHEN k >= 90 THEN NULL
       WHEN k >= 85 THEN CAST(k + 100 AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR) || '.1'
       ELSE CAST(k + 100 AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR) || '.'
            || CAST(event_id % 250 AS VARCHAR) || '.1' END AS ip
FROM (SELECT *, {_K} AS k FROM events)
"""

# offline log after defaults: missing -> ''
GLOG_D = f"""
SELECT event_id, ts, value, coalesce(userName, '') AS userName, coalesce(eventType, '') AS eventType,
       coalesce(time, '') AS time, coalesce(ip, '') AS ip
FROM ({GLOG})
"""

_IP_OK = r"regexp_full_match(ip, '(\d{1,3}\.){3}\d{1,3}')"
# parsed Chinese time: the source ts to the second, NULL for the garbage rows
_CN_TS = "CASE WHEN value > 480.0 THEN NULL ELSE date_trunc('second', ts) END"

LINES = f"""
SELECT event_id, ts, ts + to_minutes(event_id % 45) AS arrival,
  CASE WHEN value < 2.0 THEN concat_ws(chr(9), {{head}})
       ELSE concat_ws(chr(9), {{head}}, CAST(event_id % 13 AS VARCHAR), time) END AS line
FROM (
  SELECT event_id, ts, value,
    CAST(event_id AS VARCHAR) AS f0,
    CASE WHEN value >= 2.0 AND value < 4.0 THEN 'x' ELSE '' END
      || CASE WHEN event_type = 'click' THEN '11' ELSE '10' END AS code,
    CASE WHEN k % 3 = 0 THEN CAST(user_id AS VARCHAR) || ' ' ELSE CAST(user_id AS VARCHAR) END AS usr,
    CASE WHEN k < 50 THEN '{HEALING_ITEM}' ELSE 'item' || CAST(k AS VARCHAR) END AS item,
    CASE WHEN value >= 4.0 AND value < 6.0 THEN '2024-13-45 99:99:99'
         WHEN k % 4 = 1 THEN strftime(ts, '%Y-%-m-%-d %-H:%-M:%-S') || '.5'
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS time
  FROM (SELECT *, {_K} AS k FROM events)
)
""".replace("{head}", ", ".join(
    {0: "f0", 3: "code", 7: "usr", 8: "item"}.get(i, f"CAST(event_id % {i + 2} AS VARCHAR)") for i in range(11)))

_NAMES = ["f0", "f1", "f2", "eventType", "f4", "f5", "f6", "userName", "item", "f9", "f10", "f11", "time"]
_FIELDS = ", ".join(f"trim(string_split(line, chr(9))[{i + 1}]) AS {n}" for i, n in enumerate(_NAMES))

FIELDS = f"SELECT event_id, ts, arrival, line, {_FIELDS} FROM ({LINES})"

PARSED = f"""
SELECT *,
  CASE WHEN time IS NULL THEN 'short line' WHEN event_code IS NULL THEN 'bad event type'
       WHEN event_ts IS NULL THEN 'bad time' END AS reason,
  (time IS NOT NULL AND event_code IS NOT NULL AND event_ts IS NOT NULL) AS is_valid
FROM (SELECT *, TRY_CAST(eventType AS INTEGER) AS event_code,
             try_strptime(string_split(time, '.')[1], '%Y-%m-%d %H:%M:%S') AS event_ts FROM ({FIELDS}))
"""

_PARSED_COLS = ", ".join(_NAMES) + ", event_code, event_ts, is_valid, reason"

# ---------------------------------------------------------------- retention


def _day(n: int) -> tuple[str, str]:
    return (f"TIMESTAMP '{BASE}' + INTERVAL {n} DAY", f"TIMESTAMP '{BASE}' + INTERVAL {n + 1} DAY")


def _in_day(col: str, n: int) -> str:
    lo, hi = _day(n)
    return f"{col} >= {lo} AND {col} < {hi}"


def _counts(src: str = "events", user: str = "user_id", ev: str = "event_type", ts: str = "ts",
            reg: str = "'signup'", login: str = "'view'", base: str = BASE) -> str:
    """newAddUserCnt, activeUserCnt, dN_retained: each new user once, with EXISTS for every day they came back."""
    def day(n: int) -> str:
        return f"{ts} >= TIMESTAMP '{base}' + INTERVAL {n} DAY AND {ts} < TIMESTAMP '{base}' + INTERVAL {n + 1} DAY"

    per_day = ",\n".join(
        f"  count(*) FILTER (WHERE EXISTS (SELECT 1 FROM logins l WHERE l.u = n.u AND l.d = {n})) AS d{n}_retained" for n in range(1, DAYS + 1))
    logins = " UNION ALL ".join(f"SELECT {user} AS u, {n} AS d FROM {src} WHERE {ev} = {login} AND {day(n)}" for n in range(1, DAYS + 1))
    return f"""
WITH logins AS ({logins}), fresh AS (SELECT DISTINCT {user} AS u FROM {src} WHERE {ev} = {reg} AND {day(0)} AND {user} IS NOT NULL)
SELECT
  (SELECT count(*) FROM fresh) AS newAddUserCnt,
  (SELECT count(DISTINCT {user}) FROM {src} WHERE {ev} IN ({reg}, {login}) AND {day(0)}) AS activeUserCnt,
{per_day}
FROM fresh n
"""


COUNTS = _counts()


def _pct(num: str, den: str) -> str:
    return f"CAST(CAST({num} * 100.0 / nullif({den}, 0) AS DECIMAL(18,2)) AS VARCHAR) || '%'"


def _report(counts_sql: str, base: str = BASE) -> str:
    rates = ",\n  ".join(f"{_pct(f'd{n}_retained', 'newAddUserCnt')} AS {c}"
                         for n, c in enumerate(RATE_COLUMNS, 1))
    return f"""
SELECT '{base}' AS date, CAST(newAddUserCnt AS BIGINT) AS newAddUserCnt,
  CAST(activeUserCnt AS BIGINT) AS activeUserCnt,
  {rates}
FROM ({counts_sql})
"""


def _report_on(base: str) -> str:
    """The report of one date from the raw game log."""
    src = f"(SELECT userName, eventType, {_CN_TS} AS event_ts FROM ({GLOG_D}) WHERE {_IP_OK} AND value <= 480.0)"
    return _report(_counts(src, "userName", "eventType", "event_ts", "'1'", "'2'", base), base)


def _long(counts_sql: str) -> str:
    parts = " UNION ALL ".join(
        f"SELECT {n} AS day_n, CAST(d{n}_retained AS BIGINT) AS retained_users FROM c" for n in range(1, DAYS + 1))
    return f"WITH c AS ({counts_sql}) {parts}"


def _matrix(where: str = "TRUE") -> str:
    """All cohort dates: (user, day) flags joined with login days d+1..d+7."""
    joins = "\n".join(
        f"LEFT JOIN ud l{n} ON l{n}.u = c.u AND l{n}.login AND l{n}.d = c.d + {n}" for n in range(1, DAYS + 1))
    cols = ",\n  ".join(
        f"CAST(count(*) FILTER (WHERE c.reg AND l{n}.u IS NOT NULL) AS BIGINT) AS d{n}_retained"
        for n in range(1, DAYS + 1))
    return f"""
WITH ud AS (
  SELECT user_id AS u, CAST(ts AS DATE) AS d, bool_or(event_type = 'signup') AS reg, bool_or(event_type = 'view') AS login
  FROM events WHERE user_id IS NOT NULL AND event_type IN ('signup', 'view') AND {where}
  GROUP BY 1, 2)
SELECT c.d AS date,
  CAST(count(*) FILTER (WHERE c.reg) AS BIGINT) AS newAddUserCnt,
  CAST(count(*) AS BIGINT) AS activeUserCnt,
  {cols}
FROM ud c
{joins}
GROUP BY c.d
"""


def _report_rows(matrix_sql: str) -> str:
    rates = ",\n  ".join(f"{_pct(f'd{n}_retained', 'newAddUserCnt')} AS {c}"
                         for n, c in enumerate(RATE_COLUMNS, 1))
    return f"""
SELECT strftime(date, '%Y-%m-%d') AS date, newAddUserCnt, activeUserCnt,
  {rates}
FROM ({matrix_sql})
"""


# ---------------------------------------------------------------- bursts


def _bursts(src: str, user: str, ts: str, gap: str | None = None) -> str:
    """Sliding 1 day / 12 h windows: each row lands in the bucket of its 12 h slot and the one before.

    ``gap`` is the column that gaps are measured on, if it is another than the windows'.
    """
    gap = gap or ts
    avg = "CAST((max(ms) - min(ms)) / count(*) AS DECIMAL(18,4))"
    return f"""
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, {user}, cnt, CAST(avg4 AS DOUBLE) AS avgTime
FROM (
  SELECT time_bucket(INTERVAL 12 HOUR, {ts}, TIMESTAMP '1970-01-01') - k.k * INTERVAL 12 HOUR AS window_start,
         {user}, count(*) AS cnt, {avg} AS avg4
  FROM (SELECT {user}, {ts}, (epoch_us({gap}) // 1000) AS ms FROM ({src}) WHERE {ts} IS NOT NULL) c
  CROSS JOIN (VALUES (0), (1)) k(k)
  GROUP BY ALL
)
WHERE cnt >= 2 AND avg4 < {MAX_AVG_MS}
"""


CLICKS = "SELECT user_id, ts FROM events WHERE event_type = 'click'"
BURSTS = _bursts(CLICKS, "user_id", "ts")
NAMED = f"SELECT window_start, window_end, CAST(user_id AS VARCHAR) AS userName, cnt, avgTime FROM ({BURSTS})"

_EXISTING = f"""
SELECT userName, arg_max(avgTime, window_end) AS avgTime, CAST(count(*) AS INTEGER) AS cnt
FROM ({NAMED}) WHERE window_end < TIMESTAMP '{SPLIT}' GROUP BY userName
"""
_BATCH = f"""
SELECT userName, arg_max(avgTime, window_end) AS avgTime, count(*) AS k
FROM ({NAMED}) WHERE window_end >= TIMESTAMP '{SPLIT}' GROUP BY userName
"""
BLACKLIST = f"""
SELECT coalesce(o.userName, b.userName) AS userName,
       CAST(coalesce(b.avgTime, o.avgTime) AS DOUBLE) AS avgTime,
       CAST(CASE WHEN o.userName IS NULL THEN 1 + b.k - 1 ELSE o.cnt + coalesce(b.k, 0) END AS INTEGER) AS cnt
FROM ({_EXISTING}) o FULL OUTER JOIN ({_BATCH}) b ON o.userName = b.userName
"""

_DICT = ", ".join(f"({c}, '{lbl}')" for c, lbl in EVENT_TYPES)

# ---------------------------------------------------------------- records in order of arrival

_ARRIVALS = "SELECT event_id, ts + to_minutes(event_id % 45) AS arrival, ts FROM events"
LATE = f"""
SELECT *, coalesce(ts < watermark, FALSE) AS late FROM (
  SELECT *, max(ts) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS watermark FROM ({_ARRIVALS}))
"""
_CLICK_ARRIVALS = """
SELECT *, max(ts) OVER (ORDER BY ts + to_hours(event_id % 45), event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS watermark
FROM events WHERE event_type = 'click'"""
ON_TIME = f"""
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, user_id, cnt, CAST(avg4 AS DOUBLE) AS avgTime FROM (
  SELECT window_start, user_id, count(*) AS cnt, CAST((max(epoch_us(ts) // 1000) - min(epoch_us(ts) // 1000)) / count(*) AS DECIMAL(18,4)) AS avg4
  FROM (SELECT user_id, ts, watermark, time_bucket(INTERVAL 12 HOUR, ts, TIMESTAMP '1970-01-01') - k.k * INTERVAL 12 HOUR AS window_start
        FROM ({_CLICK_ARRIVALS}) CROSS JOIN (VALUES (0), (1)) k(k) WHERE ts IS NOT NULL)
  WHERE watermark IS NULL OR window_start + INTERVAL 1 DAY > watermark GROUP BY ALL)
WHERE cnt >= 2 AND avg4 < {MAX_AVG_MS}
"""
#: Every click in each of its 24 windows.
HOURLY = f"""
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, user_id, cnt, CAST(avg4 AS DOUBLE) AS avgTime FROM (
  SELECT date_trunc('hour', ts) - to_hours(k.k) AS window_start, user_id, count(*) AS cnt,
         CAST((max(epoch_us(ts) // 1000) - min(epoch_us(ts) // 1000)) / count(*) AS DECIMAL(18,4)) AS avg4
  FROM ({CLICKS}) CROSS JOIN (SELECT CAST(unnest(generate_series(0, 23)) AS INTEGER) AS k) k WHERE ts IS NOT NULL GROUP BY ALL)
WHERE cnt >= 2 AND avg4 < {MAX_AVG_MS}
"""

# ---------------------------------------------------------------- players over time

#: One offence after the other: the count so far, until the account is closed.
HISTORY = f"""
WITH RECURSIVE o AS (SELECT userName, window_end AS "at", row_number() OVER (PARTITION BY userName ORDER BY window_end) AS n,
                       lead(window_end) OVER (PARTITION BY userName ORDER BY window_end) AS later
                     FROM ({NAMED}) WHERE window_end <= TIMESTAMP '{AS_OF}'),
r AS (SELECT userName, "at", n, later, CAST(1 AS BIGINT) AS cnt FROM o WHERE n = 1
      UNION ALL
      SELECT o.userName, o."at", o.n, o.later, CASE WHEN r."at" + INTERVAL 7 DAY < o."at" THEN 1 ELSE r.cnt + 1 END
      FROM r JOIN o ON o.userName = r.userName AND o.n = r.n + 1 WHERE r.cnt <= 3)
SELECT userName, "at", 'warn' AS action, cnt FROM r WHERE cnt = 1
UNION ALL SELECT userName, "at", 'close', cnt FROM r WHERE cnt > 3
UNION ALL SELECT userName, "at" + INTERVAL 7 DAY, 'clear', CAST(0 AS BIGINT) FROM r
  WHERE cnt <= 3 AND "at" + INTERVAL 7 DAY < TIMESTAMP '{AS_OF}' AND (later IS NULL OR later > "at" + INTERVAL 7 DAY)
"""
POLL_START, POLL_END = "2024-01-08 00:00:01", "2024-01-20 00:00:00"
#: Ticks at odd seconds: from the first at or after a player's first window to the last before the end.
POLLED = f"""
WITH w AS (SELECT userName, avgTime, window_end, epoch_us(window_end) - epoch_us(TIMESTAMP '{POLL_START}') AS us FROM ({NAMED})),
last AS (SELECT (epoch_us(TIMESTAMP '{POLL_END}') - epoch_us(TIMESTAMP '{POLL_START}')) // 2000000 AS tick)
SELECT userName, arg_max(avgTime, window_end) AS avgTime, CAST(max(tick) - greatest(ceil(min(us) / 2000000.0), 0) + 1 AS BIGINT) AS cnt
FROM w, last WHERE us <= tick * 2000000 GROUP BY userName
"""

# ---------------------------------------------------------------- the table

ORACLE: dict[str, str] = {
    # offline log
    "scan_gamelog": f"SELECT userName, eventType, time, ip FROM ({GLOG})",
    "gamelog_defaults": f"SELECT userName, eventType, time, ip FROM ({GLOG_D})",
    "ip_filter": f"SELECT userName, eventType, time, ip FROM ({GLOG_D}) WHERE {_IP_OK}",
    "parse_cn_time": f"SELECT userName, eventType, time, {_CN_TS} AS event_ts FROM ({GLOG_D})",
    "get_time_mills": f"SELECT userName, time, (epoch_us({_CN_TS}) // 1000) AS time_ms FROM ({GLOG_D})",
    "gamelog_quarantine": f"""
        SELECT userName, eventType, time, ip,
               CASE WHEN NOT {_IP_OK} THEN 'bad ip' ELSE 'bad time' END AS reason
        FROM ({GLOG_D}) WHERE NOT {_IP_OK} OR value > 480.0""",
    "gamelog_report": _report(_counts(
        src=f"(SELECT userName, eventType, {_CN_TS} AS event_ts FROM ({GLOG_D}) WHERE {_IP_OK} AND value <= 480.0)",
        user="userName", ev="eventType", ts="event_ts", reg="'1'", login="'2'")),
    "event_decode": f"""
        SELECT g.event_id, g.eventType, d.label AS event_label
        FROM ({GLOG}) g LEFT JOIN (VALUES {_DICT}) d(code, label) ON TRY_CAST(g.eventType AS INTEGER) = d.code""",
    # tab lines
    "parse_log_line": f"SELECT {_PARSED_COLS} FROM ({PARSED})",
    "quarantine": f"SELECT f0, line, reason FROM ({PARSED}) WHERE NOT is_valid",
    "item_use_filter": f"SELECT userName, event_ts FROM ({PARSED}) WHERE is_valid AND event_code = 11 AND item = '{HEALING_ITEM}'",
    "parse_iso_time": f"SELECT f0, time, (epoch_us(event_ts) // 1000) AS event_ms FROM ({PARSED})",
    "scan_log_dir": f"SELECT {', '.join(_NAMES)} FROM ({FIELDS})",
    "burst_lines": _bursts(
        f"SELECT userName, event_ts FROM ({PARSED}) WHERE is_valid AND event_code = 11 AND item = '{HEALING_ITEM}'",
        "userName", "event_ts"),
    # events
    "event_in": "SELECT event_id, user_id, event_type, ts FROM events WHERE event_type IN ('signup', 'view')",
    "day_slice": f"SELECT event_id, user_id, event_type, ts FROM events WHERE {_in_day('ts', 0)}",
    "day_bounds": f"""
        SELECT day, epoch_ms(CAST(day AS TIMESTAMP)) AS start_ms,
               epoch_ms(CAST(day AS TIMESTAMP) + INTERVAL 1 DAY) AS end_ms,
               epoch_ms(CAST(day AS TIMESTAMP) + INTERVAL {DAYS + 1} DAY) AS horizon_ms
        FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE ts IS NOT NULL)""",
    "distinct_users": "SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL",
    "new_users": f"SELECT DISTINCT user_id FROM events WHERE event_type = 'signup' AND {_in_day('ts', 0)} AND user_id IS NOT NULL",
    "active_users": f"SELECT DISTINCT user_id FROM events WHERE event_type IN ('signup', 'view') AND {_in_day('ts', 0)} AND user_id IS NOT NULL",
    "retained_day1": f"""
        SELECT count(*) AS retained_users FROM (
          SELECT DISTINCT user_id FROM events n WHERE event_type = 'signup' AND {_in_day('ts', 0)}
            AND EXISTS (SELECT 1 FROM events l WHERE l.user_id = n.user_id AND l.event_type = 'view' AND {_in_day('l.ts', 1)}))""",
    "retained_dayn": _long(COUNTS),
    "retained_semi": _long(COUNTS),
    "retained_selfjoin": _long(COUNTS),
    "retained_intersect": _long(COUNTS),
    "retention_counts": COUNTS,
    "first_row": f"SELECT * FROM ({COUNTS}) LIMIT 1",
    "metrics_union": COUNTS,
    "retention_rate": "SELECT newAddUserCnt, activeUserCnt, " + ", ".join(
        f"round(d{n}_retained * 100.0 / nullif(newAddUserCnt, 0), 4) AS d{n}_rate" for n in range(1, DAYS + 1))
        + f" FROM ({COUNTS})",
    "retention_report": _report(COUNTS),
    "retention_matrix": _matrix(),
    "retention_bitmaps": _matrix(),
    "retention_by_loads": _matrix(),
    "stream_latest": f"SELECT line AS value, arrival AS ingest_ts FROM ({LINES}) WHERE arrival >= TIMESTAMP '{SPLIT}'",
    "burst_messages": BURSTS,
    "late_records": LATE,
    "late_records_stream": LATE,
    "burst_on_time": ON_TIME,
    "burst_panes": HOURLY,
    "sanction_history": HISTORY,
    "blacklist_polled": POLLED,
    "blacklist_bucketed": BLACKLIST,
    "user_history": "SELECT event_id, user_id, event_type, ts, value FROM events WHERE user_id IN (7, 77, 777)",
    "percent_text": f"""
        WITH m AS ({_matrix()})
        SELECT date, day_n, {_pct('retained', 'newAddUserCnt')} AS rate FROM (
          {" UNION ALL ".join(f"SELECT date, newAddUserCnt, {n} AS day_n, d{n}_retained AS retained FROM m"
                              for n in range(1, DAYS + 1))})""",
    # bursts
    "burst_stats": """
        SELECT user_id, count(*) AS cnt, max(epoch_us(ts) // 1000) AS maxTime, min(epoch_us(ts) // 1000) AS minTime,
               CAST(CAST((max(epoch_us(ts) // 1000) - min(epoch_us(ts) // 1000)) / count(*) AS DECIMAL(18,4)) AS DOUBLE) AS avgTime
        FROM events WHERE event_type = 'click' AND ts IS NOT NULL GROUP BY user_id""",
    "burst_players": BURSTS,
    "burst_stream": BURSTS,
    "burst_stream_complete": f"SELECT user_id, avgTime FROM ({BURSTS})",
    "burst_stream_wm": BURSTS,
    "late_drop": BURSTS,
    "blacklist_stream": f"""
        SELECT CAST(user_id AS VARCHAR) AS userName, arg_max(avgTime, window_end) AS avgTime,
               CAST(count(*) AS INTEGER) AS cnt
        FROM ({BURSTS}) GROUP BY user_id""",
    "sync_blacklist": f"""
        SELECT userName, arg_max(avgTime, window_end) AS avgTime, CAST(2 AS INTEGER) AS cnt FROM ({NAMED}) GROUP BY userName""",
    "burst_stream_ingest": _bursts(
        f"SELECT userName, arrival, event_ts FROM ({PARSED}) WHERE is_valid AND event_code = 11 AND item = '{HEALING_ITEM}'",
        "userName", "arrival", "event_ts"),
    "stream_ingest": f"SELECT arrival AS ingest_ts, {_PARSED_COLS} FROM ({PARSED})",
    "merge_stats": """
        SELECT user_id, count(ts) AS cnt, max(epoch_us(ts) // 1000) AS maxTime, min(epoch_us(ts) // 1000) AS minTime
        FROM events WHERE event_type = 'click' AND ts IS NOT NULL GROUP BY user_id""",
    "daily_report_saved": " UNION ALL ".join(f"({_report_on(d)})" for d in REPORT_DATES),
    # keyed tables
    "flagged_latest": f"""
        SELECT userName, arg_max(avgTime, window_end) AS avgTime, max(window_end) AS window_end
        FROM ({NAMED}) GROUP BY userName""",
    "flagged_snapshot": f"SELECT userName, arg_max(avgTime, window_end) AS avgTime FROM ({NAMED}) GROUP BY userName",
    "blacklist_merge": BLACKLIST,
    "upsert_daily": f"""
        WITH stale AS ({_report_rows(_matrix(f"ts < TIMESTAMP '{SPLIT}'"))}),
             fresh AS (SELECT * FROM ({_report_rows(_matrix())}) WHERE date >= '{FIRST_OPEN}')
        SELECT * FROM stale WHERE date NOT IN (SELECT date FROM fresh)
        UNION ALL SELECT * FROM fresh""",
    "sanctions": f"""
        SELECT b.userName, b.avgTime, b.cnt, s.last_seen,
               CASE WHEN b.cnt > 3 THEN 'close'
                    WHEN s.last_seen < TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY THEN 'clear'
                    ELSE 'warn' END AS action
        FROM ({BLACKLIST}) b
        LEFT JOIN (SELECT userName, max(window_end) AS last_seen FROM ({NAMED}) GROUP BY userName) s
          ON b.userName = s.userName""",
}
