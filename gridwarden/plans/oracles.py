"""The registered queries once more, as plain SQL for another engine.

Written from the definitions (range joins over the windows, no buckets), not from the Spark plans.
"""

from __future__ import annotations

WEEKS = """weeks(week_start) AS (
  VALUES (TIMESTAMP '2024-01-08'), (TIMESTAMP '2024-01-15'), (TIMESTAMP '2024-01-22'), (TIMESTAMP '2024-01-29')
)"""

UNEVEN = "weeks(week_start) AS (SELECT TIMESTAMP '2024-01-05' + to_days((i + i * i // 9)::INTEGER) FROM range(20) AS r(i))"

RAW = """tele AS (
  SELECT printf('%012X', user_id) AS gateway_id, ts, event_id, value AS x0,
         CAST(event_type = 'error' AS INTEGER) AS x1, CAST(event_type = 'signup' AS INTEGER) AS x2
  FROM events
)"""

UNIQUE = """tele AS (
  SELECT printf('%012X', user_id) AS gateway_id, ts, event_id, value AS x0,
         CAST(event_type = 'error' AS INTEGER) AS x1, CAST(event_type = 'signup' AS INTEGER) AS x2
  FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id) = 1
)"""

# Readings sent twice: the first one counts. One week has no data.
REPEATED = """sent AS (
  SELECT printf('%012X', user_id) AS gateway_id, ts, event_id, copy, value + copy * 5000 AS x0,
         CAST(event_type = 'error' AS INTEGER) AS x1, CAST(event_type = 'signup' AS INTEGER) AS x2
  FROM events, unnest(range(0, CASE WHEN event_id % 5 = 0 THEN 2 ELSE 1 END)) AS u(copy)
), tele AS (
  SELECT * FROM sent QUALIFY row_number() OVER (PARTITION BY gateway_id, ts ORDER BY event_id, copy) = 1
)"""

DIRTY = """dirty AS (
  SELECT CASE WHEN event_id % 3 = 0 THEN ' ' || concat_ws(':',
           substr(low, 1, 2), substr(low, 3, 2), substr(low, 5, 2),
           substr(low, 7, 2), substr(low, 9, 2), substr(low, 11, 2)) || chr(9) ELSE bare END AS gateway_id,
         CASE WHEN event_id % 97 = 0 THEN ['bad', '12:30', 'T10:00', '2024-01', '2024-01-05 junk'][1 + event_id // 97 % 5] ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS ts_utc,
         CASE WHEN event_id % 11 = 0 THEN 'abc' WHEN event_id % 13 = 0 THEN '-' || reading
              ELSE ' ' || reading END AS offline_duration_sec,
         CASE WHEN event_id % 17 = 0 THEN '5d' ELSE CAST(CAST(event_type = 'error' AS INTEGER) AS VARCHAR) END
           AS disconnection_cnt,
         CASE WHEN event_type = 'signup' THEN '1' WHEN event_id % 7 = 0 THEN '-1' END AS reboot_cnt,
         'part-' || (user_id % 4) AS source_file,
         event_id, copy
  FROM (
    SELECT *, printf('%012X', user_id) AS bare, lower(printf('%012X', user_id)) AS low,
           CAST(CAST(round(value * 100) AS BIGINT) + copy * 7 AS VARCHAR) AS reading
    FROM (
      SELECT e.*, CAST(u.copy AS INTEGER) AS copy
      FROM events e, unnest(range(0, CASE WHEN event_id % 50 = 0 THEN 2 ELSE 1 END)) AS u(copy)
    )
  )
)"""

CLEAN = (
    DIRTY
    + """, clean AS (
  SELECT upper(replace(trim(gateway_id, ' ' || chr(9)), ':', '')) AS gateway_id,
         try_cast(ts_utc AS TIMESTAMP) AS ts_utc,
         greatest(coalesce(try_cast(trim(offline_duration_sec) AS DOUBLE), 0), 0) AS offline_duration_sec,
         CASE WHEN disconnection_cnt = '5d' THEN 0.0
              ELSE greatest(coalesce(try_cast(disconnection_cnt AS DOUBLE), 0), 0) END AS disconnection_cnt,
         greatest(coalesce(try_cast(reboot_cnt AS DOUBLE), 0), 0) AS reboot_cnt,
         source_file, event_id, copy
  FROM dirty WHERE try_cast(ts_utc AS TIMESTAMP) IS NOT NULL
  QUALIFY row_number() OVER (
    PARTITION BY upper(replace(trim(gateway_id, ' ' || chr(9)), ':', '')), try_cast(ts_utc AS TIMESTAMP)
    ORDER BY event_id, copy) = 1
)"""
)

VISITS = """visits AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS visit_id,
         printf('%012X', l_suppkey) AS gateway_id,
         CASE WHEN l_linenumber = 5 THEN ['soon', strftime(o_orderdate, '%Y-%m'),
                strftime(o_orderdate, '%Y-%m-%d') || ' junk', '12:30'][1 + l_orderkey % 4]
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS requested_on,
         strftime(l_shipdate, '%Y-%m-%d') AS visited_on,
         o_orderpriority AS reason_reported,
         CASE WHEN l_returnflag = 'R' THEN ' Fehler  behöben ' WHEN l_returnflag = 'A' THEN 'Kein Fehler gefunden'
              WHEN l_linenumber = 1 THEN 'FIXED' ELSE 'sonstiges' END AS outcome,
         CASE WHEN l_linenumber = 6 THEN '-' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)
              WHEN l_linenumber <> 7 THEN CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS technician_hours,
         CASE WHEN l_linestatus = 'F' AND l_linenumber = 2 THEN ' N  A '
              WHEN l_linestatus = 'F' THEN 'Netzteil' END AS parts_replaced
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey,
       unnest(range(0, CASE WHEN l_orderkey % 20 = 0 THEN 2 ELSE 1 END)) AS u(copy)
)"""

CLEAN_VISITS = (
    VISITS
    + """, clean_visits AS (
  SELECT DISTINCT visit_id, upper(gateway_id) AS gateway_id,
         strftime(try_cast(requested_on AS DATE), '%Y-%m-%d') AS requested_on,
         strftime(try_cast(visited_on AS DATE), '%Y-%m-%d') AS visited_on,
         reason_reported, outcome,
         CASE WHEN CAST(technician_hours AS DOUBLE) < 0 THEN 0.0 ELSE CAST(technician_hours AS DOUBLE) END
           AS technician_hours,
         coalesce(parts_replaced, '') AS parts_replaced
  FROM visits
)"""
)

METER = """meter AS (
  SELECT strftime(l_shipdate, '%Y-%m-%d') AS week_start, printf('%012X', l_suppkey) AS gateway_id,
         CAST(round(l_tax * 100) AS BIGINT) AS meters_expected,
         CAST(round(l_discount * 100) AS BIGINT) AS meters_read
  FROM lineitem
)"""

REVIEWS = """reviews AS (
  SELECT CASE WHEN s_suppkey % 3 = 0 THEN lower(printf('%012X', s_suppkey)) ELSE printf('%012X', s_suppkey) END
           AS gateway_id,
         CASE WHEN s_suppkey % 13 = 12 THEN NULL WHEN (s_nationkey % 3 = 0) <> (copy = 1) THEN ' Schlecht '
              ELSE 'gut' END AS "Kategorie",
         CASE s_suppkey % 7 WHEN 6 THEN 'n/a' WHEN 5 THEN '2026-2' ELSE '2026-02-15' END AS reviewed_on, copy
  FROM supplier, unnest(range(0, CASE WHEN s_suppkey % 10 = 0 THEN 2 ELSE 1 END)) AS u(copy)
)"""

LABELS = (
    REVIEWS
    + """, label AS (
  SELECT upper(gateway_id) AS gateway_key,
         CAST(coalesce(lower(trim("Kategorie")) = 'schlecht', false) AS INTEGER) AS target
  FROM reviews
  QUALIFY row_number() OVER (PARTITION BY upper(gateway_id) ORDER BY copy DESC) = 1
)"""
)


def _score_ctes(
    baseline_days: int = 28,
    recent_days: int = 7,
    sigma: str = "3",
    first_breach: bool = False,
) -> str:
    """From ``weeks`` and ``tele`` to ``scores(week_start, gateway_id, score, metric)``."""
    stats = ",\n         ".join(
        f"avg(x{i}) AS mean{i}, CASE WHEN min(x{i}) < max(x{i}) THEN stddev_samp(x{i}) END AS std{i}" for i in range(3)
    )
    flags = ", ".join(f"CAST(coalesce(x{i} > mean{i} + {sigma} * std{i}, false) AS INTEGER) AS f{i}" for i in range(3))
    metric = (
        "arg_min(m, ts) FILTER (WHERE m <> '')" if first_breach else "arg_min(m, ts)"
    )
    return f"""base AS (
  SELECT week_start, gateway_id,
         {stats}
  FROM weeks JOIN tele ON ts >= week_start - INTERVAL {baseline_days} DAY AND ts < week_start
  GROUP BY week_start, gateway_id
), flagged AS (
  SELECT w.week_start, t.gateway_id, t.ts, {flags}
  FROM weeks w
  JOIN tele t ON t.ts >= w.week_start - INTERVAL {recent_days} DAY AND t.ts < w.week_start
  JOIN base b ON b.week_start = w.week_start AND b.gateway_id = t.gateway_id
), marked AS (
  SELECT *, CASE WHEN f0 = 1 THEN 'offline_duration_sec' WHEN f1 = 1 THEN 'disconnection_cnt'
                 WHEN f2 = 1 THEN 'reboot_cnt' ELSE '' END AS m
  FROM flagged
), scores AS (
  SELECT CAST(week_start AS DATE) AS week_start, gateway_id, CAST(sum(f0 + f1 + f2) AS BIGINT) AS score,
         coalesce({metric}, '') AS metric
  FROM marked GROUP BY week_start, gateway_id
)"""


def _rank_ctes(tele: str, sigma: str = "3", first_breach: bool = False) -> str:
    if first_breach:
        reason = (
            "CAST(score AS VARCHAR) || ' hour(s) beyond 3 sigma of this gateway''s own 28-day baseline in the "
            "last 7 days; first breach on ' || CASE WHEN metric <> '' THEN metric ELSE 'no metric over 3 sigma' END"
        )
    else:
        reason = (
            "CASE WHEN metric <> '' THEN CAST(score AS VARCHAR) || ' anomalous hour(s) detected in the previous "
            "7 days based on ' || metric || ' exceeding the gateway''s 28-day baseline.' "
            "ELSE 'Gateway ranked using recent telemetry anomaly score.' END"
        )
    return f"""{WEEKS}, {tele}, {_score_ctes(sigma=sigma, first_breach=first_breach)}, ranked AS (
  SELECT strftime(week_start, '%Y-%m-%d') AS week_start,
         CAST(row_number() OVER (PARTITION BY week_start ORDER BY score DESC, gateway_id) AS INTEGER) AS rank,
         gateway_id, CAST(score AS DOUBLE) AS score, {reason} AS reason
  FROM scores
  QUALIFY rank <= 15
)"""


def _rank(tele: str, sigma: str = "3", first_breach: bool = False) -> str:
    return f"WITH {_rank_ctes(tele, sigma, first_breach)} SELECT * FROM ranked"


TELEMETRY_FEATURES = """telemetry_features AS (
  SELECT printf('%012X', user_id) AS gateway_id,
         CAST(sum(CAST(event_type = 'signup' AS INTEGER)) AS BIGINT) AS total_reboots,
         CAST(sum(CAST(event_type = 'error' AS INTEGER)) AS BIGINT) AS total_disconnections,
         sum(value) AS total_offline_seconds, avg(value) AS avg_offline_seconds, max(value) AS max_offline_seconds,
         CAST(sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS total_reboot_duration,
         avg(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS avg_reboot_duration
  FROM events GROUP BY user_id
)"""

METER_FEATURES = (
    METER
    + """, meter_features AS (
  SELECT gateway_id, CAST(sum(meters_expected) AS BIGINT) AS total_meters_expected,
         CAST(sum(meters_read) AS BIGINT) AS total_meters_read,
         avg(rate) AS avg_read_rate, min(rate) AS min_read_rate
  FROM (SELECT *, CASE WHEN meters_expected = 0 THEN 0.0
                       ELSE CAST(meters_read AS DOUBLE) / CAST(meters_expected AS DOUBLE) END AS rate FROM meter)
  GROUP BY gateway_id
)"""
)

VISIT_FEATURES = (
    CLEAN_VISITS
    + r""", visit_features AS (
  SELECT gateway_id, count(visit_id) AS total_visits,
         CAST(sum(CAST(o IN ('fehler behoben', 'problem behoben', 'problem fixed', 'fixed') AS INTEGER)) AS BIGINT)
           AS problems_fixed,
         CAST(sum(CAST(o IN ('kein fehler gefunden', 'kein fehler', 'no problem found', 'no fault found')
           AS INTEGER)) AS BIGINT) AS no_problem_found,
         sum(coalesce(technician_hours, 0)) AS total_technician_hours,
         avg(coalesce(technician_hours, 0)) AS avg_technician_hours,
         CAST(sum(CAST(p NOT IN ('', 'nan', 'none', 'na', 'n a') AS INTEGER)) AS BIGINT) AS parts_replaced_count
  FROM (
    SELECT *, regexp_replace(strip_accents(lower(trim(outcome))), '\s+', ' ', 'g') AS o,
           regexp_replace(strip_accents(lower(trim(parts_replaced))), '\s+', ' ', 'g') AS p
    FROM clean_visits
  ) GROUP BY gateway_id
)"""
)

FEATURES = f"""{TELEMETRY_FEATURES}, {METER_FEATURES}, {VISIT_FEATURES}, features AS (
  SELECT m.gateway_id, m.name, m.balance, m.nation, CAST(NULL AS VARCHAR) AS retired,
         coalesce(total_reboots, 0) AS total_reboots, coalesce(total_disconnections, 0) AS total_disconnections,
         coalesce(total_offline_seconds, 0) AS total_offline_seconds,
         coalesce(avg_offline_seconds, 0) AS avg_offline_seconds,
         coalesce(max_offline_seconds, 0) AS max_offline_seconds,
         coalesce(total_reboot_duration, 0) AS total_reboot_duration,
         coalesce(avg_reboot_duration, 0) AS avg_reboot_duration,
         coalesce(total_meters_expected, 0) AS total_meters_expected,
         coalesce(total_meters_read, 0) AS total_meters_read,
         coalesce(avg_read_rate, 0) AS avg_read_rate, coalesce(min_read_rate, 0) AS min_read_rate,
         coalesce(total_visits, 0) AS total_visits, coalesce(problems_fixed, 0) AS problems_fixed,
         coalesce(no_problem_found, 0) AS no_problem_found,
         coalesce(total_technician_hours, 0) AS total_technician_hours,
         coalesce(avg_technician_hours, 0) AS avg_technician_hours,
         coalesce(parts_replaced_count, 0) AS parts_replaced_count
  FROM (
    SELECT printf('%012X', s_suppkey + CASE WHEN s_suppkey % 11 = 5 THEN 2000000 ELSE 0 END) AS gateway_id, s_name AS name, s_acctbal AS balance, n_name AS nation
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
  ) m
  LEFT JOIN telemetry_features t ON t.gateway_id = m.gateway_id
  LEFT JOIN meter_features r ON r.gateway_id = m.gateway_id
  LEFT JOIN visit_features v ON v.gateway_id = m.gateway_id
)"""

FLOATS = (
    "total_offline_seconds", "avg_offline_seconds", "max_offline_seconds", "avg_reboot_duration",
    "avg_read_rate", "min_read_rate", "total_technician_hours", "avg_technician_hours",
)
COMPARED = (
    "balance", "total_reboots", "total_disconnections", "total_offline_seconds", "avg_offline_seconds",
    "max_offline_seconds", "total_reboot_duration", "avg_reboot_duration", "total_meters_expected",
    "total_meters_read", "avg_read_rate", "min_read_rate", "total_visits", "problems_fixed",
    "no_problem_found", "total_technician_hours", "avg_technician_hours", "parts_replaced_count",
)


def _rounding(names: tuple[str, ...], digits: int = 8) -> str:
    return "REPLACE (" + ", ".join(f"round(CAST({n} AS DOUBLE), {digits}) AS {n}" for n in names) + ")"


def _comparison() -> str:
    rows = "\n  UNION ALL ".join(
        f"SELECT '{n}' AS feature, avg({n}) FILTER (WHERE target = 0) AS normal, "
        f"avg({n}) FILTER (WHERE target = 1) AS poor FROM training"
        for n in COMPARED
    )
    return f"""WITH {FEATURES}, {LABELS}, training AS (
  SELECT f.*, l.target FROM features f JOIN label l ON f.gateway_id = l.gateway_key
), sides AS (
  {rows}
)
SELECT feature, round(normal, 6) AS "Normal", round(poor, 6) AS "Schlecht",
       round(poor - normal, 6) AS difference,
       round((poor - normal) / nullif(normal, 0) * 100, 6) AS difference_percent,
       CAST(row_number() OVER (ORDER BY (poor - normal) / nullif(normal, 0) DESC NULLS LAST, feature) AS INTEGER) AS place
FROM sides"""


def _basic(table: str, columns: list[str], scope: str = "'all'") -> str:
    nulls = " + ".join(f'CAST("{c}" IS NULL AS INTEGER)' for c in columns)
    listed = ", ".join(f'"{c}"' for c in columns)
    return f"""SELECT {scope} AS scope, unnest([
         {{'check': 'rows', 'value': CAST(count(*) AS VARCHAR)}},
         {{'check': 'columns', 'value': '{len(columns)}'}},
         {{'check': 'missing_values', 'value': CAST(sum({nulls}) AS VARCHAR)}},
         {{'check': 'duplicate_rows', 'value': CAST(count(*) - count(DISTINCT ({listed})) AS VARCHAR)}},
         {{'check': 'missing_required_columns', 'value': ''}}
       ], recursive := true) FROM {table} GROUP BY 1"""


def _counted(table: str, checks: dict[str, str], scope: str = "'all'") -> str:
    rows = ",\n         ".join(f"{{'check': '{n}', 'value': CAST({e} AS VARCHAR)}}" for n, e in checks.items())
    return f"""SELECT {scope} AS scope, unnest([
         {rows}
       ], recursive := true) FROM {table} GROUP BY 1"""


def _profile(ctes: str, name: str, *parts: str) -> str:
    body = "\n  UNION ALL ".join(parts)
    return f"""WITH {ctes}, found AS (
  {body}
) SELECT '{name}' AS "table", scope, "check", value FROM found"""


TELEMETRY_COLUMNS = [
    "gateway_id", "ts_utc", "offline_duration_sec", "disconnection_cnt", "reboot_cnt",
]

DQ_TELEMETRY = _profile(
    DIRTY,
    "telemetry",
    _basic("dirty", TELEMETRY_COLUMNS, "source_file"),
    _counted(
        "dirty",
        {
            "negative_reboot_cnt": "count(*) FILTER (WHERE try_cast(reboot_cnt AS DOUBLE) < 0)",
            "negative_disconnection_cnt": "count(*) FILTER (WHERE disconnection_cnt <> '5d' "
            "AND try_cast(disconnection_cnt AS DOUBLE) < 0)",
            "negative_offline_duration_sec": "count(*) FILTER (WHERE try_cast(offline_duration_sec AS DOUBLE) < 0)",
            "invalid_timestamps": "count(*) FILTER (WHERE try_cast(ts_utc AS TIMESTAMP) IS NULL)",
            "first_timestamp": "strftime(min(try_cast(ts_utc AS TIMESTAMP)), '%Y-%m-%d %H:%M:%S.%f')",
            "last_timestamp": "strftime(max(try_cast(ts_utc AS TIMESTAMP)), '%Y-%m-%d %H:%M:%S.%f')",
        },
        "source_file",
    ),
    _counted(
        "dirty",
        {
            "rows": "count(*)",
            "duplicate_rows": "count(*) - count(DISTINCT (" + ", ".join(TELEMETRY_COLUMNS) + "))",
            "duplicate_gateway_timestamps": "count(*) - count(DISTINCT (gateway_id, ts_utc))",
            "unique_gateways": "count(DISTINCT gateway_id)",
        },
    ),
)

DQ_METER = _profile(
    METER,
    "meter_reads",
    _basic("meter", ["week_start", "gateway_id", "meters_expected", "meters_read"]),
    _counted(
        "meter",
        {
            "expected_zero": "count(*) FILTER (WHERE meters_expected = 0)",
            "read_above_expected": "count(*) FILTER (WHERE meters_read > meters_expected)",
            "negative_expected": "count(*) FILTER (WHERE meters_expected < 0)",
            "negative_read": "count(*) FILTER (WHERE meters_read < 0)",
            "unique_gateways": "count(DISTINCT gateway_id)",
        },
    ),
)

DQ_VISITS = _profile(
    VISITS,
    "field_visits",
    _basic(
        "visits",
        [
            "visit_id", "gateway_id", "requested_on", "visited_on", "reason_reported", "outcome",
            "technician_hours", "parts_replaced",
        ],
    ),
    _counted(
        "visits",
        {
            "negative_hours": "count(*) FILTER (WHERE CAST(technician_hours AS DOUBLE) < 0)",
            "invalid_requested_dates": "count(*) FILTER (WHERE try_cast(requested_on AS DATE) IS NULL)",
            "invalid_visited_dates": "count(*) FILTER (WHERE try_cast(visited_on AS DATE) IS NULL)",
            "visited_before_requested": "count(*) FILTER (WHERE try_cast(visited_on AS DATE) "
            "< try_cast(requested_on AS DATE))",
            "unique_gateways": "count(DISTINCT gateway_id)",
            "unique_visits": "count(DISTINCT visit_id)",
        },
    ),
)

DQ_REVIEWS = _profile(
    REVIEWS,
    "engineer_reviews",
    _basic("reviews", ["gateway_id", "Kategorie", "reviewed_on"]),
    _counted(
        "reviews",
        {
            "invalid_review_dates": "count(*) FILTER (WHERE try_cast(reviewed_on AS DATE) IS NULL)",
            "unique_gateways": "count(DISTINCT gateway_id)",
        },
    ),
    "SELECT 'all' AS scope, 'category:' || coalesce(\"Kategorie\", '<null>') AS \"check\", "
    'CAST(count(*) AS VARCHAR) AS value FROM reviews GROUP BY "Kategorie"',
)


def _validation(ctes: str, table: str, extra: str = "") -> str:
    bare = "regexp_full_match(trim(gateway_id), '[0-9A-Fa-f]{12}|([0-9A-Fa-f]{2}:){5}[0-9A-Fa-f]{2}')"
    n_extra = 1 if extra else 0
    return f"""WITH {ctes}, per AS (
  SELECT week_start AS week, count(*) AS found, count(rank) AS ranks, count(DISTINCT rank) AS dr,
         min(rank) AS low, max(rank) AS high,
         count(DISTINCT CASE WHEN {bare} THEN upper(replace(gateway_id, ':', '')) ELSE '' END) AS ids
  FROM {table} GROUP BY week_start
), both_sides AS (
  SELECT coalesce(p.week, strftime(w.week_start, '%Y-%m-%d')) AS week, p.found, w.week_start AS expected
  FROM per p FULL OUTER JOIN weeks w ON p.week = strftime(w.week_start, '%Y-%m-%d')
), res("check", week, ok, n_bad, detail) AS (
  SELECT 'missing_columns', NULL, true, 0, ''
  UNION ALL SELECT 'unexpected_columns', NULL, {str(not extra).lower()}, {n_extra}, '{extra}'
  UNION ALL SELECT 'row_count', NULL, count(*) = 60, abs(count(*) - 60), 'expected 60 rows, found ' || count(*) FROM {table}
  UNION ALL SELECT 'week_start_is_date', NULL, count(*) = 0, count(*), '' FROM {table}
            WHERE try_cast(week_start AS DATE) IS NULL
  UNION ALL SELECT 'gateway_id_form', NULL, count(*) = 0, count(*), coalesce('e.g. ' || min(gateway_id), '') FROM {table}
            WHERE NOT {bare}
  UNION ALL SELECT 'score_numeric', NULL, true, 0, ''
  UNION ALL SELECT 'score_blank', NULL, count(*) = 0, count(*), '' FROM {table} WHERE score IS NULL
  UNION ALL SELECT 'reason_blank', NULL, count(*) FILTER (WHERE reason IS NULL OR trim(reason) = '') = 0,
            count(*) FILTER (WHERE trim(reason) = ''), count(*) FILTER (WHERE reason IS NULL) || ' null' FROM {table}
  UNION ALL SELECT 'reason_length', NULL, count(*) = 0, count(*), '' FROM {table} WHERE length(trim(reason)) > 300
  UNION ALL SELECT 'week_expected', week, expected IS NOT NULL, CAST(expected IS NULL AS INTEGER), '' FROM both_sides
  UNION ALL SELECT 'week_present', week, found IS NOT NULL, CAST(found IS NULL AS INTEGER), '' FROM both_sides
  UNION ALL SELECT 'rows_per_week', week, found = 15, abs(found - 15), found || ' rows, expected 15' FROM per
  UNION ALL SELECT 'ranks', week, ranks = 15 AND dr = 15 AND low = 1 AND high = 15,
            1 - CAST(ranks = 15 AND dr = 15 AND low = 1 AND high = 15 AS INTEGER),
            'must be 1..15 with no repeats' FROM per
  UNION ALL SELECT 'gateway_repeated', week, ids = found, found - ids, '' FROM per
) SELECT "check", CAST(week AS VARCHAR) AS week, ok, CAST(n_bad AS BIGINT) AS n_bad, detail FROM res"""


BAD_RANKING = (
    _rank_ctes(UNIQUE)
    + """, bad AS (
  SELECT CASE WHEN week_start = '2024-01-29' AND rank = 15 THEN '2024-02-05' ELSE week_start END AS week_start,
         CASE WHEN week_start = '2024-01-15' AND rank = 3 THEN 2 ELSE rank END AS rank,
         CASE WHEN week_start = '2024-01-08' AND rank = 1 THEN 'xyz' ELSE gateway_id END AS gateway_id,
         CASE WHEN NOT (week_start = '2024-01-08' AND rank = 4) THEN score END AS score,
         CASE WHEN week_start = '2024-01-08' AND rank = 5 THEN ' '
              WHEN week_start = '2024-01-08' AND rank = 6 THEN repeat('x', 301)
              WHEN NOT (week_start = '2024-01-08' AND rank = 7) THEN reason END AS reason
  FROM ranked
)"""
)

CLEAN_TELE = (
    CLEAN
    + """, tele AS (
  SELECT gateway_id, ts_utc AS ts, offline_duration_sec AS x0, disconnection_cnt AS x1, reboot_cnt AS x2 FROM clean
)"""
)

STATS = ", ".join(
    f"round(avg(x{i}), 8) AS mean_{m}, "
    f"round(CASE WHEN count(x{i}) > 1 THEN CASE WHEN min(x{i}) = max(x{i}) THEN 0.0 ELSE stddev_samp(x{i}) END END, 8) "
    f"AS std_{m}"
    for i, m in enumerate(("offline_duration_sec", "disconnection_cnt", "reboot_cnt"))
)

TRIMMED = "trim(raw, ' ' || chr(9))"


def all_oracles() -> dict[str, str]:
    return {
        "weekly_rank_3sigma": _rank(UNIQUE),
        "weekly_rank_stored": _rank(UNIQUE),
        "weekly_rank_first_breach": _rank(RAW, first_breach=True),
        "weekly_rank_sigma1": _rank(UNIQUE, sigma="1"),
        "weekly_rank_dirty": _rank(CLEAN_TELE, sigma="1.5"),
        "weekly_rank_repeated": _rank(REPEATED).replace("weeks(week_start) AS (\n  VALUES", "weeks(week_start) AS (\n  VALUES (TIMESTAMP '2023-10-02'),"),
        "weekly_scores": f"WITH {WEEKS}, {UNIQUE}, {_score_ctes(21, 3, '1.5', True)} "
        "SELECT week_start, gateway_id, score, metric FROM scores",
        "weekly_scores_uneven": f"WITH {UNEVEN}, {UNIQUE}, {_score_ctes(sigma='1.5')} "
        "SELECT week_start, gateway_id, score, metric FROM scores",
        "clean_visits_inferred": """SELECT DISTINCT printf('%012X', l_suppkey) AS gateway_id,
         l_orderkey || '-' || l_linenumber || '-' || l_partkey AS visit_id,
         strftime(try_strptime(CASE l_linenumber WHEN 5 THEN strftime(l_shipdate, '%Y-%m-%d') WHEN 6 THEN strftime(l_shipdate, '%d/%m/%Y')
           WHEN 7 THEN 'soon' ELSE strftime(l_shipdate, '%m/%d/%Y') END, '%m/%d/%Y'), '%Y-%m-%d') AS visited_on,
         strftime(l_shipdate, '%Y-%m-%d') AS requested_on FROM lineitem""",
        "weekly_baseline_stats": f"WITH {WEEKS}, {UNIQUE} "
        f"SELECT CAST(week_start AS DATE) AS week_start, gateway_id, {STATS} "
        "FROM weeks JOIN tele ON ts >= week_start - INTERVAL 28 DAY AND ts < week_start "
        "GROUP BY weeks.week_start, gateway_id",
        "hourly_flags": f"WITH {WEEKS}, {UNIQUE}, {_score_ctes(sigma='2')} "
        "SELECT CAST(week_start AS DATE) AS week_start, gateway_id, ts, f0 AS flag_offline_duration_sec, "
        "f1 AS flag_disconnection_cnt, f2 AS flag_reboot_cnt, f0 + f1 + f2 AS flags, m AS metric FROM marked",
        "clean_telemetry": f"WITH {CLEAN} SELECT gateway_id, ts_utc, offline_duration_sec, disconnection_cnt, "
        'reboot_cnt, source_file, ts_utc AS "timestamp" FROM clean',
        "clean_visits": f"WITH {CLEAN_VISITS} SELECT * FROM clean_visits",
        "clean_reviews_first": f'WITH {REVIEWS} SELECT upper(gateway_id) AS gateway_id, "Kategorie", reviewed_on '
        "FROM reviews QUALIFY row_number() OVER (PARTITION BY upper(gateway_id) ORDER BY copy) = 1",
        "labels_last": f"WITH {LABELS} SELECT gateway_key, target FROM label",
        "gateway_id_forms": f"""WITH {DIRTY}, forms AS (
  SELECT DISTINCT unnest([gateway_id, substr(gateway_id, 1, 5) || ' ' || substr(gateway_id, 6, 20),
                          substr(gateway_id, 1, 7)]) AS raw FROM dirty
) SELECT raw, upper(trim(replace(raw, ':', ''), ' ' || chr(9))) AS cleaned,
         upper(trim(replace(replace(raw, ':', ''), ' ', ''), ' ' || chr(9))) AS joined,
         CASE WHEN regexp_full_match({TRIMMED}, '[0-9A-Fa-f]{{12}}') THEN upper({TRIMMED})
              WHEN regexp_full_match({TRIMMED}, '([0-9A-Fa-f]{{2}}:){{5}}[0-9A-Fa-f]{{2}}')
              THEN upper(replace({TRIMMED}, ':', '')) END AS canonical
  FROM forms""",
        "value_forms": f"""WITH {DIRTY} SELECT event_id, copy,
         greatest(coalesce(try_cast(offline_duration_sec AS DOUBLE), 0), 0) AS clipped,
         coalesce(try_cast(offline_duration_sec AS DOUBLE), 0) AS unclipped,
         CASE WHEN try_cast(offline_duration_sec AS DOUBLE) < 0 THEN 0.0
              ELSE try_cast(offline_duration_sec AS DOUBLE) END AS clipped_or_null,
         try_cast(ts_utc AS TIMESTAMP) AS "time",
         strftime(try_cast(ts_utc AS TIMESTAMP), '%Y-%m-%d') AS "day",
         lower(trim(gateway_id, ' ' || chr(9))) AS "text" FROM dirty""",
        "duplicate_counts": f"""WITH {DIRTY} SELECT count(*) AS rows,
         count(*) - count(DISTINCT ({", ".join(TELEMETRY_COLUMNS)}, source_file)) AS duplicate_rows,
         count(*) - count(DISTINCT (gateway_id, ts_utc)) AS duplicate_keys FROM dirty""",
        "table_size": f"""WITH {VISITS} SELECT count(*) AS rows, count(DISTINCT gateway_id) AS unique_gateway_id,
         count(DISTINCT visit_id) AS unique_visit_id, count(DISTINCT visited_on) AS unique_visited_on FROM visits""",
        "telemetry_features": f"WITH {TELEMETRY_FEATURES} SELECT * "
        + _rounding(("total_offline_seconds", "avg_offline_seconds", "max_offline_seconds", "avg_reboot_duration"))
        + " FROM telemetry_features",
        "telemetry_features_absent_metric": f"WITH {TELEMETRY_FEATURES} SELECT * REPLACE (CAST(0 AS DOUBLE) AS "
        "total_reboot_duration, CAST(0 AS DOUBLE) AS avg_reboot_duration, "
        + _rounding(("total_offline_seconds", "avg_offline_seconds", "max_offline_seconds"))[9:]
        + " FROM telemetry_features",
        "meter_features": f"WITH {METER_FEATURES} SELECT * "
        + _rounding(("avg_read_rate", "min_read_rate"))
        + " FROM meter_features",
        "visit_features": f"WITH {VISIT_FEATURES} SELECT * "
        + _rounding(("total_technician_hours", "avg_technician_hours"))
        + " FROM visit_features",
        "gateway_features": f"WITH {FEATURES} SELECT * {_rounding(FLOATS)} FROM features",
        "training_table": f"WITH {FEATURES}, {LABELS}, training AS (SELECT f.* EXCLUDE (retired), l.target FROM features f "
        f"JOIN label l ON f.gateway_id = l.gateway_key) SELECT * {_rounding(FLOATS)} FROM training",
        "class_balance": f'WITH {REVIEWS} SELECT "Kategorie" AS value, count(*) AS count, '
        "round(count(*) / sum(count(*)) OVER (), 8) AS share "
        'FROM reviews WHERE "Kategorie" IS NOT NULL GROUP BY "Kategorie"',
        "class_means": "SELECT 1 - quality AS target, round(avg(n_chars), 8) AS n_chars, "
        "round(avg(toxic), 8) AS toxic FROM labels JOIN documents USING (doc_id) GROUP BY quality",
        "feature_comparison": _comparison(),
        "dq_telemetry": DQ_TELEMETRY,
        "dq_meter": DQ_METER,
        "dq_visits": DQ_VISITS,
        "dq_reviews": DQ_REVIEWS,
        "validate_ranking_ok": _validation(_rank_ctes(UNIQUE), "ranked"),
        "validate_ranking_bad": _validation(BAD_RANKING, "bad", "note"),
        "gateway_lookup": """SELECT printf('%012X', user_id) AS gateway_id, ts AS ts_utc, value AS offline_duration_sec,
         CAST(event_type = 'error' AS INTEGER) AS disconnection_cnt, CAST(event_type = 'signup' AS INTEGER) AS reboot_cnt,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS reboot_duration_sec, event_id
  FROM events WHERE user_id IN (1, 2, 30, 31, 32) AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-17'""",
        "distinct_by_sketch": "SELECT count(*) AS rows, true AS near_gateway_id, true AS near_ts_utc FROM events",
        "increment_table": f"WITH {REPEATED} SELECT gateway_id, ts AS ts_utc, x0 AS offline_duration_sec, x1 AS disconnection_cnt, "
        "x2 AS reboot_cnt FROM tele",
        "files_csv": """SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS note_id, printf('%012X', l_suppkey) AS gateway_id,
         CASE l_linenumber WHEN 1 THEN 'said "' || l_returnflag || '",' || chr(10) || chr(10) || l_linestatus || ' ""' || chr(13) || chr(10) || 'end'
              WHEN 2 THEN 'a "b" c' WHEN 3 THEN 'x,' || chr(10) || 'y' WHEN 4 THEN 'plain' WHEN 5 THEN 'plain' END AS note,
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantity FROM lineitem""",
        "files_master": """SELECT printf('%012X', s_suppkey + CASE WHEN s_suppkey % 11 = 5 THEN 2000000 ELSE 0 END) AS gateway_id,
         s_name || CASE WHEN copy = 1 THEN ' (moved)' ELSE '' END || ' Größe' AS name, round(s_acctbal, 8) AS balance,
         n_name AS nation, CAST(NULL AS VARCHAR) AS retired, CAST(copy AS DOUBLE) AS copy
  FROM supplier JOIN nation ON s_nationkey = n_nationkey, unnest(range(0, CASE WHEN s_suppkey % 10 = 0 THEN 2 ELSE 1 END)) AS u(copy)""",
        "files_telemetry": """SELECT printf('%012X', user_id) AS gateway_id, ts AS ts_utc, value AS offline_duration_sec,
         CAST(event_type = 'error' AS DOUBLE) AS disconnection_cnt, CAST(event_type = 'signup' AS INTEGER) AS reboot_cnt,
         CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS reboot_duration_sec,
         event_id, true AS has_place
  FROM events WHERE strftime(ts, '%Y-%m') IN ('2023-12', '2024-01', '2024-02')""",
    }
