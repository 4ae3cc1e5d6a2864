"""The registered queries in standard SQL over the same tables, to check results with."""

from __future__ import annotations

from lotflow.plans.catalogue import AS_OF, LEDGER_CLOSED, VIP_LISTED

PRICE, VIP_PRICE = 5000, 8000
BILLABLE = "status_code IN ('PARKED', 'MOVING', 'EXITING')"
CUT_1, CUT_2 = "2024-01-11 00:00:00", "2024-01-21 00:00:00"
KNOWN = "status_code IN ('ENTERING', 'PARKED', 'MOVING', 'EXITING')"
ORDER = "timestamp_unix, status_rank, event_id"
ORDER_DESC = "timestamp_unix DESC, status_rank DESC, event_id DESC"

FEED = """
sightings AS (
  SELECT event_id,
         strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS "timestamp",
         CAST(floor(epoch(ts)) AS BIGINT) AS timestamp_unix,
         printf('29A-%05d', user_id) AS license_plate,
         substr('ABCDEF', CAST(slot // 10 + 1 AS INT), 1) || CAST(slot % 10 + 1 AS VARCHAR) AS location,
         CASE event_type WHEN 'signup' THEN 'ENTERING' WHEN 'view' THEN 'PARKED' WHEN 'click' THEN 'MOVING'
                         WHEN 'purchase' THEN 'EXITING' ELSE 'UNKNOWN' END AS status_code,
         event_type, k, ts
  FROM (SELECT *, (user_id * 7 + k % 3) % 60 AS slot
        FROM (SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k FROM events))
),
feed AS (
  SELECT *, CASE status_code WHEN 'ENTERING' THEN 1 WHEN 'PARKED' THEN 2 WHEN 'MOVING' THEN 3
                             WHEN 'EXITING' THEN 4 ELSE 0 END AS status_rank
  FROM sightings
)"""

_FEE_COLUMNS = f"""
  parked_seconds,
  parked_seconds // 60 AS parked_minutes,
  (parked_seconds // 60 + 9) // 10 AS fee_blocks,
  ((parked_seconds // 60 + 9) // 10) * {PRICE} AS total_fee"""


def _totals(name: str, clock: str, where: str, keys: str = "location, license_plate") -> str:
    """Running totals and fees as CTE ``name``."""
    return f"""
{name} AS (
  SELECT {keys}, current_status, entry_time, entry_timestamp, last_update, exit_timestamp, {_FEE_COLUMNS}
  FROM (SELECT *, CASE WHEN entry_time IS NULL THEN 0 ELSE last_update - entry_time END AS parked_seconds
        FROM (SELECT {keys},
                     arg_max(status_code, timestamp_unix * 8 + status_rank) AS current_status,
                     min(timestamp_unix) FILTER (WHERE status_code = '{clock}') AS entry_time,
                     min("timestamp") FILTER (WHERE status_code = '{clock}') AS entry_timestamp,
                     max(timestamp_unix) AS last_update,
                     max("timestamp") FILTER (WHERE status_code = 'EXITING') AS exit_timestamp
              FROM feed_w WHERE {where} GROUP BY {keys}))
)""".replace("feed_w", "(SELECT *, timestamp_unix // 30 * 30 AS window_start FROM feed)")


LIFE = _totals("life", "PARKED", BILLABLE)
_PAID_LIFE = _totals("paid_life", "PARKED", f"{BILLABLE} AND ts < TIMESTAMP '{LEDGER_CLOSED}'")
LEDGER = f"""{_PAID_LIFE},
ledger AS (
  SELECT license_plate, location, total_fee, parked_minutes, exit_timestamp AS checkout_time, entry_time
  FROM paid_life WHERE current_status = 'EXITING' AND entry_time IS NOT NULL
)"""
VIEW = f"""{LIFE}, {LEDGER},
view_rows AS (
  SELECT location, license_plate, current_status, entry_timestamp, parked_minutes, total_fee, last_update
  FROM life WHERE entry_time IS NOT NULL
    AND (license_plate, location) NOT IN (SELECT (license_plate, location) FROM ledger)
)"""
SLOTS = """
slots AS (
  SELECT floor || CAST(slot_no AS VARCHAR) AS location, floor, slot_no, floor = 'F' AS is_vip
  FROM (SELECT unnest(['A', 'B', 'C', 'D', 'E', 'F']) AS floor) f,
       (SELECT CAST(unnest(generate_series(1, 10)) AS INT) AS slot_no) n
)"""


def _visits(name: str = "visits", where: str = "TRUE", gap: int | None = None) -> str:
    starts = "prev_status = 'EXITING'" + (f" OR timestamp_unix - prev_unix > {gap}" if gap else "")
    return f"""
{name}_rows AS (
  SELECT *, CAST(sum(starts) OVER (PARTITION BY license_plate ORDER BY {ORDER}) AS BIGINT) AS visit_no
  FROM (SELECT *, CASE WHEN {starts} THEN 1 ELSE 0 END AS starts
        FROM (SELECT *, lag(status_code) OVER w AS prev_status, lag(timestamp_unix) OVER w AS prev_unix
              FROM feed WHERE {BILLABLE} AND {where}
              WINDOW w AS (PARTITION BY license_plate ORDER BY {ORDER})))
),
{name} AS (
  SELECT license_plate, visit_no, current_status, exit_time IS NOT NULL AS closed, entry_time, last_update, exit_time,
         entry_location, last_location, {_FEE_COLUMNS}
  FROM (SELECT *, last_update - entry_time AS parked_seconds
        FROM (SELECT license_plate, visit_no,
                     first(status_code ORDER BY {ORDER_DESC}) AS current_status,
                     min(timestamp_unix) FILTER (WHERE status_code = 'PARKED') AS entry_time,
                     max(timestamp_unix) AS last_update,
                     max(timestamp_unix) FILTER (WHERE status_code = 'EXITING') AS exit_time,
                     first(location ORDER BY {ORDER}) FILTER (WHERE status_code = 'PARKED') AS entry_location,
                     first(location ORDER BY {ORDER_DESC}) AS last_location
              FROM {name}_rows GROUP BY license_plate, visit_no)
        WHERE entry_time IS NOT NULL)
)"""


CHANGES = f"""
changes AS (
  SELECT license_plate, location, prev_status, status_code, timestamp_unix, status_rank, event_id
  FROM (SELECT *, lag(status_code) OVER (PARTITION BY license_plate, location ORDER BY {ORDER}) AS prev_status
        FROM feed WHERE {KNOWN})
  WHERE prev_status IS NULL OR prev_status <> status_code
)"""


def _ceil_fee(seconds: str, price: str) -> str:
    return f"((({seconds}) + 59) // 60 + 9) // 10 * ({price})"


# one window per stay at the slot: the rows between two releases
FSM = f"""
stay_rows AS (
  SELECT *, coalesce(sum(CASE WHEN status_code = 'EXITING' THEN 1 ELSE 0 END) OVER
              (PARTITION BY location ORDER BY {ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stay
  FROM feed WHERE {KNOWN}
),
marked AS (
  SELECT *, status_code = 'PARKED' AND (prev_status IS NULL OR prev_status <> 'PARKED'
                                        OR prev_plate IS DISTINCT FROM license_plate) AS restart,
         CASE WHEN status_code IN ('MOVING', 'EXITING') THEN 1 ELSE 0 END AS charges
  FROM (SELECT *, lag(status_code) OVER w AS prev_status, lag(license_plate) OVER w AS prev_plate
        FROM stay_rows WINDOW w AS (PARTITION BY location, stay ORDER BY {ORDER}))
),
clocked AS (
  SELECT *, last_value(CASE WHEN restart THEN timestamp_unix END IGNORE NULLS) OVER w AS enter_unix,
         last_value(CASE WHEN restart OR status_code = 'ENTERING' THEN license_plate END IGNORE NULLS) OVER w AS plate
  FROM marked
  WINDOW w AS (PARTITION BY location, stay ORDER BY {ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
fsm AS (
  SELECT event_id, location, plate AS license_plate, status_code AS status, enter_unix,
         timestamp_unix AS last_update_unix,
         coalesce(last_value(CASE WHEN restart THEN 0 WHEN charges = 1 AND enter_unix IS NOT NULL
                                  THEN timestamp_unix - enter_unix END IGNORE NULLS) OVER w, 0) AS parked_seconds,
         coalesce(last_value(CASE WHEN charges = 1 AND enter_unix IS NOT NULL
                                  THEN {_ceil_fee('timestamp_unix - enter_unix', "CASE WHEN location LIKE 'F%' THEN 8000 ELSE 5000 END")}
                             END IGNORE NULLS) OVER w, 0) AS fee_vnd,
         row_number() OVER (PARTITION BY location ORDER BY {ORDER_DESC}) AS from_end
  FROM clocked
  WINDOW w AS (PARTITION BY location, stay ORDER BY {ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
current_state AS (
  SELECT location, license_plate, status, enter_unix, last_update_unix, parked_seconds, fee_vnd
  FROM fsm WHERE from_end = 1 AND status <> 'EXITING'
)"""

_DURATION = "CASE WHEN {m} // 60 > 0 THEN printf('%dh %dp', {m} // 60, {m} % 60) ELSE printf('%d phút', {m} % 60) END"
_AMOUNT = "replace(format('{{:,}}', {a}), ',', '.') || chr(160) || '₫'"
DURATION = _DURATION.format(m="parked_minutes")
AMOUNT = _AMOUNT.format(a="total_fee")
SNAPSHOT_COLUMNS = "location, license_plate, current_status, entry_timestamp, parked_minutes, total_fee, last_update"
LISTED = ", ".join(f"('{name}')" for name in VIP_LISTED)
IN_LISTED = ", ".join(f"'{name}'" for name in VIP_LISTED)
VERSIONS = """versions AS (
  SELECT timestamp_unix AS valid_from, max(CASE WHEN event_id % 17 <> 0 THEN 4000 + event_id % 9 * 500 END) AS price
  FROM feed WHERE status_code = 'PARKED' AND event_id % 13 <> 0 GROUP BY timestamp_unix)"""


def _with(*parts: str) -> str:
    return "WITH " + ", ".join((FEED, *parts)) + "\n"


VISIT_COLUMNS = """license_plate, visit_no, current_status, closed, entry_time, last_update, exit_time,
  entry_location, last_location, parked_seconds, parked_minutes, fee_blocks, total_fee"""

ORACLES: dict[str, str] = {
    "parse_events": _with() + """SELECT event_id, "timestamp", timestamp_unix, license_plate, location, status_code,
  timestamp_unix AS event_time_unix FROM feed""",
    "malformed_events": _with() + """
SELECT event_id,
  CASE k % 6 WHEN 0 THEN NULL WHEN 2 THEN 'no time' ELSE "timestamp" END AS "timestamp",
  CASE WHEN k % 6 IN (0, 1) THEN NULL ELSE timestamp_unix END AS timestamp_unix,
  CASE WHEN k % 6 IN (0, 4) THEN NULL ELSE license_plate END AS license_plate,
  CASE k % 6 WHEN 0 THEN NULL WHEN 5 THEN '' ELSE location END AS location,
  CASE k % 6 WHEN 0 THEN NULL WHEN 3 THEN 'WHAT' ELSE 'PARKED' END AS status_code,
  CASE k % 6 WHEN 0 THEN 'not_json' WHEN 1 THEN 'no_unix_time' WHEN 2 THEN 'bad_timestamp'
             WHEN 3 THEN 'unknown_status' WHEN 4 THEN 'no_plate' ELSE 'no_location' END AS reason,
  k % 6 IN (0, 1, 5) AS set_aside
FROM feed WHERE event_type = 'error'""",
    "billable_events": _with() + f"""SELECT event_id, "timestamp", timestamp_unix, license_plate, location, status_code,
  CASE WHEN status_code = 'PARKED' THEN timestamp_unix END AS parked_time,
  CASE WHEN status_code = 'PARKED' THEN "timestamp" END AS parked_timestamp
FROM feed WHERE {BILLABLE}""",
    "clock_check": _with() + """SELECT location, count(*) AS events, count(*) FILTER (WHERE skew > 0) AS differing,
  max(skew) AS max_skew_seconds
FROM (SELECT location, abs(CAST(epoch(strptime("timestamp", '%Y-%m-%d %H:%M:%S')) AS BIGINT) - timestamp_unix
        + CASE WHEN status_code = 'EXITING' THEN event_id % 7 * 30 - 90 ELSE 0 END) AS skew
      FROM feed) GROUP BY location""",
    "lifetime_fees": _with(LIFE) + "SELECT * FROM life",
    "lifetime_fees_entering": _with(_totals("life", "ENTERING", "TRUE")) + "SELECT * EXCLUDE (exit_timestamp) FROM life",
    "window_fees_30s": _with(_totals("life", "ENTERING", "TRUE", "window_start, location, license_plate"))
    + "SELECT * EXCLUDE (exit_timestamp) FROM life",
    "fee_table": _with(LIFE) + f"""SELECT DISTINCT parked_seconds,
  (parked_seconds // 60 + 9) // 10 AS blocks_floor, (parked_seconds // 60 + 9) // 10 * {PRICE} AS fee_floor,
  ((parked_seconds + 59) // 60 + 9) // 10 AS blocks_ceil, {_ceil_fee('parked_seconds', str(PRICE))} AS fee_ceil FROM life""",
    "display_columns": _with(VIEW) + f"""SELECT location, license_plate,
  CASE current_status WHEN 'PARKED' THEN 'Đã đỗ' WHEN 'MOVING' THEN 'Di chuyển' WHEN 'EXITING' THEN 'Đang ra'
       ELSE current_status END AS status_text,
  coalesce(entry_timestamp, '-') AS entry_text, {DURATION} AS duration_text, {AMOUNT} AS fee_text,
  strftime(make_timestamp(last_update * 1000000), '%H:%M:%S') AS updated_text,
  current_status = 'EXITING' AS can_check_out FROM view_rows""",
    "active_vehicles": _with(LIFE)
    + f"SELECT {SNAPSHOT_COLUMNS} FROM life WHERE entry_time IS NOT NULL AND current_status <> 'EXITING' ORDER BY 1, 2",
    "snapshot_all": _with(LIFE) + f"SELECT {SNAPSHOT_COLUMNS} FROM life WHERE entry_time IS NOT NULL ORDER BY 1, 2",
    "checkout_records": _with(LIFE) + """SELECT license_plate, location AS exit_location, entry_time, entry_timestamp,
  exit_timestamp, parked_minutes, total_fee
FROM life WHERE entry_time IS NOT NULL AND current_status = 'EXITING'""",
    "status_view": _with(VIEW) + "SELECT * FROM view_rows ORDER BY location, license_plate",
    "summary_stats": _with(VIEW) + """SELECT CAST(60 AS BIGINT) AS total, count(*) AS occupied_locations,
  count(DISTINCT location) AS occupied_slots, count(DISTINCT license_plate) AS unique_vehicles,
  60 - count(*) AS available, greatest(60 - count(DISTINCT location), 0) AS free_slots FROM view_rows""",
    "floor_summary": _with(VIEW, SLOTS) + """SELECT s.floor, s.total_slots,
  coalesce(n, 0) AS occupied_locations, coalesce(used, 0) AS occupied_slots, coalesce(plates, 0) AS unique_vehicles,
  s.total_slots - coalesce(n, 0) AS available, greatest(s.total_slots - coalesce(used, 0), 0) AS free_slots,
  round(coalesce(n, 0) * 100.0::DOUBLE / s.total_slots, 2) AS percent_occupied
FROM (SELECT floor, count(*) AS total_slots FROM slots GROUP BY floor) s
LEFT JOIN (SELECT regexp_extract(location, '^[A-Z]+') AS floor, count(*) AS n, count(DISTINCT location) AS used,
                  count(DISTINCT license_plate) AS plates FROM view_rows GROUP BY 1) v ON s.floor = v.floor""",
    "location_detail": _with(VIEW, SLOTS) + """SELECT s.location, s.floor,
  CASE WHEN count(v.location) > 0 THEN 'occupied' ELSE 'available' END AS status, count(v.location) AS vehicles
FROM slots s LEFT JOIN view_rows v ON s.location = v.location GROUP BY s.location, s.floor""",
    "vehicle_totals": _with(VIEW) + """SELECT upper(license_plate) AS license_plate, count(*) AS location_count,
  CAST(sum(total_fee) AS BIGINT) AS total_fee_all_locations, max(last_update) AS last_update
FROM view_rows GROUP BY 1""",
    "vehicle_locations": _with(VIEW) + f"""SELECT upper(license_plate) AS license_plate, location, current_status,
  entry_timestamp, parked_minutes, total_fee, location || ' (' || {DURATION} || ', ' || {AMOUNT} || ')' AS detail
FROM view_rows""",
    "slot_dimension": _with(SLOTS) + """SELECT s.location, s.floor, s.slot_no, s.is_vip, count(f.location) AS sightings
FROM slots s LEFT JOIN feed f ON s.location = f.location GROUP BY 1, 2, 3, 4""",
    "free_slots": _with(FSM, SLOTS) + """SELECT location, floor, is_vip FROM slots
WHERE location NOT IN (SELECT location FROM current_state) ORDER BY location""",
    "vip_slots": _with(SLOTS) + f"""SELECT v.location, count(f.location) AS sightings
FROM (SELECT location FROM slots WHERE is_vip UNION SELECT * FROM (VALUES {LISTED})) v
LEFT JOIN feed f ON v.location = f.location GROUP BY 1 ORDER BY 1""",
    "slot_conflicts": _with() + f"""SELECT location, count(*) AS vehicles, min(timestamp_unix) AS first_seen,
  max(timestamp_unix) AS last_seen
FROM (SELECT *, row_number() OVER (PARTITION BY license_plate ORDER BY {ORDER_DESC}) AS n FROM feed WHERE {KNOWN})
WHERE n = 1 AND status_code <> 'EXITING' GROUP BY location HAVING count(*) > 1""",
    "visit_fees": _with(_visits()) + f"SELECT {VISIT_COLUMNS} FROM visits",
    "visit_fees_with_gap": _with(_visits(gap=86400)) + f"SELECT {VISIT_COLUMNS} FROM visits",
    "park_exit_pairs": _with(_visits()) + """SELECT license_plate, entry_time AS parked_unix,
  entry_location AS parked_location, exit_time AS exit_unix, last_location AS exit_location FROM visits WHERE closed""",
    "occupied_by_visits": _with(_visits())
    + "SELECT last_location AS location, license_plate, current_status, entry_time, last_update FROM visits WHERE NOT closed",
    "visit_paths": _with(_visits()) + f"""SELECT license_plate, visit_no,
  row_number() OVER (PARTITION BY license_plate, visit_no ORDER BY {ORDER}) AS step_no, location,
  timestamp_unix AS arrived_unix
FROM (SELECT *, lag(location) OVER (PARTITION BY license_plate, visit_no ORDER BY {ORDER}) AS prev_location
      FROM visits_rows) WHERE prev_location IS DISTINCT FROM location""",
    "status_changes": _with(CHANGES)
    + "SELECT license_plate, location, prev_status, status_code, timestamp_unix, event_id FROM changes",
    "transition_audit": _with(CHANGES) + """SELECT prev_status, status_code, count(*) AS changes,
  coalesce(prev_status, '') || '>' || status_code IN
    ('>ENTERING', 'ENTERING>PARKED', 'PARKED>MOVING', 'MOVING>EXITING', 'EXITING>ENTERING') AS allowed
FROM changes GROUP BY prev_status, status_code""",
    "status_dwell": _with(CHANGES) + f"""SELECT status_code, count(*) AS spells, CAST(sum(d) AS BIGINT) AS total_seconds,
  min(d) AS min_seconds, max(d) AS max_seconds,
  count(*) FILTER (WHERE (status_code = 'PARKED' AND d BETWEEN 60 AND 300)
                      OR (status_code = 'MOVING' AND d BETWEEN 10 AND 30)) AS usual_spells,
  CAST(sum(d) // count(*) AS BIGINT) AS mean_seconds
FROM (SELECT status_code, lead(timestamp_unix) OVER (PARTITION BY license_plate, location ORDER BY {ORDER})
             - timestamp_unix AS d FROM changes)
WHERE d IS NOT NULL GROUP BY status_code""",
    "slot_fsm_events": _with(FSM) + "SELECT * EXCLUDE (from_end) FROM fsm",
    "slot_fsm_current": _with(FSM) + "SELECT * FROM current_state",
    "live_state": _with(FSM) + f"""SELECT location, license_plate, status, enter_unix, last_update_unix,
  CASE WHEN status = 'PARKED' AND enter_unix IS NOT NULL THEN {AS_OF} - enter_unix ELSE parked_seconds END AS parked_seconds,
  CASE WHEN status = 'PARKED' AND enter_unix IS NOT NULL
       THEN {_ceil_fee(f'{AS_OF} - enter_unix', f"CASE WHEN location LIKE 'F%' THEN {VIP_PRICE} ELSE {PRICE} END")}
       ELSE fee_vnd END AS fee_vnd,
  location LIKE 'F%' AS is_vip FROM current_state""",
    "vip_tier_fees": _with(LIFE) + f"""SELECT location, license_plate, is_vip, price_per_block, parked_seconds,
  {_ceil_fee('parked_seconds', 'price_per_block')} AS fee_vnd
FROM (SELECT *, CASE WHEN is_vip THEN {VIP_PRICE} ELSE {PRICE} END AS price_per_block
      FROM (SELECT *, location LIKE 'F%' OR location IN ({IN_LISTED}) AS is_vip FROM life WHERE entry_time IS NOT NULL))""",
    "price_asof_fees": _with(LIFE, VERSIONS) + """
SELECT location, license_plate, last_update, fee_blocks, price AS price_per_block, fee_blocks * price AS total_fee
FROM (SELECT * FROM life WHERE entry_time IS NOT NULL) l ASOF LEFT JOIN versions v ON l.last_update >= v.valid_from""",
    "layered_config": _with(LIFE) + """SELECT location, license_plate, fee_blocks, fee_blocks * 5000 AS fee_default,
  fee_blocks * 6000 AS fee_file, fee_blocks * 7000 AS fee_legacy FROM life""",
    "ledger_rows": _with(LEDGER) + """SELECT license_plate || '_' || location AS ledger_key, license_plate, location,
  total_fee, parked_minutes, checkout_time FROM ledger""",
    "checkout_requests": _with(VIEW) + """SELECT r.event_id AS request_id, r.license_plate, r.location,
  CASE WHEN r.location IS NULL THEN 'missing_field' WHEN v.location IS NULL THEN 'not_found'
       WHEN v.current_status <> 'EXITING' THEN 'not_exiting' WHEN r.n > 1 THEN 'not_found' ELSE 'success' END AS outcome,
  CASE WHEN v.current_status <> 'EXITING' OR r.n = 1 THEN v.current_status END AS current_status,
  CASE WHEN v.current_status = 'EXITING' AND r.n = 1 THEN v.total_fee END AS total_fee,
  CASE WHEN v.current_status = 'EXITING' AND r.n = 1 THEN v.parked_minutes END AS parked_minutes
FROM (SELECT *, row_number() OVER (PARTITION BY license_plate, location ORDER BY event_id) AS n
      FROM (SELECT event_id, license_plate, CASE WHEN status_code <> 'ENTERING' THEN location END AS location FROM feed)) r
LEFT JOIN view_rows v ON r.license_plate = v.license_plate AND r.location = v.location""",
    "checkout_history": _with() + """SELECT
  sha256(CAST(timestamp_unix AS VARCHAR) || '|' || license_plate || '|' || location || '|' || CAST(event_id AS VARCHAR)) AS event_id,
  timestamp_unix AS event_time_unix, license_plate, location, status_code AS status
FROM feed WHERE status_code = 'EXITING'""",
}

_PAYMENTS = """payments AS (
  SELECT license_plate, location, total_fee, parked_minutes, exit_timestamp AS checkout_time, entry_time
  FROM life WHERE entry_time IS NOT NULL AND current_status = 'EXITING')"""
for _name, _keys in (("ledger_upsert", "license_plate, location"), ("ledger_per_stay", "license_plate, location, entry_time")):
    _columns = "license_plate, location, total_fee, parked_minutes, checkout_time" + (", entry_time" if "entry" in _keys else "")
    ORACLES[_name] = _with(LIFE, LEDGER, _PAYMENTS) + f"""SELECT {_columns}
FROM (SELECT *, row_number() OVER (PARTITION BY {_keys} ORDER BY checkout_time DESC, total_fee DESC) AS n
      FROM (SELECT * FROM ledger UNION ALL SELECT * FROM payments)) WHERE n = 1"""
ORACLES["unpaid_stays"] = _with(_visits(), _visits("paid", f"ts < TIMESTAMP '{LEDGER_CLOSED}'")) + """
SELECT license_plate, last_location AS location, entry_time, exit_time, total_fee FROM visits
WHERE closed AND (license_plate, last_location, entry_time) NOT IN
  (SELECT (license_plate, last_location, entry_time) FROM paid WHERE closed)"""


ORACLES["checkout_repeats"] = _with(VIEW) + """SELECT r.request_id, r.license_plate, r.location,
  CASE WHEN r.request_id IS NULL THEN 'missing_field' WHEN v.location IS NULL THEN 'not_found'
       WHEN v.current_status <> 'EXITING' THEN 'not_exiting' WHEN r.n > 1 THEN 'not_found' ELSE 'success' END AS outcome,
  CASE WHEN r.request_id IS NOT NULL AND (v.current_status <> 'EXITING' OR r.n = 1) THEN v.current_status END AS current_status,
  CASE WHEN r.request_id IS NOT NULL AND v.current_status = 'EXITING' AND r.n = 1 THEN v.total_fee END AS total_fee,
  CASE WHEN r.request_id IS NOT NULL AND v.current_status = 'EXITING' AND r.n = 1 THEN v.parked_minutes END AS parked_minutes
FROM (SELECT *, row_number() OVER (PARTITION BY license_plate, location ORDER BY request_id NULLS LAST) AS n
      FROM (SELECT CASE WHEN event_id % 11 <> 0 THEN event_id // 2 END AS request_id, license_plate, location
            FROM feed, (VALUES (1), (2)) twice(copy))) r
LEFT JOIN view_rows v ON r.license_plate = v.license_plate AND r.location = v.location"""
ORACLES["checkout_stays"] = _with(_visits(), _visits("paid", f"ts < TIMESTAMP '{LEDGER_CLOSED}'")) + """
SELECT request_id, license_plate, location, outcome, CASE WHEN outcome = 'success' THEN entry_time END AS entry_time,
  CASE WHEN outcome = 'success' THEN total_fee END AS total_fee,
  CASE WHEN outcome = 'success' THEN parked_minutes END AS parked_minutes
FROM (SELECT *, CASE WHEN asked IS NULL THEN 'missing_field' WHEN entry_time IS NULL OR is_paid OR (is_over AND turn > 1) THEN 'not_found'
                     WHEN NOT is_over THEN 'not_exiting' ELSE 'success' END AS outcome
      FROM (SELECT *, row_number() OVER (PARTITION BY license_plate, location, entry_time, is_over, asked IS NULL ORDER BY asked, request_id) AS turn
            FROM (SELECT r.*, s.entry_time, s.total_fee, s.parked_minutes, coalesce(s.exit_time <= r.asked, FALSE) AS is_over,
                         (r.license_plate, r.location, s.entry_time) IN (SELECT (license_plate, last_location, entry_time) FROM paid WHERE closed) AS is_paid
                  FROM (SELECT event_id AS request_id, license_plate, location, CASE WHEN event_id % 7 <> 0 THEN timestamp_unix END AS asked FROM feed) r
                  ASOF LEFT JOIN visits s ON r.license_plate = s.license_plate AND r.location = s.last_location AND r.asked >= s.entry_time)))"""
ORACLES["record_gaps"] = """
SELECT partition, reached + 1 AS first_missing, place - 1 AS last_missing, place - 1 - reached AS missing
FROM (SELECT partition, place, lag(place) OVER (PARTITION BY partition ORDER BY place) AS reached
      FROM (SELECT DISTINCT CAST(event_id % 4 AS INT) AS partition, event_id // 4 AS place FROM events WHERE event_id // 97 % 5 <> 0))
WHERE place > reached + 1"""
ORACLES["stream_record_gaps"] = ORACLES["record_gaps"]


def _straggling(where: str, until: str = "timestamp_unix", kept: str = "ripe AND NOT late") -> str:
    """The feed whose every fifth event comes a part late, parted by the watermark of two minutes before each part."""
    part = f"CASE WHEN ts < TIMESTAMP '{CUT_1}' THEN 0 WHEN ts < TIMESTAMP '{CUT_2}' THEN 1 ELSE 2 END"
    return FEED.replace("feed AS (", "whole AS (") + f""",
arrivals AS (SELECT *, least({part} + CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END, 2) AS part FROM whole WHERE {where}),
marks AS (SELECT p.part, max(timestamp_unix) FILTER (WHERE a.part < p.part) - 120 AS passed, max(timestamp_unix) - 120 AS at_end
          FROM arrivals a, (SELECT DISTINCT part FROM arrivals) p GROUP BY p.part),
parted AS (SELECT a.*, coalesce({until} <= passed, FALSE) AS late, timestamp_unix <= at_end AS ripe
           FROM arrivals a JOIN marks m ON a.part = m.part),
feed AS (SELECT * FROM parted WHERE {kept})"""


_SLOW = f"WITH {_straggling(KNOWN)}"
ORACLES["stream_slots_in_order"] = f"{_SLOW}, {FSM} SELECT * FROM current_state"
ORACLES["stream_slot_releases_in_order"] = f"{_SLOW}, {FSM} SELECT * EXCLUDE (from_end, event_id) FROM fsm WHERE status = 'EXITING'"
ORACLES["stream_late_at_slots"] = f"{_SLOW} SELECT license_plate, status_code, timestamp_unix, location FROM parted WHERE late"
ORACLES["stream_visits_in_order"] = f"WITH {_straggling(BILLABLE)}, {_visits()} SELECT {VISIT_COLUMNS} FROM visits"

_WINDOWED = f"WITH {_straggling('TRUE', 'timestamp_unix // 30 * 30 + 30', 'NOT late')}"
ORACLES["stream_windows_parted"] = (
    f"{_WINDOWED}, {_totals('life', 'ENTERING', 'TRUE', 'window_start, location, license_plate')} SELECT * EXCLUDE (exit_timestamp) FROM life"
)
ORACLES["stream_late_in_windows"] = f"{_WINDOWED} SELECT license_plate, status_code, timestamp_unix, location FROM parted WHERE late"

HISTORY = """
changes AS (
  SELECT * FROM (SELECT *, lag(price) OVER (ORDER BY set_at) AS before
                 FROM (SELECT timestamp_unix AS set_at, max(4000 + timestamp_unix // 200000 % 3 * 500) AS price
                       FROM feed WHERE status_code = 'PARKED' AND event_id % 7 <> 0 AND event_id % 11 <> 0 GROUP BY timestamp_unix))
  WHERE before IS DISTINCT FROM price),
history AS (SELECT price, set_at AS valid_from, lead(set_at) OVER (ORDER BY set_at) AS valid_until FROM changes)"""
ORACLES["price_history"] = _with(HISTORY) + "SELECT * FROM history"
ORACLES["config_price_fees"] = _with(LIFE, HISTORY) + f"""
SELECT location, license_plate, last_update, fee_blocks, coalesce(price, {PRICE}) AS price_per_block, fee_blocks * coalesce(price, {PRICE}) AS total_fee
FROM (SELECT * FROM life WHERE entry_time IS NOT NULL) l
LEFT JOIN history h ON l.last_update >= h.valid_from AND (h.valid_until IS NULL OR l.last_update < h.valid_until)"""
ORACLES["plate_sketches"] = _with() + """
SELECT substr(location, 1, 1) AS floor, count(DISTINCT license_plate) AS plates, TRUE AS within_error FROM feed GROUP BY 1"""
ORACLES["stream_plate_sketches"] = ORACLES["plate_sketches"]
ORACLES["dwell_quantiles"] = _with(CHANGES) + f"""
SELECT status_code, level, count(*) AS spells, TRUE AS within_bounds
FROM (SELECT status_code, lead(timestamp_unix) OVER (PARTITION BY license_plate, location ORDER BY {ORDER}) AS next FROM changes),
     (VALUES (CAST(0.5 AS DOUBLE)), (CAST(0.95 AS DOUBLE))) AS levels(level)
WHERE next IS NOT NULL GROUP BY 1, 2"""

# streams give what their batch forms give
ORACLES["stream_stay_join"] = ORACLES["park_exit_pairs"]
ORACLES["snapshot_roundtrip"] = ORACLES["snapshot_all"]
ORACLES["stream_snapshot"] = ORACLES["snapshot_all"]
ORACLES["stream_lifetime_complete"] = ORACLES["active_vehicles"]
ORACLES["stream_lifetime_update"] = ORACLES["lifetime_fees"]
ORACLES["stream_restart"] = ORACLES["lifetime_fees"]
ORACLES["stream_window_update"] = ORACLES["window_fees_30s"]
ORACLES["stream_slot_fsm"] = ORACLES["slot_fsm_current"]
ORACLES["stream_visits"] = ORACLES["visit_fees"]
ORACLES["stream_park_exit_pairs"] = ORACLES["park_exit_pairs"]
ORACLES["stream_history"] = ORACLES["checkout_history"]
ORACLES["stream_slot_releases"] = _with(FSM) + "SELECT * EXCLUDE (from_end, event_id) FROM fsm WHERE status = 'EXITING'"
ORACLES["stream_dedup"] = _with() + """
SELECT DISTINCT "timestamp", license_plate, location, status_code, timestamp_unix FROM feed"""

ORACLES["stream_late_data"] = (
    _with(_totals("life", "ENTERING", f"ts >= TIMESTAMP '{CUT_1}'", "window_start, location, license_plate"))
    + "SELECT * EXCLUDE (exit_timestamp) FROM life"
)
# with the first part last: all of it where the vehicle left later, and exits that nothing before explains where it stayed
ORACLES["stream_late_rows"] = _with() + f"""
SELECT license_plate, status_code, timestamp_unix, location
FROM (SELECT *, ts < TIMESTAMP '{CUT_1}' AS first_part,
             bool_or(ts >= TIMESTAMP '{CUT_1}' AND status_code = 'EXITING') OVER (PARTITION BY license_plate) AS left_later,
             bool_or(ts >= TIMESTAMP '{CUT_1}' AND status_code = 'PARKED') OVER (PARTITION BY license_plate) AS parked_later,
             coalesce(bool_or(status_code = 'PARKED') OVER (PARTITION BY license_plate ORDER BY timestamp_unix, status_rank, event_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS parked_before
      FROM feed WHERE {BILLABLE})
WHERE first_part AND (left_later OR (parked_later AND NOT parked_before AND status_code = 'EXITING'))"""
ORACLES["stream_quarantine"] = f"SELECT * EXCLUDE (set_aside) FROM ({ORACLES['malformed_events']}) WHERE set_aside"
ORACLES["stream_metrics"] = _with() + f"""
SELECT batch_id, count(*) AS records, count(*) AS usable, count(*) FILTER (WHERE {BILLABLE}) AS billable
FROM (SELECT status_code, CAST(CASE WHEN ts < TIMESTAMP '{CUT_1}' THEN 0 WHEN ts < TIMESTAMP '{CUT_2}' THEN 1 ELSE 2 END
                               AS BIGINT) AS batch_id FROM feed) GROUP BY batch_id"""

ORACLES["stream_observed"] = ORACLES["stream_metrics"]

# (slot, vehicle) rows as they stand after each part of the feed
_PARTS = ", ".join(
    _totals(name, "PARKED", f"{BILLABLE}{until}")
    for name, until in (
        ("life_0", f" AND ts < TIMESTAMP '{CUT_1}'"),
        ("life_1", f" AND ts < TIMESTAMP '{CUT_2}'"),
        ("life", ""),
    )
)
_LEFT = "entry_time IS NOT NULL AND current_status = 'EXITING'"
_STAYS = f"""stays AS (
  SELECT *, row_number() OVER (PARTITION BY license_plate, location, entry_time ORDER BY part DESC) AS n
  FROM (SELECT *, 0 AS part FROM life_0 UNION ALL SELECT *, 1 FROM life_1 UNION ALL SELECT *, 2 FROM life)
  WHERE {_LEFT})"""
ORACLES["stream_checkout"] = _with(_PARTS, _STAYS) + """
SELECT license_plate, location AS exit_location, entry_time, entry_timestamp, exit_timestamp, parked_minutes, total_fee
FROM stays WHERE n = 1"""
ORACLES["stream_fanout"] = _with(_PARTS, _STAYS) + f"""
SELECT {SNAPSHOT_COLUMNS}, (license_plate, location) IN (SELECT (license_plate, location) FROM stays) AS checked_out
FROM life WHERE entry_time IS NOT NULL"""
