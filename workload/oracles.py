"""The registered queries in SQL for DuckDB, on the same tables."""

from __future__ import annotations

# Event names as documents spell them, in the dictionary's order, and the keys of both maps.
EVENT_NAMES = (
    "disembarking_start", "disembarking_finish", "arrival_dispatcher_on_stand", "pbb_connected",
    "placement_of_aircraft_steps_connected", "ramp_unloading_start", "gate_open",
    "departure_dispatcher_on_stand", "toilet_service_start", "toilet_service_finish",
    "potable_water_service_start", "potable_water_service_finish", "tug_connected", "gate_closed",
    "boarding_clearance", "boarding_start", "boarding_finish", "total_hand_baggage", "fuelling_start",
    "fuelling_finish", "ramp_loading_start", "ramp_loading_finish", "offload_received", "engineer_off_finish",
    "cabin_doors_closed", "cargo_positioned", "ramp_unloading_end", "cleaning_start", "cleaning_finish",
    "catering_start", "catering_finish", "linked_flight", "stand", "flight_status", "flight_status_ad",
    "flight_status_code", "aircraft_call_sign", "et", "gate", "catering_requested", "catering_arrived",
    "delay_code_1", "delay_duration_1", "delay_code_2", "delay_duration_2", "delay_code_3", "delay_duration_3",
    "total_delay_duration", "departure_temp_on_arrival", "departure_temp_for_boarding",
    "departure_boarding_held_for_temp", "baggage_offloading_start", "baggage_offloading_finish",
    "cargo_door_closed",
)
ARRIVAL_KEYS = (
    "disembarking_start", "disembarking_finish", "arrival_dispatcher_on_stand", "pbb_connected",
    "placement_of_aircraft_steps_connected", "ramp_unloading_start", "arrival_pax_off_start",
    "arrival_pax_off_finish",
)
DEPARTURE_KEYS = (
    "gate_open", "departure_dispatcher_on_stand", "toilet_service_start", "toilet_service_finish",
    "potable_water_service_start", "potable_water_service_finish", "tug_connected", "gate_closed",
    "boarding_clearance", "boarding_start", "boarding_finish", "total_hand_baggage", "fuelling_start",
    "fuelling_finish", "ramp_loading_start", "ramp_loading_finish", "offload_received", "engineer_off_finish",
    "cabin_doors_closed", "cargo_positioned", "ramp_unloading_end",
)
DUAL_KEYS = ("cleaning_start", "cleaning_finish", "catering_start", "catering_finish")

MILLIS = "%Y-%m-%dT%H:%M:%S.%g"

EVENTS = """
e AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
)"""

NORMALIZED = f"""
CASE WHEN k < 15 THEN NULL
     WHEN k < 20 THEN CAST(event_id AS VARCHAR)
     WHEN k < 25 THEN 'not-a-date'
     WHEN k < 40 THEN strftime(ts, '{MILLIS}Z')
     WHEN k < 50 THEN strftime(ts, '%Y-%m-%dT00:00:00.000Z')
     WHEN k < 60 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
     WHEN k < 68 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.000Z')
     WHEN k < 76 THEN strftime(date_trunc('minute', ts) - INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:00.000Z')
     WHEN k < 92 THEN strftime(ts, '%Y-%m-%dT00:00:00.000Z')
     ELSE strftime(ts + INTERVAL 3 HOUR, '{MILLIS}Z') END"""

GAPS = f"""
WITH {EVENTS}
SELECT event_id, nullif(event_type, 'error') AS acdm_id, nullif(user_id, 0) AS flight_number,
       CASE WHEN k >= 10 THEN strftime(ts, '{MILLIS}Z') END AS scheduledate,
       CASE WHEN k < 90 THEN event_type END AS origin
FROM e"""

LATEST_EVENTS = """
SELECT user_id, event_type, event_id, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"""

LATEST_EVENT_VALUES = """
SELECT user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"""

LINE_ROWS = """
newest AS (
  SELECT l_orderkey, l_linenumber AS n, CAST(l_partkey AS VARCHAR) AS v FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                             ORDER BY l_shipdate DESC, l_partkey DESC) = 1
),
o AS (
  SELECT o_orderkey AS l_orderkey, any_value(o_orderstatus) AS s, count(n) AS c,
""" + ",\n".join(f"         max(CASE WHEN n = {i} THEN v END) AS v{i}" for i in range(1, 8)) + """
  FROM orders LEFT JOIN newest ON o_orderkey = newest.l_orderkey GROUP BY o_orderkey
)"""

LINE_KEY = "l_orderkey, l_linenumber, l_partkey, strftime(l_shipdate, '%Y-%m-%d') AS ship_day"

def _listed(keys) -> str:
    return "[" + ", ".join(f"'{k}'" for k in keys) + "]"


# Good messages with their key, from the events they were made of.
MESSAGES = f"""
WITH {EVENTS},
m AS (
  SELECT *, date_trunc('hour', ts) AS enq, {_listed(EVENT_NAMES)}[event_id % 54 + 1] AS cycled,
    CASE event_type WHEN 'click' THEN 'EY' WHEN 'view' THEN 'qr' WHEN 'purchase' THEN '' ELSE 'AB' END AS carrier,
    ltrim(CAST(user_id AS VARCHAR), '0') AS num,
    CASE WHEN k BETWEEN 60 AND 79 THEN strftime(date_trunc('day', ts) - INTERVAL 1 DAY, '%Y-%m-%d')
         ELSE strftime(ts, '%Y-%m-%d') END AS day,
    CASE WHEN k BETWEEN 10 AND 14 THEN NULL WHEN event_type = 'click' THEN 'BCN' ELSE 'AUH' END AS org,
    CASE event_type WHEN 'click' THEN 'ARRIVAL' WHEN 'view' THEN 'DEPARTURE' ELSE 'OTHER' END AS ftype
  FROM e WHERE event_type <> 'error'
),
d AS (
  SELECT *, carrier || '-' || num || '-' || day || '-' || coalesce(org, 'no_orig') AS id
  FROM m WHERE k >= 10
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY enq DESC, event_id DESC) = 1
)"""

# What the messages say about each scalar document column; all others are null.
DOCUMENT_VALUES = {
    "id": "id",
    "flight_key": "id",
    "acdm_id": """'{"h":"' || user_id || '"}'""",
    "aircraft_reg": "'A6' || user_id || 'X'",
    "airline": "carrier",
    "airline_src": "'ETD'",
    "at": "CASE WHEN k < 50 THEN CAST(k AS VARCHAR) END",
    "cancelled": "k > 90",
    "deleted": "CAST(NULL AS BOOLEAN)",
    "destination": "upper(event_type)",
    "diverted": "k % 3 = 0",
    "flight_number": "num",
    "flight_type": "ftype",
    "origin": "org",
    "partial": "k < 20",
    "scheduledate": "day",
    "schedule_datetime": """CASE WHEN k BETWEEN 60 AND 79
        THEN strftime(date_trunc('day', ts) - INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:00.000Z')
        ELSE strftime(ts, '%Y-%m-%dT00:00:00.000Z') END""",
    "st": f"strftime(ts, '{MILLIS}Z')",
    "gate": "CAST(event_id AS VARCHAR)",
    "delay_code_1": "CAST(k AS VARCHAR)",
    "total_delay_duration": "'PT' || k || 'M'",
    "departure_temp_on_arrival": "event_type",
    "baggage_offloading_start": f"strftime(ts, '{MILLIS}')",
    "cargo_door_closed": f"""CASE WHEN k >= 90 THEN NULL
        WHEN event_type = 'signup' THEN strftime(ts - INTERVAL 270 MINUTE, '{MILLIS}Z')
        WHEN cycled = 'cargo_door_closed' THEN 'v' || event_id END""",
    "enqueued_datetime": f"strftime(enq, '{MILLIS}Z')",
    "aircraft_call_sign": "'acs-' || event_id",
    "aircraft_type": "'act-' || event_id",
    "baggage_offloading_finish": "'bof-' || event_id",
    "catering_arrived": "'cta-' || event_id",
    "catering_requested": "'ctr-' || event_id",
    "delay_code_2": "'dc2-' || event_id",
    "delay_code_3": "'dc3-' || event_id",
    "delay_duration_1": "'dd1-' || event_id",
    "delay_duration_2": "'dd2-' || event_id",
    "delay_duration_3": "'dd3-' || event_id",
    "departure_boarding_held_for_temp": "'bht-' || event_id",
    "departure_temp_for_boarding": "'tfb-' || event_id",
    "et": "'eta-' || event_id",
    "flight_status": "'fst-' || event_id",
    "flight_status_ad": "'fad-' || event_id",
    "flight_status_code": "'fsc-' || event_id",
    "linked_flight": "'lfl-' || event_id",
    "source": "'src-' || event_id",
    "source_location": "'slo-' || event_id",
    "stand": "'std-' || event_id",
}

DOCUMENTS = (
    MESSAGES
    + "\nSELECT "
    + ",\n  ".join(f"{value} AS {name}" for name, value in DOCUMENT_VALUES.items())
    + """,
  CASE WHEN ftype = 'ARRIVAL' THEN 12 ELSE 8 END AS n_arrival,
  CASE WHEN ftype = 'DEPARTURE' THEN 25 ELSE 21 END AS n_departure
FROM d"""
)


DOCUMENT_MAPS = (
    MESSAGES
    + f""",
keyed AS (
  SELECT *, 'arrival' AS side,
    unnest(CASE WHEN ftype = 'ARRIVAL' THEN {_listed(ARRIVAL_KEYS + DUAL_KEYS)} ELSE {_listed(ARRIVAL_KEYS)} END) AS name
  FROM d
  UNION ALL
  SELECT *, 'departure' AS side,
    unnest(CASE WHEN ftype = 'DEPARTURE' THEN {_listed(DEPARTURE_KEYS + DUAL_KEYS)} ELSE {_listed(DEPARTURE_KEYS)} END) AS name
  FROM d
)
SELECT id, side, name,
  CASE WHEN k >= 90 THEN NULL
       WHEN name = 'gate_open' THEN strftime(ts, '{MILLIS}Z')
       WHEN name IN ('disembarking_start', 'arrival_pax_off_start') AND event_type = 'click'
         THEN strftime(ts - INTERVAL 270 MINUTE, '{MILLIS}Z')
       WHEN name = 'cleaning_start' AND event_type = 'purchase'
         THEN strftime(ts - INTERVAL 270 MINUTE, '{MILLIS}Z')
       WHEN name = 'boarding_start' THEN strftime(ts + INTERVAL 2 HOUR, '{MILLIS}Z')
       WHEN name = 'catering_finish' AND k < 50 THEN CAST(k AS VARCHAR)
       WHEN name = 'fuelling_finish' AND k >= 50 THEN CAST(k AS VARCHAR)
       WHEN cycled = CASE name WHEN 'arrival_pax_off_start' THEN 'disembarking_start'
                               WHEN 'arrival_pax_off_finish' THEN 'disembarking_finish' ELSE name END
         THEN 'v' || event_id END AS value
FROM keyed"""
)

KEY_LOG = (
    MESSAGES
    + f"""
SELECT carrier || '-' || num || '-' || day || '-' || org AS flight_key, strftime(enq, '{MILLIS}Z') AS enqueued
FROM m WHERE k NOT BETWEEN 5 AND 14"""
)

REJECTS = f"""
WITH {EVENTS}
SELECT CASE WHEN event_type = 'error' THEN 'invalid_json' WHEN k < 5 THEN 'missing_field'
            ELSE 'invalid_date' END AS reject_reason,
       event_id AS sequence_number, strftime(date_trunc('hour', ts), '{MILLIS}Z') AS enqueued
FROM e WHERE event_type = 'error' OR k < 10"""

VERSIONED_NAMES = """
WITH versions AS (
  SELECT ['click', 'view', 'purchase', 'signup', 'unseen'][p_size % 5 + 1] AS name,
         TIMESTAMP '2024-01-01' + to_minutes(CAST(p_partkey * 37 % 43200 AS BIGINT)) AS valid_from,
         CASE WHEN p_size % 10 > 0 THEN p_brand || '/' || p_partkey END AS target
  FROM part
  QUALIFY row_number() OVER (PARTITION BY name, valid_from ORDER BY p_partkey DESC) = 1
)
SELECT event_id, event_type, target AS friendly_name
FROM events ASOF LEFT JOIN versions ON event_type = name AND ts >= valid_from"""

ORACLES: dict[str, str] = {
    "versioned_names": VERSIONED_NAMES,
    "versioned_names_merged": VERSIONED_NAMES,
    "decode_envelope": f"""
WITH {EVENTS},
a AS (SELECT *, ts + to_microseconds(CAST(k AS BIGINT) * 900000) AS arrived FROM e)
SELECT props AS json_body, strftime(arrived, '{MILLIS}Z') AS ingestiontime,
       strftime(ts, '{MILLIS}Z') AS enqueued,
       CAST(floor(epoch(arrived)) AS BIGINT) - CAST(floor(epoch(ts)) AS BIGINT) AS time_difference_seconds,
       event_id AS "sequenceNumber"
FROM a""",
    "parse_json_fields": """
SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       json_extract_string(props, '$.absent') AS absent
FROM events""",
    "json_validity": f"""
WITH {EVENTS},
t AS (
  SELECT *, [' tail', '],[', '],["a"', ',"x":1', '}} cut off {{"', ',"m":{{}}', '] [', ' '][k % 8 + 1] AS tail FROM e
)
SELECT event_id, coalesce(json_valid(CASE event_type
         WHEN 'error' THEN left(props, length(props) - 1) WHEN 'signup' THEN props || tail
         WHEN 'purchase' THEN '1' || tail WHEN 'view' THEN NULL ELSE props END), false) AS valid
FROM t""",
    "message_lag": """
SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(epoch(l_shipdate) - epoch(o_orderdate) AS BIGINT) AS lag_seconds
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "business_key": r"""
WITH j AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN c_name END AS raw, o_orderdate,
         CASE WHEN o_orderstatus <> 'F' THEN n_name END AS place, upper(o_orderstatus) AS kind
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
p AS (
  SELECT *, regexp_extract(raw, '^([A-Za-z]+)', 1) AS carrier,
         regexp_replace(regexp_extract(raw, '(\d+)$', 1), '^0+', '') AS number
  FROM j
)
SELECT o_orderkey, concat_ws('-', coalesce(carrier, 'no_carrier'), coalesce(number, 'no_fn'),
         strftime(o_orderdate, '%Y-%m-%d'), coalesce(place, 'no_orig')) AS key, number, carrier, kind
FROM p""",
    "normalize_timestamp": f"WITH {EVENTS} SELECT event_id, {NORMALIZED} AS normalized FROM e",
    "validate_date": f"""
WITH {EVENTS}
SELECT event_id, left({NORMALIZED}, 10) AS day FROM e WHERE k >= 25""",
    "map_names": """
SELECT event_id, CASE event_type WHEN 'click' THEN 'clicked' WHEN 'view' THEN 'viewed'
                                 WHEN 'purchase' THEN 'bought' END AS friendly_name
FROM events WHERE event_type IN ('click', 'view', 'purchase')""",
    "strip_and_upper": """
SELECT o_orderkey, replace(o_orderpriority, '-', '') AS priority, upper(o_orderstatus) AS status,
       regexp_replace(lpad(CAST(o_orderkey AS VARCHAR), 12, '0'), '^0+', '') AS number
FROM orders""",
    "null_rules_main": f"""
SELECT * FROM ({GAPS}) WHERE acdm_id IS NOT NULL AND flight_number IS NOT NULL AND scheduledate IS NOT NULL""",
    "null_rules_keylog": f"""
SELECT * FROM ({GAPS}) WHERE flight_number IS NOT NULL AND scheduledate IS NOT NULL AND origin IS NOT NULL""",
    "latest_per_key_window": LATEST_EVENTS,
    "latest_per_key_maxby": LATEST_EVENTS,
    "latest_per_key_late_fetch": LATEST_EVENTS,
    "latest_with_ties": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC) = 1""",
    "explode_attributes": f"""
WITH l AS (SELECT *, l_returnflag <> 'R' AND l_discount > 0 AS listed FROM lineitem)
SELECT {LINE_KEY}, 0 AS position, 'RF.' || l_returnflag AS name, CAST(l_suppkey AS VARCHAR) AS value
FROM l WHERE listed
UNION ALL
SELECT {LINE_KEY}, 1, 'LS.' || l_linestatus, strftime(l_shipdate, '%Y-%m-%d') FROM l WHERE listed
UNION ALL
SELECT {LINE_KEY}, 2, 'unknown', CAST(l_partkey AS VARCHAR) FROM l WHERE listed
UNION ALL
SELECT {LINE_KEY}, 3, NULL, CAST(l_partkey AS VARCHAR) FROM l WHERE listed
UNION ALL
SELECT {LINE_KEY}, 4, 'RF.' || l_returnflag, ' ' || l_partkey || ' ' FROM l WHERE listed
UNION ALL
SELECT {LINE_KEY}, NULL, NULL, NULL FROM l WHERE NOT listed""",
    "pivot_attributes_arrayform": f"""
WITH l AS (SELECT *, l_returnflag <> 'R' AND l_discount > 0 AS listed FROM lineitem)
SELECT {LINE_KEY}, CASE WHEN listed THEN 2 ELSE 0 END AS n_attributes,
       CASE WHEN listed THEN CAST(l_partkey AS VARCHAR) END AS flag,
       CASE WHEN listed THEN strftime(l_shipdate, '%Y-%m-%dT00:00:00.000Z') END AS line_status
FROM l""",
    "pivot_attributes_rowform": """
SELECT l_orderkey, 'line_' || l_linenumber AS name, CAST(l_partkey AS VARCHAR) AS value FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC) = 1""",
    "attach_attributes": f"""
WITH {LINE_ROWS} SELECT l_orderkey, CAST(c AS INTEGER) AS n_attributes, v1 AS line_1 FROM o""",
    "alias_keys": f"""
WITH {LINE_ROWS}
SELECT l_orderkey, CAST(c + 2 AS INTEGER) AS n_attributes, v1 AS first, v1 AS line_1, v2 AS second, v2 AS line_2
FROM o""",
    "typed_groups": f"""
WITH {LINE_ROWS}
SELECT l_orderkey, CASE s WHEN 'F' THEN 3 ELSE 2 END AS n_low, CASE s WHEN 'O' THEN 3 ELSE 2 END AS n_high,
       v1 AS low_1, v2 AS low_2, CASE s WHEN 'F' THEN v7 END AS low_7,
       v5 AS high_5, v6 AS high_6, CASE s WHEN 'O' THEN v7 END AS high_7
FROM o""",
    "documents": DOCUMENTS,
    "document_maps": DOCUMENT_MAPS,
    "documents_variant": DOCUMENTS,
    "documents_late": DOCUMENTS,
    "key_log": KEY_LOG,
    "rejects": REJECTS,
    "rejects_variant": REJECTS,
    "top1_config": """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'
ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1""",
    "batch_metrics": MESSAGES
    + """
SELECT 'raw' AS sink, count(*) AS n_rows FROM e
UNION ALL SELECT 'rejects', count(*) FROM e WHERE event_type = 'error' OR k < 10
UNION ALL SELECT 'key_log', count(*) FROM m WHERE k NOT BETWEEN 5 AND 14
UNION ALL SELECT 'documents', count(*) FROM d""",
    "append_partitioned": """
SELECT event_id, user_id, event_type, CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN props END AS props,
       strftime(ts, '%Y-%m-%d') AS day
FROM events""",
    "upsert_snapshot": LATEST_EVENT_VALUES,
    "compacted_snapshot": LATEST_EVENT_VALUES,
    "stream_raw": f"""
SELECT props AS json_body, strftime(ts, '{MILLIS}Z') AS enqueued, event_id AS "sequenceNumber" FROM events""",
    "stream_documents": DOCUMENTS,
    "stream_key_log": KEY_LOG,
    "stream_latest": LATEST_EVENT_VALUES,
    "stream_changes": """
WITH arrivals AS (
  SELECT 0 AS batch_id, * FROM events WHERE ts >= '2024-01-15' AND ts < '2024-01-20'
  UNION ALL SELECT 1, * FROM events WHERE ts < '2024-01-10'
  UNION ALL SELECT 2, * FROM events WHERE ts >= '2024-01-15' AND ts < '2024-01-20'
  UNION ALL SELECT 3, * FROM events WHERE ts >= '2024-01-20'
  UNION ALL SELECT 4, * FROM events WHERE ts >= '2024-01-10' AND ts < '2024-01-15'
),
newest AS (
  SELECT *, {'ts': ts, 'id': event_id} AS rank FROM arrivals
  QUALIFY row_number() OVER (PARTITION BY batch_id, user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
),
held AS (
  SELECT *, max(rank) OVER (PARTITION BY user_id, event_type ORDER BY batch_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM newest
)
SELECT CAST(batch_id AS BIGINT) AS batch_id, user_id, event_type, event_id, value
FROM held WHERE before IS NULL OR rank > before""",
    "stream_changed_documents": DOCUMENTS,
    "stream_attach_attributes": """
SELECT o_orderkey AS l_orderkey, CAST(count(DISTINCT l_linenumber) AS INTEGER) AS n_attributes,
       CAST(max({'at': l_shipdate, 'part': l_partkey}) FILTER (WHERE l_linenumber = 1).part AS VARCHAR) AS line_1
FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_linenumber BETWEEN 1 AND 7) AS lines
  ON l_orderkey = o_orderkey AND l_shipdate >= o_orderdate AND l_shipdate <= o_orderdate + INTERVAL 60 DAY
GROUP BY o_orderkey, o_orderdate""",
    "stream_replay": f"""
SELECT event_id AS "sequenceNumber", strftime(date_trunc('hour', ts), '{MILLIS}Z') AS enqueued FROM events""",
    "active_config": MESSAGES
    + """
SELECT id, (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 3 > 0
            ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1) AS o_orderkey,
       true AS arrived_in_run, true AS processed_in_run, true AS dated_in_run
FROM d""",
}
