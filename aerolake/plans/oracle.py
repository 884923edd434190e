"""SQL for the registered queries, over the same tables.

It starts from the typed feed rules, never from JSON text, so it shares no decoding
with the operators it checks.
"""

from __future__ import annotations

from aerolake.operators.alarms import ALARMS, AlarmSpec

_FEED = """
feed AS (
  SELECT event_id,
    CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 97 = 0 THEN ''
         ELSE printf('%06x', user_id) END AS icao24,
    event_type AS callsign,
    'NATION_' || CAST(user_id % 30 AS VARCHAR) AS origin_country,
    CASE WHEN event_id % 53 = 0 THEN NULL ELSE CAST(floor(epoch(ts)) AS BIGINT) END AS time_position,
    CAST(floor(epoch(ts)) AS BIGINT) AS last_contact,
    CASE WHEN event_id % 10 = 0 THEN NULL ELSE value - 180 END AS longitude,
    CASE WHEN event_id % 15 = 0 THEN NULL ELSE value * 0.5::DOUBLE - 80 END AS latitude,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) * 100 AS altitude,
    event_type = 'error' AS on_ground,
    value AS velocity,
    CAST(event_id % 360 AS DOUBLE) AS heading,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) - 50 AS vertical_rate,
    ([user_id, event_id % 7, 1])[1:event_id % 4] AS sensors,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) * 100 + 10 AS geo_altitude,
    lpad(CAST(event_id % 7777 AS VARCHAR), 4, '0') AS squawk,
    false AS spi,
    CAST(event_id % 6 AS INTEGER) AS position_source,
    CASE WHEN event_id % 997 = 0 THEN 'not_an_array'
         WHEN event_id % 83 = 0 THEN 'short_row'
         WHEN event_id % 71 = 0 THEN 'bad_velocity'
         WHEN event_id % 6 = 5 THEN 'bad_position_source' END AS reject_reason,
    event_id // 50 AS snapshot_id,
    row_number() OVER (PARTITION BY event_id // 50 ORDER BY event_id) - 1 AS pos
  FROM events
),
states AS (SELECT * FROM feed WHERE reject_reason IS NULL),
points AS (
  SELECT * FROM states WHERE latitude IS NOT NULL AND longitude IS NOT NULL
),
chunks AS (
  SELECT snapshot_id, (row_number() OVER (PARTITION BY snapshot_id ORDER BY pos) - 1) // 10 AS batch_no,
         last_contact, icao24
  FROM states
),
newest AS (
  SELECT * FROM (
    SELECT *, coalesce(nullif(icao24, ''), 'unknown') AS key,
           row_number() OVER (PARTITION BY coalesce(nullif(icao24, ''), 'unknown')
                              ORDER BY last_contact DESC, event_id DESC) AS place
    FROM states)
  WHERE place = 1
),
cut AS (
  SELECT *, sum(starts) OVER (PARTITION BY icao24, callsign ORDER BY last_contact, event_id
                              ROWS UNBOUNDED PRECEDING) AS segment
  FROM (
    SELECT *, CASE WHEN last_contact - lag(last_contact) OVER (
                     PARTITION BY icao24, callsign ORDER BY last_contact, event_id) > 21600
                   THEN 1 ELSE 0 END AS starts
    FROM points)
),
segments AS (
  SELECT icao24, callsign, CAST(segment AS BIGINT) AS segment,
         min(last_contact) AS first_seen, max(last_contact) AS last_seen, count(*) AS points,
         arg_min(latitude, event_id) AS first_latitude, arg_max(longitude, event_id) AS last_longitude,
         arg_min(longitude, event_id) AS first_longitude, arg_max(altitude, event_id) AS last_altitude
  FROM cut GROUP BY icao24, callsign, segment
),
incoming AS (
  SELECT CAST(floor(epoch(ts)) AS BIGINT) // 600 * 600 AS period_start, CAST(count(*) AS DOUBLE) AS value
  FROM events GROUP BY 1
),
idle AS (
  SELECT 'incoming_records' AS metric, 'events' AS source, period_start, value, breaches
  FROM (
    SELECT period_start, value,
           sum(CASE WHEN value < 1 THEN 1 ELSE 0 END)
             OVER (ORDER BY period_start ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS breaches
    FROM (
      SELECT s.period_start, coalesce(i.value, 0) AS value
      FROM (SELECT unnest(generate_series((SELECT min(period_start) FROM incoming),
                                          (SELECT max(period_start) FROM incoming), 600)) AS period_start) s
      LEFT JOIN incoming i ON i.period_start = s.period_start))
  WHERE breaches >= 2
)
"""


def _iso(seconds: str) -> str:
    return f"strftime(make_timestamp(({seconds}) * 1000000), '%Y-%m-%dT%H:%M:%S')"


def _alarm(spec: AlarmSpec) -> str:
    value = "coalesce(v, 0)" if spec.statistic == "Sum" else "v"
    return f"""
    SELECT '{spec.name}' AS alarm, {f"'{spec.severity}'" if spec.severity else "CAST(NULL AS VARCHAR)"} AS severity,
           '{spec.metric}' AS metric, source, period_start, {value} AS value, breaches
    FROM (
      SELECT *, CAST(sum(CASE WHEN {value} {spec.comparison} {spec.threshold} THEN 1 ELSE 0 END) OVER (
               PARTITION BY source ORDER BY period_start ROWS BETWEEN {spec.periods - 1} PRECEDING AND CURRENT ROW) AS BIGINT) AS breaches
      FROM (SELECT source, unnest(generate_series(1704067200 // {spec.period_seconds} * {spec.period_seconds}, 1706745599, {spec.period_seconds})) AS period_start
            FROM watched WHERE metric = '{spec.metric}') s
      LEFT JOIN (SELECT source, seconds // {spec.period_seconds} * {spec.period_seconds} AS period_start, {spec.statistic}(value) AS v
                 FROM metrics WHERE metric = '{spec.metric}' GROUP BY ALL) r USING (source, period_start))
    WHERE breaches >= {spec.breaching}"""


def _changes(spec: AlarmSpec) -> str:
    """Periods up to the last closed minute in which the alarm begins or ends."""
    value = "coalesce(v, 0)" if spec.statistic == "Sum" else "v"
    return f"""
    SELECT '{spec.name}' AS alarm, '{spec.metric}' AS metric, source, period_start, {value} AS value, breaches, in_alarm
    FROM (
      SELECT *, in_alarm != lag(in_alarm, 1, false) OVER (PARTITION BY source ORDER BY period_start) AS changed
      FROM (
        SELECT *, breaches >= {spec.breaching} AS in_alarm
        FROM (
          SELECT *, CAST(sum(CASE WHEN {value} {spec.comparison} {spec.threshold} THEN 1 ELSE 0 END) OVER (
                 PARTITION BY source ORDER BY period_start ROWS BETWEEN {spec.periods - 1} PRECEDING AND CURRENT ROW) AS BIGINT) AS breaches
          FROM (SELECT source, unnest(generate_series(1704067200 // {spec.period_seconds} * {spec.period_seconds}, 1706745599, {spec.period_seconds})) AS period_start
                FROM watched WHERE metric = '{spec.metric}' AND source != 'ledger') s
          LEFT JOIN (SELECT source, seconds // {spec.period_seconds} * {spec.period_seconds} AS period_start, {spec.statistic}(value) AS v
                     FROM metrics WHERE metric = '{spec.metric}' GROUP BY ALL) r USING (source, period_start))))
    WHERE changed AND period_start + {spec.period_seconds} <= (
      SELECT max(seconds // 60 * 60 + 60) FROM metrics
      WHERE source != 'ledger' AND seconds // 60 * 60 + 60 <= (SELECT floor(epoch(max(ts))) - 3600 FROM events))"""


_METRICS = """
ledger AS (
  SELECT 1704067200 + snapshot_id * 60 AS seconds, count(*) FILTER (last_contact % 31 = 0) AS failed
  FROM chunks GROUP BY snapshot_id, batch_no HAVING failed > 0
),
metrics AS (
  SELECT 'incoming_records' AS metric, 'events' AS source, CAST(floor(epoch(ts)) AS BIGINT) AS seconds, 1.0::DOUBLE AS value FROM events
  UNION ALL SELECT 'incoming_records', 'first-half', CAST(floor(epoch(ts)) AS BIGINT), 1.0::DOUBLE FROM events WHERE floor(epoch(ts)) < 1705406400
  UNION ALL SELECT 'iterator_age_ms', event_type, CAST(floor(epoch(ts)) AS BIGINT), value * 1000 FROM events
  UNION ALL SELECT 'errors', 'events', CAST(floor(epoch(ts)) AS BIGINT), 1.0::DOUBLE FROM events WHERE event_type = 'error'
  UNION ALL SELECT 'throttled_records', 'ledger', seconds, CAST(failed * 600 AS DOUBLE) FROM ledger
  UNION ALL SELECT 'throttled_requests', 'ledger', seconds, 200.0::DOUBLE FROM ledger
),
watched AS (SELECT DISTINCT metric, source FROM metrics UNION SELECT 'incoming_records', 'silent')
"""


def _with_feed(select: str) -> str:
    return f"WITH {_FEED} {select}"


_LOCATION = "CAST(latitude AS VARCHAR) || ',' || CAST(longitude AS VARCHAR)"
_EVENT_TIME = "'2024-02-01T00:00:00+00:00'"
_POSITIONED = "latitude IS NOT NULL AND longitude IS NOT NULL"
_RESULT = (
    "CASE WHEN event_id % 61 = 0 THEN 'ProcessingFailed' "
    f"WHEN {_POSITIONED} THEN 'Ok' ELSE 'Dropped' END"
)
_BODY = (
    "CASE WHEN event_id % 101 = 0 THEN 'body_unreadable' "
    "WHEN event_id % 103 != 0 AND event_id % 107 = 0 THEN 'body_unreadable' "
    "WHEN event_id % 103 != 0 AND event_id % 109 = 0 THEN 'body_not_an_object' "
    "WHEN event_id % 103 != 0 AND event_id % 113 = 0 THEN 'states_not_a_list' "
    "WHEN reject_reason IS NULL THEN 'good' ELSE 'row' END"
)
_PASSED = ["icao24", "callsign", "origin_country", "latitude", "longitude", "altitude", "velocity", "heading"]
_SENSORS_JSON = "CASE WHEN len(sensors) > 0 THEN '[' || array_to_string(sensors, ',') || ']' END"
_ENRICHED = (
    "icao24, callsign, origin_country, latitude, longitude, altitude, velocity, heading, "
    f"{_iso('last_contact')} AS last_contact, {_LOCATION} AS location"
)
_STATE = (
    f"icao24, callsign, origin_country, {_iso('time_position')} AS time_position, "
    f"{_iso('last_contact')} AS last_contact, longitude, latitude, altitude, on_ground, velocity, "
    f"heading, vertical_rate, {_SENSORS_JSON} AS sensors, geo_altitude, squawk, spi, position_source"
)
_NEWEST = "SELECT key, event_id, callsign, last_contact, longitude, latitude, squawk FROM newest"
_FLIGHTS = """
SELECT *, CAST(last_seen - first_seen AS DOUBLE) AS duration_seconds,
       CAST(last_seen - first_seen AS DOUBLE) / 3600.0::DOUBLE AS duration_hours
FROM (
  SELECT printf('%06x', o_custkey) AS icao24,
    CAST(epoch(o_orderdate) AS BIGINT) AS first_seen,
    CAST(epoch(o_orderdate) AS BIGINT) + (o_orderkey % 12 + 1) * 3600 AS last_seen,
    o_orderpriority AS callsign,
    CASE WHEN o_orderkey % 7 <> 0 THEN 'NATION_' || CAST(o_custkey % 25 AS VARCHAR) END AS departure_airport,
    CASE WHEN o_orderkey % 5 <> 0
         THEN 'NATION_' || CAST((o_custkey + o_orderkey) % 25 AS VARCHAR) END AS arrival_airport
  FROM orders)
"""
_LISTED = "(SELECT n_name, n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)"


def _names(key: str, names: list[str]) -> str:
    return f"CASE {key} " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names)) + " END"


def oracle_sql() -> dict[str, str]:
    sources = ["ADSB", "ASTERIX", "MLAT", "FLARM", "UNKNOWN"]
    categories = [
        "NO_INFO", "NO_CATEGORY", "LIGHT", "SMALL", "LARGE", "HIGH_VORTEX_LARGE", "HEAVY",
        "HIGH_PERFORMANCE", "ROTORCRAFT", "GLIDER", "LIGHTER_THAN_AIR", "PARACHUTIST", "ULTRALIGHT",
        "RESERVED", "UAV", "SPACE", "SURFACE_EMERGENCY", "SURFACE_SERVICE", "POINT_OBSTACLE",
        "CLUSTER_OBSTACLE", "LINE_OBSTACLE",
    ]
    ledger = """
      SELECT snapshot_id, batch_no, records, records - failed AS sent, failed, failed = 0 AS ok
      FROM (SELECT snapshot_id, batch_no, count(*) AS records, count(*) FILTER ({failed}) AS failed
            FROM chunks GROUP BY ALL)"""
    by_time = ledger.format(failed="WHERE last_contact % 31 = 0")
    by_key = ledger.format(failed="WHERE coalesce(icao24, '') = ''")
    plain = {
        "category_names": f"""
            SELECT CAST(event_id % 21 AS INTEGER) AS category, {_names('event_id % 21', categories)} AS name,
                   count(*) AS states
            FROM events GROUP BY ALL""",
        "arrivals": f"SELECT * FROM ({_FLIGHTS}) WHERE arrival_airport IS NOT NULL",
        "departures": f"SELECT * FROM ({_FLIGHTS}) WHERE departure_airport IS NOT NULL",
        "lag_alarm": """
            WITH rolled AS (
              SELECT event_type AS source, CAST(floor(epoch(ts)) AS BIGINT) // 300 * 300 AS period_start,
                     max(value) AS value
              FROM events GROUP BY ALL),
            spine AS (
              SELECT source, unnest(generate_series(min(period_start), max(period_start), 300)) AS period_start
              FROM rolled GROUP BY source),
            judged AS (
              SELECT source, period_start, value,
                     sum(CASE WHEN value > 60 THEN 1 ELSE 0 END) OVER (
                       PARTITION BY source ORDER BY period_start
                       ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS breaches
              FROM spine LEFT JOIN rolled USING (source, period_start))
            SELECT 'iterator_age_ms' AS metric, source, period_start, value, CAST(breaches AS BIGINT) AS breaches
            FROM judged WHERE breaches >= 2""",
        "error_burst_alarm": """
            WITH rolled AS (
              SELECT CAST(floor(epoch(ts)) AS BIGINT) // 3600 * 3600 AS period_start, count(*) AS n
              FROM events WHERE event_type = 'error' GROUP BY 1),
            spine AS (
              SELECT unnest(generate_series(min(period_start), max(period_start), 3600)) AS period_start
              FROM rolled),
            judged AS (
              SELECT period_start, CAST(coalesce(n, 0) AS DOUBLE) AS value,
                     sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) OVER (
                       ORDER BY period_start ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS breaches
              FROM spine LEFT JOIN rolled USING (period_start))
            SELECT 'errors' AS metric, 'events' AS source, period_start, value,
                   CAST(breaches AS BIGINT) AS breaches, breaches >= 3 AS in_alarm
            FROM judged""",
        "stream_raw": """
            SELECT CAST(floor(epoch(ts)) AS BIGINT) AS time, count(*) AS records FROM events GROUP BY 1""",
    }
    over_feed = {
        "enrich_states": f"SELECT {_ENRICHED}, {_EVENT_TIME} AS event_time FROM states WHERE {_POSITIONED}",
        "decode_states": f"SELECT snapshot_id, CAST(pos AS INTEGER) AS pos, {_STATE} FROM states",
        "malformed_counts": """
            SELECT coalesce(reject_reason, 'good') AS reason, count(*) AS rows FROM feed GROUP BY 1""",
        "quarantine_rows": """
            SELECT event_id, reject_reason,
                   CASE WHEN event_id % 997 <> 0 THEN icao24 END AS icao24,
                   CAST(CASE WHEN event_id % 997 = 0 THEN NULL WHEN event_id % 83 = 0 THEN 16 ELSE 17 END
                        AS INTEGER) AS slots
            FROM feed WHERE reject_reason IS NOT NULL""",
        "transform_outcomes": f"""
            SELECT {_RESULT} AS result, count(*) AS records FROM states GROUP BY 1
            UNION ALL SELECT 'all', count(*) FROM states""",
        "quarantine_bodies": f"SELECT event_id, {_BODY} AS outcome FROM feed",
        "stream_ingest": f"""
            SELECT event_id, {_BODY} AS outcome FROM feed
            UNION ALL SELECT event_id, 'sent' FROM feed WHERE {_BODY} = 'good'""",
        "alarm_table": f", {_METRICS} {' UNION ALL '.join(_alarm(spec) for spec in ALARMS.values())}",
        "stream_alarms": f", {_METRICS} {' UNION ALL '.join(_changes(spec) for spec in ALARMS.values())}",
        "country_file": """
            SELECT n_nationkey AS id, CAST(n_nationkey AS VARCHAR) AS code, n_name AS name, r_name AS continent,
                   CAST(NULL AS VARCHAR) AS wikipedia_link, n_name || ', ' || r_name AS keywords
            FROM nation JOIN region ON n_regionkey = r_regionkey""",
        "user_transform": """
            SELECT event_id, event_id % 61 != 0 AS whole, event_id % 61 != 0 AS filled FROM states""",
        "transform_records": f"""
            SELECT event_id, result,
                   {", ".join(f"CASE WHEN result = 'Ok' THEN {c} END AS {c}" for c in _PASSED)},
                   CASE WHEN result = 'Ok' THEN {_iso('last_contact')} END AS last_contact,
                   CASE WHEN result = 'Ok' THEN {_EVENT_TIME} END AS event_time,
                   CASE WHEN result = 'Ok' THEN {_LOCATION} END AS location
            FROM (SELECT *, {_RESULT} AS result FROM states)""",
        "filter_country_states": """
            SELECT event_id, icao24, callsign, origin_country FROM states WHERE origin_country = 'NATION_3'""",
        "unit_conversions": """
            SELECT event_id, altitude * 3.28084::DOUBLE AS altitude_ft, velocity * 1.94384::DOUBLE AS velocity_kts,
                   vertical_rate * 196.85::DOUBLE AS vertical_rate_ftpm
            FROM states""",
        "position_source_names": f"""
            SELECT position_source, {_names('position_source', sources)} AS name, count(*) AS states
            FROM states GROUP BY ALL""",
        "sensor_ids": """
            SELECT event_id, CAST(len(sensors) AS INTEGER) AS sensors, CAST(list_sum(sensors) AS BIGINT) AS id_sum
            FROM states WHERE len(sensors) > 0""",
        "snapshot_summary": """
            SELECT snapshot_id, '2024-02-01T00:00:00' AS timestamp,
                   count(*) FILTER (WHERE reject_reason IS NULL) AS total_states
            FROM feed GROUP BY ALL""",
        "snapshot_summary_country": """
            SELECT snapshot_id, '2024-02-01T00:00:00' AS timestamp,
                   count(*) FILTER (WHERE reject_reason IS NULL AND origin_country = 'NATION_3') AS total_states
            FROM feed GROUP BY ALL""",
        "snapshot_documents": """
            SELECT f.snapshot_id, '2024-02-01T00:00:00' AS timestamp, count(s.event_id) OVER (PARTITION BY f.snapshot_id) AS total_states,
                   CASE WHEN s.event_id IS NOT NULL THEN CAST(row_number() OVER (PARTITION BY f.snapshot_id ORDER BY s.pos) - 1 AS INTEGER) END AS n,
                   s.icao24, s.squawk, s.longitude, s.last_contact
            FROM (SELECT DISTINCT snapshot_id FROM feed) f LEFT JOIN states s ON s.snapshot_id = f.snapshot_id""",
        "delivery_ledger": by_time,
        "delivered_chunks": by_key,
        "delivery_outcome": f"""
            SELECT s.snapshot_id, count(l.batch_no) AS batches, CAST(coalesce(sum(sent), 0) AS BIGINT) AS sent,
                   coalesce(bool_and(ok), true) AS ok
            FROM (SELECT DISTINCT snapshot_id FROM feed) s
            LEFT JOIN ({by_time}) l ON l.snapshot_id = s.snapshot_id
            GROUP BY s.snapshot_id""",
        "publish_key_counts": """
            SELECT coalesce(nullif(icao24, ''), 'unknown') AS key, count(*) AS records FROM states GROUP BY 1""",
        "key_partitions": """
            SELECT coalesce(nullif(icao24, ''), 'unknown') AS key, count(*) AS records,
                   count(*) = 1 OR key != 'unknown' AS together
            FROM states GROUP BY 1""",
        "state_json": f"SELECT event_id, {_STATE} FROM states",
        "latest_state": _NEWEST,
        "stream_latest": _NEWEST,
        "country_enrichment": f"""
            SELECT event_id, origin_country, CAST(n_nationkey AS VARCHAR) AS country_code, r_name AS continent
            FROM states LEFT JOIN {_LISTED} ON origin_country = n_name""",
        "country_unmatched": """
            SELECT origin_country, count(*) AS states FROM states
            WHERE origin_country NOT IN (SELECT n_name FROM nation) GROUP BY 1""",
        "flight_tracks": f"""
            SELECT icao24, callsign, {_iso('min(last_contact)')} AS start_time,
                   {_iso('max(last_contact)')} AS end_time, count(*) AS points,
                   CAST(max(last_contact) - min(last_contact) AS DOUBLE) AS duration_seconds,
                   CAST(max(last_contact) - min(last_contact) AS DOUBLE) / 3600.0::DOUBLE AS duration_hours
            FROM points GROUP BY icao24, callsign""",
        "flight_track_segments": f"""
            SELECT icao24, callsign, segment, {_iso('first_seen')} AS start_time, {_iso('last_seen')} AS end_time,
                   points, CAST(last_seen - first_seen AS DOUBLE) AS duration_seconds
            FROM segments""",
        "track_paths": """
            SELECT icao24, callsign, segment, CAST(0 AS BIGINT) AS part, points,
                   CAST(points AS INTEGER) AS path_length, first_seen, last_seen,
                   first_latitude, last_longitude, true AS in_order
            FROM segments""",
        "track_geojson": f"""
            , numbered AS (
              SELECT *, row_number() OVER (PARTITION BY icao24, callsign, segment ORDER BY last_contact, event_id) - 1 AS number,
                     count(*) OVER track AS total, min(last_contact) OVER track AS first_seen, max(last_contact) OVER track AS last_seen
              FROM cut WINDOW track AS (PARTITION BY icao24, callsign, segment)
            ), placed AS (
              SELECT *, number // 5 AS part, number % 5 + CASE WHEN number >= 5 THEN 1 ELSE 0 END AS n FROM numbered
              UNION ALL SELECT *, number // 5 + 1, 0 FROM numbered WHERE number % 5 = 4 AND number + 1 < total
            )
            SELECT icao24, callsign, CAST(segment AS BIGINT) AS segment, part, CAST(ceil(total / 5) AS BIGINT) AS parts,
                   {_iso('first_seen')} AS start_time, {_iso('last_seen')} AS end_time,
                   CAST(last_seen - first_seen AS DOUBLE) AS duration_seconds, 'Feature' AS feature,
                   'LineString' AS geometry, CAST(n AS INTEGER) AS n, longitude, latitude, altitude
            FROM placed""",
        "incoming_rollup": """
            SELECT 'incoming_records' AS metric, 'events' AS source, period_start, value FROM incoming""",
        "stream_rollup": """
            SELECT 'incoming_records' AS metric, 'events' AS source, period_start, value FROM incoming
            WHERE period_start + 600 <= (SELECT epoch(max(ts)) - 3600 FROM events)""",
        "idle_alarm": "SELECT metric, source, period_start, value, CAST(breaches AS BIGINT) AS breaches FROM idle",
        "alert_messages": """
            SELECT '[ALERTA] stream-idle' || chr(10) || 'Status: '
                   || strftime(make_timestamp(period_start * 1000000), '%Y-%m-%dT%H:%M:%SZ') || chr(10)
                   || 'Descrição: no record has entered the stream for 10 minutes or more' || chr(10) || chr(10)
                   || 'Métrica: incoming_records = ' || CAST(CAST(value AS BIGINT) AS VARCHAR)
                   || ' (Limite: 1)' || chr(10) || 'Recurso: events' || chr(10) || 'Ação Recomendada: -' AS message
            FROM idle""",
        "feed_lag": """
            SELECT 'iterator_age_ms' AS metric, 'states' AS source, CAST(1706745600 AS BIGINT) AS period_start,
                   CAST((1706745600 - min(last_contact)) * 1000 AS DOUBLE) AS value
            FROM states""",
        "retention": """
            SELECT event_id, last_contact FROM states
            WHERE last_contact >= (SELECT max(last_contact) FROM states) - 48 * 3600""",
        "retained_table": """
            SELECT event_id, last_contact FROM states
            WHERE last_contact >= (SELECT max(last_contact) FROM states) - 48 * 3600""",
        "stream_deduplicated": """
            SELECT DISTINCT icao24, last_contact, CAST(1 AS BIGINT) AS records FROM states""",
        "stream_delivered": """
            SELECT key, CAST(CASE right(key, 1) WHEN 'a' THEN 3 WHEN 'f' THEN 4 ELSE 1 END AS INTEGER) AS attempt,
                   count(*) AS records, right(key, 1) != 'f' AS accepted
            FROM (SELECT coalesce(nullif(icao24, ''), 'unknown') AS key FROM states) GROUP BY key""",
        "replayed_errors": f"""
            SELECT event_id, CAST(least(event_id % 4 + 1, 3) AS INTEGER) AS attempt,
                   CASE WHEN event_id % 4 = 3 THEN 'ProcessingFailed' WHEN {_POSITIONED} THEN 'Ok' ELSE 'Dropped' END AS result,
                   CASE WHEN event_id % 4 != 3 AND {_POSITIONED} THEN icao24 END AS icao24
            FROM states WHERE event_id % 61 = 0""",
        "stream_tracks": """
            , told AS (
              SELECT *, last_contact // 14400 AS slice FROM cut
              WHERE last_contact < (SELECT max(last_contact) - 16 * 86400 FROM cut) // 14400 * 14400
            ), spans AS (
              SELECT icao24, callsign, segment, min(last_contact) AS started, max(last_contact) AS ended, count(DISTINCT slice) AS parts
              FROM told GROUP BY ALL HAVING max(last_contact) + 21600 < (SELECT (max(slice) + 1) * 14400 FROM told)
            ), pieces AS (
              SELECT icao24, callsign, segment, slice, count(*) AS points,
                     arg_min(struct_pack(x := longitude, z := altitude), (last_contact, event_id)) AS head,
                     arg_max(struct_pack(x := longitude, z := altitude, t := last_contact, y := latitude, g := on_ground), (last_contact, event_id)) AS tail
              FROM told GROUP BY ALL
            ), placed AS (
              SELECT *, row_number() OVER track - 1 AS part, lag(tail) OVER track AS before
              FROM pieces WINDOW track AS (PARTITION BY icao24, callsign, segment ORDER BY slice)
            )
            SELECT p.icao24, p.callsign, started, ended, part, parts, points,
                   CAST(points + CASE WHEN part > 0 THEN 1 ELSE 0 END AS INTEGER) AS path_length,
                   CASE WHEN part > 0 THEN before.x ELSE head.x END AS first_longitude,
                   CASE WHEN part > 0 THEN before.z ELSE head.z END AS first_altitude,
                   tail.t AS last_seen, tail.y AS last_latitude, tail.g AS on_ground
            FROM placed p JOIN spans s ON p.icao24 IS NOT DISTINCT FROM s.icao24
              AND p.callsign IS NOT DISTINCT FROM s.callsign AND p.segment = s.segment""",
        "stream_enriched": f"""
            SELECT {_ENRICHED}, true AS event_time FROM states WHERE {_RESULT} = 'Ok'""",
        "stream_errors": """
            SELECT event_id, '%%%' AS data, 'ProcessingFailed' AS reason FROM states WHERE event_id % 61 = 0""",
        "stream_published": f"""
            SELECT coalesce(nullif(icao24, ''), 'unknown') AS key, count(*) AS records,
                   {_iso('max(last_contact)')} AS newest
            FROM states GROUP BY 1""",
    }
    return {**plain, **{name: _with_feed(sql) for name, sql in over_feed.items()}}
