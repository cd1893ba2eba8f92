"""The checking SQL of each registered query: an independent formulation over the same tables.

Nothing here is shared with the library but the input expressions and the fixed values.
"""

from __future__ import annotations

import re

from skytally.constants import (
    AFFECTED_AIRLINES,
    AIRLINE_BY_PREFIX,
    AIRLINE_COLOURS,
    AIRPORTS,
    HALO_RGBA,
    OTHER_COLOUR,
    STATUS_COLOURS,
    STATUS_ICONS,
    ZONE_FILL,
    ZONES,
)
from skytally.plans.adapters import CONFLICT_EXPRESSIONS, DATE_ADDED, EPOCH, STATE_EXPRESSIONS
from skytally.plans.registry import AS_OF, DETAIL_REGION, HOURS, REPLAY_AT


def _literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return f"CAST({value!r} AS DOUBLE)" if isinstance(value, float) else str(value)


def _values(rows) -> str:
    return "VALUES " + ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in rows)


def _columns(expressions: dict[str, str]) -> str:
    return ", ".join(f"{text} AS {name}" for name, text in expressions.items())


def _km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"2 * 6371.0 * asin(least(1.0, sqrt(power(sin(radians({lat2} - {lat1}) / 2), 2)"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * power(sin(radians({lon2} - {lon1}) / 2), 2))))"
    )


def _case(column: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"WHEN {_literal(k)} THEN {_literal(v)}" for k, v in mapping.items())
    return f"CASE {column} {whens} ELSE {default} END"


def _nearest(source: str, lat: str, lon: str, key: str) -> str:
    """Every row with its nearest airport, by comparing it with all of them."""
    return (
        f"SELECT * EXCLUDE (rn, ap_lat, ap_lon, ord, code, km), round(km, 3) AS km,"
        f" CASE WHEN km > 150 THEN 'OTHER' ELSE code END AS nearest_region FROM ("
        f"SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY km, ord) AS rn FROM ("
        f"SELECT s.*, a.*, {_km(f's.{lat}', f's.{lon}', 'a.ap_lat', 'a.ap_lon')} AS km FROM {source} s CROSS JOIN airports a"
        f")) WHERE rn = 1"
    )


def _airline(callsign: str) -> str:
    prefix = f"regexp_extract(upper(trim(coalesce({callsign}, ''))), '^[A-Z]{{2,3}}')"
    return f"CASE WHEN {prefix} = '' THEN 'Unknown / private' ELSE {_case(prefix, AIRLINE_BY_PREFIX, _literal('Other'))} END"


ZONE = "CASE " + " ".join(
    f"WHEN latitude BETWEEN {south} AND {north} AND longitude BETWEEN {west} AND {east} THEN '{name}'"
    for name, south, north, west, east in ZONES
) + " END"

_SCORED = """
    SELECT region, bucket_sk, aircraft_count,
      CASE WHEN n >= 12 THEN m END AS rolling_mean, CASE WHEN n >= 12 THEN s END AS rolling_std, n AS baseline_n, z AS z_score,
      CASE WHEN z IS NULL THEN 'insufficient_baseline' WHEN az < 1.5 THEN 'normal' WHEN az < 2.5 THEN 'warning'
        WHEN az < 3.5 THEN 'serious' ELSE 'critical' END AS anomaly_status,
      CASE WHEN az >= 1.5 AND z > 0 THEN 'spike' WHEN az >= 1.5 AND z < 0 THEN 'drop' END AS anomaly_direction
    FROM (SELECT *, round(abs(z), 9) AS az FROM (
      SELECT *, CASE WHEN n >= 12 THEN (aircraft_count - m) / greatest(s, 1.0) END AS z FROM (
        SELECT *, count(*) OVER w AS n, avg(aircraft_count) OVER w AS m, stddev_samp(aircraft_count) OVER w AS s
        FROM {source}
        WINDOW w AS (PARTITION BY region ORDER BY bucket_sk ROWS BETWEEN 288 PRECEDING AND 1 PRECEDING))))
"""


def _hourly(source: str) -> str:
    return (
        f"SELECT nearest_region AS region, date_trunc('hour', poll_ts) AS bucket_sk,"
        f" count(DISTINCT icao24) AS aircraft_count FROM {source} GROUP BY 1, 2"
    )


# Named building blocks; each query takes along those it mentions, and those they mention.
BLOCKS = {
    "airports": "SELECT * FROM (" + _values([(i, *a) for i, a in enumerate(AIRPORTS)]) + ") t(ord, code, ap_lat, ap_lon)",
    "records_v": f"SELECT {_columns(STATE_EXPRESSIONS)}, {EPOCH['check']} AS poll_timestamp, date_trunc('second', ts) AS poll_ts FROM events",
    "responses_v": "SELECT DISTINCT hour, event_id % CAST(ceil(n / 500) AS BIGINT) AS response"
    " FROM (SELECT event_id, poll_timestamp // 3600 AS hour, count(*) OVER (PARTITION BY poll_timestamp // 3600) AS n FROM records_v)",
    "bronze_v": "SELECT * REPLACE (nullif(trim(callsign), '') AS callsign) FROM records_v WHERE icao24 IS NOT NULL",
    "placed_v": "SELECT * FROM records_v WHERE latitude IS NOT NULL AND longitude IS NOT NULL",
    "placed_bronze_v": "SELECT * FROM bronze_v WHERE latitude IS NOT NULL AND longitude IS NOT NULL",
    "near_v": _nearest("placed_v", "latitude", "longitude", "event_id"),
    "silver_v": f"SELECT *, {_airline('callsign')} AS airline, {ZONE} AS zone FROM ("
    + _nearest("placed_bronze_v", "latitude", "longitude", "event_id") + ")",
    "hourly_v": _hourly("near_v"),
    "scored_v": _SCORED.format(source="hourly_v"),
    "silver_hourly_v": _hourly("silver_v"),
    "silver_scored_v": _SCORED.format(source="silver_hourly_v"),
    "status_v": "SELECT region, bucket_sk, anomaly_status FROM ("
    "SELECT *, row_number() OVER (PARTITION BY region ORDER BY bucket_sk DESC) AS rn FROM scored_v) WHERE rn = 1",
    "current_v": f"SELECT * FROM status_v WHERE region <> '{DETAIL_REGION}'",
    "raw_v": f"SELECT event_id, {_columns(CONFLICT_EXPRESSIONS)}, {DATE_ADDED['check']} AS DATEADDED FROM events",
    "box_v": "SELECT *, try_cast(ActionGeo_Lat AS DOUBLE) AS lat, try_cast(ActionGeo_Long AS DOUBLE) AS lon FROM raw_v"
    " WHERE try_cast(ActionGeo_Lat AS DOUBLE) BETWEEN 12.0 AND 37.5 AND try_cast(ActionGeo_Long AS DOUBLE) BETWEEN 31.0 AND 63.3",
    "class_v": "SELECT * FROM box_v WHERE try_cast(QuadClass AS DOUBLE) >= 3",
    "conflicts_v": "SELECT GLOBALEVENTID AS global_event_id, CAST(try_strptime(DATEADDED, '%Y%m%d%H%M%S') AS TIMESTAMP) AS event_timestamp,"
    " nullif(Actor1Name, '') AS actor1_name, nullif(Actor2Name, '') AS actor2_name, EventCode AS event_code,"
    " CAST(QuadClass AS INTEGER) AS quad_class, try_cast(GoldsteinScale AS DOUBLE) AS goldstein_scale,"
    " try_cast(NumMentions AS DOUBLE) AS num_mentions, try_cast(NumSources AS DOUBLE) AS num_sources,"
    " try_cast(NumArticles AS DOUBLE) AS num_articles, lat AS action_geo_lat, lon AS action_geo_long,"
    " ActionGeo_CountryCode AS action_geo_country_code, SOURCEURL AS source_url, nearest_region FROM ("
    + _nearest("class_v", "lat", "lon", "event_id") + ")",
    "since_v": f"SELECT * FROM conflicts_v WHERE event_timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL {HOURS} HOUR",
    "detail_events_v": f"SELECT * FROM since_v WHERE nearest_region = '{DETAIL_REGION}'",
    "detail_v": f"SELECT * FROM scored_v WHERE region = '{DETAIL_REGION}' AND bucket_sk >= TIMESTAMP '{AS_OF}' - INTERVAL {HOURS} HOUR",
    "stored_v": "SELECT region, bucket_sk, aircraft_count + 2 AS aircraft_count FROM hourly_v WHERE bucket_sk < TIMESTAMP '2024-01-21'",
    "new_v": "SELECT * FROM hourly_v WHERE bucket_sk >= TIMESTAMP '2024-01-20'",
    "merged_v": "SELECT * FROM new_v UNION ALL SELECT * FROM stored_v WHERE bucket_sk < TIMESTAMP '2024-01-20'"
    " UNION ALL SELECT * FROM stored_v s WHERE bucket_sk >= TIMESTAMP '2024-01-20'"
    " AND NOT EXISTS (SELECT 1 FROM new_v n WHERE n.region = s.region AND n.bucket_sk = s.bucket_sk)",
    "merged_scored_v": _SCORED.format(source="merged_v"),
    "slots_v": "SELECT DISTINCT strftime(time_bucket(INTERVAL '15 minutes', ts), '%Y%m%d%H%M%S') AS slot FROM events",
    "urls_v": "SELECT 'http://example.org/v2/' || slot || '.export.CSV.zip' AS url, slot || '.export.CSV.zip' AS file_name FROM slots_v",
}


def _needed(body: str) -> list[str]:
    """Blocks a text depends on, each after what it depends on itself."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in BLOCKS:
            if name not in ordered and re.search(rf"\b{name}\b", text):
                visit(BLOCKS[name])
                ordered.append(name)

    visit(body)
    return ordered


def _sql(body: str) -> str:
    blocks = _needed(body)
    if not blocks:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({BLOCKS[name]})" for name in blocks) + "\n" + body


def _r(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


_RECORD = (
    "icao24, callsign, origin_country, "
    + _r("longitude", "latitude", "baro_altitude")
    + ", on_ground, "
    + _r("velocity", "true_track", "vertical_rate", "geo_altitude")
    + ", poll_timestamp"
)
_STATES = (
    "icao24, callsign, airline, origin_country, "
    + _r("longitude", "latitude", "baro_altitude", "velocity", "true_track", "vertical_rate")
    + ", on_ground, poll_timestamp, nearest_region"
)
_TRAFFIC = (
    "region, bucket_sk, aircraft_count, "
    + _r("rolling_mean", "rolling_std", "z_score")
    + ", baseline_n, anomaly_status, anomaly_direction"
)
_EVENTS = (
    "global_event_id, event_timestamp, actor1_name, actor2_name, event_code, quad_class, "
    + _r("goldstein_scale", "num_mentions", "num_sources", "num_articles", "action_geo_lat", "action_geo_long")
    + ", action_geo_country_code, source_url, nearest_region"
)


def _decimal(name: str) -> str:
    return f"CAST(CAST(CAST(round(CAST({name} AS DOUBLE), 6) AS VARCHAR) AS DECIMAL(38,18)) AS VARCHAR) AS {name}"


_BUCKET_ITEM = "'BUCKET#' || strftime(bucket_sk, '%Y-%m-%dT%H:%M:%S') || '+00:00'"
_TRAFFIC_ITEM = (
    f"'REGION#' || region AS region_pk, {_BUCKET_ITEM} AS bucket_sk, "
    + ", ".join(_decimal(n) for n in ("aircraft_count", "rolling_mean", "rolling_std", "z_score", "baseline_n"))
    + ", anomaly_status, anomaly_direction,"
    " CASE WHEN anomaly_status IN ('warning', 'serious', 'critical') THEN 'STATUS#' || anomaly_status END AS status_gsi_pk"
)
_HISTORY = "bucket_sk, aircraft_count, " + _r("rolling_mean") + ", anomaly_status"
_SEVERITY = (
    "CASE anomaly_status WHEN 'critical' THEN 0 WHEN 'serious' THEN 1 WHEN 'warning' THEN 2 WHEN 'normal' THEN 3"
    " WHEN 'insufficient_baseline' THEN 4 ELSE 5 END"
)


def _count(column: str, out: str = "aircraft", source: str = "silver_v") -> str:
    return f"SELECT {column}, count(*) AS {out} FROM {source} WHERE {column} IS NOT NULL GROUP BY {column}"


def _rgba(column: str, mapping: dict, default: list | None, names=("red", "green", "blue", "alpha")) -> str:
    parts = []
    for i, name in enumerate(names):
        otherwise = "NULL" if default is None else str(default[i])
        parts.append(f"{_case(column, {k: v[i] for k, v in mapping.items()}, otherwise)} AS {name}")
    return ", ".join(parts)


def _rgb(colour: str) -> list[int]:
    return [int(colour[i : i + 2], 16) for i in (1, 3, 5)]


_GREY = _rgb(OTHER_COLOUR)
_ALL_RGBA = {name: [*_rgb(colour), 255] for name, colour in AIRLINE_COLOURS.items()}
_MAP_RGBA = dict(list(_ALL_RGBA.items())[:3])
_CORRIDOR_RGBA = {name: [*rgba[:3], 90] for name, rgba in _MAP_RGBA.items()}


def _correlation(directions: str, minutes: int) -> str:
    within = f"INTERVAL {minutes} MINUTE"
    return f"""
    SELECT s.region, s.bucket_sk, s.aircraft_count, round(s.z_score, 6) AS z_score, s.anomaly_status,
      count(e.global_event_id) AS event_count,
      coalesce(sum(CASE WHEN e.global_event_id IS NOT NULL THEN coalesce(e.num_mentions, 1) END), 0) AS event_mentions,
      min(e.goldstein_scale) AS min_goldstein,
      first(e.global_event_id ORDER BY coalesce(e.num_mentions, 1) DESC, e.global_event_id DESC) FILTER (e.global_event_id IS NOT NULL) AS top_event_id
    FROM scored_v s LEFT JOIN conflicts_v e
      ON e.nearest_region = s.region AND e.event_timestamp BETWEEN s.bucket_sk - {within} AND s.bucket_sk + {within}
    WHERE s.anomaly_direction IN ({directions})
    GROUP BY ALL
    """


def _detour(rate: int) -> str:
    affected = ", ".join(map(_literal, AFFECTED_AIRLINES))
    return f"""
    SELECT n AS affected_flights, CAST(round_even(n * 0.75 * {rate}, 0) AS BIGINT) AS low_usd,
      CAST(round_even(n * 2.0 * {rate}, 0) AS BIGINT) AS high_usd, {rate} AS per_hour_usd
    FROM (SELECT count(*) AS n FROM silver_v WHERE airline IN ({affected}))
    """


_CHECKPOINTS = """
    SELECT 's' || CAST(user_id % 50 AS VARCHAR) AS source, event_type AS shard, max(event_id) AS position
    FROM events WHERE {condition} GROUP BY 1, 2
"""

_BODIES = {
    "flatten_states": f"SELECT {_RECORD} FROM bronze_v",
    "read_polls": f"SELECT {_RECORD[: -len('poll_timestamp')]} poll_timestamp - poll_timestamp % 3600 AS poll_timestamp FROM bronze_v",
    "scan_polls": f"SELECT {_RECORD[: -len('poll_timestamp')]} poll_timestamp - poll_timestamp % 3600 AS poll_timestamp FROM bronze_v",
    "quarantined_records": """
        SELECT reason, count(*) AS n FROM (
          SELECT unnest([CASE WHEN off THEN 'position' WHEN far THEN 'time' END, CASE WHEN placed THEN 'cleaned' END,
            CASE WHEN placed AND NOT far THEN 'bucketed' END]) AS reason
          FROM (SELECT far, NOT (latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180) AS off,
              latitude IS NOT NULL AND longitude IS NOT NULL AS placed
            FROM (SELECT longitude, CASE event_id % 50 WHEN 1 THEN CAST(1e300 AS DOUBLE) WHEN 2 THEN CAST('Infinity' AS DOUBLE)
              WHEN 3 THEN CAST(91 AS DOUBLE) ELSE latitude END AS latitude, event_id % 50 = 4 AS far FROM records_v))
          UNION ALL SELECT 'malformed' FROM responses_v WHERE hour % 10 = 0)
        WHERE reason IS NOT NULL GROUP BY reason""",
    "gold_events": f"SELECT {_EVENTS} FROM (SELECT * REPLACE (num_mentions"
    " + CASE WHEN CAST(global_event_id AS BIGINT) % 2 = 0 THEN 0 ELSE 1 END AS num_mentions) FROM conflicts_v)",
    "pipeline_summary": """
        SELECT CAST(0 AS INTEGER) AS run, 'polls' AS layer, count(*) + count(*) FILTER (hour % 10 = 0) AS n FROM responses_v
        UNION ALL SELECT 0, 'malformed_polls', count(*) FROM responses_v WHERE hour % 10 = 0
        UNION ALL SELECT 0, 'records', count(*) FROM bronze_v
        UNION ALL SELECT 0, 'states', count(*) FROM placed_bronze_v
        UNION ALL SELECT 0, 'traffic_items', count(*) FROM silver_hourly_v
        UNION ALL SELECT 1, 'polls', 0 UNION ALL SELECT 1, 'records', 0 UNION ALL SELECT 1, 'states', 0
        UNION ALL SELECT 1, 'manifest traffic', 1""",
    "keyed_messages": f"SELECT {_RECORD} FROM bronze_v",
    "bronze_records": f"SELECT {_RECORD}, CAST(poll_ts AS DATE) AS dt FROM bronze_v",
    "export_events": f"SELECT {_EVENTS} FROM conflicts_v",
    "stored_exports": f"SELECT {_EVENTS} FROM conflicts_v",
    "newest_file_states": f"SELECT {_STATES}, 'cached' AS freshness FROM silver_v"
    " WHERE poll_timestamp // 3600 = (SELECT max(poll_timestamp // 3600) FROM bronze_v)",
    "latest_snapshot": f"SELECT {_STATES} FROM silver_v WHERE date_trunc('hour', poll_ts) = (SELECT max(date_trunc('hour', poll_ts)) FROM silver_v)",
    "region_history": f"SELECT {_HISTORY} FROM detail_v",
    "events_by_region_since": f"SELECT {_EVENTS} FROM detail_events_v",
    "alerts_by_status": f"SELECT {_TRAFFIC} FROM scored_v WHERE anomaly_status = 'warning'",
    "export_urls": "SELECT url, file_name FROM urls_v",
    "latest_export_url": "SELECT max(url) AS url FROM urls_v",
    "unprocessed_files": "SELECT url, file_name FROM urls_v WHERE file_name >= '20240120'",
    "merge_checkpoints": f"""
        SELECT coalesce(n.source, o.source) AS source, coalesce(n.shard, o.shard) AS shard,
          CAST(coalesce(n.position, o.position) AS VARCHAR) AS position
        FROM ({_CHECKPOINTS.format(condition=f"ts < TIMESTAMP '{REPLAY_AT}'")}) o
        FULL JOIN ({_CHECKPOINTS.format(condition=f"ts >= TIMESTAMP '{REPLAY_AT}'")}) n
          ON n.source = o.source AND n.shard = o.shard""",
    "stored_etag": "SELECT event_type || '-' || CAST(event_id AS VARCHAR) AS source_etag FROM events"
    " WHERE user_id % 50 = 7 ORDER BY event_id DESC LIMIT 1",
    "expired_partitions": f"SELECT DISTINCT CAST(ts AS DATE) AS dt FROM events WHERE CAST(ts AS DATE) < CAST(TIMESTAMP '{AS_OF}' AS DATE) - 10",
    "clean_states": f"SELECT {_STATES} FROM silver_v",
    "nearest_region": "SELECT event_id, nearest_region, CASE WHEN km <= 150 THEN km END AS km FROM near_v",
    "nearest_of_many": f"""
        SELECT event_id, CASE WHEN km <= 30 THEN code ELSE 'OTHER' END AS point, CASE WHEN km <= 30 THEN round(km, 3) END AS km FROM (
          SELECT event_id, code, km, row_number() OVER (PARTITION BY event_id ORDER BY km, n) AS rn FROM (
            SELECT s.event_id, p.code, p.n, {_km('s.latitude', 's.longitude', 'p.lat', 'p.lon')} AS km
            FROM placed_v s JOIN (
              SELECT n, 'P' || CAST(n AS VARCHAR) AS code, CAST(11.0 AS DOUBLE) + (n // 40) * CAST(1.1 AS DOUBLE) AS lat,
                CAST(30.0 AS DOUBLE) + (n % 40) * CAST(0.9 AS DOUBLE) AS lon FROM range(1000) t(n)) p
            ON abs(s.latitude - p.lat) < 2 AND abs(s.longitude - p.lon) < 2)) WHERE rn = 1""",
    "haversine": f"SELECT event_id, round({_km('latitude', 'longitude', str(AIRPORTS[0][1]), str(AIRPORTS[0][2]))}, 6) AS km FROM records_v",
    "resolve_airline": f"SELECT event_id, {_airline('callsign')} AS airline FROM records_v",
    "zone_for_point": f"SELECT event_id, {ZONE} AS zone FROM records_v",
    "events_in_bbox": f"SELECT GLOBALEVENTID AS global_event_id, {_r('lat', 'lon')} FROM box_v",
    "clean_events": f"SELECT {_EVENTS} FROM conflicts_v",
    "filter_airlines": "SELECT airline, count(*) AS aircraft FROM silver_v WHERE airline IN ('Emirates', 'Saudia') GROUP BY airline",
    "traffic_by_bucket": "SELECT nearest_region AS region, time_bucket(INTERVAL '5 minutes', poll_ts) AS bucket_sk,"
    " count(DISTINCT icao24) AS aircraft_count FROM near_v GROUP BY 1, 2",
    "rolling_baseline": f"SELECT region, bucket_sk, aircraft_count, {_r('rolling_mean', 'rolling_std')}, baseline_n FROM scored_v",
    "anomaly_score": f"SELECT {_TRAFFIC} FROM scored_v",
    "anomaly_score_dense": f"WITH dense AS (SELECT event_type AS region, time_bucket(INTERVAL '5 minutes', ts) AS bucket_sk,"
    f" count(DISTINCT user_id) AS aircraft_count FROM events GROUP BY 1, 2), dense_scored AS ({_SCORED.format(source='dense')})"
    f" SELECT {_TRAFFIC} FROM dense_scored",
    "latest_status": "SELECT region, anomaly_status, bucket_sk FROM status_v",
    "status_as_of": f"""
        SELECT a.code AS region, coalesce(s.anomaly_status, 'insufficient_baseline') AS anomaly_status FROM airports a LEFT JOIN (
          SELECT region, arg_max(anomaly_status, bucket_sk) AS anomaly_status FROM scored_v
          WHERE bucket_sk <= TIMESTAMP '{REPLAY_AT}' GROUP BY region) s ON s.region = a.code""",
    "recent_history": f"""
        SELECT region, bucket_sk, aircraft_count FROM (
          SELECT *, row_number() OVER (PARTITION BY region ORDER BY bucket_sk DESC) AS rn FROM hourly_v
          WHERE region IN (SELECT region FROM hourly_v WHERE bucket_sk >= TIMESTAMP '{AS_OF}')) WHERE rn <= 48""",
    "new_scored_rows": f"SELECT {_TRAFFIC} FROM scored_v WHERE bucket_sk >= TIMESTAMP '{AS_OF}' - INTERVAL {HOURS} HOUR",
    "merge_history": "SELECT region, bucket_sk, aircraft_count FROM merged_v",
    "upsert_traffic": "SELECT region, bucket_sk, aircraft_count FROM merged_v",
    "incremental_score": f"SELECT {_TRAFFIC} FROM merged_scored_v m WHERE EXISTS ("
    "SELECT 1 FROM new_v n WHERE n.region = m.region AND n.bucket_sk = m.bucket_sk)",
    "upsert_events": f"SELECT {_EVENTS} FROM (SELECT * REPLACE (CASE WHEN quad_class = 4"
    " THEN num_mentions + 1000 ELSE num_mentions END AS num_mentions) FROM conflicts_v)",
    "drop_event_correlation": _correlation("'drop'", 60),
    "anomaly_event_correlation": _correlation("'drop', 'spike'", 150),
    "serving_traffic": f"SELECT {_TRAFFIC_ITEM} FROM scored_v",
    "serving_traffic_json": f"""
        SELECT *, 5 + CAST(rolling_mean IS NOT NULL AS INTEGER) + CAST(rolling_std IS NOT NULL AS INTEGER)
          + CAST(z_score IS NOT NULL AS INTEGER) + CAST(anomaly_direction IS NOT NULL AS INTEGER)
          + CAST(status_gsi_pk IS NOT NULL AS INTEGER) AS attributes
        FROM (SELECT {_TRAFFIC_ITEM} FROM scored_v)""",
    "serving_events": f"""
        SELECT 'EVENT#' || global_event_id AS event_pk, 'REGION#' || nearest_region AS region_gsi_pk,
          strftime(event_timestamp, '%Y-%m-%dT%H:%M:%SZ') AS event_timestamp,
          {', '.join(_decimal(n) for n in ('action_geo_lat', 'action_geo_long', 'quad_class', 'goldstein_scale', 'num_mentions', 'num_sources', 'num_articles'))},
          actor1_name, actor2_name, event_code, source_url FROM conflicts_v""",
    "decode_history": f"SELECT region, bucket_sk, aircraft_count, {_r('rolling_mean')}, anomaly_status FROM scored_v",
    "load_serving": f"SELECT region, bucket_sk, aircraft_count, {_r('rolling_mean')}, anomaly_status FROM scored_v",
    "baseline_series": f"SELECT {_HISTORY} FROM scored_v WHERE region = '{DETAIL_REGION}' AND rolling_mean IS NOT NULL"
    f" AND bucket_sk >= TIMESTAMP '{AS_OF}' - INTERVAL {10 * HOURS} HOUR",
    "recent_critical": f"""
        SELECT 'REGION#' || region AS region_pk, {_BUCKET_ITEM} AS bucket_sk, {_decimal('aircraft_count')}, {_decimal('z_score')},
          anomaly_direction FROM scored_v WHERE anomaly_status = 'critical' ORDER BY scored_v.bucket_sk DESC, region LIMIT 50""",
    "count_by_region": _count("nearest_region"),
    "count_by_airline": _count("airline"),
    "airline_list": "SELECT DISTINCT airline FROM silver_v",
    "kpi_summary": "SELECT count(*) AS aircraft, CAST(count(DISTINCT airline) AS INTEGER) AS airlines,"
    f" (SELECT nearest_region FROM ({_count('nearest_region')}) ORDER BY aircraft DESC, nearest_region LIMIT 1) AS busiest_region FROM silver_v",
    "top_regions": _count("nearest_region") + " ORDER BY aircraft DESC, nearest_region LIMIT 5",
    "top_airlines": f"SELECT airline, aircraft, {_case('airline', AIRLINE_COLOURS, _literal(OTHER_COLOUR))} AS colour,"
    f" round(aircraft / sum(aircraft) OVER (), 6) AS share FROM ({_count('airline')} ORDER BY aircraft DESC, airline LIMIT 6)",
    "top_airlines_bar": f"""
        SELECT airline, aircraft, rank, CASE WHEN rank <= 3 THEN CAST(aircraft AS VARCHAR) ELSE '' END AS label,
          {_case('airline', AIRLINE_COLOURS, _literal(OTHER_COLOUR))} AS colour
        FROM (SELECT *, CAST(rank() OVER (ORDER BY aircraft DESC) AS INTEGER) AS rank FROM ({_count('airline')}))
        ORDER BY aircraft DESC, airline DESC LIMIT 8""",
    "ranked_labels": f"""
        SELECT nearest_region, aircraft, rank, CASE WHEN aircraft >= cutoff THEN CAST(aircraft AS VARCHAR) ELSE '' END AS label
        FROM (SELECT *, CAST(rank() OVER (ORDER BY aircraft DESC) AS INTEGER) AS rank,
          nth_value(aircraft, 3) OVER (ORDER BY aircraft DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS cutoff
          FROM ({_count('nearest_region')}))""",
    "alert_count": "SELECT count(*) AS alerts FROM current_v WHERE anomaly_status IN ('warning', 'serious', 'critical')",
    "status_counts": f"SELECT anomaly_status, count(*) AS regions, {_SEVERITY} AS severity FROM current_v GROUP BY anomaly_status",
    "alert_board": f"SELECT region, anomaly_status, {_SEVERITY} AS severity,"
    f" {_case('anomaly_status', STATUS_COLOURS, _literal(OTHER_COLOUR))} AS colour, {_case('anomaly_status', STATUS_ICONS, _literal('•'))} AS icon FROM current_v",
    "zone_counts": _count("zone"),
    "zone_total": "SELECT count(zone) AS aircraft, round(count(zone) / count(*), 6) AS share FROM silver_v",
    "altitude_speed": "SELECT round(avg(baro_altitude) * 3.28084, 6) AS altitude_ft, round(avg(velocity) * 1.94384, 6) AS speed_kt FROM silver_v",
    "altitude_bands": """
        SELECT position, band, (SELECT count(*) FROM silver_v WHERE baro_altitude > low AND baro_altitude <= high) AS aircraft
        FROM (VALUES (0, '<10k ft', -1, 3000), (1, '10-30k ft', 3000, 9000), (2, '>30k ft', 9000, 100000)) t(position, band, low, high)""",
    "detour_cost": _detour(5000),
    "detour_cost_full": _detour(6000),
    "event_counts": f"SELECT nearest_region, events, (SELECT count(*) FROM since_v) AS total_events"
    f" FROM ({_count('nearest_region', 'events', 'since_v')} ORDER BY events DESC, nearest_region LIMIT 5)",
    "events_all_regions": f"SELECT {_EVENTS} FROM conflicts_v WHERE event_timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR",
    "recent_events": f"SELECT global_event_id, event_timestamp, nearest_region, actor1_name, actor2_name, event_code, {_r('num_mentions', 'goldstein_scale')}, source_url FROM conflicts_v",
    "top_events": """
        SELECT global_event_id, event_timestamp, actor1_name, actor2_name, event_code, m AS num_mentions, g AS goldstein_scale, source_url,
          round(least(m, 50) / 3 + 8, 6) AS marker_size, CASE WHEN g < -7 THEN '#d03b3b' ELSE '#ec835a' END AS marker_colour,
          (SELECT count(*) FROM detail_events_v) AS total_events
        FROM (SELECT *, coalesce(num_mentions, 1) AS m, coalesce(goldstein_scale, 0) AS g FROM detail_events_v)
        ORDER BY m DESC, global_event_id LIMIT 8""",
    "trend_overlay": """
        SELECT global_event_id, round(least(m, 50) / 3 + 8, 6) AS marker_size, CASE WHEN g < -7 THEN '#d03b3b' ELSE '#ec835a' END AS marker_colour,
          (SELECT round(coalesce(max(aircraft_count) * CAST(1.1 AS DOUBLE), 1), 6) FROM detail_v) AS y
        FROM (SELECT *, coalesce(num_mentions, 1) AS m, coalesce(goldstein_scale, 0) AS g FROM detail_events_v)
        ORDER BY m DESC, global_event_id LIMIT 8""",
    "region_detail": """
        SELECT arg_max(aircraft_count, bucket_sk) AS latest_count, round(avg(aircraft_count), 6) AS mean_count, count(*) AS buckets,
          round(arg_max(aircraft_count, bucket_sk) - avg(aircraft_count), 6) AS delta FROM detail_v""",
    "map_points": f"SELECT icao24, poll_timestamp, {_r('longitude', 'latitude')}, coalesce(true_track, 0) AS angle, {_rgba('airline', _MAP_RGBA, [*_GREY, 255])} FROM silver_v",
    "colour_rgba": f"SELECT airline, aircraft, {_rgba('airline', _ALL_RGBA, [*_GREY, 255])} FROM ({_count('airline')})",
    "zone_polygons": "SELECT z.zone, polygon, red, green, blue, alpha, (SELECT count(*) FROM silver_v s WHERE s.zone = z.zone) AS aircraft FROM ("
    + _values([
        (name, f"{west} {south}, {east} {south}, {east} {north}, {west} {north}", *ZONE_FILL[name])
        for name, south, north, west, east in ZONES
    ])
    + ") z(zone, polygon, red, green, blue, alpha)",
    "airport_halos": f"""
        SELECT region, latitude, longitude, anomaly_status, {_rgba('anomaly_status', HALO_RGBA, None)} FROM (
          SELECT a.code AS region, ap_lat AS latitude, ap_lon AS longitude, coalesce(c.anomaly_status, 'insufficient_baseline') AS anomaly_status
          FROM airports a LEFT JOIN current_v c ON c.region = a.code)""",
    "corridors": f"SELECT icao24, poll_timestamp, {_r('longitude', 'latitude')}, nearest_region, ap_lon AS target_longitude, ap_lat AS target_latitude,"
    f" {_rgba('airline', _CORRIDOR_RGBA, [*_GREY, 90])} FROM silver_v JOIN airports ON code = nearest_region",
    "bronze_to_silver": f"SELECT nearest_region, states, events FROM ({_count('nearest_region', 'states')})"
    f" FULL JOIN ({_count('nearest_region', 'events', 'conflicts_v')}) USING (nearest_region)",
    "silver_to_gold": f"SELECT {_TRAFFIC} FROM silver_scored_v",
    "stream_clean_states": f"SELECT {_STATES} FROM silver_v",
    "stream_traffic_by_bucket": "SELECT nearest_region AS region, time_bucket(INTERVAL '5 minutes', poll_ts) AS bucket_sk,"
    " count(DISTINCT icao24) AS aircraft_count FROM near_v GROUP BY 1, 2",
    "stream_anomaly_score": f"SELECT {_TRAFFIC} FROM scored_v",
    "stream_late_scores": f"SELECT {_TRAFFIC} FROM scored_v",
    "stream_late_traffic": "SELECT nearest_region AS region, time_bucket(INTERVAL '5 minutes', poll_ts) AS bucket_sk,"
    " count(DISTINCT icao24) AS aircraft_count FROM near_v GROUP BY 1, 2",
    "stream_event_correlation": _correlation("'drop'", 60),
}

ORACLES = {name: _sql(body) for name, body in _BODIES.items()}
