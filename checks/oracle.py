"""SQL counterparts of the registered queries, for an engine that shares no code with the library."""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-30 23:59:59'"
TODAY = "DATE '2024-01-30'"
LONG_AS_OF = "DATE '2001-08-01'"


def r(expression: str, name: str, digits: int = 6) -> str:
    """A double rounded half up in decimal, past the digits that depend on the order of addition."""
    return f"CAST(round(CAST(CAST({expression} AS DOUBLE) AS DECIMAL(38, 9)), {digits}) AS DOUBLE) AS {name}"


def rs(*pairs: tuple[str, str] | str) -> str:
    return ", ".join(r(p, p) if isinstance(p, str) else r(*p) for p in pairs)


# --- input frames as common table expressions -----------------------------------------------

EV = """
ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
)"""

PM25_AQI = """CAST(trunc(CASE
    WHEN {x} <= 12e0 THEN (50e0 / 12e0) * {x}
    WHEN {x} <= 35.4e0 THEN 50e0 + (50e0 / (35.4e0 - 12e0)) * ({x} - 12e0)
    WHEN {x} <= 55.4e0 THEN 100e0 + (50e0 / (55.4e0 - 35.4e0)) * ({x} - 35.4e0)
    ELSE 150e0 + (50e0 / (150.4e0 - 55.4e0)) * ({x} - 55.4e0) END) AS INTEGER)"""


def aqi_label(x: str) -> str:
    return (
        f"CASE WHEN {x} <= 50 THEN 'Good' WHEN {x} <= 100 THEN 'Moderate' "
        f"WHEN {x} <= 150 THEN 'Unhealthy for Sensitive Groups' WHEN {x} <= 200 THEN 'Unhealthy' "
        "ELSE 'Very Unhealthy' END"
    )


AIR = f"""{EV},
air0 AS (
  SELECT event_id, 'AQ_' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS sensor_id,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS reading_timestamp,
         ts AS reading_datetime, 'air_quality' AS sensor_type,
         CASE user_id % 5 WHEN 0 THEN 40.7128e0 WHEN 1 THEN 40.7589e0 WHEN 2 THEN 40.7831e0
              WHEN 3 THEN 40.6782e0 ELSE 40.7489e0 END AS latitude,
         CASE user_id % 5 WHEN 0 THEN -74.0060e0 WHEN 1 THEN -73.9851e0 WHEN 2 THEN -73.9712e0
              WHEN 3 THEN -73.9442e0 ELSE -73.9680e0 END AS longitude,
         CASE user_id % 5 WHEN 0 THEN 'downtown' WHEN 1 THEN 'midtown' WHEN 2 THEN 'uptown'
              WHEN 3 THEN 'industrial' ELSE 'residential' END AS zone,
         'New_York' AS city, 'USA' AS country,
         value AS pm25, value * 1.4e0 AS pm10, 400e0 + k AS co2, 10e0 + 0.3e0 * k AS no2,
         20e0 + 0.4e0 * k AS o3, 0.5e0 * k - 5e0 AS temperature_celsius, 30e0 + 0.5e0 * k AS humidity_percent,
         1003e0 + 0.2e0 * k AS pressure_hpa,
         {PM25_AQI.format(x="value")} AS aqi_value,
         CASE WHEN event_id % 20 = 7 THEN 'maintenance' ELSE 'active' END AS device_status,
         k AS battery_level, -30 - (k % 50) AS signal_strength_dbm,
         '2.1.' || CAST(k % 5 AS VARCHAR) AS firmware_version,
         DATE '2024-01-10' AS calibration_date, 'synthetic_iot' AS data_source
  FROM ev
),
air AS (
  SELECT *, {aqi_label("aqi_value")} AS aqi_category,
         CAST(year(reading_datetime) AS INTEGER) AS year, CAST(month(reading_datetime) AS INTEGER) AS month,
         CAST(day(reading_datetime) AS INTEGER) AS day, CAST(reading_datetime AS DATE) AS date,
         CAST(hour(reading_datetime) AS INTEGER) AS hour,
         CAST(date_trunc('hour', reading_datetime) AS TIMESTAMP) AS hour_timestamp
  FROM air0
),
spoiled AS (
  SELECT * REPLACE (
    CASE event_id % 50 WHEN 0 THEN NULL WHEN 1 THEN -1e0 WHEN 2 THEN 999e0 ELSE pm25 END AS pm25,
    CASE event_id % 50 WHEN 3 THEN 75e0 ELSE temperature_celsius END AS temperature_celsius,
    CASE event_id % 50 WHEN 4 THEN 95e0 ELSE latitude END AS latitude,
    CASE event_id % 50 WHEN 5 THEN NULL ELSE sensor_id END AS sensor_id)
  FROM air
)"""

RULES = {
    "pm25": "coalesce(pm25 >= 0 AND pm25 < 500, FALSE)",
    "temperature": "coalesce(temperature_celsius BETWEEN -50 AND 60, FALSE)",
    "coordinates": "coalesce(latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180, FALSE)",
    "sensor_id": "sensor_id IS NOT NULL",
}
VALID = " AND ".join(f"({x})" for x in RULES.values())


def change_feed(first: str, bad_update: str) -> str:
    """All versions of all events, and the newest insert or update per reading."""
    return f"""{AIR},
feed AS (
  SELECT *, CASE WHEN event_id % 20 = 9 THEN 'REMOVE' ELSE 'INSERT' END AS kind, event_id + 1 AS seq FROM {first}
  UNION ALL BY NAME
  SELECT * REPLACE ({bad_update} AS pm25), 'MODIFY' AS kind, event_id + 100000001 AS seq
  FROM air WHERE event_id % 10 = 0
  UNION ALL BY NAME
  SELECT *, 'REMOVE' AS kind, event_id + 200000001 AS seq FROM air WHERE event_id % 20 = 10
),
upserts AS (SELECT * FROM feed WHERE kind <> 'REMOVE'),
latest AS (
  SELECT * FROM upserts
  QUALIFY row_number() OVER (PARTITION BY sensor_id, reading_timestamp ORDER BY seq DESC) = 1
)"""


FEED = change_feed("air", "pm25 + 1")
BAD_FEED = change_feed("spoiled", "CASE WHEN event_id % 50 = 20 THEN -5e0 ELSE pm25 + 1 END")

TRAFFIC = f"""{EV},
traffic AS (
  SELECT event_id, 'TR_' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS sensor_id, ts AS reading_datetime,
         'TRF_' || CAST(event_id AS VARCHAR) AS event_name,
         CASE user_id % 8 WHEN 0 THEN 'Main_St_5th_Ave' WHEN 1 THEN 'Broadway_42nd_St'
              WHEN 2 THEN 'Park_Ave_23rd_St' WHEN 3 THEN 'Amsterdam_96th_St' WHEN 4 THEN 'West_Houston_St'
              WHEN 5 THEN 'FDR_Drive_23rd' WHEN 6 THEN 'Brooklyn_Bridge' ELSE 'Queens_Midtown_Tunnel' END
           AS intersection,
         CASE user_id % 8 WHEN 0 THEN 'major' WHEN 1 THEN 'major' WHEN 2 THEN 'arterial' WHEN 3 THEN 'arterial'
              WHEN 4 THEN 'local' WHEN 5 THEN 'highway' WHEN 6 THEN 'major' ELSE 'highway' END AS road_type,
         CASE user_id % 8 WHEN 0 THEN 40.7128e0 WHEN 1 THEN 40.7589e0 WHEN 2 THEN 40.7399e0 WHEN 3 THEN 40.7946e0
              WHEN 4 THEN 40.7280e0 WHEN 5 THEN 40.7350e0 WHEN 6 THEN 40.7061e0 ELSE 40.7434e0 END AS latitude,
         CASE user_id % 8 WHEN 0 THEN -74.0060e0 WHEN 1 THEN -73.9851e0 WHEN 2 THEN -73.9850e0
              WHEN 3 THEN -73.9697e0 WHEN 4 THEN -74.0020e0 WHEN 5 THEN -73.9750e0 WHEN 6 THEN -73.9969e0
              ELSE -73.9694e0 END AS longitude,
         'New_York' AS city, 'USA' AS country, k AS vehicle_count, least(value, 65e0) AS avg_speed_mph,
         CASE WHEN k > 70 THEN 'severe' WHEN k > 50 THEN 'high' WHEN k > 25 THEN 'moderate' ELSE 'low' END
           AS congestion_level,
         CASE WHEN k > 70 THEN 1e0 WHEN k > 50 THEN 0.7e0 WHEN k > 25 THEN 0.4e0 ELSE 0.1e0 END AS congestion,
         CAST(event_id % 31 AS INTEGER) AS pedestrian_count, CAST(event_id % 11 AS INTEGER) AS bike_count,
         CAST(k AS DOUBLE) AS occupancy_percent,
         greatest(0e0, (70e0 - least(value, 65e0)) * 2) AS queue_length_meters,
         100 - k AS traffic_flow_score, event_type = 'error' AS incident_detected, 'active' AS device_status,
         -30 - (k % 50) AS signal_strength_dbm, '3.2.1' AS firmware_version,
         'synthetic_streaming' AS data_source, 'kinesis_stream' AS ingestion_type,
         CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
         CAST(hour(ts) AS INTEGER) AS hour, CAST(ts AS DATE) AS date,
         CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour_timestamp,
         CAST(time_bucket(INTERVAL '15 minutes', ts) AS TIMESTAMP) AS quarter
  FROM ev
)"""

LONG = """
placed AS (
  SELECT CAST(o_orderdate AS DATE) AS date, r_name, o_custkey, o_orderkey, o_orderstatus,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'highway' WHEN '2' THEN 'major'
              WHEN '3' THEN 'arterial' ELSE 'local' END AS road_type
  FROM orders JOIN customer ON o_custkey = c_custkey
       JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
road_day AS (
  SELECT date, r_name AS city, road_type, CAST(sum(o_custkey % 100) AS BIGINT) AS total_vehicles,
         avg(10 + o_orderkey % 50) AS daily_avg_speed,
         count(*) FILTER (WHERE o_orderstatus = 'F') AS total_incidents,
         count(DISTINCT o_custkey) AS unique_intersections
  FROM placed GROUP BY ALL
),
air_day_long AS (
  SELECT date, r_name AS zone, avg(o_custkey % 200) AS avg_aqi FROM placed GROUP BY ALL
)"""

ORACLE: dict[str, str] = {}


def define(name: str, ctes: str, body: str) -> None:
    ORACLE[name] = f"WITH {ctes.strip()}\n{body.strip()}"


YMD = "CAST(year({0}) AS INTEGER) AS year, CAST(month({0}) AS INTEGER) AS month, CAST(day({0}) AS INTEGER) AS day"

# --- sources and sinks ----------------------------------------------------------------------

define("src_jsonl", BAD_FEED, """
SELECT 'chg_' || CAST(seq AS VARCHAR) AS cdc_event_id, kind AS cdc_event_type,
       CAST(seq AS VARCHAR) AS cdc_sequence_number,
       CASE WHEN kind <> 'REMOVE' THEN sensor_id END AS sensor_id,
       CASE WHEN kind <> 'REMOVE' THEN zone END AS zone,
       reading_timestamp AS key_timestamp,
       CASE WHEN kind <> 'REMOVE' THEN pm25 END AS pm25,
       CASE WHEN kind <> 'INSERT' THEN city END AS old_city,
       FALSE AS broken
FROM feed
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, TRUE""")

define("src_parquet_table", AIR, """
SELECT year, month, day, zone, count(*) AS readings, CAST(sum(aqi_value) AS BIGINT) AS aqi_total
FROM air GROUP BY ALL""")

RANGE = """min(reading_datetime) AS earliest, max(reading_datetime) AS latest,
       count(DISTINCT sensor_id) AS sensors, count(DISTINCT intersection) AS intersections"""

define("src_empty_guard", TRAFFIC, f"SELECT 'all' AS input, {RANGE} FROM traffic")
define("silver_data_range", TRAFFIC, f"SELECT {RANGE} FROM traffic")

define("rt_jsonl_hour", FEED, """
SELECT 2024 AS year, 1 AS month, 31 AS day, CASE WHEN kind = 'REMOVE' THEN 1 ELSE 0 END AS hour,
       kind AS cdc_event_type, count(*) AS records
FROM feed GROUP BY ALL""")

define("rt_parquet_append", FEED, f"""
SELECT year, month, day, zone, count(*) AS readings, {r("sum(pm25)", "pm25_total")}
FROM latest GROUP BY ALL""")

# --- change feed and silver -----------------------------------------------------------------

define("cdc_filter_active", FEED, """
SELECT 'chg_' || CAST(seq AS VARCHAR) AS cdc_event_id, kind AS cdc_event_type, sensor_id,
       reading_timestamp AS sensor_timestamp
FROM upserts""")

define("cdc_dedup_latest", FEED, f"""
SELECT sensor_id, reading_timestamp AS sensor_timestamp, CAST(seq AS VARCHAR) AS cdc_sequence_number,
       strftime(reading_datetime + INTERVAL 5 SECONDS, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS cdc_timestamp,
       'chg_' || CAST(seq AS VARCHAR) AS cdc_event_id, kind AS cdc_event_type, {rs("pm25")}
FROM latest""")

define("cdc_apply_deletes", FEED, f"""
SELECT sensor_id, reading_timestamp, kind AS cdc_event_type, CAST(seq AS VARCHAR) AS cdc_sequence_number, {rs("pm25")}
FROM (SELECT * FROM feed
      QUALIFY row_number() OVER (PARTITION BY sensor_id, reading_timestamp ORDER BY seq DESC) = 1)
WHERE kind <> 'REMOVE'""")

define("cdc_decode", AIR, f"""
SELECT event_id, sensor_id AS id, {rs("pm25")}, battery_level AS battery, battery_level % 2 = 0 AS even,
       CAST(NULL AS VARCHAR) AS gone, zone, battery_level AS n, 2 * battery_level + 1 AS pair_sum,
       zone || '|' || city AS tags, {r("battery_level + 2.5", "level_sum")},
       '{{"extra":{{"x":' || battery_level || ',"y":["' || zone || '","' || city || '"]}}'
       || CASE WHEN battery_level % 2 = 0 THEN ',"note":"seen ' || zone || '"' ELSE '' END
       || CASE WHEN battery_level % 3 = 0 THEN ',"odd":{{"QQ":' || battery_level || '}}' ELSE '' END
       || ',"place":{{"city":"' || city || '"}},"raw":["AQI=","Aw=="]}}' AS rest
FROM air""")

# Records that are no removals have a new image. Whole numbers next to one digit behind the point need 21 digits.
define("cdc_open_attributes", AIR, """
SELECT 'new_image' AS document, attribute, count(*) AS n, kind
FROM air, (VALUES ('site_code', 'DECIMAL(21,1)'), ('owner', 'OBJECT<team: STRING>')) AS v(attribute, kind)
WHERE battery_level % 13 <> 0 AND battery_level % 7 <> 0 GROUP BY attribute, kind""")

define("job_capture", AIR, """
SELECT 'rec_' || CAST(event_id AS VARCHAR) AS record_id,
       CASE WHEN battery_level % 7 = 0 THEN 'REMOVE' WHEN battery_level % 2 = 0 THEN 'MODIFY' ELSE 'INSERT' END AS outcome
FROM air WHERE battery_level % 13 <> 0
UNION ALL SELECT 'rec_odd', 'INSERT'
UNION ALL SELECT NULL, 'not a JSON record'
UNION ALL SELECT NULL, 'not a JSON record'""")

define("cdc_flatten", AIR, f"""
SELECT 'rec_' || CAST(event_id AS VARCHAR) AS cdc_event_id,
       CASE WHEN k % 7 = 0 THEN 'REMOVE' WHEN k % 2 = 0 THEN 'MODIFY' ELSE 'INSERT' END AS cdc_event_type,
       'dynamodb-streams' AS cdc_source, CAST(event_id + 1 AS VARCHAR) AS cdc_sequence_number,
       CAST(256 AS BIGINT) AS cdc_size_bytes, '2024' AS partition_year, '00' AS partition_hour,
       sensor_id AS key_sensor, CASE WHEN k % 2 = 0 THEN zone END AS old_zone,
       CASE WHEN live THEN k % 2 = 0 END AS new_active,
       CASE WHEN live THEN sensor_id END AS sensor_id,
       CASE WHEN live THEN reading_timestamp END AS sensor_timestamp,
       CASE WHEN live THEN zone END AS zone,
       {r("CASE WHEN live THEN pm25 END", "pm25")},
       {r("CASE WHEN live AND k % 10 <> 0 THEN temperature_celsius END", "temperature")},
       CASE WHEN live THEN aqi_value END AS aqi_value
FROM (SELECT *, battery_level AS k, battery_level % 7 <> 0 AS live FROM air)
WHERE k % 13 <> 0""")

SILVER = f"""sensor_id, reading_timestamp, reading_datetime, sensor_type,
       {rs("latitude", "longitude")}, zone, city, country,
       {rs("pm25", "pm10", "co2", "no2", "o3", "temperature_celsius", "humidity_percent", "pressure_hpa")},
       aqi_value, aqi_category, device_status, battery_level, signal_strength_dbm, firmware_version,
       'chg_' || CAST(seq AS VARCHAR) AS source_cdc_event_id, data_source, year, month, day"""

define("silver_air_project", BAD_FEED, f"SELECT {SILVER} FROM upserts")
define("silver_air_valid", BAD_FEED, f"SELECT {SILVER} FROM latest WHERE {VALID}")
define("st_incremental_bronze", BAD_FEED, f"SELECT {SILVER} FROM latest WHERE {VALID}")

FAILED = " || ".join(f"CASE WHEN {ok} THEN '' ELSE '|{name}' END" for name, ok in RULES.items())

define("silver_air_quarantine", BAD_FEED, f"""
SELECT 'chg_' || CAST(seq AS VARCHAR) AS source_cdc_event_id, sensor_id, reading_timestamp,
       {rs("pm25", "temperature_celsius", "latitude")}, substr({FAILED}, 2) AS failed_rules
FROM latest WHERE NOT ({VALID})""")

define("silver_dq_summary", BAD_FEED, f"""
SELECT count(*) AS rows_in, count(*) FILTER (WHERE {VALID}) AS rows_valid,
       count(*) FILTER (WHERE NOT ({VALID})) AS rows_rejected,
       {", ".join(f"count(*) FILTER (WHERE NOT ({ok})) AS failed_{name}" for name, ok in RULES.items())}
FROM latest""")

# --- gold -----------------------------------------------------------------------------------


def air_hourly(source: str) -> str:
    return f"""
air_hourly AS (
  SELECT hour_timestamp, zone, city, country, year, month, day, hour,
         avg(pm25) AS avg_pm25, avg(pm10) AS avg_pm10, avg(co2) AS avg_co2, avg(no2) AS avg_no2, avg(o3) AS avg_o3,
         avg(temperature_celsius) AS avg_temperature, avg(humidity_percent) AS avg_humidity,
         avg(pressure_hpa) AS avg_pressure, avg(aqi_value) AS avg_aqi, avg(battery_level) AS avg_battery_level,
         min(pm25) AS min_pm25, max(pm25) AS max_pm25, stddev_samp(pm25) AS stddev_pm25, max(aqi_value) AS max_aqi,
         count(DISTINCT sensor_id) AS active_sensor_count, count(*) AS reading_count,
         count(*) FILTER (WHERE pm25 > 35.4) AS unhealthy_reading_count
  FROM {source} GROUP BY ALL
)"""


AIR_HOURLY_OUT = f"""
SELECT hour_timestamp, zone, city, country, year, month, day, hour,
       {rs("avg_pm25", "avg_pm10", "avg_co2", "avg_no2", "avg_o3", "avg_temperature", "avg_humidity", "avg_pressure",
           "avg_aqi", "avg_battery_level", "min_pm25", "max_pm25", "stddev_pm25")},
       max_aqi, active_sensor_count, reading_count, unhealthy_reading_count,
       CASE WHEN avg_aqi <= 50 THEN 'Good' WHEN avg_aqi <= 100 THEN 'Moderate'
            WHEN avg_aqi <= 150 THEN 'Unhealthy for Sensitive Groups' ELSE 'Unhealthy' END AS aqi_status
FROM air_hourly"""

for _name in ("gold_air_hourly", "rt_parquet_overwrite"):
    define(_name, f"{AIR},{air_hourly('air')}", AIR_HOURLY_OUT)


def air_daily(source: str) -> str:
    return f"""
peaks AS (
  SELECT date, zone, city, hour AS peak_pollution_hour FROM {source}
  QUALIFY row_number() OVER (PARTITION BY date, zone, city ORDER BY pm25 DESC, reading_datetime DESC) = 1
),
air_daily AS (
  SELECT date, zone, city, year, month, day, avg(pm25) AS daily_avg_pm25, min(pm25) AS daily_min_pm25,
         max(pm25) AS daily_max_pm25, avg(aqi_value) AS daily_avg_aqi, max(aqi_value) AS daily_max_aqi,
         min(temperature_celsius) AS daily_min_temp, max(temperature_celsius) AS daily_max_temp,
         avg(temperature_celsius) AS daily_avg_temp, count(*) AS total_readings,
         count(DISTINCT sensor_id) AS unique_sensors,
         count(*) FILTER (WHERE aqi_value > 100) AS moderate_plus_hours,
         count(*) FILTER (WHERE aqi_value > 150) AS unhealthy_hours
  FROM {source} GROUP BY ALL
)"""


AIR_DAILY_OUT = f"""
SELECT date, zone, city, year, month, day,
       {rs("daily_avg_pm25", "daily_min_pm25", "daily_max_pm25", "daily_avg_aqi", "daily_min_temp", "daily_max_temp",
           "daily_avg_temp")},
       daily_max_aqi, total_readings, unique_sensors, moderate_plus_hours, unhealthy_hours, peak_pollution_hour,
       CASE WHEN daily_avg_aqi <= 50 THEN 'Excellent' WHEN daily_avg_aqi <= 100 THEN 'Good'
            WHEN daily_avg_aqi <= 150 THEN 'Fair' ELSE 'Poor' END AS air_quality_rating
FROM air_daily JOIN peaks USING (date, zone, city)"""

for _name in ("gold_air_daily", "rt_parquet_overwrite_ym"):
    define(_name, f"{AIR},{air_daily('air')}", AIR_DAILY_OUT)
for _name in ("job_air", "job_gold_ledger"):
    define(_name, f"{BAD_FEED}, good AS (SELECT * FROM latest WHERE {VALID}),{air_daily('good')}", AIR_DAILY_OUT)


def health(source: str) -> str:
    return f"""
newest AS (
  SELECT date, sensor_id, zone, device_status AS latest_status, firmware_version,
         battery_level AS latest_battery_level, reading_datetime AS last_reading_time
  FROM {source}
  QUALIFY row_number() OVER (PARTITION BY date, sensor_id, zone ORDER BY reading_datetime DESC,
    CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 15) AS BIGINT) DESC) = 1
),
health AS (
  SELECT *, CASE WHEN latest_battery_level < 20 OR latest_status = 'maintenance' THEN 'Critical'
                 WHEN latest_battery_level < 50 OR avg_signal_strength < -70 THEN 'Warning'
                 ELSE 'Healthy' END AS health_status,
         CAST(active_hours / 24e0 * 100 AS DECIMAL(5, 2)) AS uptime_percent
  FROM (SELECT date, sensor_id, zone, year, month, day, avg(battery_level) AS avg_battery_level,
               min(battery_level) AS min_battery_level, avg(signal_strength_dbm) AS avg_signal_strength,
               count(*) AS readings_count, count(DISTINCT hour) AS active_hours
        FROM {source} GROUP BY ALL)
       JOIN newest USING (date, sensor_id, zone)
)"""


define("gold_sensor_health", f"{AIR},{health('air')}", f"""
SELECT date, sensor_id, zone, year, month, day, {rs("avg_battery_level", "avg_signal_strength")}, min_battery_level,
       readings_count, active_hours, latest_status, firmware_version, latest_battery_level, last_reading_time,
       uptime_percent, health_status
FROM health""")

define("gold_sensor_health_ties", f"""{AIR},
tied AS (SELECT * REPLACE (date_trunc('day', reading_datetime) AS reading_datetime, 0 AS hour) FROM air),
{health('tied')}""", f"""
SELECT date, sensor_id, zone, {rs("avg_battery_level", "avg_signal_strength")}, min_battery_level,
       readings_count, latest_status, firmware_version, latest_battery_level, health_status
FROM health""")

define("gold_aqi_trends", AIR, f"""
SELECT date, hour, zone, year, month, day, count(*) AS aqi_category_count,
       string_agg(aqi_category || '=' || CAST(n AS VARCHAR), '|' ORDER BY aqi_category) AS aqi_categories,
       {r("sum(total) / CAST(sum(n) AS DOUBLE)", "avg_aqi")}, CAST(sum(n) AS BIGINT) AS reading_count
FROM (SELECT date, hour, zone, year, month, day, aqi_category, count(*) AS n, sum(aqi_value) AS total
      FROM air GROUP BY ALL)
GROUP BY date, hour, zone, year, month, day""")

define("gold_aqi_category_list", AIR, """
SELECT date, hour, zone, string_agg(aqi_category, '|' ORDER BY aqi_category) AS aqi_category_list
FROM air GROUP BY date, hour, zone""")

LEVEL_SUMS = ", ".join(
    f"count(*) FILTER (WHERE congestion_level = '{x}') AS {{prefix}}{x}{{suffix}}"
    for x in ("severe", "high", "moderate", "low")
)


def dominant(suffix: str) -> str:
    return (
        f"CASE WHEN severe{suffix} > 0 THEN 'severe' WHEN high{suffix} > moderate{suffix} THEN 'high' "
        f"WHEN moderate{suffix} > 0 THEN 'moderate' ELSE 'low' END"
    )


TRAFFIC_HOURLY = f"""{TRAFFIC},
traffic_hourly AS (
  SELECT hour_timestamp, intersection, road_type, city, year, month, day, hour,
         avg(vehicle_count) AS avg_vehicle_count, avg(avg_speed_mph) AS avg_speed_mph,
         avg(occupancy_percent) AS avg_occupancy_percent, avg(queue_length_meters) AS avg_queue_length_meters,
         avg(traffic_flow_score) AS avg_traffic_flow_score, min(vehicle_count) AS min_vehicle_count,
         max(vehicle_count) AS max_vehicle_count, stddev_samp(vehicle_count) AS stddev_vehicle_count,
         CAST(sum(vehicle_count) AS BIGINT) AS total_vehicles, min(traffic.avg_speed_mph) AS min_speed_mph,
         max(traffic.avg_speed_mph) AS max_speed_mph, {LEVEL_SUMS.format(prefix="", suffix="_congestion_count")},
         count(*) FILTER (WHERE incident_detected) AS incidents_detected,
         CAST(sum(pedestrian_count) AS BIGINT) AS total_pedestrians, CAST(sum(bike_count) AS BIGINT) AS total_bikes,
         count(*) AS reading_count, count(DISTINCT sensor_id) AS active_sensors,
         avg(congestion) AS hourly_avg_congestion
  FROM traffic GROUP BY ALL
)"""

define("gold_traffic_hourly", TRAFFIC_HOURLY, f"""
SELECT hour_timestamp, intersection, road_type, city, year, month, day, hour,
       {rs("avg_vehicle_count", "avg_speed_mph", "avg_occupancy_percent", "avg_queue_length_meters",
           "avg_traffic_flow_score", "stddev_vehicle_count", "min_speed_mph", "max_speed_mph")},
       min_vehicle_count, max_vehicle_count, total_vehicles, severe_congestion_count, high_congestion_count,
       moderate_congestion_count, low_congestion_count, incidents_detected, total_pedestrians, total_bikes,
       reading_count, active_sensors, {dominant("_congestion_count")} AS dominant_congestion_level,
       {r('''(severe_congestion_count * 100 + high_congestion_count * 70 + moderate_congestion_count * 40
           + low_congestion_count * 10) / CAST(reading_count AS DOUBLE)''', "congestion_score", 2)}
FROM traffic_hourly""")

for _name in ("gold_traffic_daily", "job_traffic"):
    define(_name, TRAFFIC, f"""
SELECT date, road_type, city, year, month, day,
       {rs(("avg(vehicle_count)", "daily_avg_vehicles"), ("avg(avg_speed_mph)", "daily_avg_speed"),
           ("min(avg_speed_mph)", "daily_min_speed"), ("max(avg_speed_mph)", "daily_max_speed"),
           ("avg(traffic_flow_score)", "daily_avg_flow_score"))},
       CAST(sum(vehicle_count) AS BIGINT) AS total_vehicles, max(vehicle_count) AS daily_peak_vehicles,
       min(vehicle_count) AS daily_min_vehicles,
       count(*) FILTER (WHERE congestion_level IN ('high', 'severe')) AS congested_readings,
       count(*) FILTER (WHERE incident_detected) AS total_incidents,
       CAST(sum(pedestrian_count) AS BIGINT) AS daily_pedestrians, CAST(sum(bike_count) AS BIGINT) AS daily_bikes,
       count(*) AS total_readings, count(DISTINCT sensor_id) AS unique_sensors,
       count(DISTINCT intersection) AS unique_intersections, count(DISTINCT hour) AS active_hours,
       {r("count(*) FILTER (WHERE congestion_level IN ('high', 'severe')) / CAST(count(*) AS DOUBLE) * 100",
          "congestion_percentage", 2)},
       CASE WHEN avg(traffic_flow_score) >= 85 THEN 'Excellent' WHEN avg(traffic_flow_score) >= 70 THEN 'Good'
            WHEN avg(traffic_flow_score) >= 50 THEN 'Fair' ELSE 'Poor' END AS traffic_quality_rating,
       {r("count(DISTINCT hour) / 24e0 * 100", "coverage_score", 2)}
FROM traffic GROUP BY date, road_type, city, year, month, day""")

INCIDENTS = f"""{TRAFFIC},
incidents AS (
  SELECT reading_datetime AS incident_datetime, year, month, day, hour, date, sensor_id, intersection, road_type,
         city, vehicle_count, avg_speed_mph, congestion_level, queue_length_meters, traffic_flow_score,
         CASE WHEN avg_speed_mph < 5 AND vehicle_count > 60 THEN 'Critical'
              WHEN avg_speed_mph < 10 AND vehicle_count > 50 THEN 'High' ELSE 'Moderate' END AS incident_severity
  FROM traffic WHERE incident_detected
)"""

for _name in ("gold_traffic_incidents", "rt_skip_empty"):
    define(_name, INCIDENTS, f"""
SELECT incident_datetime, year, month, day, hour, sensor_id, intersection, road_type, city, vehicle_count,
       {rs("avg_speed_mph", "queue_length_meters")}, congestion_level, traffic_flow_score, incident_severity
FROM incidents""")

for _name in ("gold_congestion_trends", "rt_catalog_table", "st_congestion_15m", "st_late_windows"):
    define(_name, TRAFFIC, f"""
SELECT quarter AS time_window_start, quarter + INTERVAL 15 MINUTES AS time_window_end, year, month, day, hour, city,
       road_type,
       {rs(("avg(vehicle_count)", "avg_vehicles"), ("avg(avg_speed_mph)", "avg_speed"),
           ("avg(occupancy_percent)", "avg_occupancy"), ("avg(traffic_flow_score)", "avg_flow_score"))},
       {LEVEL_SUMS.format(prefix="", suffix="_count")}, count(*) AS reading_count,
       CASE WHEN avg(traffic_flow_score) < 40 THEN 'Worsening' WHEN avg(traffic_flow_score) > 70 THEN 'Improving'
            ELSE 'Stable' END AS congestion_trend
FROM traffic GROUP BY quarter, year, month, day, hour, city, road_type""")

SENSOR_MEANS = """avg(aqi_value) AS avg_aqi, avg(pm25) AS avg_pm25, avg(pm10) AS avg_pm10,
         avg(temperature_celsius) AS avg_temperature, avg(humidity_percent) AS avg_humidity,
         count(*) AS reading_count"""
SENSOR_OUT = rs("avg_aqi", "avg_pm25", "avg_pm10", "avg_temperature", "avg_humidity") + ", reading_count"

SENSOR_DAYS = f"""{AIR},
sensor_days AS (SELECT date, sensor_id, zone, year, month, day, {SENSOR_MEANS} FROM air GROUP BY ALL)"""
SENSOR_HOURS = f"""{AIR},
sensor_hours AS (SELECT hour_timestamp, sensor_id, zone, year, month, day, {SENSOR_MEANS} FROM air GROUP BY ALL)"""

define("support_air_daily_sensor", SENSOR_DAYS,
       f"SELECT date, sensor_id, zone, year, month, day, {SENSOR_OUT} FROM sensor_days")
define("support_air_hourly_sensor", SENSOR_HOURS,
       f"SELECT hour_timestamp, sensor_id, zone, year, month, day, {SENSOR_OUT} FROM sensor_hours")

QUARTERS = f"""{TRAFFIC},
quarters AS (
  SELECT *, {dominant("_count")} AS congestion_level
  FROM (SELECT quarter AS time_window_start, intersection, road_type, city, {YMD.format("quarter")},
               avg(traffic.avg_speed_mph) AS avg_speed_mph, CAST(sum(traffic.vehicle_count) AS BIGINT) AS vehicle_count,
               {LEVEL_SUMS.format(prefix="", suffix="_count")}, count(*) AS reading_count
        FROM traffic GROUP BY quarter, intersection, road_type, city)
)"""

define("support_traffic_15m", QUARTERS, f"""
SELECT time_window_start, intersection, road_type, city, year, month, day, {rs("avg_speed_mph")}, vehicle_count,
       severe_count, high_count, moderate_count, low_count, reading_count, congestion_level
FROM quarters""")

# --- saved air reports ----------------------------------------------------------------------

define("aq_q1", SENSOR_DAYS, f"""
SELECT date, zone, {rs("daily_avg_aqi", "daily_avg_pm25", "daily_avg_pm10")}, active_sensors,
       CASE WHEN daily_avg_aqi <= 50 THEN 'Good' WHEN daily_avg_aqi <= 100 THEN 'Moderate'
            WHEN daily_avg_aqi <= 150 THEN 'Unhealthy for Sensitive Groups' WHEN daily_avg_aqi <= 200 THEN 'Unhealthy'
            WHEN daily_avg_aqi <= 300 THEN 'Very Unhealthy' ELSE 'Hazardous' END AS air_quality_category
FROM (SELECT date, zone, avg(avg_aqi) AS daily_avg_aqi, avg(avg_pm25) AS daily_avg_pm25,
             avg(avg_pm10) AS daily_avg_pm10, count(DISTINCT sensor_id) AS active_sensors
      FROM sensor_days WHERE date >= {TODAY} - INTERVAL 7 DAY GROUP BY date, zone)""")

define("aq_q2", SENSOR_HOURS, f"""
SELECT hour_timestamp, sensor_id, zone, {SENSOR_OUT},
       CASE WHEN sensor_hours.avg_aqi <= 50 THEN '🟢 Good' WHEN sensor_hours.avg_aqi <= 100 THEN '🟡 Moderate'
            WHEN sensor_hours.avg_aqi <= 150 THEN '🟠 USG' ELSE '🔴 Unhealthy' END AS status_emoji
FROM sensor_hours WHERE CAST(hour_timestamp AS DATE) = {TODAY}""")

define("aq_q3", SENSOR_HOURS, f"""
SELECT zone, {rs("avg_aqi_24h", "peak_aqi", "avg_pm25_24h", "peak_pm25")}, hourly_readings, sensor_count
FROM (SELECT zone, avg(avg_aqi) AS avg_aqi_24h, max(avg_aqi) AS peak_aqi, avg(avg_pm25) AS avg_pm25_24h,
             max(avg_pm25) AS peak_pm25, count(*) AS hourly_readings, count(DISTINCT sensor_id) AS sensor_count
      FROM sensor_hours WHERE hour_timestamp >= {AS_OF} - INTERVAL 24 HOUR GROUP BY zone)
WHERE avg_aqi_24h > 100 ORDER BY avg_aqi_24h DESC, zone LIMIT 10""")

SCORED_HEALTH = f"""{AIR}, good AS (SELECT * FROM spoiled WHERE {VALID}),{health('good')},
scores AS (
  SELECT date, sensor_id, avg(CASE WHEN {VALID} THEN 1e0 ELSE 0e0 END) AS data_quality_score,
         max(calibration_date) AS last_calibration_date
  FROM spoiled WHERE sensor_id IS NOT NULL GROUP BY date, sensor_id
),
scored AS (SELECT * FROM health LEFT JOIN scores USING (date, sensor_id))"""

define("aq_q4", SCORED_HEALTH, f"""
SELECT sensor_id, zone, uptime_percent, {rs("avg_battery_level", "data_quality_score")}, readings_count,
       CASE WHEN uptime_percent < 90 THEN '🔴 Critical' WHEN uptime_percent < 95 THEN '🟠 Warning'
            WHEN uptime_percent < 99 THEN '🟡 Monitor' ELSE '🟢 Healthy' END AS health_status,
       CASE WHEN scored.avg_battery_level < 20 THEN 'Replace Battery' WHEN uptime_percent < 90 THEN 'Check Connection'
            WHEN scored.data_quality_score < 0.8 THEN 'Calibrate Sensor' ELSE 'No Action Needed' END
         AS recommended_action
FROM scored
WHERE date = {TODAY}
  AND (uptime_percent < 99 OR scored.avg_battery_level < 30 OR scored.data_quality_score < 0.9)""")

define("aq_q5", f"""{SENSOR_DAYS},
weeks AS (
  SELECT zone,
         avg(avg_aqi) FILTER (WHERE date >= date_trunc('week', {TODAY})) AS now_aqi,
         avg(avg_aqi) FILTER (WHERE date < date_trunc('week', {TODAY})
                                AND date >= date_trunc('week', {TODAY}) - INTERVAL 7 DAY) AS then_aqi
  FROM sensor_days GROUP BY zone
)""", f"""
SELECT zone, {r("now_aqi", "current_week_aqi", 2)}, {r("then_aqi", "previous_week_aqi", 2)},
       {r("now_aqi - then_aqi", "aqi_change", 2)},
       {r("(now_aqi - then_aqi) / nullif(then_aqi, 0) * 100", "percent_change", 2)},
       CASE WHEN now_aqi > then_aqi THEN '📈 Worsening' WHEN now_aqi < then_aqi THEN '📉 Improving'
            ELSE '➡️ Stable' END AS trend
FROM weeks WHERE now_aqi IS NOT NULL AND then_aqi IS NOT NULL""")

define("aq_q6", LONG, f"""
SELECT CAST(date_trunc('month', date) AS DATE) AS month, zone, count(DISTINCT date) AS days_monitored,
       {rs(("avg(avg_aqi)", "monthly_avg_aqi"), ("max(avg_aqi)", "worst_daily_aqi"),
           ("min(avg_aqi)", "best_daily_aqi"))},
       count(*) FILTER (WHERE avg_aqi <= 50) AS good_days,
       count(*) FILTER (WHERE avg_aqi > 50 AND avg_aqi <= 100) AS moderate_days,
       count(*) FILTER (WHERE avg_aqi > 100) AS unhealthy_days,
       {r("count(*) FILTER (WHERE avg_aqi <= 50) * 100e0 / count(*)", "good_days_percentage", 2)}
FROM air_day_long
WHERE date >= date_trunc('month', {LONG_AS_OF}) - INTERVAL 3 MONTH
GROUP BY date_trunc('month', date), zone""")

define("aq_q7", SENSOR_DAYS, f"""
SELECT date, zone, {rs("avg_temp", "avg_humidity", "avg_aqi", "avg_pm25")},
       CASE WHEN avg_temp > 30 THEN 'Hot' WHEN avg_temp > 20 THEN 'Warm' ELSE 'Cool' END AS temp_category,
       CASE WHEN days.avg_humidity > 70 THEN 'High' WHEN days.avg_humidity > 40 THEN 'Moderate' ELSE 'Low' END
         AS humidity_category
FROM (SELECT date, zone, avg(avg_temperature) AS avg_temp, avg(avg_humidity) AS avg_humidity,
             avg(avg_aqi) AS avg_aqi, avg(avg_pm25) AS avg_pm25
      FROM sensor_days WHERE date >= {TODAY} - INTERVAL 30 DAY GROUP BY date, zone) days""")

define("aq_q8", f"""{AIR},
spine AS (SELECT CAST({TODAY} - INTERVAL 7 DAY + n * INTERVAL 1 DAY AS DATE) AS expected_date FROM range(7) t(n)),
today AS (SELECT DISTINCT sensor_id, zone FROM air WHERE date = {TODAY}),
seen AS (SELECT DISTINCT date, sensor_id FROM air)""", """
SELECT expected_date, today.sensor_id, zone, '❌ Missing' AS data_status
FROM spine CROSS JOIN today LEFT JOIN seen ON seen.date = expected_date AND seen.sensor_id = today.sensor_id
WHERE seen.date IS NULL""")

# --- saved traffic reports ------------------------------------------------------------------

define("tr_q1", QUARTERS, f"""
SELECT intersection, city, high_congestion_periods, {rs("avg_speed")}, peak_vehicle_count, {rs("slowest_speed")},
       {r("mean_vehicles", "avg_vehicle_count", 0)}
FROM (SELECT intersection, city, count(*) AS high_congestion_periods, avg(avg_speed_mph) AS avg_speed,
             max(vehicle_count) AS peak_vehicle_count, min(avg_speed_mph) AS slowest_speed,
             avg(vehicle_count) AS mean_vehicles
      FROM quarters
      WHERE congestion_level = 'high' AND time_window_start >= {AS_OF} - INTERVAL 24 HOUR
      GROUP BY intersection, city)
WHERE high_congestion_periods > 3
ORDER BY high_congestion_periods DESC, avg_speed, intersection LIMIT 10""")

define("tr_q2", TRAFFIC_HOURLY, f"""
SELECT hour_timestamp, intersection, city, total_vehicles, {rs("avg_speed_mph")},
       incidents_detected AS incident_count,
       CASE WHEN traffic_hourly.avg_speed_mph < 15 THEN '🔴 Severe Congestion'
            WHEN traffic_hourly.avg_speed_mph < 25 THEN '🟠 Heavy Traffic'
            WHEN traffic_hourly.avg_speed_mph < 35 THEN '🟡 Moderate Traffic' ELSE '🟢 Free Flow' END
         AS traffic_status,
       {r(f"total_vehicles / CAST(greatest(1, floor((epoch({AS_OF}) - epoch(hour_timestamp) + 3600) / 3600)) AS DOUBLE)",
          "vehicles_per_hour", 0)}
FROM traffic_hourly WHERE CAST(hour_timestamp AS DATE) = {TODAY}""")

define("tr_q3", LONG, f"""
SELECT date, city, road_type, total_vehicles, {rs("daily_avg_speed")}, total_incidents, unique_intersections,
       {r("total_vehicles / CAST(unique_intersections AS DOUBLE)", "avg_vehicles_per_intersection", 0)},
       {r("total_incidents * 1000e0 / nullif(total_vehicles, 0)", "incidents_per_1000_vehicles", 2)}
FROM road_day WHERE date >= {LONG_AS_OF} - INTERVAL 7 DAY""")

define("tr_q4", TRAFFIC_HOURLY, f"""
SELECT hour AS hour_of_day, dayname(hour_timestamp) AS day_name, {r("avg(total_vehicles)", "avg_vehicles", 0)},
       {r("avg(traffic_hourly.avg_speed_mph)", "avg_speed_mph", 2)},
       count(DISTINCT intersection) AS active_intersections,
       CASE WHEN hour BETWEEN 7 AND 9 THEN 'Morning Rush' WHEN hour BETWEEN 17 AND 19 THEN 'Evening Rush'
            WHEN hour >= 22 OR hour <= 5 THEN 'Night' ELSE 'Off-Peak' END AS time_period
FROM traffic_hourly
WHERE hour_timestamp >= {AS_OF} - INTERVAL 30 DAY AND dayofweek(hour_timestamp) BETWEEN 1 AND 5
GROUP BY hour, dayname(hour_timestamp)""")

define("tr_q5", INCIDENTS, f"""
SELECT date, intersection, congestion_level, incident_severity, count(*) AS incident_count,
       {rs(("avg(vehicle_count)", "avg_vehicles_during_incident"), ("avg(avg_speed_mph)", "avg_speed_during_incident"),
           ("min(avg_speed_mph)", "min_speed_observed"))},
       {r("avg(hour)", "avg_hour_of_occurrence", 1)}
FROM incidents WHERE date >= {TODAY} - INTERVAL 30 DAY AND congestion_level IS NOT NULL
GROUP BY date, intersection, congestion_level, incident_severity""")

define("tr_q6", QUARTERS, f"""
SELECT CAST(time_window_start AS DATE) AS date, CAST(hour(time_window_start) AS INTEGER) AS hour, intersection, city,
       congestion_level, count(*) AS interval_count,
       {rs(("avg(avg_speed_mph)", "avg_speed"), ("avg(vehicle_count)", "avg_vehicles"),
           ("min(avg_speed_mph)", "min_speed"))}, max(vehicle_count) AS max_vehicles
FROM quarters WHERE time_window_start >= {AS_OF} - INTERVAL 7 DAY
GROUP BY 1, 2, 3, 4, 5 HAVING congestion_level IN ('high', 'severe')""")

define("tr_q7", f"""{LONG},
kinds AS (
  SELECT city, road_type,
         avg(total_vehicles) FILTER (WHERE dayofweek(date) NOT IN (0, 6)) AS wd_v,
         avg(total_vehicles) FILTER (WHERE dayofweek(date) IN (0, 6)) AS we_v,
         avg(daily_avg_speed) FILTER (WHERE dayofweek(date) NOT IN (0, 6)) AS wd_s,
         avg(daily_avg_speed) FILTER (WHERE dayofweek(date) IN (0, 6)) AS we_s
  FROM road_day WHERE date >= {LONG_AS_OF} - INTERVAL 30 DAY GROUP BY city, road_type
)""", f"""
SELECT city, road_type, {rs(("wd_v", "weekday_avg_vehicles"), ("we_v", "weekend_avg_vehicles"),
                            ("wd_s", "weekday_avg_speed"), ("we_s", "weekend_avg_speed"))},
       {r("(wd_v - we_v) * 100e0 / nullif(we_v, 0)", "weekday_increase_pct", 2)}
FROM kinds""")

define("tr_q8", f"""{INCIDENTS},
hours AS (
  SELECT intersection, date, hour_timestamp, avg(avg_speed_mph) AS usual FROM traffic
  WHERE date >= {TODAY} - INTERVAL 90 DAY GROUP BY intersection, date, hour_timestamp
),
pairs AS (
  SELECT i.city, i.intersection, sum(h.usual) AS s, count(h.usual) AS n
  FROM incidents i LEFT JOIN hours h ON h.intersection = i.intersection AND h.date = i.date
  WHERE i.date >= {TODAY} - INTERVAL 90 DAY GROUP BY i.city, i.intersection
),
alone AS (
  SELECT city, intersection, count(DISTINCT date) AS days_with_incidents, count(*) AS total_incidents,
         count(*) FILTER (WHERE incident_severity = 'Critical') AS critical_incidents,
         count(*) FILTER (WHERE incident_severity = 'High') AS high_severity_incidents,
         avg(avg_speed_mph) AS during
  FROM incidents WHERE date >= {TODAY} - INTERVAL 90 DAY GROUP BY city, intersection
)""", f"""
SELECT city, intersection, days_with_incidents, total_incidents, critical_incidents, high_severity_incidents,
       {rs(("during", "avg_speed_during_incidents"), ("s / n", "normal_avg_speed"))},
       {r("s / n - during", "speed_reduction_during_incidents", 2)}
FROM alone JOIN pairs USING (city, intersection) WHERE total_incidents >= 10
ORDER BY critical_incidents DESC, total_incidents DESC, intersection LIMIT 15""")

define("tr_q9", f"""{TRAFFIC_HOURLY},
means AS (
  SELECT intersection, city, road_type, avg(avg_speed_mph) AS speed, avg(total_vehicles) AS volume,
         CAST(sum(incidents_detected) AS BIGINT) AS total_incidents
  FROM traffic_hourly WHERE hour_timestamp >= {AS_OF} - INTERVAL 30 DAY GROUP BY intersection, city, road_type
),
scored AS (
  SELECT *, {r("""speed / CASE road_type WHEN 'highway' THEN 65e0 WHEN 'arterial' THEN 45e0 ELSE 35e0 END
                  * (1 - least(total_incidents / 100e0, 0.5e0)) * 100""", "efficiency_score", 2)}
  FROM means
)""", f"""
SELECT intersection, city, road_type, {r("speed", "avg_speed_mph", 2)}, {r("volume", "avg_daily_vehicles", 0)},
       total_incidents, efficiency_score,
       CASE WHEN efficiency_score >= 80 THEN '🟢 Excellent' WHEN efficiency_score >= 60 THEN '🟡 Good'
            WHEN efficiency_score >= 40 THEN '🟠 Fair' ELSE '🔴 Poor' END AS performance_rating
FROM scored""")

define("tr_q10", f"""{LONG},
monthly AS (
  SELECT CAST(date_trunc('month', date) AS DATE) AS month, city, CAST(sum(total_vehicles) AS BIGINT) AS total_vehicles,
         avg(daily_avg_speed) AS speed
  FROM road_day WHERE date >= date_trunc('month', {LONG_AS_OF}) - INTERVAL 6 MONTH
  GROUP BY date_trunc('month', date), city
),
lagged AS (SELECT *, lag(total_vehicles) OVER (PARTITION BY city ORDER BY month) AS before FROM monthly)""", f"""
SELECT month, city, total_vehicles, {r("speed", "avg_speed_mph", 2)}, before AS prev_month_vehicles,
       {r("(total_vehicles - before) * 100e0 / nullif(before, 0)", "month_over_month_growth_pct", 2)}
FROM lagged""")

# --- documented queries and metrics ---------------------------------------------------------

define("doc_q1", f"{AIR},{air_hourly('air')}", f"""
SELECT city, zone, hour_timestamp, {rs("avg_pm25")}, max_aqi
FROM air_hourly WHERE hour_timestamp >= {AS_OF} - INTERVAL 24 HOUR
ORDER BY air_hourly.avg_pm25 DESC, hour_timestamp, zone LIMIT 10""")

define("doc_q2", TRAFFIC_HOURLY, f"""
SELECT hour_timestamp, intersection, city, {rs("hourly_avg_congestion")}, incidents_detected AS hourly_incidents
FROM traffic_hourly
WHERE hour_timestamp >= {AS_OF} - INTERVAL 24 HOUR AND traffic_hourly.hourly_avg_congestion > 0.7e0""")

define("doc_q3", f"""{AIR},{air_hourly('air')},{TRAFFIC_HOURLY.split("),", 1)[1]},
city_hours AS (
  SELECT city, hour_timestamp, avg(hourly_avg_congestion) AS congestion,
         CAST(sum(incidents_detected) AS BIGINT) AS city_incidents
  FROM traffic_hourly GROUP BY city, hour_timestamp
)""", f"""
SELECT city, hour_timestamp, zone, max_aqi, {r("congestion", "city_avg_congestion")}, city_incidents
FROM air_hourly JOIN city_hours USING (city, hour_timestamp)
WHERE hour_timestamp >= {AS_OF} - INTERVAL 24 HOUR""")

AQI_STEPS = f"""{AIR},{air_daily('air')},
steps AS (
  SELECT a.date, a.city, a.zone, a.daily_max_aqi, a.daily_avg_aqi, b.daily_max_aqi AS previous_day_aqi,
         a.daily_max_aqi - b.daily_max_aqi AS aqi_change
  FROM air_daily a LEFT JOIN air_daily b
    ON a.city = b.city AND a.zone = b.zone AND a.date = b.date + 1
)"""

define("doc_aqi_change", AQI_STEPS, f"""
SELECT date, city, zone, daily_max_aqi, {rs("daily_avg_aqi")}, {aqi_label("daily_max_aqi")} AS aqi_category,
       previous_day_aqi, aqi_change,
       CASE WHEN aqi_change > 0 THEN 'worsening' WHEN aqi_change < 0 THEN 'improving'
            WHEN aqi_change = 0 THEN 'stable' END AS aqi_trend
FROM steps""")

define("doc_aqi_alerts", AQI_STEPS, """
SELECT date, city, zone, daily_max_aqi, aqi_change,
       daily_max_aqi > 150 OR coalesce(aqi_change >= 50, FALSE) AS alert_triggered,
       CASE WHEN daily_max_aqi > 150 AND aqi_change >= 50
              THEN 'max AQI above 150; AQI up by 50 or more in a day'
            WHEN daily_max_aqi > 150 THEN 'max AQI above 150'
            WHEN aqi_change >= 50 THEN 'AQI up by 50 or more in a day' END AS alert_reason
FROM steps""")

define("doc_unhealthy_streak", f"""{AIR},{air_daily('air')},
bad AS (SELECT date, city, zone, daily_max_aqi FROM air_daily WHERE daily_max_aqi > 190),
starts AS (
  SELECT *, CASE WHEN lag(date) OVER w = date - 1 THEN 0 ELSE 1 END AS is_start FROM bad
  WINDOW w AS (PARTITION BY city, zone ORDER BY date)
),
runs AS (
  SELECT *, sum(is_start) OVER (PARTITION BY city, zone ORDER BY date ROWS UNBOUNDED PRECEDING) AS run FROM starts
)""", """
SELECT date, city, zone, daily_max_aqi,
       CAST(date - min(date) OVER (PARTITION BY city, zone, run) + 1 AS INTEGER) AS consecutive_unhealthy_days
FROM runs""")

define("doc_sequences_carried", f"""{LONG},
days AS (
  SELECT date, 'all' AS city, zone, CAST(round(CAST(avg_aqi AS DECIMAL(38, 9)), 0) AS INTEGER) AS daily_max_aqi FROM air_day_long
),
lagged AS (
  SELECT *, CASE WHEN lag(date) OVER w = date - 1 THEN lag(daily_max_aqi) OVER w END AS previous_day_aqi
  FROM days WINDOW w AS (PARTITION BY zone ORDER BY date)
),
starts AS (SELECT *, CASE WHEN previous_day_aqi > 99 THEN 0 ELSE 1 END AS is_start FROM lagged),
runs AS (
  SELECT *, sum(is_start) OVER (PARTITION BY zone ORDER BY date ROWS UNBOUNDED PRECEDING) AS run FROM starts
)""", """
SELECT date, city, zone, daily_max_aqi, previous_day_aqi, daily_max_aqi - previous_day_aqi AS aqi_change,
       CASE WHEN daily_max_aqi > 99
            THEN CAST(row_number() OVER (PARTITION BY zone, run ORDER BY date) AS INTEGER) ELSE 0 END AS consecutive_unhealthy_days
FROM runs""")

define("doc_good_air_pct", f"{AIR},{air_hourly('air')}", f"""
SELECT CAST(hour_timestamp AS DATE) AS date, city, zone, count(*) AS hours_observed,
       count(*) FILTER (WHERE avg_aqi > 100) AS unhealthy_hours,
       {r("count(*) FILTER (WHERE avg_aqi <= 50) * 100e0 / count(*)", "good_air_quality_percentage")}
FROM air_hourly GROUP BY 1, 2, 3""")

define("doc_sensor_health", SCORED_HEALTH, f"""
SELECT date, sensor_id, zone, latest_status AS device_status, readings_count AS total_readings,
       CAST(288 AS BIGINT) AS expected_readings, {r("readings_count / 288e0 * 100", "uptime_percent")},
       {r("avg_battery_level", "avg_battery_percent")}, min_battery_level AS min_battery_percent,
       CASE WHEN avg_battery_level < 20 THEN 'critical' WHEN avg_battery_level < 50 THEN 'low' ELSE 'healthy' END
         AS battery_status,
       firmware_version, last_calibration_date,
       CAST(date - last_calibration_date AS INTEGER) AS days_since_calibration, {rs("data_quality_score")}
FROM scored""")

define("doc_congestion_change", f"""{TRAFFIC},
windows AS (
  SELECT quarter AS time_window, city, road_type, avg(congestion) AS c, max(congestion) AS c_max,
         avg(avg_speed_mph) AS speed, CAST(sum(vehicle_count) AS BIGINT) AS window_vehicle_count
  FROM traffic GROUP BY quarter, city, road_type
),
steps AS (
  SELECT a.*, b.c AS before, CAST(round(CAST(a.c - b.c AS DECIMAL(38, 9)), 6) AS DOUBLE) AS change
  FROM windows a LEFT JOIN windows b
    ON a.city = b.city AND a.road_type = b.road_type AND a.time_window = b.time_window + INTERVAL 15 MINUTES
)""", f"""
SELECT time_window, city, road_type,
       {rs(("c", "window_avg_congestion"), ("c_max", "window_max_congestion"), ("speed", "window_avg_speed_mph"))},
       window_vehicle_count, {r("before", "previous_window_congestion")}, change AS congestion_change,
       CASE WHEN change > 0 THEN 'worsening' WHEN change < 0 THEN 'improving' WHEN change = 0 THEN 'stable' END
         AS trend_indicator,
       hour(time_window) BETWEEN 7 AND 9 OR hour(time_window) BETWEEN 17 AND 19 AS peak_period
FROM steps""")

define("doc_severity", f"""{TRAFFIC},
graded AS (
  SELECT *, CASE WHEN congestion > 0.9e0 OR avg_speed_mph < 5 THEN 'critical'
                 WHEN congestion > 0.7e0 OR avg_speed_mph < 15 THEN 'high' ELSE 'moderate' END AS severity
  FROM traffic WHERE incident_detected
)""", f"""
SELECT event_name AS event_id, reading_datetime AS incident_datetime, sensor_id, intersection, city, road_type,
       vehicle_count, {rs("avg_speed_mph", ("congestion", "congestion_level"))}, severity,
       CASE severity WHEN 'critical' THEN 1e0 WHEN 'high' THEN 0.7e0 ELSE 0.4e0 END AS severity_score
FROM graded""")

define("doc_congestion_level", f"""{TRAFFIC},
hours AS (
  SELECT date, hour, city, road_type, avg(congestion) AS c FROM traffic GROUP BY date, hour, city, road_type
),
above AS (
  SELECT date, city, road_type, count(*) FILTER (WHERE c > 0.7e0) AS n FROM hours GROUP BY date, city, road_type
)""", f"""
SELECT date, city, road_type, {rs(("avg(congestion)", "daily_avg_congestion"), ("max(congestion)", "daily_max_congestion"))},
       n AS congestion_hours, {r("n / 24e0 * 100", "congestion_percentage")}
FROM traffic JOIN above USING (date, city, road_type) GROUP BY date, city, road_type, n""")


def rule_report(source: str, broken: dict[str, str], extra: str = "") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {extra}'{name}' AS rule, count(*) AS rows_checked, count(*) FILTER (WHERE {bad}) AS violations "
        f"FROM {source}"
        for name, bad in broken.items()
    )


define("doc_dq_air", AIR, rule_report("spoiled", {
    "pm25": "pm25 < 0 OR pm25 > 500", "pm10": "pm10 < 0 OR pm10 > 500", "no2": "no2 < 0 OR no2 > 500",
    "o3": "o3 < 0 OR o3 > 500", "temperature_celsius": "temperature_celsius < -50 OR temperature_celsius > 60",
    "humidity_percent": "humidity_percent < 0 OR humidity_percent > 100",
}) + "\nUNION ALL SELECT 'co', 0, NULL")

define("doc_dq_traffic", TRAFFIC, rule_report("traffic", {
    "vehicle_count": "vehicle_count < 0", "avg_speed_mph": "avg_speed_mph < 0 OR avg_speed_mph > 120",
    "occupancy_percent": "occupancy_percent < 0 OR occupancy_percent > 100",
    "congestion_level": "congestion_level NOT IN ('low', 'moderate', 'high', 'severe')",
}))


def gold_report(source: str, name: str, stamp: str, seconds: int) -> str:
    return rule_report(source, {
        "reading_count_positive": "reading_count <= 0",
        "within_ten_years": f"{stamp} < {AS_OF} - INTERVAL 10 YEAR OR {stamp} > {AS_OF}",
        "bucket_aligned": f"epoch({stamp}) % {seconds} <> 0",
    }, f"'{name}' AS gold_table, ")


define("doc_gold_constraints", f"""{AIR},{air_hourly('air')},{TRAFFIC.split("),", 1)[1]},
trend_windows AS (SELECT quarter, city, road_type, count(*) AS reading_count FROM traffic GROUP BY ALL)""",
       gold_report("air_hourly", "air_quality_hourly_avg", "hour_timestamp", 3600)
       + "\nUNION ALL\n"
       + gold_report("trend_windows", "traffic_congestion_trends", "quarter", 900))

PM10_ROWS = ((54, 0, 0, 50), (154, 55, 51, 100), (254, 155, 101, 150), (354, 255, 151, 200), (424, 355, 201, 300),
             (504, 425, 301, 400), (604, 505, 401, 500))
PM10_AQI = "CASE " + " ".join(
    f"WHEN floor(pm10) <= {hi} THEN floor({ilo}e0 + ({ihi - ilo}e0 / {hi - lo}e0) * (floor(pm10) - {lo}) + 0.5)"
    for hi, lo, ilo, ihi in PM10_ROWS
) + " ELSE floor(pm10) - 604 + 500 END"  # one index point per microgram beyond the table

define("air_aqi_index", f"""{AIR},
indexed AS (SELECT event_id, pm25, pm10, aqi_value AS aqi_pm25, CAST({PM10_AQI} AS INTEGER) AS aqi_pm10 FROM air),
overall AS (
  SELECT *, CASE WHEN aqi_pm10 IS NULL OR aqi_pm25 >= aqi_pm10 THEN aqi_pm25 ELSE aqi_pm10 END AS overall_aqi
  FROM indexed
)""", f"""
SELECT event_id, {rs("pm25", "pm10")}, aqi_pm25, aqi_pm10, overall_aqi, {aqi_label("overall_aqi")} AS aqi_category
FROM overall""")

define("traffic_classify", TRAFFIC, f"""
SELECT event_name AS event_id, vehicle_count, {rs("avg_speed_mph")}, congestion_level,
       CASE WHEN traffic.avg_speed_mph > 40 AND vehicle_count < 30 THEN 'Excellent'
            WHEN traffic.avg_speed_mph > 25 AND vehicle_count < 50 THEN 'Good'
            WHEN traffic.avg_speed_mph > 15 THEN 'Fair' ELSE 'Poor' END AS flow_band,
       traffic.avg_speed_mph < 8 AND vehicle_count > 60 AS incident_candidate
FROM traffic""")

# --- streams --------------------------------------------------------------------------------

for _name in ("st_traffic_silver", "st_broker_records"):
    define(_name, TRAFFIC, f"""
SELECT sensor_id, reading_datetime, event_name AS event_id, {rs("latitude", "longitude")}, intersection, road_type,
       city, country, vehicle_count, {rs("avg_speed_mph")}, congestion_level, pedestrian_count, bike_count,
       {rs("occupancy_percent", "queue_length_meters")}, traffic_flow_score, incident_detected, device_status,
       signal_strength_dbm, firmware_version, data_source, ingestion_type, year, month, day, hour
FROM traffic""")

define("st_traffic_rejected", TRAFFIC, """
SELECT event_name AS record_id,
       CASE event_id % 40 WHEN 0 THEN 'avg_speed_mph' WHEN 1 THEN 'time' ELSE 'congestion_level' END AS reason
FROM traffic WHERE event_id % 40 < 3
UNION ALL SELECT NULL, 'not a JSON record'""")

define("st_dedup", TRAFFIC, "SELECT event_name AS event_id, sensor_id, reading_datetime FROM traffic")

define("st_enrich", TRAFFIC, f"""
SELECT event_name AS event_id, intersection, {rs("latitude", "longitude")}, road_type
FROM traffic,
     range(CASE WHEN event_id % 10 <> 0 THEN 1 WHEN reading_datetime < TIMESTAMP '2024-01-21' THEN 3 ELSE 2 END)""")

define("st_sensor_sketches", TRAFFIC, """
SELECT year, month, day, road_type, count(DISTINCT sensor_id) AS exact, TRUE AS within_error
FROM traffic GROUP BY year, month, day, road_type""")

define("st_batch_metrics", f"""{BAD_FEED},
arrived AS (
  SELECT CAST(kind = 'INSERT' AS INTEGER) AS number, * FROM upserts
  QUALIFY row_number() OVER (PARTITION BY kind, sensor_id, reading_timestamp ORDER BY seq DESC) = 1
)""", f"""
SELECT 'traffic' AS stream, CAST(event_id % 2 AS INTEGER) AS number, count(*) AS rows_in,
       count(*) FILTER (WHERE event_id % 40 >= 2) AS rows_valid, count(*) FILTER (WHERE event_id % 40 < 2) AS rows_rejected,
       count(*) FILTER (WHERE event_id % 40 = 0) AS avg_speed_mph, count(*) FILTER (WHERE event_id % 40 < 2) AS congestion_level,
       CAST(0 AS BIGINT) AS pm25
FROM ev GROUP BY event_id % 2
UNION ALL
SELECT 'air_quality' AS stream, number, count(*) AS rows_in, count(*) FILTER (WHERE {VALID}) AS rows_valid,
       count(*) FILTER (WHERE NOT ({VALID})) AS rows_rejected, CAST(0 AS BIGINT) AS avg_speed_mph,
       CAST(0 AS BIGINT) AS congestion_level, count(*) FILTER (WHERE NOT {RULES["pm25"]}) AS pm25
FROM arrived GROUP BY number""")

# --- refreshes: rows per table and day, as a rebuild from the corrected readings leaves them --


def rows_by_day(source: str, keys_by_table: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, year, month, day, count(*) AS n_rows, count(*) AS n_as_rebuilt, count(*) AS n_rebuilt "
        f"FROM (SELECT DISTINCT year, month, day, {keys} FROM {source}) GROUP BY year, month, day"
        for name, keys in keys_by_table.items()
    )


CORRECTED = "make_date(year, month, day) <> DATE '2024-01-10' AND NOT (year = 2024 AND month = 1 AND day = 12 AND hour < 12)"

define("job_air_refresh", f"{AIR}, corrected AS (SELECT * FROM air WHERE {CORRECTED})", rows_by_day("corrected", {
    "air_quality_sensor_hours": "hour, sensor_id, zone, city, country, device_status, firmware_version, aqi_category",
    "air_quality_hourly_avg": "hour, zone, city, country",
    "aqi_trends": "hour, zone",
    "air_quality_daily_summary": "zone, city",
    "sensor_health_metrics": "sensor_id, zone",
    "air_quality_daily_by_sensor": "sensor_id, zone",
    "air_quality_hourly_by_sensor": "hour, sensor_id, zone",
}))

define("job_traffic_refresh", f"{TRAFFIC}, corrected AS (SELECT * FROM traffic WHERE {CORRECTED})", rows_by_day(
    "corrected", {
        "traffic_sensor_quarters": "quarter, intersection, road_type, city, sensor_id",
        "traffic_hourly_by_intersection": "hour, intersection, road_type, city",
        "traffic_daily_summary": "road_type, city",
        "traffic_congestion_trends": "quarter, road_type, city",
        "traffic_congestion_by_intersection": "quarter, intersection, road_type, city",
        "traffic_hourly_congestion": "hour, intersection, city, road_type",
    }) + """
UNION ALL
SELECT 'traffic_incidents' AS table_name, year, month, day, count(*) AS n_rows, count(*) AS n_as_rebuilt,
       count(*) AS n_rebuilt FROM corrected
WHERE incident_detected AND NOT (year = 2024 AND month = 1 AND day = 11) GROUP BY year, month, day""")


# --- saved reports over stored tables: the results of the same reports straight from readings ----

SAVED = {
    "weekly_trend": "aq_q1", "today_by_sensor": "aq_q2", "most_polluted_zones": "aq_q3",
    "devices_needing_attention": "aq_q4", "week_over_week": "aq_q5", "weather_and_aqi": "aq_q7",
    "missing_sensor_days": "aq_q8", "worst_hours": "doc_q1", "congested_hours": "doc_q2", "air_with_traffic": "doc_q3",
    "today_by_intersection": "tr_q2", "rush_hours": "tr_q4", "incident_profile": "tr_q5",
    "congested_quarter_hours": "tr_q6", "dangerous_intersections": "tr_q8", "flow_efficiency": "tr_q9",
}
for _name, _direct in SAVED.items():
    ORACLE[f"saved_{_name}"] = ORACLE[_direct]

# Reports over months: the same SQL as over the long table of orders, with days from readings and the readings' own date.
DAYS_OF_READINGS = {
    "aq_q6": f"{AIR},\nair_day_long AS (SELECT date, zone, avg(aqi_value) AS avg_aqi FROM air GROUP BY date, zone, city)",
    "road": f"""{TRAFFIC},
road_day AS (
  SELECT date, city, road_type, CAST(sum(vehicle_count) AS BIGINT) AS total_vehicles, avg(avg_speed_mph) AS daily_avg_speed,
         count(*) FILTER (WHERE incident_detected) AS total_incidents, count(DISTINCT intersection) AS unique_intersections
  FROM traffic GROUP BY date, city, road_type)""",
}
for _name, _direct in {"monthly_summary": "aq_q6", "daily_by_city": "tr_q3", "weekday_against_weekend": "tr_q7",
                       "monthly_growth": "tr_q10"}.items():
    _days = DAYS_OF_READINGS.get(_direct, DAYS_OF_READINGS["road"])
    ORACLE[f"saved_{_name}"] = ORACLE[_direct].replace(LONG.strip(), _days.strip()).replace(LONG_AS_OF, TODAY)
ORACLE["saved_congestion_hotspots"] = ORACLE["tr_q1"].replace("high_congestion_periods > 3", "high_congestion_periods > 10")
