"""DuckDB oracle SQL for the registered queries (independent formulations).

The role CTEs mirror ``lakehold/plans/roles.py``; the query bodies are written
from the reference's semantics, not from the Spark plans (e.g. the station facts
oracle runs the station x connector fan-out and the window over it).
"""

AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"
OPEN_END = "TIMESTAMP '2999-12-31 00:00:00'"
CUTOFF = "TIMESTAMP '2024-01-16 00:00:00'"

VERSIONS = f"""
versions AS (
  SELECT o.o_custkey AS station_id, o.o_orderkey AS station_sk, c.c_name AS title,
         o.o_orderpriority AS address, c.c_mktsegment AS town,
         CASE WHEN c.c_nationkey % 2 = 0 THEN 'NY' ELSE 'NJ' END AS state_or_province,
         c.c_acctbal / CAST(100 AS DOUBLE) AS latitude,
         CAST(c.c_nationkey AS DOUBLE) / CAST(10 AS DOUBLE) - CAST(74 AS DOUBLE) AS longitude,
         c.c_nationkey AS weather_zone,
         CASE o.o_orderstatus WHEN 'F' THEN 'Operational' WHEN 'O' THEN 'Temporarily Unavailable'
              WHEN 'P' THEN 'Planned' END AS status,
         CAST(CASE o.o_orderstatus WHEN 'F' THEN 50 WHEN 'O' THEN 30 WHEN 'P' THEN 20 END AS INTEGER) AS status_id,
         o.o_orderdate AS date_last_status_update,
         min(o.o_orderdate) OVER (PARTITION BY o.o_custkey) AS date_created,
         o.o_orderdate AS valid_from,
         coalesce(lead(o.o_orderdate) OVER (PARTITION BY o.o_custkey ORDER BY o.o_orderdate, o.o_orderkey),
                  {OPEN_END}) AS valid_to
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""

CONNECTORS = """
connectors AS (
  SELECT o.o_custkey AS station_id, l.l_orderkey, l.l_linenumber,
         CASE WHEN l.l_quantity > 45 THEN 3 WHEN l.l_quantity > 20 THEN 2 ELSE 1 END AS level_id,
         l.l_quantity AS power_kw, 1 + l.l_linenumber % 2 AS quantity
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

WEATHER = """
weather AS (
  SELECT event_id AS weather_sk, CAST(user_id % 25 AS INTEGER) AS zone,
         CAST(user_id % 25 AS INTEGER) AS weather_zone_id, ts AS dt_utc,
         CASE event_type WHEN 'click' THEN 'Clear' WHEN 'view' THEN 'light snow'
              WHEN 'purchase' THEN 'Rain' WHEN 'error' THEN 'Thunderstorm'
              WHEN 'signup' THEN 'Snow' ELSE event_type END AS weather,
         event_type AS description, value AS temp,
         CAST(1000 + user_id % 50 AS INTEGER) AS pressure,
         CAST(event_id % 101 AS INTEGER) AS humidity, 10000 AS visibility,
         CASE WHEN event_type = 'purchase' THEN value ELSE CAST(0 AS DOUBLE) END AS rain,
         CASE WHEN event_type = 'signup' THEN value ELSE CAST(0 AS DOUBLE) END AS snow
  FROM events)"""

ROLES = f"WITH {VERSIONS},{CONNECTORS},{WEATHER}"


def _round(expr: str, digits: int) -> str:
    # Spark rounds the decimal text of a double HALF_UP; DuckDB rounds binary doubles.
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def station_facts_sql(mode: str) -> str:
    """Fan-out form: station x connector x latest weather of the zone, then window."""
    if mode == "parity":
        direction, like = "DESC", "LIKE"
        counted = "NOT is_operational AND (prev_op OR prev_op IS NULL)"
        dur_cond = counted
        dur = f"date_sub('minute', valid_from, least({AS_OF}, valid_to))"
        cost = f"sum(CASE WHEN rn = 1 THEN {_round('0.35 * total_power', 0)} ELSE 0 END)"
    else:
        direction, like = "ASC", "ILIKE"
        counted = "NOT is_operational AND (prev_op OR prev_op IS NULL)"
        dur_cond = "NOT is_operational"
        dur = f"greatest(date_sub('minute', valid_from, least({AS_OF}, valid_to)), 0)"
        cost = None
    # In the fan-out every version appears once per connector; only its first copy in
    # window order may count (the later copies see the version itself as neighbour).
    return f"""{ROLES},
wl AS (
  SELECT zone, weather_sk, weather, temp, dt_utc,
         row_number() OVER (PARTITION BY zone ORDER BY dt_utc DESC, weather_sk DESC) AS r
  FROM weather),
wz AS (SELECT zone, max(weather_zone_id) AS weather_zone_id FROM weather GROUP BY zone),
j AS (
  SELECT v.*, c.l_orderkey, c.l_linenumber, c.level_id, c.power_kw * c.quantity AS total_power,
         w.weather_sk, w.weather, w.temp, w.dt_utc, wz.weather_zone_id,
         v.status_id = 50 AS is_operational
  FROM versions v
  JOIN connectors c ON c.station_id = v.station_id
  JOIN wl w ON w.zone = v.weather_zone AND w.r = 1
  JOIN wz ON wz.zone = v.weather_zone
  WHERE v.status_id IN (50, 30)),
k AS (
  SELECT *,
    lag(is_operational) OVER (PARTITION BY station_id ORDER BY date_last_status_update {direction},
        station_sk {direction}, l_orderkey, l_linenumber, total_power) AS prev_op,
    row_number() OVER (PARTITION BY station_id ORDER BY date_last_status_update DESC,
        station_sk DESC, l_orderkey, l_linenumber, total_power) AS rn,
    sum(total_power) OVER (PARTITION BY station_id, station_sk) AS version_power
  FROM j),
first_copy AS (
  SELECT *, row_number() OVER (PARTITION BY station_id, station_sk ORDER BY l_orderkey, l_linenumber, total_power) AS copy_no
  FROM k),
a AS (
  SELECT station_id,
    max(weather_zone_id) AS weather_zone_id,
    arg_max(weather_sk, dt_utc) AS weather_sk,
    arg_max(is_operational, (date_last_status_update, station_sk)) AS is_operational,
    CAST(sum(CASE WHEN {counted} THEN 1 ELSE 0 END) AS BIGINT) AS offline_count,
    CAST(sum(CASE WHEN {dur_cond} {'' if mode == 'parity' else 'AND copy_no = 1'} THEN {dur} ELSE 0 END) AS BIGINT) AS offline_duration,
    CAST(date_sub('minute', max(date_created), {AS_OF}) AS BIGINT) AS total_duration,
    CAST(15 + CASE WHEN arg_max(weather, dt_utc) {like} '%storm%' OR arg_max(weather, dt_utc) {like} '%snow%' THEN 30 ELSE 0 END
       + CASE WHEN arg_max(temp, dt_utc) > 95 OR arg_max(temp, dt_utc) < 20 THEN 30 ELSE 0 END
       + CASE WHEN max(level_id) = 3 THEN 25 ELSE 0 END AS INTEGER) AS risk_score,
    {cost if cost else _round('0.35 * arg_max(version_power, (date_last_status_update, station_sk))', 0)} AS avg_energy_cost_per_hour
  FROM first_copy GROUP BY station_id)
SELECT station_id, weather_zone_id, weather_sk, is_operational, offline_count, offline_duration,
       total_duration, risk_score,
       CASE WHEN risk_score < 60 THEN 'low_risk' ELSE 'high_risk' END AS risk_severity_level,
       avg_energy_cost_per_hour,
       avg_energy_cost_per_hour * offline_duration / 60 AS est_downtime_cost,
       {_round('1 - CAST(offline_duration AS DOUBLE) / CAST(total_duration AS DOUBLE)', 2)} AS availability,
       {AS_OF} AS ingest_timestamp
FROM a"""

STATION_DIM = f"""{ROLES},
j AS (
  SELECT v.*, c.power_kw FROM versions v
  JOIN connectors c ON c.station_id = v.station_id
  JOIN weather w ON w.zone = v.weather_zone
  WHERE v.status_id IN (50, 30))
SELECT station_id, max(title) AS title, max(address) AS address, max(town) AS town,
       max(state_or_province) AS state_or_province, max(latitude) AS latitude,
       max(longitude) AS longitude, max(power_kw) AS max_power_kw, {AS_OF} AS ingest_timestamp
FROM j GROUP BY station_id"""

WEATHER_DIM = f"""{ROLES},
z AS (
  SELECT DISTINCT v.weather_zone FROM versions v
  WHERE v.status_id IN (50, 30) AND EXISTS (SELECT 1 FROM connectors c WHERE c.station_id = v.station_id))
SELECT weather_sk, max(weather_zone_id) AS weather_zone_id, max(weather) AS weather,
       max(description) AS description, max(temp) AS temp, max(pressure) AS pressure,
       max(humidity) AS humidity, max(visibility) AS visibility, max(rain) AS rain,
       max(snow) AS snow, {AS_OF} AS ingest_timestamp
FROM weather w JOIN z ON w.zone = z.weather_zone GROUP BY weather_sk"""

WEATHER_MAIN = ("CASE event_type WHEN 'click' THEN 'Clear' WHEN 'view' THEN 'light snow' "
                "WHEN 'purchase' THEN 'Rain' WHEN 'error' THEN 'Thunderstorm' WHEN 'signup' THEN 'Snow' "
                "ELSE event_type END")

JSON_PATH_PROJECT = """
SELECT event_id, json_extract_string(props, '$.k') AS k,
       json_extract_string(props, '$.missing.x') AS missing_x,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_int
FROM events"""

JSON_ARRAY_EXPLODE = """
SELECT o.o_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, l.l_returnflag, l.l_linestatus
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey"""

_OBS_COLS = f"""
  value AS lat, -value AS lon, {WEATHER_MAIN} AS weather, event_type AS description, value AS temp,
  CAST(1000 + user_id % 50 AS INTEGER) AS pressure, CAST(event_id % 101 AS INTEGER) AS humidity,
  10000 AS visibility,
  CASE WHEN event_type = 'purchase' THEN value ELSE CAST(0 AS DOUBLE) END AS rain,
  CASE WHEN event_type = 'signup' THEN value ELSE CAST(0 AS DOUBLE) END AS snow,
  value / CAST(10 AS DOUBLE) AS wind_speed, CAST(event_id % 101 AS INTEGER) AS clouds"""

OBSERVATION_FLATTEN = f"""
SELECT event_id, {_OBS_COLS},
  CAST(date_sub('second', TIMESTAMP '1970-01-01 00:00:00', ts) AS BIGINT) AS dt
FROM events WHERE event_type NOT IN ('error', 'view')"""

OBSERVATION_REJECTS = """
SELECT event_id, CASE event_type WHEN 'error' THEN 'temp,pressure,humidity'
                                 WHEN 'view' THEN 'weather,description' END AS missing_fields
FROM events WHERE event_type IN ('error', 'view')"""

WEATHER_STANDARDIZE = f"""
SELECT event_id, {_round('value', 1)} AS lat, {_round('-value', 1)} AS lon,
  {WEATHER_MAIN} AS weather, event_type AS description, value AS temp,
  CAST(1000 + user_id % 50 AS INTEGER) AS pressure, CAST(event_id % 101 AS INTEGER) AS humidity,
  10000 AS visibility,
  CASE WHEN event_type = 'purchase' THEN value ELSE CAST(0 AS DOUBLE) END AS rain,
  CASE WHEN event_type = 'signup' THEN value ELSE CAST(0 AS DOUBLE) END AS snow,
  value / CAST(10 AS DOUBLE) AS wind_speed, CAST(event_id % 101 AS INTEGER) AS clouds,
  TIMESTAMP '1970-01-01 00:00:00' + to_seconds(date_sub('second', TIMESTAMP '1970-01-01 00:00:00', ts)) AS dt_utc
FROM events WHERE event_type NOT IN ('error', 'view')"""

_POINTS = """
pts AS (SELECT c_custkey, c_acctbal / CAST(100 AS DOUBLE) AS latitude,
               CAST(c_nationkey AS DOUBLE) / CAST(10 AS DOUBLE) - CAST(74 AS DOUBLE) AS longitude
        FROM customer)"""

REQUEST_GRID = f"""
WITH {_POINTS},
b AS (SELECT min(latitude) AS a, min(longitude) AS b, max(latitude) AS c, max(longitude) AS d FROM pts),
n AS (SELECT a, b, CAST(ceil((c - a) / CAST(0.1 AS DOUBLE)) AS BIGINT) AS nl,
             CAST(ceil((d - b) / CAST(0.1 AS DOUBLE)) AS BIGINT) AS nm FROM b),
t1 AS (SELECT a, b, nm, unnest(range(nl)) AS i FROM n),
t2 AS (SELECT a, b, i, unnest(range(nm)) AS j FROM t1)
SELECT a + CAST(i AS DOUBLE) * ((a + CAST(0.1 AS DOUBLE)) - a) AS lat,
       b + CAST(j AS DOUBLE) * ((b + CAST(0.1 AS DOUBLE)) - b) AS lon
FROM t2"""

STANDARDIZE_VALUES = """
SELECT c_custkey,
  CASE c_nationkey % 3 WHEN 0 THEN 'New Jersey' WHEN 1 THEN 'New York' ELSE 'PA' END AS state_or_province,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_acctbal END AS latitude
FROM customer"""

ZONE_ASSIGN = f"""
WITH {_POINTS}
SELECT c_custkey, latitude, longitude, {_round('latitude', 1)} AS weather_zone_lat,
       {_round('longitude', 1)} AS weather_zone_lon
FROM pts"""

ZONE_DISTINCT = f"""
SELECT DISTINCT weather_zone_lat, weather_zone_lon FROM ({ZONE_ASSIGN})"""

INCREMENTAL_FILTER = f"SELECT event_id, ts, user_id FROM events WHERE ts > {CUTOFF}"

WATERMARK_BUFFER = """
SELECT user_id, max(ts) AS watermark, max(ts) - INTERVAL 15 MINUTE AS buffered_watermark
FROM events GROUP BY user_id"""

_REDELIVERED = """
(SELECT * FROM events UNION ALL
 SELECT * FROM events WHERE hour(ts) = 23 AND minute(ts) >= 45)"""

DEDUP_ROWS = f"SELECT DISTINCT * FROM {_REDELIVERED} r"

DEDUP_LATEST = f"""
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM {_REDELIVERED} r) WHERE rn = 1"""

_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
               "o_orderpriority", "o_refund_priority"]
COLUMN_GATE = "WITH o AS (SELECT *, CASE WHEN o_totalprice < 0 THEN o_orderpriority END AS o_refund_priority FROM orders)\n" + \
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count({c}) AS non_null_count, count({c}) > 0 AS passed FROM o"
        for c in _ORDER_COLS)

QUARANTINE_SPLIT = """
WITH c AS (
  SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS seg,
         CASE WHEN c_nationkey <> 0 THEN c_acctbal END AS acct FROM customer)
SELECT c_custkey,
  (c_custkey IS NOT NULL AND seg IS NOT NULL AND acct IS NOT NULL AND acct >= 0) AS is_valid,
  concat_ws(',', CASE WHEN c_custkey IS NULL THEN 'c_custkey:null' END,
                 CASE WHEN seg IS NULL THEN 'c_mktsegment:null' END,
                 CASE WHEN acct IS NULL THEN 'c_acctbal:null' WHEN acct < 0 THEN 'c_acctbal:negative' END)
    AS reject_reasons
FROM c"""


def _history_sql(where: str) -> str:
    return f"""
h0 AS (SELECT user_id, event_type AS status, value, ts, event_id FROM events WHERE {where}),
h1 AS (SELECT *, lag(status) OVER w AS p_status, lag(1) OVER w AS p_exists FROM h0
       WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
h2 AS (SELECT user_id, status, value, ts, event_id FROM h1
       WHERE p_exists IS NULL OR p_status IS DISTINCT FROM status),
hist AS (SELECT user_id, status, value, ts AS valid_from,
           coalesce(lead(ts) OVER w, {OPEN_END}) AS valid_to, lead(ts) OVER w IS NULL AS is_current
         FROM h2 WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""


SCD2_HISTORY = f"WITH {_history_sql('true')}\nSELECT * FROM hist"

_SCD_STAGED = f"""staged AS (
  SELECT user_id, event_type AS status, value, CASE WHEN event_id % 97 <> 0 THEN ts END AS ts, event_id FROM events
  WHERE (ts >= {CUTOFF} AND user_id % 5 <> 0)
     OR (ts >= {CUTOFF} - INTERVAL 1 DAY AND ts < {CUTOFF} AND user_id % 3 = 0))"""
SCD2_UNTIMED = f"WITH {_SCD_STAGED}\nSELECT user_id, status, event_id FROM staged WHERE ts IS NULL"

_SCD_BASE = f"""WITH {_history_sql(f'ts < {CUTOFF} AND user_id % 7 <> 0')}, {_SCD_STAGED},
stg AS (SELECT * FROM (
  SELECT user_id, status, value, ts,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM staged WHERE ts IS NOT NULL) WHERE rn = 1),
cur AS (SELECT * FROM hist WHERE is_current),
cls AS (
  SELECT s.user_id, s.status, s.value, s.ts, c.valid_from AS cur_from,
    CASE WHEN c.valid_from IS NULL THEN 'INSERT'
         WHEN s.ts > c.valid_from AND s.status IS DISTINCT FROM c.status THEN 'UPDATE' END AS scd_action
  FROM stg s LEFT JOIN cur c ON s.user_id = c.user_id),
newv AS (SELECT user_id, status, value, ts AS valid_from, {OPEN_END} AS valid_to, true AS is_current
         FROM cls WHERE scd_action IN ('INSERT', 'UPDATE'))"""

SCD2_CLASSIFY = f"{_SCD_BASE}\nSELECT user_id, scd_action FROM cls"
SCD2_NEW_VERSIONS = f"{_SCD_BASE}\nSELECT * FROM newv"
SCD2_EXPIRE = f"{_SCD_BASE}\nSELECT user_id, cur_from AS valid_from, ts AS valid_to FROM cls WHERE scd_action = 'UPDATE'"
SCD2_APPLY = f"""{_SCD_BASE}
SELECT user_id, status, value, valid_from, valid_to, is_current FROM hist WHERE NOT is_current
UNION ALL
SELECT c.user_id, c.status, c.value, c.valid_from,
       CASE WHEN a.scd_action = 'UPDATE' THEN a.ts ELSE c.valid_to END AS valid_to,
       CASE WHEN a.scd_action = 'UPDATE' THEN false ELSE c.is_current END AS is_current
FROM cur c LEFT JOIN cls a ON a.user_id = c.user_id
UNION ALL
SELECT * FROM newv"""

_UPSERT_SRC = f"""
e AS (SELECT CASE WHEN event_id % 101 <> 0 THEN event_id END AS event_id, ts, user_id, event_type, value, props FROM events),
tgt AS (SELECT * FROM e WHERE ts < {CUTOFF} AND event_id IS NOT NULL
        UNION ALL SELECT max(event_id), max(ts), max(user_id), max(event_type), max(value), max(props) FROM e WHERE event_id IS NULL),
src0 AS (SELECT event_id, ts, user_id, event_type, value + CAST(1 AS DOUBLE) AS value, props FROM e WHERE ts >= {CUTOFF} - INTERVAL 1 DAY),
src1 AS (SELECT * FROM src0 UNION ALL
         SELECT event_id, ts, user_id, event_type, value + CAST(1 AS DOUBLE), props FROM src0 WHERE user_id % 4 = 0),
src AS (SELECT event_id, ts, user_id, event_type, value, props FROM (
          SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts DESC, value DESC, user_id DESC, event_type DESC, props DESC) AS rn
          FROM src1) WHERE rn = 1)"""

UPSERT = f"""WITH {_UPSERT_SRC}
SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM src WHERE src.event_id IS NOT DISTINCT FROM tgt.event_id)
UNION ALL SELECT * FROM src"""

INSERT_COUNT = f"""WITH {_UPSERT_SRC}
SELECT count(*) AS inserted FROM src WHERE NOT EXISTS (SELECT 1 FROM tgt WHERE src.event_id IS NOT DISTINCT FROM tgt.event_id)"""

NEAREST_REGION = """
WITH p AS (SELECT c_custkey, c_acctbal / CAST(1000 AS DOUBLE) AS x,
                  CAST(c_custkey % 97 AS DOUBLE) / CAST(10 AS DOUBLE) AS y FROM customer),
r AS (SELECT * FROM (VALUES ('North', 0.0, 6.0, 3.0, 9.0), ('East', 5.0, 4.0, 9.0, 8.0),
                            ('South', 1.0, 0.0, 4.0, 3.0), ('West', -1.0, 3.0, 0.5, 5.0))
      t(name, xmin, ymin, xmax, ymax)),
d AS (SELECT p.c_custkey, r.name,
        sqrt(pow(greatest(CAST(r.xmin AS DOUBLE) - x, 0, x - CAST(r.xmax AS DOUBLE)), 2)
           + pow(greatest(CAST(r.ymin AS DOUBLE) - y, 0, y - CAST(r.ymax AS DOUBLE)), 2)) AS dist
      FROM p, r),
m AS (SELECT c_custkey, min(dist) AS md FROM d GROUP BY c_custkey)
SELECT d.c_custkey, d.name AS region FROM d JOIN m ON d.c_custkey = m.c_custkey
WHERE d.dist <= m.md + 1e-9"""

_RUNS = """
runs AS (SELECT event_type AS pipeline_name,
           CASE user_id % 3 WHEN 0 THEN 'bronze' WHEN 1 THEN 'silver' ELSE 'gold' END AS layer,
           CASE WHEN value >= 5 THEN ts END AS last_processed_timestamp,
           CAST(event_id AS VARCHAR) AS batch_id,
           CASE WHEN value <= 450 THEN ts END AS end_time
         FROM events)"""

WATERMARK_TOP1 = f"""WITH {_RUNS},
g AS (SELECT DISTINCT pipeline_name, layer FROM runs),
t AS (SELECT pipeline_name, layer, last_processed_timestamp,
        row_number() OVER (PARTITION BY pipeline_name, layer
                           ORDER BY end_time DESC NULLS LAST, batch_id DESC) AS rn
      FROM runs WHERE last_processed_timestamp IS NOT NULL)
SELECT g.pipeline_name, g.layer,
       coalesce(t.last_processed_timestamp, TIMESTAMP '2011-01-01 00:00:00') AS watermark
FROM g LEFT JOIN t ON g.pipeline_name = t.pipeline_name AND g.layer = t.layer AND t.rn = 1"""

RUN_LOG = """
SELECT 'events' AS pipeline_name, 'bronze' AS layer, max(ts) AS last_processed_timestamp,
       'events/bronze/' || strftime(CAST(ts AS DATE), '%Y-%m-%d') AS batch_id, 'success' AS status,
       count(*) AS records_processed,
       count(*) FILTER (WHERE value < 1) AS records_failed,
       min(ts) AS start_time, max(ts) AS end_time, CAST(NULL AS VARCHAR) AS error_message
FROM events GROUP BY CAST(ts AS DATE)"""


def _health(table, critical, ranges, key, ts, as_of=AS_OF):
    parts = [f"SELECT '{table}' AS table_name, 'table_exists' AS check_name, 'pass' AS status, CAST(NULL AS DOUBLE) AS observed",
             f"SELECT '{table}', 'not_empty', CASE WHEN count(*) = 0 THEN 'fail' ELSE 'pass' END, CAST(count(*) AS DOUBLE) FROM {table}"]
    for c in critical:
        parts.append(f"SELECT '{table}', 'nulls:{c}', CASE WHEN count(*) FILTER (WHERE {c} IS NULL) > 0 THEN 'fail' ELSE 'pass' END, "
                     f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) FROM {table}")
        share = _round(f"(count(*) FILTER (WHERE {c} IS NULL) * CAST(100 AS DOUBLE) / count(*))", 2)
        parts.append(f"SELECT '{table}', 'null_percent:{c}', 'info', {share} FROM {table}")
    if ts:
        age = f"(CAST(date_sub('second', max({ts}), {as_of}) AS DOUBLE) / CAST(3600 AS DOUBLE))"
        parts.append(f"SELECT '{table}', 'freshness', CASE WHEN {age} IS NULL THEN 'fail' WHEN {age} > 48 THEN 'warning' ELSE 'pass' END, "
                     f"{_round(age, 2)} FROM {table}")
    else:
        parts.append(f"SELECT '{table}', 'freshness', 'warning', CAST(NULL AS DOUBLE)")
    for c, (lo, hi) in ranges.items():
        n = f"count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi})"
        parts.append(f"SELECT '{table}', 'range:{c}', CASE WHEN {n} > 0 THEN 'warning' ELSE 'pass' END, CAST({n} AS DOUBLE) FROM {table}")
    n = f"(count(*) - count(DISTINCT {key}))"
    parts.append(f"SELECT '{table}', 'unique:{key}', CASE WHEN {n} > 0 THEN 'fail' ELSE 'pass' END, CAST({n} AS DOUBLE) FROM {table}")
    return "\nUNION ALL\n".join(parts)


HEALTH_REPORT = (_health("orders", ["o_orderkey", "o_custkey", "o_orderdate"], {"o_totalprice": (0, 500000)},
                         "o_orderkey", "o_orderdate")
                 + "\nUNION ALL\n"
                 + _health("customer", ["c_custkey", "c_name", "c_mktsegment"], {"c_acctbal": (-1000, 10000)},
                           "c_custkey", None))


ZORDER_LAYOUT = "SELECT * FROM lineitem"

MAINTENANCE_REPORT = """
WITH t AS (SELECT 'lineitem.parquet' AS "table", count(*) AS n FROM lineitem
           UNION ALL SELECT 'orders.parquet', count(*) FROM orders UNION ALL SELECT 'customer.parquet', count(*) FROM customer)
SELECT "table", 'optimize' AS operation, 'success' AS status, n AS rows_in, n AS rows_out, CAST(0 AS INTEGER) AS errors FROM t
UNION ALL SELECT 'missing.parquet', 'optimize', 'failed', NULL, NULL, 1
UNION ALL SELECT 'TOTAL', 'optimize', 'failed', CAST(sum(n) AS BIGINT), CAST(sum(n) AS BIGINT), 1 FROM t"""

ORACLES = {
    "station_facts": station_facts_sql("parity"),
    "station_facts_corrected": station_facts_sql("corrected"),
    "station_dim": STATION_DIM,
    "weather_dim": WEATHER_DIM,
    "json_path_project": JSON_PATH_PROJECT,
    "json_array_explode": JSON_ARRAY_EXPLODE,
    "observation_flatten": OBSERVATION_FLATTEN,
    "observation_rejects": OBSERVATION_REJECTS,
    "weather_standardize": WEATHER_STANDARDIZE,
    "request_grid": REQUEST_GRID,
    "standardize_values": STANDARDIZE_VALUES,
    "zone_assign": ZONE_ASSIGN,
    "zone_distinct": ZONE_DISTINCT,
    "incremental_filter": INCREMENTAL_FILTER,
    "watermark_buffer": WATERMARK_BUFFER,
    "dedup_rows": DEDUP_ROWS,
    "dedup_latest": DEDUP_LATEST,
    "column_gate": COLUMN_GATE,
    "quarantine_split": QUARANTINE_SPLIT,
    "scd2_classify": SCD2_CLASSIFY,
    "scd2_new_versions": SCD2_NEW_VERSIONS,
    "scd2_expire": SCD2_EXPIRE,
    "scd2_untimed": SCD2_UNTIMED,
    "scd2_apply": SCD2_APPLY,
    "scd2_replay": SCD2_APPLY,
    "scd2_history": SCD2_HISTORY,
    "upsert": UPSERT,
    "insert_count": INSERT_COUNT,
    "nearest_region": NEAREST_REGION,
    "watermark_top1": WATERMARK_TOP1,
    "run_log": RUN_LOG,
    "health_report": HEALTH_REPORT,
    "zorder_layout": ZORDER_LAYOUT,
    "maintenance_report": MAINTENANCE_REPORT,
}

ORACLES["stream_dedup"] = """
SELECT event_id, CASE WHEN event_id % 10 = 7 THEN ts - INTERVAL 3 DAY ELSE ts END AS ts, * EXCLUDE (event_id, ts) FROM events"""
ORACLES["stream_scd2"] = SCD2_HISTORY

_STATION_DOCS = """
docs AS (
  SELECT o.o_custkey, o.o_orderkey, o.o_orderstatus, o.o_orderdate, o.o_orderpriority,
         c.c_name, c.c_mktsegment, c.c_nationkey, c.c_acctbal,
         l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice,
         l.l_returnflag, l.l_linestatus
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey),
base AS (  -- one per UUID; documents without one all stay, re-delivered ones too
  SELECT DISTINCT * FROM docs WHERE o_orderkey % 17 <> 0
  UNION ALL SELECT docs.* FROM docs, (VALUES (1), (2)) t(k) WHERE o_orderkey % 17 = 0 AND (k = 1 OR o_orderpriority = '1-URGENT')),
srows AS (
  SELECT CAST(o_custkey AS VARCHAR) AS station_id, c_name AS title, o_orderpriority AS address,
         c_mktsegment AS town,
         CASE WHEN c_nationkey % 2 = 0 THEN 'New Jersey' ELSE 'New York' END AS state_or_province,
         CASE WHEN o_custkey % 11 IN (3, 5) THEN NULL
              WHEN c_mktsegment <> 'AUTOMOBILE' THEN c_acctbal / CAST(100 AS DOUBLE) END AS latitude,
         CAST(c_nationkey AS DOUBLE) / CAST(10 AS DOUBLE) - CAST(74 AS DOUBLE) AS longitude,
         CASE o_orderstatus WHEN 'F' THEN 'Operational' WHEN 'O' THEN 'Temporarily Unavailable'
              WHEN 'P' THEN 'Planned' END AS status,
         CAST(CASE o_orderstatus WHEN 'F' THEN 50 WHEN 'O' THEN 30 WHEN 'P' THEN 20 END AS INTEGER) AS status_id,
         CASE WHEN o_custkey % 13 <> 1 THEN o_orderdate END AS date_last_status_update, o_orderdate - INTERVAL 30 DAY AS date_created,
         l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_returnflag, l_linestatus, o_custkey, c_mktsegment
  FROM base),
good AS (SELECT * FROM srows WHERE latitude IS NOT NULL AND date_last_status_update IS NOT NULL)"""

SILVER_STATIONS = f"""WITH {_STATION_DOCS}
SELECT station_id, title, address, town, state_or_province, latitude, longitude, status, status_id,
       date_last_status_update, date_created, {_round('latitude', 1)} AS weather_zone_lat,
       {_round('longitude', 1)} AS weather_zone_lon
FROM good"""

SILVER_STATION_REJECTS = f"""WITH {_STATION_DOCS}
SELECT station_id, concat_ws(',',
    CASE WHEN o_custkey % 11 = 3 THEN 'latitude:malformed' WHEN o_custkey % 11 = 5 THEN 'latitude:not_finite'
         WHEN latitude IS NULL THEN 'latitude:null' END,
    CASE WHEN date_last_status_update IS NULL THEN 'date_last_status_update:malformed' END) AS reject_reasons
FROM srows WHERE latitude IS NULL OR date_last_status_update IS NULL"""

SILVER_ROW_BALANCE = f"""WITH {_STATION_DOCS}
SELECT 'bronze' AS part, count(*) AS n FROM base
UNION ALL SELECT 'valid', count(*) FROM good
UNION ALL SELECT 'rejected', (SELECT count(*) FROM srows) - (SELECT count(*) FROM good)"""

_CONNECTORS = f"""WITH {_STATION_DOCS},
conn AS (
  SELECT station_id, l_orderkey, l_linenumber + k * 100 AS connection_type_id, l_linestatus AS connection_type,
         CASE WHEN l_quantity > 45 THEN 3 WHEN l_quantity > 20 THEN 2 ELSE 1 END AS level_id,
         CAST(l_partkey % 100 AS INTEGER) AS amps, l_extendedprice AS voltage,
         l_quantity - CAST(5 AS DOUBLE) AS power_kw, 1 + l_linenumber % 2 AS quantity,
         l_returnflag AS current_type, date_last_status_update
  FROM good, (VALUES (0), (1)) t(k) WHERE k = 0 OR l_quantity > 40)"""

SILVER_CONNECTORS = f"""{_CONNECTORS}
SELECT station_id, connection_type_id, connection_type, level_id, amps, voltage, power_kw, quantity,
       current_type, date_last_status_update
FROM conn WHERE l_orderkey IS NOT NULL AND power_kw >= 0"""

SILVER_CONNECTOR_REJECTS = f"""{_CONNECTORS}
SELECT station_id, date_last_status_update,
       CASE WHEN l_orderkey IS NULL THEN 'connection_type_id:null,level_id:null,quantity:null,power_kw:null'
            ELSE 'power_kw:negative' END AS reject_reasons
FROM conn WHERE l_orderkey IS NULL OR power_kw < 0"""

ORACLES.update({
    "silver_stations": SILVER_STATIONS,
    "silver_station_rejects": SILVER_STATION_REJECTS,
    "silver_connectors": SILVER_CONNECTORS,
    "silver_connector_rejects": SILVER_CONNECTOR_REJECTS,
    "silver_row_balance": SILVER_ROW_BALANCE,
})

ORACLES["nearest_region_parts"] = """
WITH p AS (SELECT c_custkey,
             CASE WHEN c_custkey % 50 IN (7, 9) THEN NULL
                  ELSE c_acctbal / CAST(70 AS DOUBLE) * CASE WHEN c_custkey % 10 = 0 THEN CAST(1000 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END END AS x,
             CAST((c_custkey * 31) % 1009 AS DOUBLE) / CAST(8 AS DOUBLE)
               * CASE WHEN c_custkey % 10 = 0 THEN CAST(1000 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS y FROM customer),
r0 AS (SELECT 'part-' || p_partkey AS name, CAST((p_partkey * 7919) % 10007 AS DOUBLE) / CAST(100 AS DOUBLE) AS x0,
         CAST((p_partkey * 104729) % 10007 AS DOUBLE) / CAST(100 AS DOUBLE) AS y0,
         CASE WHEN p_partkey % 97 = 0 THEN CAST(20 AS DOUBLE) ELSE CAST(p_size AS DOUBLE) / CAST(50 AS DOUBLE) END AS w FROM part),
r AS (SELECT name, x0, y0, x0 + w AS x1, y0 + w AS y1 FROM r0),
d AS (SELECT c_custkey, name, sqrt(pow(greatest(x0 - x, 0, x - x1), 2) + pow(greatest(y0 - y, 0, y - y1), 2)) AS dist FROM p, r WHERE x IS NOT NULL),
m AS (SELECT c_custkey, min(dist) AS md FROM d GROUP BY c_custkey)
SELECT d.c_custkey, d.name AS region FROM d JOIN m ON d.c_custkey = m.c_custkey WHERE d.dist <= m.md + 1e-9
UNION ALL SELECT c_custkey, NULL FROM p WHERE x IS NULL"""

ORACLES["neighbor_hot_key"] = """
WITH e AS (SELECT CASE WHEN event_type <> 'error' THEN event_type END AS kind, event_id, ts, value FROM events)
SELECT kind, event_id, ts, value, lag(ts) OVER w AS prev_ts, lead(value) OVER w AS next_value FROM e WINDOW w AS (PARTITION BY kind ORDER BY ts, event_id)"""

ORACLES["nearest_region_shapes"] = """
WITH p AS (SELECT c_custkey, c_acctbal / CAST(70 AS DOUBLE) AS x, CAST((c_custkey * 31) % 1009 AS DOUBLE) / CAST(8 AS DOUBLE) AS y FROM customer),
r AS (SELECT p_partkey AS k, 'part-' || p_partkey AS name,
        CASE WHEN p_partkey = 5 THEN CAST(1e6 AS DOUBLE) ELSE CAST((p_partkey * 7919) % 10007 AS DOUBLE) / CAST(100 AS DOUBLE) END AS x0,
        CASE WHEN p_partkey = 5 THEN CAST(1e6 AS DOUBLE) ELSE CAST((p_partkey * 104729) % 10007 AS DOUBLE) / CAST(100 AS DOUBLE) END AS y0,
        CAST(p_size AS DOUBLE) / CAST(8 AS DOUBLE) AS w FROM part),
d AS (SELECT c_custkey, name, CASE
        WHEN k % 3 = 0 AND x > x0 + w * 0.25 AND x < x0 + w * 0.75 AND y > y0 + w * 0.25 AND y < y0 + w * 0.75
        THEN least(x - x0 - w * 0.25, x0 + w * 0.75 - x, y - y0 - w * 0.25, y0 + w * 0.75 - y)
        ELSE least(sqrt(pow(greatest(x0 - x, 0, x - x0 - w), 2) + pow(greatest(y0 - y, 0, y - y0 - w), 2)),
          CASE WHEN k % 3 = 1 THEN sqrt(pow(greatest(x0 + w * 2 - x, 0, x - x0 - w * 2.5), 2) + pow(greatest(y0 - y, 0, y - y0 - w * 0.5), 2)) ELSE 1e300 END)
        END AS dist FROM p, r),
m AS (SELECT c_custkey, min(dist) AS md FROM d GROUP BY c_custkey)
SELECT d.c_custkey, d.name AS region FROM d JOIN m ON d.c_custkey = m.c_custkey WHERE d.dist <= m.md + 1e-9"""

LANDING_INGEST = f"""WITH {_STATION_DOCS}
SELECT
  CASE WHEN o_orderkey % 17 <> 0 THEN concat_ws('-', o_orderkey, l_linenumber, l_partkey, l_suppkey,
            CAST(round(l_quantity * 100) AS BIGINT), CAST(round(l_extendedprice * 100) AS BIGINT),
            l_returnflag, l_linestatus) END AS UUID,
  'https://example.org/' || c_mktsegment AS source_file,
  TIMESTAMP '2024-01-31 00:00:00' AS ingest_timestamp, true AS has_text
FROM base"""

ORACLES["landing_ingest"] = LANDING_INGEST

STATION_DIM_CORRECTED = f"""{ROLES},
q AS (
  SELECT v.* FROM versions v
  WHERE v.status_id IN (50, 30)
    AND EXISTS (SELECT 1 FROM weather w WHERE w.zone = v.weather_zone)
    AND EXISTS (SELECT 1 FROM connectors c WHERE c.station_id = v.station_id)),
l AS (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY date_last_status_update DESC, station_sk DESC) AS rn FROM q),
p AS (SELECT station_id, max(power_kw) AS max_power_kw FROM connectors GROUP BY station_id)
SELECT l.station_id, title, address, town, state_or_province, latitude, longitude, p.max_power_kw,
       {AS_OF} AS ingest_timestamp
FROM l JOIN p ON p.station_id = l.station_id WHERE rn = 1"""

ORACLES["station_dim_corrected"] = STATION_DIM_CORRECTED

ORACLES["scd2_apply_all_versions"] = SCD2_HISTORY


def _classify_nullable(changed: str) -> str:
    status = "CASE WHEN event_type <> 'error' THEN event_type END"
    return f"""WITH
h0 AS (SELECT user_id, {status} AS status, ts, event_id FROM events WHERE ts < {CUTOFF}),
h1 AS (SELECT *, lag(status) OVER w AS p_status, lag(1) OVER w AS p_exists FROM h0
       WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
h2 AS (SELECT * FROM h1 WHERE p_exists IS NULL OR p_status IS DISTINCT FROM status),
cur AS (SELECT * FROM (SELECT user_id, status, ts AS valid_from,
          row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM h2) WHERE rn = 1),
stg AS (SELECT * FROM (SELECT user_id, {status} AS status, ts,
          row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
        FROM events WHERE ts >= {CUTOFF}) WHERE rn = 1)
SELECT s.user_id,
  CASE WHEN c.valid_from IS NULL THEN 'INSERT'
       WHEN s.ts > c.valid_from AND coalesce({changed}, false) THEN 'UPDATE' END AS scd_action
FROM stg s LEFT JOIN cur c ON s.user_id = c.user_id"""


ORACLES["scd2_classify_nullsafe"] = _classify_nullable("s.status IS DISTINCT FROM c.status")
ORACLES["scd2_classify_parity"] = _classify_nullable("s.status <> c.status")

ORACLES["station_facts_zones"] = station_facts_sql("parity")
ORACLES["station_facts_store"] = station_facts_sql("parity")

ORACLES["null_removal"] = """
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_nationkey % 4 <> 0 AND c_name IS NOT NULL AND c_acctbal > 0"""

ORACLES["surrogate_keys"] = """
WITH p AS (SELECT DISTINCT CASE WHEN user_id % 3 <> 0 THEN user_id END AS a, CASE WHEN event_type <> 'error' THEN event_type END AS b,
             CAST(ts AS DATE) AS c FROM events)
SELECT count(*) AS combinations, count(*) AS keys, CAST(1 AS BIGINT) AS keys_per_combination FROM p"""

ORACLES["counted_sinks"] = """
WITH n AS (SELECT count(*) AS a, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus = 'O') AS o FROM orders)
SELECT 'created' AS step, CAST(0 AS BIGINT) AS reported, CAST(0 AS BIGINT) AS read_back UNION ALL SELECT 'created_again', 0, 0
UNION ALL SELECT 'written', a, a + f FROM n UNION ALL SELECT 'appended', f, f FROM n
UNION ALL SELECT 'published', a, a FROM n UNION ALL SELECT 'published_later', o, o FROM n"""

_AILING = """
o AS (SELECT CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey END AS o_orderkey, o_totalprice, o_orderdate FROM orders),
ailing AS (SELECT * FROM o UNION ALL SELECT * FROM o WHERE o_orderkey % 4 = 0)"""
_AILING_ROWS = (_health("ailing", ["o_orderkey", "o_orderdate"], {"o_totalprice": (0, 100000)}, "o_orderkey", "o_orderdate",
                        "TIMESTAMP '2034-02-01 00:00:00'").replace("'ailing'", "'orders'")
                .replace("count(DISTINCT o_orderkey)", "count(DISTINCT o_orderkey)") + """
UNION ALL SELECT 'customer', 'table_exists', 'pass', NULL UNION ALL SELECT 'customer', 'not_empty', 'fail', 0
UNION ALL SELECT 'customer', 'nulls:c_custkey', 'skipped', 0 UNION ALL SELECT 'customer', 'null_percent:c_custkey', 'skipped', NULL
UNION ALL SELECT 'customer', 'freshness', 'skipped', NULL UNION ALL SELECT 'customer', 'range:c_acctbal', 'skipped', 0
UNION ALL SELECT 'customer', 'unique:c_custkey', 'skipped', 0 UNION ALL SELECT 'gone', 'table_exists', 'fail', NULL""")
ORACLES["health_findings"] = f"WITH {_AILING}\n{_AILING_ROWS}"


ORACLES["health_merged"] = f"WITH {_AILING}\nSELECT * FROM ({_AILING_ROWS}) WHERE table_name IN ('orders', 'gone')"


def _verdict(rows: str, tables: str) -> str:
    return f"""SELECT count(*) FILTER (WHERE status = 'pass') AS passed, count(*) FILTER (WHERE status = 'fail') AS failed,
  count(*) FILTER (WHERE status = 'warning') AS warnings, count(*) FILTER (WHERE status = 'fail') = 0 AS healthy, '{tables}' AS tables
FROM ({rows})"""


ORACLES["health_verdict"] = f"WITH {_AILING}\n{_verdict(_AILING_ROWS, 'ailing')}\nUNION ALL\n{_verdict(HEALTH_REPORT, 'sound')}"

# documents of one station and day with equal status are one version; of equal times the lower status comes first
ORACLES["run_station_history"] = f"""WITH {_STATION_DOCS},
h1 AS (SELECT station_id, status_id, date_last_status_update AS ts, lag(status_id) OVER w AS p, lag(1) OVER w AS e FROM good
       WINDOW w AS (PARTITION BY station_id ORDER BY date_last_status_update, status_id)),
h2 AS (SELECT * FROM h1 WHERE e IS NULL OR p IS DISTINCT FROM status_id)
SELECT station_id, status_id, ts AS valid_from, coalesce(lead(ts) OVER w, {OPEN_END}) AS valid_to, lead(ts) OVER w IS NULL AS is_current
FROM h2 WINDOW w AS (PARTITION BY station_id ORDER BY ts, status_id)"""

# the runs: documents of even customers, then of odd ones with every tenth customer's again; weather before the
# first stamp, then from 15 minutes before it on
_RUN1, _RUN2 = "TIMESTAMP '2024-01-10 00:00:00'", "TIMESTAMP '2024-01-20 00:00:00'"
_LANDED = "(VALUES (1), (2)) r(run) WHERE (run = 1 AND k % 2 = 0) OR (run = 2 AND (k % 2 = 1 OR k % 10 = 0))"
_STAMP = f"CASE run WHEN 1 THEN {_RUN1} ELSE {_RUN2} END"
_RUN_CONNECTORS = f"""{_CONNECTORS},
vconn AS (SELECT *, CAST(station_id AS BIGINT) AS k, l_orderkey IS NOT NULL AND power_kw >= 0 AS ok FROM conn),
cl AS (SELECT *, lag(1) OVER w AS e, lag((amps, voltage, power_kw, quantity, current_type)) OVER w AS p FROM vconn WHERE ok
       WINDOW w AS (PARTITION BY station_id, connection_type_id, level_id ORDER BY date_last_status_update, amps, voltage, power_kw, quantity, current_type)),
cv AS (SELECT * FROM cl WHERE e IS NULL OR p IS DISTINCT FROM (amps, voltage, power_kw, quantity, current_type))"""
_RUN_WEATHER = f"""
wx AS (SELECT event_id, ts + to_hours(event_id % 4) AS ts, c_acctbal / CAST(100 AS DOUBLE) + CAST(event_id % 4 AS DOUBLE) * CAST(0.00001 AS DOUBLE) AS lat0,
         CAST(c_nationkey AS DOUBLE) / CAST(10 AS DOUBLE) - CAST(74 AS DOUBLE) AS lon0, {WEATHER_MAIN} AS weather, event_type AS description, value AS temp,
         CAST(1000 + user_id % 50 AS INTEGER) AS pressure, CAST(event_id % 101 AS INTEGER) AS humidity, 10000 AS visibility,
         CASE WHEN event_type = 'purchase' THEN value ELSE CAST(0 AS DOUBLE) END AS rain, CASE WHEN event_type = 'signup' THEN value ELSE CAST(0 AS DOUBLE) END AS snow,
         value / CAST(10 AS DOUBLE) AS wind_speed, CAST(event_id % 101 AS INTEGER) AS clouds, date_trunc('second', events.ts + to_hours(event_id % 4)) AS dt_utc
       FROM events JOIN customer ON c_custkey = event_id // 4),
wr AS (SELECT *, {_round('lat0', 1)} AS lat, {_round('lon0', 1)} AS lon, {_STAMP} AS ingest_timestamp FROM wx, (VALUES (1), (2)) r(run)
       WHERE (run = 1 AND ts < {_RUN1}) OR (run = 2 AND ts >= {_RUN1} - INTERVAL 15 MINUTE))"""
_RUN_FACTS = f"""{_RUN_CONNECTORS},
{_RUN_WEATHER},
sdocs AS (SELECT *, CAST(station_id AS BIGINT) AS k FROM good),
h1 AS (SELECT *, lag(status_id) OVER w AS p, lag(1) OVER w AS e FROM sdocs WINDOW w AS (PARTITION BY station_id ORDER BY date_last_status_update, status_id)),
vers AS (SELECT station_id, any_value(k) AS k, max(date_last_status_update) - INTERVAL 30 DAY AS created, any_value({_round('latitude', 1)}) AS zlat, any_value({_round('longitude', 1)}) AS zlon
         FROM h1 WHERE (e IS NULL OR p IS DISTINCT FROM status_id) AND status_id IN (50, 30) GROUP BY station_id),
cur AS (SELECT *, row_number() OVER (PARTITION BY station_id, connection_type_id, level_id
            ORDER BY date_last_status_update DESC, amps DESC, voltage DESC, power_kw DESC, quantity DESC) AS rn FROM vconn WHERE ok),
power AS (SELECT station_id, max(level_id) AS max_level, sum(power_kw * quantity) AS power FROM cur WHERE rn = 1 GROUP BY station_id),
runs AS (SELECT 1 AS rno UNION ALL SELECT 2),
zone AS (SELECT rno, round(lat * 10) AS a, round(lon * 10) AS o, arg_max(weather, dt_utc) AS weather, arg_max(temp, dt_utc) AS temp
         FROM wr JOIN runs ON run <= rno GROUP BY 1, 2, 3),
facts AS (SELECT v.station_id, rno, CASE rno WHEN 1 THEN {_RUN1} ELSE {_RUN2} END AS stamp, created, max_level, power, weather, temp
          FROM vers v JOIN power USING (station_id) JOIN zone ON round(zlat * 10) = a AND round(zlon * 10) = o WHERE rno = 2 OR k % 2 = 0),
wdim AS (SELECT DISTINCT rno, w.event_id, w.run FROM wr w JOIN runs ON w.run <= rno
         WHERE EXISTS (SELECT 1 FROM vers v JOIN power USING (station_id) WHERE round(zlat * 10) = round(w.lat * 10) AND round(zlon * 10) = round(w.lon * 10)
                       AND (rno = 2 OR k % 2 = 0)))"""

ORACLES["run_control_rows"] = f"""{_RUN_FACTS},
n AS (SELECT o_custkey AS k, count(*) AS n, count(*) FILTER (WHERE latitude IS NOT NULL AND date_last_status_update IS NOT NULL) AS ok FROM srows GROUP BY 1),
c AS (SELECT k, count(*) FILTER (WHERE ok) AS ok, count(*) FILTER (WHERE NOT ok) AS bad FROM vconn GROUP BY k),
ns AS (SELECT run, sum(n) AS n, sum(ok) AS ok FROM n, {_LANDED} GROUP BY run), cs AS (SELECT run, sum(ok) AS ok, sum(bad) AS bad FROM c, {_LANDED} GROUP BY run)
SELECT pipeline_name, layer, status, CAST(a AS BIGINT) AS records_processed, CAST(b AS BIGINT) AS records_failed, t AS last_processed_timestamp FROM (
SELECT 'stations' AS pipeline_name, 'bronze' AS layer, 'success' AS status, n AS a, 0 AS b, {_STAMP} AS t FROM ns
UNION ALL SELECT 'stations', 'bronze', 'skipped', 0, 0, {_RUN2} UNION ALL SELECT 'stations', 'silver', 'success', 0, 0, {_RUN2}
UNION ALL SELECT 'stations', 'silver', 'success', ok, n - ok, {_STAMP} FROM ns
UNION ALL SELECT 'connectors', 'silver', 'success', ok, bad, {_STAMP} FROM cs
UNION ALL SELECT 'weather', 'silver', 'success', count(*) + CASE run WHEN 1 THEN count(*) FILTER (WHERE event_id % 9 = 0) ELSE 0 END, 0, {_STAMP} FROM wr GROUP BY run
UNION ALL SELECT 'weather', 'silver', 'success', 0, 0, {_RUN2}
UNION ALL SELECT 'marts', 'gold', 'success', count(*), 0, any_value(stamp) FROM facts GROUP BY rno)"""

ORACLES["run_connector_history"] = f"""{_RUN_CONNECTORS}
SELECT station_id, CAST(connection_type_id AS INTEGER) AS connection_type_id, CAST(level_id AS INTEGER) AS level_id, power_kw, CAST(quantity AS INTEGER) AS quantity,
       date_last_status_update AS valid_from, coalesce(lead(date_last_status_update) OVER w, {OPEN_END}) AS valid_to, lead(1) OVER w IS NULL AS is_current
FROM cv WINDOW w AS (PARTITION BY station_id, connection_type_id, level_id ORDER BY date_last_status_update, amps, voltage, power_kw, quantity, current_type)"""

ORACLES["run_weather_rows"] = f"""WITH {_RUN_WEATHER}
SELECT lat, lon, weather, description, temp, pressure, humidity, visibility, rain, snow, wind_speed, clouds, dt_utc, ingest_timestamp FROM wr"""

ORACLES["run_gold_facts"] = f"""{_RUN_FACTS}
SELECT station_id, stamp AS ingest_timestamp, date_diff('minute', created, stamp) AS total_duration, risk AS risk_score,
       CASE WHEN risk < 60 THEN 'low_risk' ELSE 'high_risk' END AS risk_severity_level, {_round('CAST(0.35 AS DOUBLE) * power', 0)} AS avg_energy_cost_per_hour
FROM (SELECT *, 15 + CASE WHEN weather ILIKE '%storm%' OR weather ILIKE '%snow%' THEN 30 ELSE 0 END + CASE WHEN temp > 95 OR temp < 20 THEN 30 ELSE 0 END
             + CASE WHEN max_level = 3 THEN 25 ELSE 0 END AS risk FROM facts)"""

ORACLES["run_gold_dims"] = f"""{_RUN_FACTS}
SELECT 'station_dim' AS dim, stamp AS ingest_timestamp, count(*) AS n FROM facts GROUP BY ALL
UNION ALL SELECT 'weather_dim', CASE rno WHEN 1 THEN {_RUN1} ELSE {_RUN2} END, count(*) FROM wdim GROUP BY rno"""
