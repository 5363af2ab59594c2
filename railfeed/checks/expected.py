"""The fixture records as relations, for SQL that never sees payload text."""

from __future__ import annotations

STATIONS = """
st AS (
  SELECT s_suppkey AS sk, s_nationkey AS nk, b, s_suppkey * 2 + b AS raw_id, CAST(s_suppkey AS VARCHAR) AS station_id,
         (CASE WHEN s_nationkey % 2 = 0 THEN 'Brem ' ELSE 'Hamb ' END) || s_name || (CASE WHEN b = 1 THEN ' v2' ELSE '' END) AS name,
         'db_stations_2024010' || CAST(b + 1 AS VARCHAR) || '000000_00000000' AS batch_id,
         TIMESTAMP '2024-01-01 00:00:00' + b * INTERVAL 1 DAY AS created_at
  FROM supplier CROSS JOIN (VALUES (0), (1)) v(b) WHERE b = 0 OR s_suppkey % 3 = 0),
st_eva AS (
  SELECT raw_id, station_id, i AS pos, CAST(8000000 + sk * 4 + i AS VARCHAR) AS eva_number,
         CASE (i + sk) % 3 WHEN 1 THEN FALSE WHEN 2 THEN TRUE END AS is_main,
         (47000000 + (sk * 102947 + i * 10007) % 8000000) / 1e6 AS latitude,
         (6000000 + (sk * 104729 + i * 5003) % 9000000) / 1e6 AS longitude
  FROM st, UNNEST(range(sk % 4)) t(i)),
st_ril AS (
  SELECT raw_id, i AS pos, (CASE WHEN (nk + i) % 2 = 0 THEN '"HB"' ELSE 'XX' END) || CAST(sk AS VARCHAR) || '_' || CAST(i AS VARCHAR) AS ds100,
         (sk + i) % 2 = 0 AS is_main
  FROM st, UNNEST(range(CASE WHEN sk % 5 > 0 THEN sk % 5 % 3 ELSE 0 END)) t(i)),
eva_one AS (SELECT DISTINCT ON (raw_id) * FROM st_eva ORDER BY raw_id, is_main DESC NULLS LAST, pos),
ril_one AS (SELECT DISTINCT ON (raw_id) * FROM st_ril ORDER BY raw_id, is_main DESC NULLS LAST, pos),
assembled AS (
  SELECT st.raw_id, st.station_id, st.name, e.latitude, e.longitude, r.ds100, e.eva_number, st.created_at
  FROM st LEFT JOIN eva_one e ON e.raw_id = st.raw_id LEFT JOIN ril_one r ON r.raw_id = st.raw_id),
stations AS (
  SELECT DISTINCT ON (station_id) * FROM assembled ORDER BY station_id, created_at DESC NULLS FIRST, raw_id DESC),
region AS (
  SELECT * FROM stations WHERE name LIKE 'Brem%' AND replace(ds100, '"', '') LIKE 'HB%'),
region_xy AS (
  SELECT station_id, latitude, longitude FROM region WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND eva_number IS NOT NULL)
"""

WEATHER = """
wx AS (
  SELECT event_id AS e, user_id AS u, event_type, value, b, event_id * 2 + b AS raw_id, event_id % 50 = 49 AS broken,
         (event_id // 50) % 5 AS defect, CAST(json_extract_string(props, '$.k') AS INT) AS k, 1 + event_id % 4 AS n,
         date_trunc('hour', ts) AS h0, '2024010' || CAST(b + 1 AS VARCHAR) || '000000_00000000' AS stamp,
         CASE WHEN user_id % 11 = 0 THEN NULL WHEN user_id % 3 = 0 THEN (47000050 + (user_id * 102947) % 8000000) / 1e6
              ELSE (47000000 + (user_id * 52711) % 8000000) / 1e6 END AS latitude,
         CASE WHEN user_id % 3 = 0 THEN (6000050 + (user_id * 104729) % 9000000) / 1e6
              ELSE (6000000 + (user_id * 35317) % 9000000) / 1e6 END AS longitude
  FROM events CROSS JOIN (VALUES (0), (1)) v(b) WHERE b = 0 OR user_id % 2 = 0),
wx_hour AS (
  SELECT raw_id AS psa_id, e, stamp, u, latitude, longitude, i AS pos, strftime(h0 + i * INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M') AS "time",
         CASE WHEN event_type = 'error' AND i = 0 THEN NULL ELSE value + b + i END AS temperature_2m,
         CASE WHEN event_type = 'error' AND i = 0 THEN NULL ELSE value + b + 100 + i END AS temperature_later,
         CASE WHEN e % 5 = 0 AND i = n - 1 THEN NULL ELSE CAST(k + i AS INT) END AS weather_code,
         CASE WHEN e % 7 = 0 THEN NULL ELSE (k % 10 + 0.5::DOUBLE * i) END AS precipitation
  FROM wx, UNNEST(range(n)) t(i) WHERE NOT broken),
fc AS (SELECT *, 0 AS obj_pos, 'open_meteo_' || stamp AS batch_id FROM wx_hour),
hist AS (
  SELECT * FROM (
    SELECT * EXCLUDE (temperature_later), 0 AS obj_pos, 'open_meteo_archive_' || stamp AS batch_id FROM wx_hour
    UNION ALL BY NAME
    SELECT * EXCLUDE (temperature_2m, temperature_later), temperature_later AS temperature_2m, 1 AS obj_pos, 'open_meteo_archive_' || stamp AS batch_id
    FROM wx_hour WHERE e % 6 = 4))
"""

# brute force: every coordinate against every station of the region
MATCHED = """
spots AS (SELECT DISTINCT latitude, longitude FROM wx WHERE latitude IS NOT NULL AND longitude IS NOT NULL),
matched AS (
  SELECT p.latitude, p.longitude,
         COALESCE(MIN(CASE WHEN abs(p.latitude - s.latitude) < 1e-4 AND abs(p.longitude - s.longitude) < 1e-4 THEN s.station_id END),
           (list(s.station_id ORDER BY (p.latitude - s.latitude) * (p.latitude - s.latitude)
              + (p.longitude - s.longitude) * (p.longitude - s.longitude), s.station_id))[1]) AS station_id
  FROM spots p CROSS JOIN region_xy s GROUP BY p.latitude, p.longitude)
"""

XML = """
o AS (
  SELECT o_orderkey AS ok, o_custkey AS ck, o_orderpriority AS pri, o_orderdate + INTERVAL 25 YEAR AS base,
         '20240101_00000' || CAST(o_orderkey % 2 AS VARCHAR) AS stamp, '2024-01-01T00:00:0' || CAST(o_orderkey % 2 AS VARCHAR) || 'Z' AS arrived
  FROM orders WHERE o_orderkey % 40 <> 39),
s AS (
  SELECT o.*, j, ok * 10 + j AS sid, CAST(ok * 10 + j AS VARCHAR) AS s_id, 'S' || CAST(ck AS VARCHAR) AS station, CAST(ck AS VARCHAR) AS eva,
         (ok * 10 + j) % 11 <> 0 AS has_tl
  FROM o, UNNEST(range(1 + ok % 2)) t(j)),
node0 AS (
  SELECT s.*, 'ar' AS node, 0 AS d, i FROM s, UNNEST(range((ok + j) % 3)) t(i)
  UNION ALL
  SELECT s.*, 'dp', 1, i FROM s, UNNEST(range((ok + 2 * j + 1) % 3)) t(i)),
node1 AS (
  SELECT *, ok + j + 3 * i + d AS q, base + (ok % 1440 + 7 * i + 3 * d) * INTERVAL 1 MINUTE AS planned FROM node0),
nodes AS (
  SELECT *, CASE WHEN q % 19 = 0 THEN NULL WHEN q % 23 = 0 THEN '2024-13-01T09:00:00Z' ELSE strftime(planned, '%Y-%m-%dT%H:%M:00Z') END AS pt_iso,
         CASE WHEN q % 5 <> 0 THEN strftime(planned + (q % 60) * INTERVAL 1 MINUTE, '%Y-%m-%dT%H:%M:00Z') END AS ct_iso,
         CASE WHEN q % 19 = 0 OR q % 23 = 0 THEN NULL ELSE planned END AS pt,
         CASE WHEN q % 5 <> 0 THEN planned + (q % 60) * INTERVAL 1 MINUTE END AS ct,
         CAST(q % 12 AS VARCHAR) AS pp, CASE WHEN q % 4 = 0 THEN CAST(q % 12 AS VARCHAR) || 'a' END AS cp,
         CASE q % 4 WHEN 0 THEN '' WHEN 1 THEN 'RS1' WHEN 2 THEN '51' END AS l,
         CASE WHEN q % 15 = 0 THEN 'A|' WHEN q % 3 = 0 THEN 'A|B' || CAST(ck AS VARCHAR) WHEN q % 3 = 1 THEN '' END AS ppth,
         CASE WHEN q % 2 = 0 THEN 'C|D&E' END AS cpth, (q * 3 + 1) % 4 % 3 AS nm
  FROM node1),
msg0 AS (
  SELECT sid, ok, base, 's' AS parent, 0 AS i, x, ok * 2 + j + 5 * x AS w FROM s, UNNEST(range(((ok + j) * 7 + 2) % 5 % 3)) t(x)
  UNION ALL
  SELECT sid, ok, base, node, i, x, q + 5 * x FROM nodes, UNNEST(range(nm)) t(x)),
msg AS (
  SELECT sid, parent, i, x, CASE WHEN w % 13 <> 0 THEN 'M' || CAST(ok AS VARCHAR) || '_' || CAST(w AS VARCHAR) END AS id,
         CASE w % 3 WHEN 0 THEN 'f' WHEN 1 THEN 'h' ELSE 'd' END AS t,
         CASE w % 3 WHEN 1 THEN 'Störung' WHEN 2 THEN 'Information' END AS cat,
         CASE w % 5 WHEN 0 THEN '0' WHEN 1 THEN '12' WHEN 2 THEN 'x' WHEN 3 THEN '-3' END AS c,
         CASE w % 5 WHEN 0 THEN 0 WHEN 1 THEN 12 END AS delay,
         COALESCE(w % 3 = 0 AND w % 5 = 1, FALSE) AS cancels,
         CASE w % 4 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN 'a' END AS pr,
         CASE w % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 END AS priority,
         CASE WHEN w % 4 <> 0 THEN base + (w % 1440) * INTERVAL 1 MINUTE END AS any_time,
         CASE WHEN w % 4 IN (1, 2) THEN strftime(base + (w % 1440) * INTERVAL 1 MINUTE, '%Y-%m-%dT%H:%M:00Z') END AS ts_iso,
         CASE WHEN w % 3 = 1 THEN base END AS valid_from, CASE WHEN w % 3 = 1 THEN base + INTERVAL 1 DAY END AS valid_to
  FROM msg0),
last_m AS (SELECT DISTINCT ON (sid, parent, i) * FROM msg WHERE parent <> 's' ORDER BY sid, parent, i, x DESC)
"""

FCHG = """
svc AS (
  SELECT s.sid, s.s_id, s.ok, s.stamp, s.eva AS eva_number, s.station AS station_name, 'FCHG_' || s.stamp AS batch_id,
         CASE WHEN a.l IS NULL OR a.l = '' THEN p.l ELSE a.l END AS train_name,
         COALESCE(
           CASE WHEN COALESCE(a.ppth, '') <> '' THEN split_part(a.ppth, '|', -1) WHEN COALESCE(a.cpth, '') <> '' THEN split_part(a.cpth, '|', -1) END,
           CASE WHEN COALESCE(p.ppth, '') <> '' THEN split_part(p.ppth, '|', -1) WHEN COALESCE(p.cpth, '') <> '' THEN split_part(p.cpth, '|', -1) END
         ) AS final_destination_station,
         CASE WHEN s.has_tl THEN s.pri END AS train_type, s.s_id AS train_line_ride_id,
         CAST(CASE WHEN a.l = '51' OR p.l = '51' THEN 51 END AS BIGINT) AS train_line_station_num,
         a.pt AS arrival_planned_time, a.ct AS arrival_change_time, p.pt AS departure_planned_time, p.ct AS departure_change_time,
         a.sid IS NOT NULL AS has_ar, p.sid IS NOT NULL AS has_dp,
         EXISTS (SELECT 1 FROM msg WHERE msg.sid = s.sid AND msg.parent <> 's' AND msg.i = 0 AND msg.cancels) AS service_canceled
  FROM s LEFT JOIN nodes a ON a.sid = s.sid AND a.node = 'ar' AND a.i = 0 LEFT JOIN nodes p ON p.sid = s.sid AND p.node = 'dp' AND p.i = 0),
fchg_m AS (
  SELECT svc.*, 'm' AS source_node, m.delay AS delay_in_min, m.any_time AS event_time, m.cancels OR svc.service_canceled AS is_canceled,
         m.t AS "type", m.cat AS category, m.priority, m.id AS message_id
  FROM svc JOIN msg m ON m.sid = svc.sid AND m.parent = 's'),
fchg_n AS (
  SELECT n.*, lm.delay AS delay_in_min, lm.any_time AS event_time, n.service_canceled AS is_canceled,
         lm.t AS "type", CAST(NULL AS VARCHAR) AS category, lm.priority, lm.id AS message_id
  FROM (SELECT *, 'ar' AS source_node FROM svc WHERE has_ar UNION ALL SELECT *, 'dp' FROM svc WHERE has_dp) n
  LEFT JOIN last_m lm ON lm.sid = n.sid AND lm.parent = n.source_node AND lm.i = 0),
fchg AS (SELECT * FROM fchg_m UNION ALL BY NAME SELECT * FROM fchg_n)
"""

PLAN = """
plan AS (
  SELECT DISTINCT station AS station_name, s_id AS train_line_ride_id, CASE WHEN has_tl THEN CAST(j AS VARCHAR) END AS train_number,
         CASE WHEN has_tl THEN pri END AS train_category, CASE WHEN has_tl AND ok % 4 <> 0 THEN 'p' END AS train_type,
         CASE WHEN has_tl THEN 'F' || CAST(ck % 50 AS VARCHAR) END AS train_direction, node AS event_type, pt AS event_time,
         pp AS platform, l AS train_line_name, ppth AS route_path, 'PLAN_' || stamp AS batch_id
  FROM nodes)
"""

RCHG = """
rchg_m AS (
  SELECT s.s_id AS event_id, s.eva AS eva_number, s.station AS station_name, m.id AS message_id, 'm' AS event_type, m.cat AS category,
         m.t AS change_type, m.priority, m.valid_from, m.valid_to, CAST(NULL AS TIMESTAMP) AS old_time, CAST(NULL AS TIMESTAMP) AS new_time,
         m.delay AS delay_minutes, CAST(NULL AS VARCHAR) AS platform, CAST(NULL AS VARCHAR) AS platform_change, CAST(NULL AS VARCHAR) AS route,
         CAST(NULL AS VARCHAR) AS train_line_name, COALESCE(m.ts_iso, s.arrived) AS ts_event, 'RCHG_' || s.stamp AS batch_id,
         sha1(concat_ws('|', s.s_id, s.eva, s.station, COALESCE(m.id, ''), 'm', COALESCE(m.cat, ''), m.t, COALESCE(m.pr, ''),
           COALESCE(strftime(m.valid_from, '%Y-%m-%dT%H:%M:%SZ'), ''), COALESCE(strftime(m.valid_to, '%Y-%m-%dT%H:%M:%SZ'), ''), '', '',
           COALESCE(m.c, ''), '', '', '', COALESCE(m.ts_iso, s.arrived))) AS event_hash, s.ok, s.j, 0 AS kind_no, m.x AS ord
  FROM s JOIN msg m ON m.sid = s.sid AND m.parent = 's'),
rchg_n AS (
  SELECT n.s_id AS event_id, n.eva AS eva_number, n.station AS station_name, m.id AS message_id, n.node AS event_type, m.cat AS category,
         m.t AS change_type, CAST(NULL AS INT) AS priority, m.valid_from, m.valid_to, n.pt AS old_time, n.ct AS new_time,
         m.delay AS delay_minutes, n.pp AS platform, n.cp AS platform_change, n.ppth AS route, n.l AS train_line_name,
         COALESCE(n.ct_iso, m.ts_iso, n.arrived) AS ts_event, 'RCHG_' || n.stamp AS batch_id,
         sha1(concat_ws('|', n.s_id, n.eva, n.station, COALESCE(m.id, ''), n.node, COALESCE(m.cat, ''), COALESCE(m.t, ''), '',
           COALESCE(strftime(m.valid_from, '%Y-%m-%dT%H:%M:%SZ'), ''), COALESCE(strftime(m.valid_to, '%Y-%m-%dT%H:%M:%SZ'), ''),
           COALESCE(n.pt_iso, ''), COALESCE(n.ct_iso, ''), COALESCE(m.c, ''), n.pp, COALESCE(n.cp, ''), COALESCE(n.ppth, ''),
           COALESCE(n.ct_iso, m.ts_iso, n.arrived), COALESCE(n.l, ''))) AS event_hash, n.ok, n.j, CASE n.node WHEN 'dp' THEN 1 ELSE 2 END AS kind_no, n.i AS ord
  FROM nodes n LEFT JOIN last_m m ON m.sid = n.sid AND m.parent = n.node AND m.i = n.i),
rchg_all AS (
  SELECT * REPLACE (CAST(strptime(ts_event, '%Y-%m-%dT%H:%M:%SZ') AS TIMESTAMP) AS ts_event) FROM (SELECT * FROM rchg_m UNION ALL SELECT * FROM rchg_n)),
rchg AS (SELECT DISTINCT ON (event_hash) * FROM rchg_all ORDER BY event_hash, batch_id, ok, j, kind_no, ord)
"""

PAGES = """
pg0 AS (
  SELECT c_custkey AS ck, 'db_stations_' || lpad(CAST(c_custkey // 10 AS VARCHAR), 6, '0') AS batch_id, CAST(c_custkey % 10 * 7 AS INT) AS "offset",
         c_custkey // 10 AS bt, c_custkey % 10 AS p, CASE WHEN c_custkey % 19 = 18 THEN 500 ELSE 200 END AS status_code,
         CASE WHEN c_custkey % 19 = 18 THEN 0 WHEN c_custkey % 23 = 22 THEN 0 ELSE 7 END AS n
  FROM customer),
pg AS (
  SELECT *, CAST(CASE WHEN status_code = 500 THEN NULL WHEN p % 6 = 5 THEN n WHEN bt % 3 = 0 THEN 70 WHEN bt % 3 = 2 AND p >= 1 THEN 30 END AS BIGINT) AS page_total,
         status_code = 200 AND n > 0 AS ok
  FROM pg0),
pg1 AS (
  SELECT *, (list(page_total ORDER BY "offset") FILTER (page_total IS NOT NULL) OVER w)[1] AS known_total,
         COALESCE(bool_and(ok) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), TRUE) AS before_ok
  FROM pg WINDOW w AS (PARTITION BY batch_id ORDER BY "offset")),
pg2 AS (SELECT *, COALESCE(known_total IS NOT NULL AND "offset" + 7 >= known_total, FALSE) AS full_here FROM pg1),
pg3 AS (
  SELECT *, before_ok AND NOT COALESCE(bool_or(full_here) OVER (PARTITION BY batch_id ORDER BY "offset" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS fetched
  FROM pg2)
"""

CALLS = """
calls AS (
  SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'open_meteo' ELSE 'deutsche_bahn' END AS source,
         CASE WHEN event_id % 2 = 0 THEN 'archive' ELSE 'plan' END AS endpoint, CAST(user_id AS VARCHAR) AS eva,
         CASE WHEN event_type <> 'view' THEN strftime(ts, '%Y-%m-%d') END AS end_date,
         CASE event_type WHEN 'signup' THEN 204 WHEN 'view' THEN 404 ELSE 200 END AS status_code,
         CAST(floor(value) AS INT) AS response_time_ms, CASE WHEN event_id % 4 = 0 THEN '' ELSE '<timetable/>' END AS payload,
         event_type = 'error' AS raised, CAST(event_id % 3 AS INT) AS result_count, ts AS called_at
  FROM events)
"""

EVENT_RAW = """
raw AS (
  SELECT event_id AS raw_id, CASE WHEN user_id % 10 <> 9 THEN 'open_meteo_' || strftime(ts, '%Y%m%d') || '_' || lpad(CAST(user_id AS VARCHAR), 8, '0') END AS batch_id, ts AS ingested_at
  FROM events)
"""

RUNS = """
run_start AS (
  SELECT event_id, 'r' || CAST(event_id AS VARCHAR) AS run_id,
         CASE WHEN event_id % 2 = 0 THEN 'weather_forecast_transform_dwh' ELSE 'db_timetables_fchg_transform' END AS process_name,
         'open_meteo_' || strftime(ts, '%Y%m%d') || '_' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS batch_id, event_type, ts AS started_at,
         CASE event_type WHEN 'click' THEN 'running' WHEN 'error' THEN 'failed' WHEN 'view' THEN 'skipped' ELSE 'success' END AS status,
         CASE WHEN event_type <> 'click' THEN ts + (event_id % 90) * INTERVAL 1 SECOND END AS finished_at,
         CASE WHEN event_type = 'click' THEN 'start' ELSE 'rows_inserted=' || CAST(event_id % 50 AS VARCHAR) END AS message
  FROM events)
"""


def sql(*relations: str, select: str) -> str:
    """A statement over the given relations; later ones may use earlier ones."""
    body = ",".join(r.strip("\n") for r in relations)
    return f"WITH {body}\n{select}" if relations else select
