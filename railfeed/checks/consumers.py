"""Checks of expressions, consumer queries and data quality."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import compact_to_ts, dashed_to_iso, digits_to_int, first_nonempty, iso_to_ts, parse_json, prefix_like
from ..operators import analytics as an
from ..operators import quality as dq
from ..operators import stations as st
from ..operators import timetables as tt
from ..operators import weather as wx
from ..operators.ranking import latest_per_key
from ..plans import ledger
from ..schemas import FORECAST_MEASURES
from ..session import work_dir
from . import fixtures as fx
from .expected import CALLS, EVENT_RAW, FCHG, MATCHED, PLAN, RCHG, STATIONS, WEATHER, XML, sql
from .feeds import _FCHG_LIST, _forecast, _view_sql
from .registry import check

# ---------------------------------------------------------------- expressions


@check(
    "ts_compact",
    sql(
        select="""SELECT event_id, CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE date_trunc('minute', ts) END AS parsed FROM events""",
    ),
)
def ts_compact(spark, sf_dir):
    """Nine digits, an impossible month and text give NULL."""
    compact = F.date_format("ts", "yyMMddHHmm")
    text = (
        F.when(F.col("event_id") % 5 == 0, F.substring(compact, 1, 9))
        .when(F.col("event_id") % 5 == 1, F.concat(F.substring(compact, 1, 2), F.lit("13"), F.substring(compact, 5, 6)))
        .when(F.col("event_id") % 5 == 2, F.concat(F.lit("x"), F.substring(compact, 2, 9)))
        .otherwise(compact)
    )
    return fx.table(spark, sf_dir, "events").select("event_id", compact_to_ts(text).alias("parsed"))


@check(
    "ts_dashed",
    sql(select="SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE date_trunc('second', ts) END AS parsed FROM events"),
)
def ts_dashed(spark, sf_dir):
    event = F.col("event_id")
    text = (
        F.when(event % 4 == 0, F.date_format("ts", "yy-MM-dd HH:mm"))
        .when(event % 4 == 1, F.date_format("ts", "yy-MM-dd HH:mm:ss.SSS"))
        .when(event % 4 == 2, F.date_format("ts", "yy/MM/dd'T'HH.mm.ss"))
        .otherwise(F.date_format("ts", "yy-MM-dd HH:mm:ss"))
    )
    return fx.table(spark, sf_dir, "events").select("event_id", iso_to_ts(dashed_to_iso(text)).alias("parsed"))


@check(
    "safe_int",
    sql(
        select="""SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_linenumber % 4 = 1 THEN CAST(l_partkey AS INT)
          WHEN l_linenumber % 4 = 2 THEN TRY_CAST(CAST(l_partkey AS VARCHAR) || '000000000' AS INT) END AS parsed FROM lineitem""",
    ),
)
def safe_int(spark, sf_dir):
    """Signs, decimals and numbers too large for an int give NULL."""
    part = F.col("l_partkey").cast("string")
    line = F.col("l_linenumber") % 4
    text = (
        F.when(line == 0, F.concat(F.lit("-"), part))
        .when(line == 1, part)
        .when(line == 2, F.concat(part, F.lit("000000000")))
        .otherwise(F.concat(part, F.lit(".0")))
    )
    return fx.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", digits_to_int(text).alias("parsed"))


@check(
    "first_nonempty",
    sql(
        select="""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_type WHEN 1 THEN p_type WHEN 2 THEN NULL ELSE p_brand END AS picked FROM part""",
    ),
)
def first_nonempty_check(spark, sf_dir):
    key = F.col("p_partkey") % 4
    first = F.when(key == 1, "").when(key == 3, F.col("p_brand"))
    second = F.when(key != 2, F.col("p_type"))
    return fx.table(spark, sf_dir, "part").select("p_partkey", first_nonempty(first, second).alias("picked"))


@check("like_prefix", sql(select="SELECT p_partkey, p_brand FROM part WHERE p_brand LIKE 'Brand#1%'"))
def like_prefix(spark, sf_dir):
    parts = fx.table(spark, sf_dir, "part")
    quoted = F.concat(F.lit('"Brand"'), F.substring("p_brand", 6, 20))
    return parts.filter(prefix_like(quoted, "Brand#1%")).select("p_partkey", "p_brand")


@check(
    "json_extract",
    sql(
        select="""SELECT event_id, json_extract_string(props, '$.k') AS k_text, CAST(json_extract_string(props, '$.k') AS INT) AS k_int,
          CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_double, json_exists(props, '$.k') AS has_k, json_exists(props, '$.z') AS has_z FROM events""",
    ),
)
def json_extract(spark, sf_dir):
    doc = parse_json(F.col("props"))
    keys = F.json_object_keys("props")
    return fx.table(spark, sf_dir, "events").select(
        "event_id",
        F.try_variant_get(doc, "$.k", "string").alias("k_text"),
        F.try_variant_get(doc, "$.k", "int").alias("k_int"),
        F.try_variant_get(doc, "$.k", "double").alias("k_double"),
        F.array_contains(keys, "k").alias("has_k"),
        F.array_contains(keys, "z").alias("has_z"),
    )


# ---------------------------------------------------------------- consumer queries


@check("dup_check", sql(select="SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1"))
def dup_check(spark, sf_dir):
    return an.duplicate_keys(fx.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@check("topn_weather", sql(select="SELECT event_id, ts, value FROM events ORDER BY ts, event_id LIMIT 10"))
def topn_weather(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "events").select("event_id", "ts", "value")
    return an.first_rows(rows, 10, F.asc("ts"), F.asc("event_id"))


@check("ingested_on_day", sql(EVENT_RAW, select="SELECT raw_id, batch_id, ingested_at FROM raw WHERE CAST(ingested_at AS DATE) = DATE '2024-01-15'"))
def ingested_on_day(spark, sf_dir):
    return an.ingested_on(fx.event_raw(spark, sf_dir), dt.date(2024, 1, 15)).drop("payload")


@check("payload_peek", sql(select="SELECT page_id, substring(html, 1, 200) AS payload_head FROM pages ORDER BY page_id DESC LIMIT 1"))
def payload_peek(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("payload"))
    return an.payload_peek(pages, 1, F.desc("page_id"))


def _fchg(spark, sf_dir):
    return tt.fchg_events(fx.timetable_raw(spark, sf_dir, "FCHG"))


@check("incidents", sql(XML, FCHG, select=f"""SELECT {_FCHG_LIST} FROM fchg WHERE "type" = 'h' AND category = 'Störung'"""))
def incidents(spark, sf_dir):
    return an.incidents(_fchg(spark, sf_dir))


@check("delays", sql(XML, FCHG, select=f"""SELECT {_FCHG_LIST} FROM fchg WHERE "type" IN ('d', 'f') AND delay_in_min IS NOT NULL"""))
def delays(spark, sf_dir):
    return an.delays(_fchg(spark, sf_dir))


_KPI = """kpi AS (
  SELECT user_id AS station, date_trunc('hour', ts) AS hour, COUNT(*) AS n_events,
         CAST(SUM(CASE WHEN event_type <> 'signup' THEN CAST(value AS DECIMAL(18, 2)) END) AS DOUBLE) / COUNT(*) FILTER (event_type <> 'signup') AS mean_delay,
         COUNT(*) FILTER (event_type = 'error') AS n_incidents
  FROM events WHERE event_type <> 'view' GROUP BY user_id, date_trunc('hour', ts))"""

_HOURLY = """hourly AS (
  SELECT DISTINCT ON (station, hour) user_id AS station, date_trunc('hour', ts) AS hour, value AS temperature FROM events WHERE event_type = 'view'
  ORDER BY station, hour, event_id DESC)"""


def _rail(spark, sf_dir):
    return fx.table(spark, sf_dir, "events").filter("event_type <> 'view'").withColumnRenamed("user_id", "station")


def _kpi_of(events):
    kind = F.col("event_type")
    return an.station_hour_kpi(events, "station", "ts", F.when(kind != "signup", F.col("value")), kind == "error")


def _kpi(spark, sf_dir):
    return _kpi_of(_rail(spark, sf_dir))


def _station_weather(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "events").filter("event_type = 'view'")
    rows = rows.select(
        F.col("user_id").alias("station"), an.hour_of(F.col("ts")).alias("hour"), F.col("value").alias("temperature"), "event_id"
    )
    return latest_per_key(rows, ["station", "hour"], [F.desc("event_id")]).drop("event_id")


@check(
    "station_hour_kpi",
    sql(_KPI.replace("WHERE event_type <> 'view' ", ""), select="SELECT * REPLACE (round(mean_delay, 6) AS mean_delay) FROM kpi"),
)
def station_hour_kpi(spark, sf_dir):
    """All rows of the table: here every event counts as one of the railway."""
    events = fx.table(spark, sf_dir, "events").withColumnRenamed("user_id", "station")
    return _kpi_of(events).withColumn("mean_delay", F.round("mean_delay", 6))


@check(
    "plan_vs_change",
    sql(
        XML,
        PLAN,
        RCHG,
        """newest AS (SELECT DISTINCT ON (event_id, event_type) * FROM rchg WHERE event_type <> 'm'
          ORDER BY event_id, event_type, ts_event DESC NULLS LAST, event_hash)""",
        select="""SELECT p.station_name, p.train_line_ride_id, p.event_type, p.event_time AS planned_time, c.new_time AS changed_time,
          CAST(date_sub('minute', p.event_time, c.new_time) AS BIGINT) AS delay_min, c.delay_minutes
          FROM plan p LEFT JOIN newest c ON c.event_id = p.train_line_ride_id AND c.event_type = p.event_type""",
    ),
)
def plan_vs_change(spark, sf_dir):
    plan = tt.plan_events(fx.timetable_raw(spark, sf_dir, "PLAN"))
    return an.plan_vs_change(plan, tt.rchg_events(fx.timetable_raw(spark, sf_dir)))


@check(
    "rail_weather_features",
    sql(_KPI, _HOURLY, select="SELECT kpi.* REPLACE (round(mean_delay, 6) AS mean_delay), temperature FROM kpi LEFT JOIN hourly USING (station, hour)"),
)
def rail_weather_features(spark, sf_dir):
    rows = an.rail_weather_features(_kpi(spark, sf_dir), _station_weather(spark, sf_dir), "station")
    return rows.withColumn("mean_delay", F.round("mean_delay", 6))


@check(
    "weather_asof",
    sql(
        _HOURLY,
        select="""SELECT e.event_id, e.user_id AS station, h.hour AS weather_hour, h.temperature FROM (SELECT * FROM events WHERE event_type <> 'view') e
          ASOF LEFT JOIN hourly h ON h.station = e.user_id AND h.hour <= date_trunc('hour', e.ts)""",
    ),
)
def weather_asof(spark, sf_dir):
    rail = _rail(spark, sf_dir).select("event_id", "station", "ts")
    return an.weather_asof(rail, _station_weather(spark, sf_dir), "station", "ts", ["temperature"]).drop("ts")


@check(
    "api_perf",
    sql(
        CALLS,
        select="""SELECT source, endpoint, CAST(called_at AS DATE) AS day, COUNT(*) AS n_calls, COUNT(*) FILTER (status_code BETWEEN 200 AND 299) AS n_success,
          COUNT(*) FILTER (status_code >= 400) AS n_failed, round(avg(response_time_ms), 6) AS avg_ms, round(quantile_cont(response_time_ms, 0.95), 6) AS p95_ms,
          MAX(response_time_ms) AS max_ms, CAST(SUM(result_count) AS BIGINT) AS n_results FROM calls GROUP BY ALL""",
    ),
)
def api_perf(spark, sf_dir):
    return an.api_performance(fx.calls(spark, sf_dir))


@check(
    "api_sketches",
    sql(
        CALLS,
        """w AS (SELECT source, endpoint, date_trunc('week', called_at) AS week, COUNT(*) AS n_calls, COUNT(DISTINCT '{"eva":"' || eva || '"' || COALESCE(',"end_date":"' || end_date || '"', '') || '}') AS n FROM calls GROUP BY ALL)""",
        select="SELECT source, endpoint, CAST(week AS DATE) AS week, n_calls, true AS rank_is_close, true AS distinct_is_close FROM w",
    ),
)
def api_sketches(spark, sf_dir):
    """Weekly figures from daily sketches alone, held against the log: the rank of the quantile and the distinct calls."""
    log = ledger.api_call_rows(fx.calls(spark, sf_dir), ["eva", "end_date"])
    week = F.date_trunc("week", "day").cast("date").alias("week")
    merged = an.sketched_performance(an.call_sketches(log), week)
    whole = log.select("source", "endpoint", "params", "response_time_ms", F.date_trunc("week", F.to_date("called_at")).cast("date").alias("week"))
    both = whole.join(merged, ["source", "endpoint", "week"])
    n, ms = F.count(F.lit(1)), F.col("response_time_ms")
    seen = both.groupBy("source", "endpoint", "week", "n_calls").agg(
        (F.count_if(ms < F.col("quantile_ms")) / n).alias("below"), (F.count_if(ms <= F.col("quantile_ms")) / n).alias("upto"),
        F.first("n_distinct").alias("n_distinct"), F.count_distinct("params").alias("n"), n.alias("n_rows"),
    )
    # the value found covers ranks from below to upto; in small groups one call is more than the sketch is off
    off = F.lit(0.02) + 1 / F.col("n_rows")
    close = (F.col("below") <= 0.95 + off) & (F.col("upto") >= 0.95 - off)
    near = F.abs(F.col("n_distinct") - F.col("n")) <= 1 + 0.05 * F.col("n")
    return seen.select("source", "endpoint", "week", "n_calls", close.alias("rank_is_close"), near.alias("distinct_is_close"))


# ---------------------------------------------------------------- weather quality


@check(
    "dq_array_lengths",
    sql(
        WEATHER,
        select="""SELECT raw_id, 'open_meteo_' || stamp AS batch_id, 0 AS obj_pos, CAST(n AS INT) AS n_time, 'weather_code' AS measure,
          CAST(n - 1 AS INT) AS n_values FROM wx WHERE NOT broken AND e % 5 = 0""",
    ),
)
def dq_array_lengths(spark, sf_dir):
    return dq.list_length_gaps(wx.weather_objects(fx.forecast_raw(spark, sf_dir)))


def _unmatched(spark, sf_dir):
    return wx.weather_vertical(wx.weather_objects(fx.forecast_raw(spark, sf_dir)), None)


@check(
    "dq_range",
    sql(
        WEATHER,
        select="""SELECT psa_id, CAST(pos AS INT) AS pos, 'temperature_2m' AS measure, temperature_2m AS value FROM fc WHERE temperature_2m < -60 OR temperature_2m > 60
          UNION ALL SELECT psa_id, CAST(pos AS INT), 'weather_code', CAST(weather_code AS DOUBLE) FROM fc WHERE weather_code < 0 OR weather_code > 99
          UNION ALL SELECT psa_id, CAST(pos AS INT), 'precipitation', precipitation FROM fc WHERE precipitation < 0 OR precipitation > 200""",
    ),
)
def dq_range(spark, sf_dir):
    return dq.range_violations(_unmatched(spark, sf_dir), "psa_id", "pos")


@check(
    "dq_batch_summary",
    sql(
        STATIONS,
        WEATHER,
        MATCHED,
        select="""SELECT batch_id, COUNT(*) AS n_rows, COUNT(*) FILTER ("time" IS NULL) AS n_no_time, COUNT(*) FILTER (m.station_id IS NULL) AS n_no_station,
          COUNT(*) FILTER (temperature_2m IS NULL) AS n_no_temperature, COUNT(*) FILTER (precipitation IS NULL) AS n_no_precipitation,
          CAST(COUNT(*) FILTER (temperature_2m > 60 OR temperature_2m < -60) + COUNT(*) FILTER (weather_code > 99) AS BIGINT) AS n_implausible,
          MIN("time") AS first_time, MAX("time") AS last_time
          FROM fc v LEFT JOIN matched m ON m.latitude = v.latitude AND m.longitude = v.longitude GROUP BY batch_id""",
    ),
)
def dq_batch_summary(spark, sf_dir):
    return dq.batch_summary(_forecast(spark, sf_dir))


@check(
    "extreme_alerts",
    sql(
        WEATHER,
        select="""SELECT psa_id, "time", 'heat' AS alert, temperature_2m AS value FROM fc WHERE temperature_2m >= 35
          UNION ALL SELECT psa_id, "time", 'heavy_rain', precipitation FROM fc WHERE precipitation >= 30""",
    ),
)
def extreme_alerts(spark, sf_dir):
    rows = _unmatched(spark, sf_dir)
    names = ["temperature_2m", "precipitation", "wind_speed_10m"]
    return dq.extreme_alerts(rows.select("psa_id", "time", *[F.col("measures")[n].alias(n) for n in names]), "psa_id", "time")


@check(
    "layer_reconcile",
    sql(
        WEATHER,
        select="""SELECT 'open_meteo_' || stamp AS batch_id, CAST(SUM(CASE WHEN NOT broken THEN n WHEN defect = 3 THEN 1 ELSE 0 END) AS BIGINT) AS expected_rows,
          CAST(SUM(CASE WHEN NOT broken THEN n ELSE 0 END) AS BIGINT) AS actual_rows, CAST(SUM(CASE WHEN broken AND defect = 3 THEN 1 ELSE 0 END) AS BIGINT) AS missing_rows
          FROM wx GROUP BY ALL""",
    ),
)
def layer_reconcile(spark, sf_dir):
    objects = wx.weather_objects(fx.forecast_raw(spark, sf_dir))
    return dq.layer_reconcile(objects, wx.weather_vertical(objects, None))


@check(
    "measure_drift",
    sql(
        """k AS (SELECT 'open_meteo_' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS batch_id, UNNEST([ 'k', 'm' || CAST(event_id % 50 AS VARCHAR)]) AS measure FROM events),
        g AS (SELECT batch_id, measure, COUNT(*) AS n_payloads FROM k GROUP BY ALL)""",
        select="SELECT batch_id, measure, n_payloads, batch_id = MIN(batch_id) OVER (PARTITION BY measure) AS is_new FROM g",
    ),
)
def measure_drift(spark, sf_dir):
    extra = F.concat(F.regexp_replace("props", r"\}$", ""), F.format_string(',"m%d":1}', F.col("event_id") % 50))
    raw = fx.table(spark, sf_dir, "events").select(F.format_string("open_meteo_%08d", "user_id").alias("batch_id"), extra.alias("payload"))
    return dq.measure_drift(raw, parse_json(F.col("payload")))


@check(
    "measure_changes",
    sql(
        """k AS (SELECT user_id, event_id, UNNEST(['k', 'm' || CAST(event_id % 50 AS VARCHAR)]) AS measure FROM events),
        b AS (SELECT user_id, 'b_' || CAST(user_id AS VARCHAR) AS batch_id, row_number() OVER (ORDER BY MIN(ts), 'b_' || CAST(user_id AS VARCHAR)) AS no FROM events GROUP BY user_id),
        has AS (SELECT DISTINCT no, measure FROM k JOIN b USING (user_id)),
        grid AS (SELECT b.batch_id, b.no, m.measure, h.no IS NOT NULL AS here, LAG(h.no IS NOT NULL) OVER w AS before,
          MAX(h.no) OVER (PARTITION BY m.measure ORDER BY b.no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ever
          FROM b CROSS JOIN (SELECT DISTINCT measure FROM has) m LEFT JOIN has h ON h.no = b.no AND h.measure = m.measure
          WINDOW w AS (PARTITION BY m.measure ORDER BY b.no))""",
        select="""SELECT batch_id, measure, CASE WHEN NOT here THEN 'vanished' WHEN ever IS NULL THEN 'new' ELSE 'returning' END AS change
          FROM grid WHERE no > 1 AND here <> before""",
    ),
)
def measure_changes(spark, sf_dir):
    """Batch ids without leading zeros, which sort otherwise than they arrived."""
    extra = F.concat(F.regexp_replace("props", r"\}$", ""), F.format_string(',"m%d":1}', F.col("event_id") % 50))
    raw = fx.table(spark, sf_dir, "events").select(
        F.concat(F.lit("b_"), F.col("user_id").cast("string")).alias("batch_id"), F.col("ts").alias("ingested_at"), extra.alias("payload")
    )
    return dq.key_changes(raw, parse_json(F.col("payload")))


@check("weather_materialised", _view_sql("fc", FORECAST_MEASURES))
def weather_materialised(spark, sf_dir):
    """Built batch by batch, the later batch first: each brings in the hours it has, and the newer version stays."""
    target, rows = work_dir(spark, "hourly"), _forecast(spark, sf_dir)
    stations = st.station_dimension(fx.station_raw(spark, sf_dir))
    for batch_id in ("open_meteo_20240102000000_00000000", "open_meteo_20240101000000_00000000"):
        wx.refresh_hours(spark, rows.filter(F.col("batch_id") == batch_id), target, stations, FORECAST_MEASURES)
    return wx.read_hours(spark, target)
