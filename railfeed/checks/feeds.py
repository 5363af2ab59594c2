"""Checks of the feed jobs: stations, weather, timetables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import stations as st
from ..operators import timetables as tt
from ..operators import weather as wx
from ..operators.matching import build_station_index, match_coordinates
from ..operators.ranking import latest_per_key
from ..plans.jobs import Warehouse
from ..schemas import FCHG_COLUMNS, FORECAST_MEASURES, HISTORY_MEASURES, PLAN_COLUMNS, RCHG_COLUMNS
from ..session import work_dir
from . import fixtures as fx
from .expected import FCHG, MATCHED, PLAN, RCHG, STATIONS, WEATHER, XML, sql
from .registry import check

# ---------------------------------------------------------------- stations


@check("station_base", sql(STATIONS, select="SELECT raw_id, station_id, name, created_at FROM st"))
def station_base(spark, sf_dir):
    return st.station_base(fx.station_raw(spark, sf_dir)).drop("doc")


@check(
    "station_eva_unnest",
    sql(
        STATIONS,
        select="""SELECT st.raw_id, st.station_id, CAST(e.pos AS INT) AS pos, e.eva_number, e.latitude, e.longitude, e.is_main
        FROM st LEFT JOIN st_eva e ON e.raw_id = st.raw_id""",
    ),
)
def station_eva_unnest(spark, sf_dir):
    return st.station_eva(st.station_base(fx.station_raw(spark, sf_dir)))


def _assembled(spark, sf_dir):
    return st.station_assembled(st.station_base(fx.station_raw(spark, sf_dir)))


@check("station_main_eva", sql(STATIONS, select="SELECT raw_id, eva_number, latitude, longitude FROM assembled"))
def station_main_eva(spark, sf_dir):
    return _assembled(spark, sf_dir).select("raw_id", "eva_number", "latitude", "longitude")


@check("station_main_ril", sql(STATIONS, select="SELECT raw_id, ds100 FROM assembled"))
def station_main_ril(spark, sf_dir):
    return _assembled(spark, sf_dir).select("raw_id", "ds100")


@check("station_assembled", sql(STATIONS, select="SELECT * FROM assembled"))
def station_assembled(spark, sf_dir):
    return _assembled(spark, sf_dir)


@check("station_latest", sql(STATIONS, select="SELECT * EXCLUDE (raw_id) FROM stations"))
def station_latest(spark, sf_dir):
    return st.station_dimension(fx.station_raw(spark, sf_dir))


@check("region_eva", sql(STATIONS, select="SELECT DISTINCT eva_number FROM region"))
def region_eva(spark, sf_dir):
    return st.region_eva(st.station_dimension(fx.station_raw(spark, sf_dir)))


@check("region_coords", sql(STATIONS, select="SELECT * FROM region_xy"))
def region_coords(spark, sf_dir):
    return st.region_coords(st.station_dimension(fx.station_raw(spark, sf_dir)))


# ---------------------------------------------------------------- weather


_INDEXES = {}


def _index(spark, sf_dir):
    """Index of the region's stations, built once per session like any table derived from the dimension."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _INDEXES:
        _INDEXES[key] = build_station_index(st.region_coords(st.station_dimension(fx.station_raw(spark, sf_dir))))
    return _INDEXES[key]


def _forecast(spark, sf_dir):
    return wx.weather_vertical(wx.weather_objects(fx.forecast_raw(spark, sf_dir)), _index(spark, sf_dir))


def _history(spark, sf_dir):
    return wx.weather_vertical(wx.weather_objects(fx.history_raw(spark, sf_dir), history=True), _index(spark, sf_dir))


@check(
    "weather_envelope",
    sql(
        WEATHER,
        select="""SELECT raw_id, 'open_meteo_archive_' || stamp AS batch_id, CAST(p AS INT) AS obj_pos
        FROM wx, UNNEST(range(CASE WHEN NOT broken AND e % 3 = 1 THEN 2 ELSE 1 END)) t(p)""",
    ),
)
def weather_envelope(spark, sf_dir):
    return wx.weather_objects(fx.history_raw(spark, sf_dir), history=True).select("raw_id", "batch_id", "obj_pos")


_VERTICAL = """SELECT psa_id, CAST(obj_pos AS INT) AS obj_pos, batch_id, m.station_id, v.latitude, v.longitude, CAST(pos AS INT) AS pos, "time",
  temperature_2m, CAST(weather_code AS DOUBLE) AS weather_code, precipitation
  FROM {rows} v LEFT JOIN matched m ON m.latitude = v.latitude AND m.longitude = v.longitude"""


def _flat(vertical):
    names = ["temperature_2m", "weather_code", "precipitation"]
    return vertical.select(*[c for c in vertical.columns if c != "measures"], *[F.col("measures")[n].alias(n) for n in names])


@check("weather_vertical_forecast", sql(STATIONS, WEATHER, MATCHED, select=_VERTICAL.format(rows="fc")))
def weather_vertical_forecast(spark, sf_dir):
    return _flat(_forecast(spark, sf_dir))


@check("weather_vertical_history", sql(STATIONS, WEATHER, MATCHED, select=_VERTICAL.format(rows="hist")))
def weather_vertical_history(spark, sf_dir):
    return _flat(_history(spark, sf_dir))


@check(
    "weather_sparse",
    sql(
        WEATHER,
        select="""SELECT psa_id, CAST(pos AS INT) AS pos, '{' || concat_ws(',', '"precipitation":' || regexp_replace(CAST(precipitation AS VARCHAR), '\\.0$', ''),
          '"temperature_2m":' || regexp_replace(CAST(temperature_2m AS VARCHAR), '\\.0$', ''), '"weather_code":' || CAST(weather_code AS VARCHAR)) || '}' AS measures
        FROM fc""",
    ),
)
def weather_sparse(spark, sf_dir):
    """The values as sent; JSON numbers are compared without a fraction of zero."""
    rows = wx.weather_vertical(wx.weather_objects(fx.forecast_raw(spark, sf_dir)), None, exact=True)
    return rows.select("psa_id", "pos", F.col("payload").alias("measures"))


@check(
    "weather_quarantine",
    sql(
        WEATHER,
        select="""SELECT raw_id, 'open_meteo_' || stamp AS batch_id, 0 AS obj_pos, CASE defect WHEN 0 THEN 'not_json' WHEN 1 THEN 'no_hourly'
          WHEN 2 THEN 'no_hourly' WHEN 3 THEN 'bad_latitude' ELSE 'time_not_list' END AS reason FROM wx WHERE broken""",
    ),
)
def weather_quarantine(spark, sf_dir):
    return wx.weather_quarantine(wx.weather_objects(fx.forecast_raw(spark, sf_dir)))


_POINTS = """
points AS (SELECT c_custkey, (47000000 + (c_custkey * 52711 + 3) % 8000000) / 1e6 AS latitude, (6000000 + (c_custkey * 35317) % 9000000) / 1e6 AS longitude
  FROM customer WHERE c_custkey % 2 = 1
  UNION ALL
  SELECT c_custkey, (47000000 + (c_custkey * 102947 + 60) % 8000000) / 1e6, (6000000 + (c_custkey * 104729 + 60) % 9000000) / 1e6
  FROM customer WHERE c_custkey % 2 = 0),
posts AS (SELECT CAST(s_suppkey AS VARCHAR) AS station_id, (47000000 + (s_suppkey * 102947) % 8000000) / 1e6 AS latitude,
  (6000000 + (s_suppkey * 104729) % 9000000) / 1e6 AS longitude FROM supplier)
"""


def _points_and_posts(spark, sf_dir):
    c, s = F.col("c_custkey"), F.col("s_suppkey")
    odd = c % 2 == 1
    lat = F.when(odd, 47000000 + (c * 52711 + 3) % 8000000).otherwise(47000000 + (c * 102947 + 60) % 8000000) / 1e6
    lon = F.when(odd, 6000000 + (c * 35317) % 9000000).otherwise(6000000 + (c * 104729 + 60) % 9000000) / 1e6
    points = fx.table(spark, sf_dir, "customer").select("c_custkey", lat.alias("latitude"), lon.alias("longitude"))
    posts = fx.table(spark, sf_dir, "supplier").select(
        s.cast("string").alias("station_id"),
        ((47000000 + (s * 102947) % 8000000) / 1e6).alias("latitude"),
        ((6000000 + (s * 104729) % 9000000) / 1e6).alias("longitude"),
    )
    return points, match_coordinates(points, build_station_index(posts))


@check(
    "station_match_tol",
    sql(
        _POINTS,
        select="""SELECT c_custkey, (SELECT MIN(s.station_id) FROM posts s
          WHERE abs(p.latitude - s.latitude) < 1e-4 AND abs(p.longitude - s.longitude) < 1e-4) AS station_id FROM points p""",
    ),
)
def station_match_tol(spark, sf_dir):
    points, matched = _points_and_posts(spark, sf_dir)
    return points.join(matched, ["latitude", "longitude"], "left").select("c_custkey", F.col("tol_station_id").alias("station_id"))


@check(
    "station_match_nearest",
    sql(
        _POINTS,
        """cand AS (SELECT c_custkey, s.station_id, (p.latitude - s.latitude) * (p.latitude - s.latitude)
             + (p.longitude - s.longitude) * (p.longitude - s.longitude) AS d,
             abs(p.latitude - s.latitude) < 1e-4 AND abs(p.longitude - s.longitude) < 1e-4 AS hit FROM points p CROSS JOIN posts s)""",
        select="""SELECT DISTINCT ON (c_custkey) c_custkey, station_id FROM cand
          ORDER BY c_custkey, hit DESC, CASE WHEN hit THEN 0 ELSE d END, station_id""",
    ),
)
def station_match_nearest(spark, sf_dir):
    points, matched = _points_and_posts(spark, sf_dir)
    return points.join(matched, ["latitude", "longitude"], "left").select("c_custkey", "station_id")


def _view_sql(rows: str, measures: list[str]) -> str:
    known = {"temperature_2m", "weather_code", "precipitation"}
    cols = ", ".join(m if m in known else f"CAST(NULL AS DOUBLE) AS {m}" for m in measures)
    return sql(
        STATIONS,
        WEATHER,
        MATCHED,
        f"""joined AS (SELECT v.*, s.station_id AS dim_id, s.name AS station_name, s.ds100, s.eva_number
          FROM {rows} v JOIN matched m ON m.latitude = v.latitude AND m.longitude = v.longitude
          LEFT JOIN stations s ON s.station_id = m.station_id WHERE m.station_id IS NOT NULL)""",
        select=f"""SELECT DISTINCT ON (dim_id, "time") psa_id, batch_id, latitude, longitude, dim_id AS station_id, station_name, ds100, eva_number,
          "time", {cols} FROM joined ORDER BY dim_id, "time", batch_id DESC NULLS FIRST, psa_id DESC, obj_pos DESC, pos DESC""",
    )


@check("weather_forecast_hourly", _view_sql("fc", FORECAST_MEASURES))
def weather_forecast_hourly(spark, sf_dir):
    return wx.forecast_hourly(_forecast(spark, sf_dir), st.station_dimension(fx.station_raw(spark, sf_dir)))


@check("weather_history_hourly", _view_sql("hist", HISTORY_MEASURES))
def weather_history_hourly(spark, sf_dir):
    return wx.history_hourly(_history(spark, sf_dir), st.station_dimension(fx.station_raw(spark, sf_dir)))


@check(
    "latest_null_key",
    sql(
        select="""SELECT DISTINCT ON (station_id, hour) event_id, event_type AS batch_id, station_id, hour FROM
          (SELECT event_id, CASE WHEN event_type <> 'view' THEN event_type END AS event_type, CASE WHEN user_id % 3 <> 2 THEN user_id END AS station_id,
             date_trunc('hour', ts) AS hour FROM events)
          ORDER BY station_id, hour, event_type DESC NULLS FIRST, event_id DESC""",
    ),
)
def latest_null_key(spark, sf_dir):
    rows = fx.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("batch_id"),
        F.when(F.col("user_id") % 3 != 2, F.col("user_id")).alias("station_id"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"),
    )
    return latest_per_key(rows, ["station_id", "hour"], [F.desc_nulls_first("batch_id"), F.desc("event_id")])


# ---------------------------------------------------------------- timetables


@check(
    "xml_shred",
    sql(
        select="""SELECT o_orderkey AS raw_id, CASE WHEN o_orderkey % 40 <> 39 THEN 'S' || CAST(o_custkey AS VARCHAR) END AS station_name,
          CASE WHEN o_orderkey % 40 <> 39 THEN CAST(o_custkey AS VARCHAR) END AS eva_number,
          CAST(CASE WHEN o_orderkey % 40 <> 39 THEN 1 + o_orderkey % 2 END AS INT) AS n_services FROM orders""",
    ),
)
def xml_shred(spark, sf_dir):
    docs = tt.shred(fx.timetable_raw(spark, sf_dir))
    usable = F.when(F.col("reason").isNull(), F.col("doc"))
    return docs.select(
        "raw_id",
        usable["_station"].alias("station_name"),
        usable["_eva"].alias("eva_number"),
        F.array_size(usable["s"]).alias("n_services"),
    )


@check(
    "xml_quarantine",
    sql(
        select="""SELECT o_orderkey AS raw_id, 'RCHG_20240101_00000' || CAST(o_orderkey % 2 AS VARCHAR) AS batch_id,
          CASE WHEN (o_orderkey // 40) % 5 < 3 THEN 'malformed' ELSE 'extra_content' END AS reason FROM orders WHERE o_orderkey % 40 = 39""",
    ),
)
def xml_quarantine(spark, sf_dir):
    return tt.xml_quarantine(fx.timetable_raw(spark, sf_dir)).drop("payload")


@check("xml_services", sql(XML, select="SELECT ok AS raw_id, CAST(j AS INT) AS s_pos, station AS station_name, eva AS eva_number, s_id FROM s"))
def xml_services(spark, sf_dir):
    rows = tt.services(fx.timetable_raw(spark, sf_dir))
    return rows.select("raw_id", "s_pos", "station_name", "eva_number", F.col("s._id").alias("s_id"))


_CONTEXT = [c for c in FCHG_COLUMNS[:18] if c not in ("delay_in_min", "event_time", "is_canceled", "type", "category", "priority", "message_id")]


def _services(spark, sf_dir):
    return tt.fchg_services(tt.services(fx.timetable_raw(spark, sf_dir, "FCHG")))


@check("fchg_service", sql(XML, FCHG, select=f"SELECT {', '.join(_CONTEXT)} FROM svc"))
def fchg_service(spark, sf_dir):
    return _services(spark, sf_dir).select(*_CONTEXT)


@check("fchg_destination", sql(XML, FCHG, select="SELECT train_line_ride_id, final_destination_station FROM svc"))
def fchg_destination(spark, sf_dir):
    return _services(spark, sf_dir).select("train_line_ride_id", "final_destination_station")


@check("fchg_cancel", sql(XML, FCHG, select="SELECT train_line_ride_id, service_canceled AS is_canceled FROM svc"))
def fchg_cancel(spark, sf_dir):
    return _services(spark, sf_dir).select("train_line_ride_id", F.col("service_canceled").alias("is_canceled"))


_FCHG_LIST = ", ".join(f'"{c}"' for c in FCHG_COLUMNS)


@check("fchg_message_rows", sql(XML, FCHG, select=f"SELECT {_FCHG_LIST} FROM fchg_m"))
def fchg_message_rows(spark, sf_dir):
    return tt.fchg_message_rows(fx.timetable_raw(spark, sf_dir, "FCHG"))


@check("fchg_node_rows", sql(XML, FCHG, select=f"SELECT {_FCHG_LIST} FROM fchg_n"))
def fchg_node_rows(spark, sf_dir):
    return tt.fchg_node_rows(fx.timetable_raw(spark, sf_dir, "FCHG"))


@check("fchg_events", sql(XML, FCHG, select=f"SELECT {_FCHG_LIST} FROM fchg"))
def fchg_events(spark, sf_dir):
    return tt.fchg_events(fx.timetable_raw(spark, sf_dir, "FCHG"))


@check("plan_events", sql(XML, PLAN, select=f"SELECT {', '.join(PLAN_COLUMNS)} FROM plan"))
def plan_events(spark, sf_dir):
    return tt.plan_events(fx.timetable_raw(spark, sf_dir, "PLAN"))


@check(
    "plan_distinct",
    sql(
        select="""SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS station_name, CAST(l_orderkey AS VARCHAR) AS train_line_ride_id,
          CAST(l_linenumber AS VARCHAR) AS train_number, l_linestatus AS train_category, CAST(NULL AS VARCHAR) AS train_type,
          CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_returnflag END AS train_direction, CASE WHEN l_linestatus = 'F' THEN 'dp' ELSE 'ar' END AS event_type,
          l_shipdate AS event_time, CAST(NULL AS VARCHAR) AS platform, '' AS train_line_name, CAST(NULL AS VARCHAR) AS route_path, 'PLAN_20240101_000000' AS batch_id
          FROM lineitem""",
    ),
)
def plan_distinct(spark, sf_dir):
    none = F.lit(None).cast("string")
    flag = F.col("l_returnflag")
    rows = fx.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("station_name"),
        F.col("l_orderkey").cast("string").alias("train_line_ride_id"),
        F.col("l_linenumber").cast("string").alias("train_number"),
        F.col("l_linestatus").alias("train_category"),
        none.alias("train_type"),
        F.when(flag != "R", flag).alias("train_direction"),
        F.when(F.col("l_linestatus") == "F", "dp").otherwise("ar").alias("event_type"),
        F.col("l_shipdate").alias("event_time"),
        none.alias("platform"),
        F.lit("").alias("train_line_name"),
        none.alias("route_path"),
        F.lit("PLAN_20240101_000000").alias("batch_id"),
    )
    return tt.distinct_plan(rows)


_RCHG_LIST = ", ".join("ts_event AS timestamp_event" if c == "timestamp_event" else c for c in RCHG_COLUMNS)


@check("rchg_message_rows", sql(XML, RCHG, select=f"SELECT {_RCHG_LIST} FROM rchg_all WHERE event_type = 'm'"))
def rchg_message_rows(spark, sf_dir):
    return tt.rchg_rows(fx.timetable_raw(spark, sf_dir), kinds=("m",)).select(*RCHG_COLUMNS)


@check("rchg_node_rows", sql(XML, RCHG, select=f"SELECT {_RCHG_LIST} FROM rchg_all WHERE event_type <> 'm'"))
def rchg_node_rows(spark, sf_dir):
    return tt.rchg_rows(fx.timetable_raw(spark, sf_dir), kinds=("dp", "ar")).select(*RCHG_COLUMNS)


@check(
    "rchg_event_hash",
    sql(select="SELECT doc_id, sha1(concat_ws('|', text, lang, '', source, CAST(n_chars AS VARCHAR))) AS event_hash FROM documents"),
)
def rchg_event_hash(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")
    none = F.lit(None).cast("string")
    return docs.select(
        "doc_id", tt.event_hash(F.col("text"), F.col("lang"), none, F.col("source"), F.col("n_chars").cast("string")).alias("event_hash")
    )


_DOC_FIRST = "first AS (SELECT DISTINCT ON (event_hash) event_hash, doc_id, lang FROM (SELECT sha1(text) AS event_hash, doc_id, lang FROM documents {where}) ORDER BY event_hash, doc_id)"


def _hashed(spark, sf_dir):
    return fx.table(spark, sf_dir, "documents").select(tt.event_hash(F.col("text")).alias("event_hash"), "doc_id", "lang", "source")


@check("rchg_dedup_batch", sql(_DOC_FIRST.format(where=""), select="SELECT * FROM first"))
def rchg_dedup_batch(spark, sf_dir):
    return tt.first_per_hash(_hashed(spark, sf_dir).drop("source"), ["doc_id"])


@check(
    "rchg_insert_ignore",
    sql(
        _DOC_FIRST.format(where=""),
        select="""SELECT * FROM first WHERE event_hash NOT IN (SELECT sha1(text) FROM documents WHERE source = (SELECT MIN(source) FROM documents))""",
    ),
)
def rchg_insert_ignore(spark, sf_dir):
    """Documents of one source are stored already; all documents arrive as the next batch."""
    rows = _hashed(spark, sf_dir)
    first_source = rows.agg(F.min("source").alias("source"))
    stored = rows.join(F.broadcast(first_source), "source", "left_semi")
    new = tt.first_per_hash(rows.drop("source"), ["doc_id"])
    return tt.insert_ignore(new, stored)


@check("rchg_events", sql(XML, RCHG, select=f"SELECT {_RCHG_LIST} FROM rchg"))
def rchg_events(spark, sf_dir):
    return tt.rchg_events(fx.timetable_raw(spark, sf_dir))


_STORED = ", ".join("ts_event AS timestamp_event" if c == "timestamp_event" else c for c in RCHG_COLUMNS if c != "batch_id")


@check("rchg_replay", sql(XML, RCHG, select=f"SELECT {_STORED} FROM rchg"))
def rchg_replay(spark, sf_dir):
    """Documents to stored events through the jobs, then the same polls again, which add nothing."""
    house, docs = Warehouse(spark, work_dir(spark, "house")), fx.timetable_raw(spark, sf_dir)
    for _ in range(2):
        for second in range(2):
            now = dt.datetime(2024, 1, 1, 0, 0, second)
            house.ingest("timetables_rchg", docs.filter(F.second("ingested_at") == second).select("payload"), now)
        house.transform_rchg()
    return spark.read.parquet(house.path("dwh", "timetables_rchg_events")).drop("event_date", "batch_id")
