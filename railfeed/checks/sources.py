"""Checks of landing, request planning, layers and logs."""

from __future__ import annotations

import contextlib
import datetime as dt

from pyspark.sql import functions as F

from ..plans import jobs, layers, ledger
from ..plans.jobs import Warehouse
from ..session import work_dir
from ..sources import landing, requests, tables
from ..sources.snapshots import SnapshotTable, added
from . import fixtures as fx
from .expected import CALLS, EVENT_RAW, PAGES, RUNS, WEATHER, sql
from .registry import check

_PROCESS = "weather_forecast_transform_dwh"


# ---------------------------------------------------------------- landing


@check(
    "land_json",
    sql(
        WEATHER,
        select="""SELECT raw_id, 'open_meteo_archive_' || stamp AS batch_id, CAST(p AS INT) AS pos,
          CASE WHEN broken AND defect = 0 THEN 'text' WHEN p = 1 AND e % 6 = 1 THEN 'text' ELSE 'object' END AS kind,
          CASE WHEN broken AND defect = 3 THEN 1 WHEN broken OR p = 1 AND e % 6 = 1 THEN NULL ELSE n END AS n_hours
        FROM wx, UNNEST(range(CASE WHEN NOT broken AND e % 3 = 1 THEN 2 ELSE 1 END)) t(p)""",
    ),
)
def land_json(spark, sf_dir):
    """A list under ``results`` is one row here; only the history job opens it."""
    rows = landing.land_json(fx.history_raw(spark, sf_dir).drop("ingested_at"))
    doc = F.try_parse_json("payload")
    is_object = F.try_variant_get(doc, "$", "map<string,variant>").isNotNull()
    hours = F.coalesce(
        F.array_size(F.try_variant_get(doc, "$.hourly.time", "array<variant>")),
        F.array_size(F.try_variant_get(doc, "$.results[0].hourly.time", "array<variant>")),
    )
    return rows.select(
        "raw_id", "batch_id", "pos", F.when(is_object, "object").otherwise("text").alias("kind"), hours.cast("bigint").alias("n_hours")
    )


@check("land_text", sql(select="SELECT page_id, 'web_20240101000000_00000000' AS batch_id, html AS payload, length(html) AS n_chars FROM pages"))
def land_text(spark, sf_dir):
    """Stored and read back, so the text has gone through the raw table."""
    pages = fx.table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("payload"))
    path = work_dir(spark, "land-text")
    landed = landing.stamp_batch(landing.land_text(pages), "web_20240101000000_00000000")
    tables.write_partitions(landed, path, "batch_id")
    rows = spark.read.parquet(path)
    return rows.select("page_id", "batch_id", "payload", F.char_length("payload").cast("bigint").alias("n_chars"))


@check("page_envelope", sql(PAGES, select='SELECT batch_id, "offset", CAST(n AS INT) AS n_items, page_total AS total FROM pg'))
def page_envelope(spark, sf_dir):
    pages = landing.page_envelope(fx.pages(spark, sf_dir))
    return pages.select("batch_id", "offset", F.coalesce(F.array_size("items"), F.lit(0)).alias("n_items"), "total")


@check(
    "page_concat",
    sql(
        PAGES,
        select="""SELECT batch_id, "offset", CAST(i AS INT) AS pos, '{"number":' || CAST(ck * 7 + i AS VARCHAR) || '}' AS payload
        FROM pg3, UNNEST(range(n)) t(i) WHERE fetched AND ok""",
    ),
)
def page_concat(spark, sf_dir):
    return landing.page_concat(fx.pages(spark, sf_dir), 7)


@check(
    "page_report",
    sql(
        PAGES,
        select="""SELECT batch_id, MAX(known_total) FILTER (fetched) AS total, COUNT(*) FILTER (fetched AND ok) AS page_count, 7 AS "limit",
          arg_max(status_code, "offset") FILTER (fetched) AS status_code FROM pg3 GROUP BY batch_id""",
    ),
)
def page_report(spark, sf_dir):
    return landing.page_report(fx.pages(spark, sf_dir), 7)


@check("result_count", sql(PAGES, select="""SELECT batch_id, "offset", CAST(CASE WHEN status_code = 500 THEN 1 WHEN p % 6 IN (2, 5) THEN n ELSE 1 END AS INT) AS result_count FROM pg"""))
def result_count(spark, sf_dir):
    return fx.pages(spark, sf_dir).select("batch_id", "offset", landing.result_count(F.col("payload")).alias("result_count"))


# ---------------------------------------------------------------- requests


@check(
    "plan_request_grid",
    sql(
        """runs AS (SELECT CAST(c_custkey AS VARCHAR) AS eva_number,
          TIMESTAMP '2024-01-01 00:30:00' + CAST(c_custkey % 366 AS INT) * INTERVAL 1 DAY + CAST(c_custkey % 24 AS INT) * INTERVAL 1 HOUR AS logical FROM customer),
        slots AS (SELECT eva_number, date_trunc('day', timezone('Europe/Berlin', timezone('UTC', logical))) + CAST(h AS INT) * INTERVAL 1 HOUR AS slot
          FROM runs, UNNEST(range(30)) t(h))""",
        select="SELECT eva_number, strftime(slot, '%y%m%d') AS date_yymmdd, strftime(slot, '%H') AS hour_hh FROM slots",
    ),
)
def plan_request_grid(spark, sf_dir):
    key = F.col("c_custkey")
    start = F.lit("2024-01-01 00:30:00").cast("timestamp_ntz")
    stations = fx.table(spark, sf_dir, "customer").select(
        key.cast("string").alias("eva_number"),
        (start + F.make_dt_interval(days=(key % 366).cast("int"), hours=(key % 24).cast("int"))).alias("logical"),
    )
    return requests.plan_request_grid(stations, F.col("logical"))


@check(
    "coord_batches",
    sql(
        """c AS (SELECT c_custkey, (47000000 + (c_custkey * 52711) % 8000000) / 1e6 AS latitude, (6000000 + (c_custkey * 35317) % 9000000) / 1e6 AS longitude,
          (ROW_NUMBER() OVER (ORDER BY c_custkey) - 1) // 200 AS request_no FROM customer)""",
        select="""SELECT request_no, CAST(COUNT(*) AS INT) AS station_count, string_agg(CAST(latitude AS VARCHAR), ',' ORDER BY c_custkey) AS latitude,
          string_agg(CAST(longitude AS VARCHAR), ',' ORDER BY c_custkey) AS longitude FROM c GROUP BY request_no""",
    ),
)
def coord_batches(spark, sf_dir):
    key = F.col("c_custkey")
    coords = fx.table(spark, sf_dir, "customer").select(
        "c_custkey",
        ((47000000 + (key * 52711) % 8000000) / 1e6).alias("latitude"),
        ((6000000 + (key * 35317) % 9000000) / 1e6).alias("longitude"),
    )
    return requests.coord_batches(coords, "c_custkey")


def _api_log(spark, sf_dir):
    return ledger.api_call_rows(fx.calls(spark, sf_dir), ["eva", "end_date"])


@check(
    "archive_window",
    sql(
        CALLS,
        select="""SELECT COALESCE((SELECT end_date FROM calls WHERE source = 'open_meteo' AND endpoint = 'archive' AND status_code BETWEEN 200 AND 299
          AND end_date IS NOT NULL ORDER BY called_at DESC NULLS FIRST, end_date DESC LIMIT 1), '2025-01-01') AS start_date, '2025-03-08' AS end_date""",
    ),
)
def archive_window(spark, sf_dir):
    return requests.archive_window(_api_log(spark, sf_dir), dt.date(2025, 3, 10))


# ---------------------------------------------------------------- layers


@check(
    "batch_scan",
    sql(
        WEATHER,
        select="SELECT raw_id, 'open_meteo_' || stamp AS batch_id FROM wx WHERE b = 1",
    ),
)
def batch_scan(spark, sf_dir):
    return tables.scan_batch(fx.forecast_raw(spark, sf_dir), "open_meteo_20240102000000_00000000").select("raw_id", "batch_id")


@check("promote", sql(WEATHER, select="SELECT raw_id, 'open_meteo_' || stamp AS batch_id, TIMESTAMP '2024-01-01' + b * INTERVAL 1 DAY AS ingested_at FROM wx"))
def promote(spark, sf_dir):
    """Promoted twice: the second run must not double anything."""
    stg, psa = _layers(spark)
    _stage_forecasts(spark, sf_dir, stg, psa, 0, 1)
    layers.promote(stg, psa)
    layers.promote(stg, psa)
    return psa.read().drop("payload", "ingest_date")


@check("raw_by_day", sql(WEATHER, select="SELECT raw_id, 'open_meteo_' || stamp AS batch_id FROM wx WHERE b = 1"))
def raw_by_day(spark, sf_dir):
    """The kept layer is cut by the day of arrival; folders of other days are not opened."""
    stg, psa = _layers(spark)
    _stage_forecasts(spark, sf_dir, stg, psa, 0, 1)
    layers.promote(stg, psa)
    return psa.read(F.col("day") == "2024-01-02").select("raw_id", "batch_id")


def _layers(spark):
    return layers.staging(spark, work_dir(spark, "stg")), layers.kept(spark, work_dir(spark, "psa"))


def _stage_forecasts(spark, sf_dir, stg, psa, *days):
    """The forecast batches as they arrived, one per day, with the ids the fixture gave them."""
    for day in days:
        now = dt.datetime(2024, 1, 1 + day)
        batch_id = f"open_meteo_{now:%Y%m%d}000000_00000000"
        layers.stage(stg, psa, tables.scan_batch(fx.forecast_raw(spark, sf_dir), batch_id), batch_id, now, keep_ids=True)


@check(
    "append_commits",
    sql(
        select="""SELECT o_orderkey, 'B' || CAST(o_orderkey % 4 AS VARCHAR) AS batch_id, CASE WHEN o_orderkey % 4 < 2 THEN 2 ELSE 4 END AS seen_at
          FROM orders UNION ALL SELECT o_orderkey, 'B' || CAST(o_orderkey % 4 AS VARCHAR), 4 FROM orders WHERE o_orderkey % 4 < 2""",
    ),
)
def append_commits(spark, sf_dir):
    """Four batches appended one by one: an older version still reads as it was, after their folders were joined too."""
    table = SnapshotTable(spark, work_dir(spark, "appended"), "o_orderkey BIGINT, batch_id STRING", "day")
    for part in range(4):
        batch = f"B{part}"
        rows = fx.table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 4 == part)
        made = table.put(rows.select("o_orderkey", F.lit(batch).alias("batch_id"), F.lit("2024-01-01").alias("day")))
        table.commit(lambda head: [added(f, day=d, batch_id=batch, n_rows=1) for d, f in made.items()], table.version())
    table.compact("2024-01-01")
    early, now = table.read(version=2), table.read()
    return early.withColumn("seen_at", F.lit(2)).unionAll(now.withColumn("seen_at", F.lit(4))).drop("day")


@check(
    "ingest_recovery",
    sql(
        select="""SELECT CAST(o_orderkey AS VARCHAR) AS ride, 'PLAN_20240101_0000' || lpad(CAST(o_orderkey % 3 AS VARCHAR), 2, '0') AS batch_id FROM orders""",
    ),
)
def ingest_recovery(spark, sf_dir):
    """The first ingest dies after staging, the second before its purge; the third finishes both. Every order is planned once."""
    house = Warehouse(spark, work_dir(spark, "house"))
    doc = F.format_string('<timetable station="S"><s id="%d"><dp pt="2503110900"/></s></timetable>', "o_orderkey")
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", doc.alias("payload"))
    for part, step in enumerate(["promote", "purge", None]):
        with _failing(step):
            try:
                house.ingest("timetables_plan", orders.filter(F.col("o_orderkey") % 3 == part).select("payload"), dt.datetime(2024, 1, 1, 0, 0, part))
            except InterruptedError:
                pass
    house.transform_plan()
    house.transform_plan()
    return spark.read.parquet(house.path("dwh", "timetables_plan_events")).select(F.col("train_line_ride_id").alias("ride"), "batch_id")


@contextlib.contextmanager
def _failing(step):
    """The named step of an ingest raises, once the calls that look for leftovers are over."""
    if step is None:
        yield
        return
    whole, calls = getattr(jobs, step), []

    def fail(stg, psa):
        calls.append(1)
        if len(calls) == 2:  # the first call is the one that looks for leftovers
            raise InterruptedError(step)
        return whole(stg, psa)

    setattr(jobs, step, fail)
    try:
        yield
    finally:
        setattr(jobs, step, whole)


@check("plan_window_import", sql(select="SELECT COUNT(*) AS n_rows, COUNT(DISTINCT o_orderkey) AS n_ids, 3 AS n_batches FROM orders"))
def plan_window_import(spark, sf_dir):
    """Three calls of the same second keep all their responses, with row ids of their own."""
    house = Warehouse(spark, work_dir(spark, "house"))
    docs = fx.timetable_raw(spark, sf_dir, "PLAN")
    for part in range(3):
        house.ingest("timetables_plan", docs.filter(F.col("raw_id") % 3 == part).select("payload"), dt.datetime(2024, 1, 1))
    ids = [F.count_distinct(c) for c in ("raw_id", "batch_id")]
    return house.raw("timetables_plan").agg(F.count("*").alias("n_rows"), ids[0].alias("n_ids"), ids[1].cast("int").alias("n_batches"))


@check("purge_remaining", sql(WEATHER, select="SELECT raw_id, 'open_meteo_' || stamp AS batch_id FROM wx WHERE b = 1"))
def purge_remaining(spark, sf_dir):
    """Only the first batch has been promoted, so the purge leaves the second one staged."""
    stg, psa = _layers(spark)
    _stage_forecasts(spark, sf_dir, stg, psa, 0)
    layers.promote(stg, psa)
    _stage_forecasts(spark, sf_dir, stg, psa, 1)
    layers.purge(stg, psa)
    return stg.read().select("raw_id", F.lit("open_meteo_20240102000000_00000000").alias("batch_id"))


@check(
    "batch_stamp",
    sql(select="SELECT event_id, 'PLAN_20240101_123456' AS batch_id, 'open_meteo_20240101123456_' AS json_stem, 8 AS tail_length FROM events"),
)
def batch_stamp(spark, sf_dir):
    """The random tail of a JSON batch id is checked by its length."""
    now = dt.datetime(2024, 1, 1, 12, 34, 56)
    rows = landing.stamp_batch(fx.table(spark, sf_dir, "events").select("event_id"), layers.make_batch_id("open_meteo", now))
    tail = F.regexp_extract("batch_id", "([0-9a-f]+)$", 1)
    rows = rows.select("event_id", F.regexp_replace("batch_id", "[0-9a-f]+$", "").alias("json_stem"), F.length(tail).alias("tail_length"))
    return landing.stamp_batch(rows, layers.make_batch_id("PLAN", now))


@check(
    "latest_batch",
    sql(EVENT_RAW, select="SELECT batch_id FROM raw WHERE batch_id IS NOT NULL ORDER BY ingested_at DESC, raw_id DESC LIMIT 1"),
)
def latest_batch(spark, sf_dir):
    return layers.latest_batch(fx.event_raw(spark, sf_dir))


@check(
    "layer_counts",
    sql(
        WEATHER,
        select="""SELECT 'raw' AS layer, COUNT(*) AS n_rows FROM wx UNION ALL SELECT 'vertical', COUNT(*) FROM fc""",
    ),
)
def layer_counts(spark, sf_dir):
    from ..operators import weather as wx

    raw = fx.forecast_raw(spark, sf_dir)
    return layers.layer_counts({"raw": raw, "vertical": wx.weather_vertical(wx.weather_objects(raw), None)})


@check(
    "batch_trace",
    sql(
        EVENT_RAW,
        RUNS,
        """stg AS (SELECT batch_id, COUNT(*) AS n FROM raw WHERE ingested_at >= TIMESTAMP '2024-01-20' GROUP BY batch_id),
        psa AS (SELECT batch_id, COUNT(*) AS n FROM raw GROUP BY batch_id),
        ev AS (SELECT run_id, batch_id, 'running' AS status, started_at AS ts, 0 AS ended FROM run_start UNION ALL
               SELECT run_id, batch_id, status, finished_at, 1 FROM run_start WHERE finished_at IS NOT NULL),
        ls AS (SELECT DISTINCT ON (batch_id) batch_id, status FROM ev ORDER BY batch_id, ts DESC, ended DESC, run_id DESC),
        rn AS (SELECT batch_id, COUNT(DISTINCT run_id) AS n_runs FROM ev GROUP BY batch_id)""",
        select="""SELECT batch_id, COALESCE(stg.n, 0) AS stg_rows, COALESCE(psa.n, 0) AS psa_rows, ls.status, COALESCE(rn.n_runs, 0) AS n_runs
          FROM stg FULL JOIN psa USING (batch_id) LEFT JOIN ls USING (batch_id) LEFT JOIN rn USING (batch_id)""",
    ),
)
def batch_trace(spark, sf_dir):
    raw = fx.event_raw(spark, sf_dir)
    recent = raw.filter(F.col("ingested_at") >= F.lit("2024-01-20").cast("timestamp_ntz"))
    return layers.batch_trace({"stg": recent, "psa": raw}, fx.run_events(spark, sf_dir))


# ---------------------------------------------------------------- logs


@check(
    "api_log",
    sql(
        CALLS,
        select="""SELECT source, endpoint, '{"eva":"' || eva || '"' || COALESCE(',"end_date":"' || end_date || '"', '') || '}' AS params,
          status_code, response_time_ms, result_count, called_at FROM calls""",
    ),
)
def api_log(spark, sf_dir):
    return _api_log(spark, sf_dir)


@check(
    "api_metrics",
    sql(
        CALLS,
        select="""SELECT source, endpoint, eva, COUNT(*) AS n_calls, COUNT(*) FILTER (NOT raised AND status_code BETWEEN 200 AND 299) AS n_success,
          COUNT(*) FILTER (NOT raised) AS n_payloads, COUNT(*) FILTER (NOT raised AND payload <> '') AS n_results,
          CAST(SUM(CASE WHEN raised THEN 0 ELSE response_time_ms END) AS BIGINT) AS sum_elapsed_ms FROM calls GROUP BY source, endpoint, eva""",
    ),
)
def api_metrics(spark, sf_dir):
    return ledger.api_metrics(fx.calls(spark, sf_dir), ["source", "endpoint", "eva"])


@check("process_state", sql(RUNS, select="SELECT run_id, process_name, batch_id, status, started_at, finished_at, message FROM run_start"))
def process_state(spark, sf_dir):
    return ledger.process_state(fx.run_events(spark, sf_dir))


_DONE = f"done AS (SELECT DISTINCT batch_id FROM run_start WHERE process_name = '{_PROCESS}' AND status = 'success')"


@check("pending_batches", sql(EVENT_RAW, RUNS, _DONE, select="SELECT DISTINCT batch_id FROM raw WHERE batch_id IS NOT NULL AND batch_id NOT IN (FROM done)"))
def pending_batches(spark, sf_dir):
    return ledger.pending_batches(fx.event_raw(spark, sf_dir), fx.run_events(spark, sf_dir), _PROCESS)


@check(
    "skip_ledger",
    sql(
        EVENT_RAW,
        RUNS,
        _DONE,
        select=f"""SELECT DISTINCT '{_PROCESS}' AS process_name, batch_id, CASE WHEN batch_id IN (FROM done) THEN 'skipped' ELSE 'running' END AS status
          FROM raw WHERE batch_id IS NOT NULL""",
    ),
)
def skip_ledger(spark, sf_dir):
    return ledger.run_decisions(fx.event_raw(spark, sf_dir), fx.run_events(spark, sf_dir), _PROCESS)
