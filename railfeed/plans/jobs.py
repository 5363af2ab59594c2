"""The feeds as jobs: land, promote, purge, transform, each safe to repeat."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import settings
from ..operators import quality as dq
from ..operators import stations as st
from ..operators import timetables as tt
from ..operators import weather as wx
from ..operators.analytics import call_sketches, duplicate_keys, ingested_on, rail_weather, rail_weather_asof, sketched_performance
from ..operators.matching import build_station_index
from ..schemas import FCHG_COLUMNS, FORECAST_MEASURES, HISTORY_MEASURES, PLAN_COLUMNS
from ..session import scratch, staged
from ..sources import landing, requests
from ..sources.membership import KeyIndex
from ..sources.snapshots import Conflict, Head, SnapshotTable, added, removed
from ..sources.tables import numbered, scan_batch, write_partitions
from .layers import Taken, kept, latest_batch, make_batch_id, promote, purge, stage, staging
from .ledger import CALL_SCHEMA, RunLedger, api_call_rows, pending_batches, succeeded_batches
from .outcomes import Dealt

# feed, batch id prefix
FEEDS = {
    "db_stations": "db_stations",
    "weather_forecast": "open_meteo",
    "weather_history": "open_meteo_archive",
    "timetables_plan": "PLAN",
    "timetables_fchg": "FCHG",
    "timetables_rchg": "RCHG",
}
# a backlog is worked off in jobs of this many batches, so that neither the plan nor the driver grows with it
BATCHES_PER_JOB = 500
STATION_SCHEMA = "station_id STRING, name STRING, latitude DOUBLE, longitude DOUBLE, ds100 STRING, eva_number STRING, created_at TIMESTAMP_NTZ"
_JSON_FEEDS = {"db_stations", "weather_forecast", "weather_history"}


class Warehouse:
    """Tables below one root folder: ``stg``, ``psa``, ``dwh`` and ``metadata``.

    ``source_tz`` is the zone of the times in timetables. They are labelled UTC and by default taken as that.
    """

    def __init__(self, spark: SparkSession, root: str, source_tz: str = "UTC"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.source_tz = source_tz
        self.ledger = RunLedger(spark, f"{self.root}/metadata/process_log")

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def exists(self, path: str) -> bool:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder)

    def staged(self, feed: str) -> SnapshotTable:
        return staging(self.spark, self.path("stg", feed))

    def kept(self, feed: str) -> SnapshotTable:
        return kept(self.spark, self.path("psa", feed))

    def raw(self, feed: str) -> DataFrame:
        return self.kept(feed).read()

    def manifest(self, feed: str) -> DataFrame:
        """One row per kept batch, as the commit log has it: when it arrived, its rows and where their ids start."""
        return self.kept(feed).entries().select("batch_id", "arrived_at", F.col("first_id").alias("first_raw_id"), "n_rows")

    def batch(self, feed: str, *batch_ids: str) -> DataFrame:
        """Raw rows of the given batches; only the folders that the log names for them are listed and read."""
        table = self.kept(feed)
        entries = table.entries().filter(F.col("batch_id").isin(*batch_ids) & (F.col("n_rows") > 0)).collect()  # one per batch of a job
        rows = table.open(sorted({e.folder for e in entries}))
        return scan_batch(rows, *batch_ids).filter(F.col("ingest_date").isin(*{e.day for e in entries}))

    def recover(self, feed: str) -> list[str]:
        """Finish what failed runs left behind: promote their staged batches, purge, refresh the stations."""
        found = promote(self.staged(feed), self.kept(feed))
        for batch_id, n_rows in found.items():
            self.ledger.run_all(f"{feed}_import", [batch_id], lambda: f"rows_inserted={n_rows}, recovered=true")
        purge(self.staged(feed), self.kept(feed))
        if feed == "db_stations":
            self._refresh_stations()
        return list(found)

    def ingest(self, feed: str, responses: DataFrame, now: dt.datetime, batch_id: str | None = None) -> str:
        """Captured responses to the kept raw layer; returns the batch id.

        An id made from the time gets a tail if another call has taken it, so calls of the same second keep their
        responses apart. A call that names its id is a replay if that batch has been imported, and is skipped.
        What an earlier run left behind is finished first. Several processes may ingest a feed at a time.
        """
        process, named = f"{feed}_import", batch_id is not None
        self.recover(feed)
        batch_id = batch_id or make_batch_id(FEEDS[feed], now)
        land = landing.land_json if feed in _JSON_FEEDS else landing.land_text
        while True:

            def job() -> str:
                rows = landing.stamp_batch(land(responses), batch_id).withColumn("ingested_at", F.lit(now).cast("timestamp_ntz"))
                with scratch(self.spark):
                    n_rows = stage(self.staged(feed), self.kept(feed), numbered(rows), batch_id, now)
                promote(self.staged(feed), self.kept(feed))
                purge(self.staged(feed), self.kept(feed))
                if feed == "db_stations":
                    self._refresh_stations()
                return f"rows_inserted={n_rows}"

            in_use = not self.manifest(feed).filter(F.col("batch_id") == batch_id).isEmpty() or self.ledger.is_done(process, batch_id)
            try:
                if in_use:
                    raise Taken(batch_id)
                self.ledger.run_all(process, [batch_id], job)
                return batch_id
            except Taken:
                if named:
                    self.ledger.skip(process, batch_id)
                    return batch_id
                batch_id = f"{make_batch_id(FEEDS[feed], now)}_{uuid.uuid4().hex[:8]}"

    def ingest_pages(self, pages: DataFrame, now: dt.datetime, limit: int, batch_id: str | None = None) -> str:
        """Stations from the pages of one paging run, ``offset, status_code, payload``, each item as a raw row of its own.

        Items are taken up to where paging stops: a bad or empty page, or the announced total. What was used of the run
        is logged: announced total, pages, page size and last status.
        """
        run = pages.withColumn("batch_id", F.lit("run"))
        batch_id = self.ingest("db_stations", landing.page_concat(run, limit).select("payload"), now, batch_id)
        report = landing.page_report(run, limit).first()  # one row per run
        if report is not None:
            used = ", ".join(f"{c}={report[c]}" for c in ("total", "page_count", "limit", "status_code"))
            self.ledger.append([(uuid.uuid4().hex, "db_stations_pages", batch_id, "end", "success", used)])
        return batch_id

    def log_calls(self, calls: DataFrame, params: list[str]) -> None:
        api_call_rows(calls, params).write.mode("append").parquet(self.path("metadata", "api_call_log"))

    def calls(self) -> DataFrame:
        path = self.path("metadata", "api_call_log")
        return self.spark.read.schema(CALL_SCHEMA).parquet(path) if self.exists(path) else self.spark.createDataFrame([], CALL_SCHEMA)

    def plan_requests(self, logical: dt.datetime) -> DataFrame:
        """Station and hour of every plan call of a logical day, given in UTC."""
        evas = st.region_eva(self.stations())
        return requests.plan_request_grid(evas, F.lit(logical).cast("timestamp_ntz"))

    def forecast_requests(self) -> DataFrame:
        return requests.coord_batches(st.region_coords(self.stations()), "station_id")

    def archive_requests(self, today: dt.date, require_results: bool = False) -> DataFrame:
        """Archive calls: the next window and the measures for every group of places; none without places.

        The window goes on from the last call that succeeded, or with ``require_results`` from the last that also brought
        something. The region is cut into groups like the forecast calls, so no request grows with the dimension.
        """
        groups = requests.coord_batches(st.region_coords(self.stations()), "station_id", fallback=False)
        window = requests.archive_window(self.calls(), today, require_results=require_results).withColumn("hourly", F.lit(",".join(settings.archive_measures())))
        # the window is a grand total, so one row
        one = F.lit(1).alias("one")
        return groups.select("*", one).join(F.broadcast(window.select("*", one)), "one").drop("one")

    def _station_table(self) -> SnapshotTable:
        return SnapshotTable(self.spark, self.path("dwh", "stations"), STATION_SCHEMA, "part")

    def _refresh_stations(self) -> None:
        """Store the dimension, so that joins know how small it is, with the raw version it was made from."""
        table, raw = self._station_table(), self.kept("db_stations")
        base, source = table.version(), raw.version()
        if table.note(base) == str(source):
            return
        old = [r.folder for r in table.entries(base).select("folder").distinct().collect()]  # one
        folders = table.put(st.station_dimension(raw.read(version=source)).withColumn("part", F.lit("all")))
        n_rows = table.open(list(folders.values())).count()

        def change(head: Head) -> list[dict]:
            if head.version > base:
                return []  # another process has stored it; the next ingest looks again
            return [removed(f) for f in old] + [added(f, n_rows=n_rows) for f in folders.values()]

        table.commit(change, base, note=str(source))

    def stations(self) -> DataFrame:
        table = self._station_table()
        return table.read().drop("part") if table.version() else st.station_dimension(self.raw("db_stations"))

    def pending(self, feed: str, step: str = "transform", after: str | None = None) -> list[str]:
        """Oldest batches still to work off, at most as many as one job takes; found in the manifest and the ledger alone.

        With ``after`` only batches that step has succeeded on.
        """
        process, batches = f"{feed}_{step}", self.manifest(feed)
        todo = pending_batches(batches, self.ledger.read(process), process)
        if after is not None:
            done = succeeded_batches(self.ledger.read(f"{feed}_{after}"), f"{feed}_{after}")
            todo = todo.join(done, "batch_id", "left_semi")
        arrived = batches.groupBy("batch_id").agg(F.max("arrived_at").alias("at"))
        oldest = arrived.join(todo, "batch_id", "left_semi").orderBy("at", "batch_id").limit(BATCHES_PER_JOB)
        return [r.batch_id for r in oldest.collect()]

    def newest(self, feed: str) -> str | None:
        batches = self.manifest(feed).select("batch_id", F.col("arrived_at").alias("ingested_at"), F.col("first_raw_id").alias("raw_id"))
        return latest_batch(batches).first().batch_id

    def _transform(self, feed: str, write: Callable[[DataFrame, list[str]], str], latest_only: bool) -> list[str]:
        """All pending batches, many per job. ``latest_only`` looks at the newest batch and no other."""
        process = f"{feed}_transform"
        if latest_only:
            newest = self.newest(feed)
            batches = [newest] if newest and not self.ledger.is_done(process, newest) else []
        else:
            batches = self.pending(feed)
        if not batches:
            newest = self.newest(feed)
            if newest is not None:
                self.ledger.skip(process, newest)
        def job() -> str:
            with scratch(self.spark):
                return write(self.batch(feed, *todo), todo)

        done = []
        while batches:
            todo = batches
            self.ledger.run_all(process, todo, job)
            done += todo
            batches = [] if latest_only else self.pending(feed)
        return done

    def _set_aside(self, feed: str, dealt: Dealt, *columns: str) -> None:
        """Store what could not be read, and log per batch how much of it there was."""
        write_partitions(dealt.rejected(*columns), self.path("psa", f"{feed}_quarantine"), "batch_id")
        write_partitions(dealt.errors(), self.path("psa", f"{feed}_errors"), "batch_id")
        counts = dealt.counts()
        if counts:
            events = [(uuid.uuid4().hex, f"{feed}_quality", batch_id, "end", "success", message) for batch_id, message in counts.items()]
            self.ledger.append(events)

    def _written(self, path: str, batch_ids: list[str]) -> int:
        """Rows that a table cut by batch has of the given batches, from the file footers of their folders alone."""
        folders = [p for b in batch_ids if self.exists(p := f"{path}/batch_id={b}")]
        return self.spark.read.schema("batch_id STRING").option("basePath", path).parquet(*folders).count() if folders else 0

    def field_errors(self, feed: str) -> DataFrame:
        """Values that could not be read, with field, reason and text: impossible dates, numbers that are none."""
        return self.spark.read.parquet(self.path("psa", f"{feed}_errors"))

    def quarantine(self, feed: str) -> DataFrame:
        """Stored payloads or objects that could not be read, with the reason."""
        path = self.path("psa", f"{feed}_quarantine")
        return self.spark.read.parquet(path)

    def transform_weather(self, feed: str, latest_only: bool = False) -> list[str]:
        """Payloads to station hours, then the hourly view of the hours they touch; what cannot be read is set aside.

        Each payload is parsed once: objects are written with their typed lists, and all that follows reads these.
        """
        measures = HISTORY_MEASURES if feed == "weather_history" else FORECAST_MEASURES

        def write(raw: DataFrame, todo: list[str]) -> str:
            dealt = Dealt(wx.parsed_objects(raw, history=feed == "weather_history"))
            index = build_station_index(st.region_coords(self.stations()))
            rows = wx.placed_hours(dealt.rows, index)
            wx.write_vertical(rows, self.path("psa", f"{feed}_vertical"))
            self._set_aside(feed, dealt, "obj_pos", "reject.reason")
            changed = wx.refresh_hours(self.spark, rows, self.path("dwh", f"{feed}_hourly"), self.stations(), measures)
            return f"rows_attempted={dealt.total('n_hours')}, rows_inserted={dealt.total('n_hours', 'read')}, hours_touched={changed}"

        return self._transform(feed, write, latest_only)

    def report_weather(self, feed: str) -> list[str]:
        """Quality of the batches that have been transformed since the last report: a summary each, and what is not credible.

        A batch is reported once; repeating the job replaces its rows.
        """
        done, process = [], f"{feed}_report"
        while todo := self.pending(feed, "report", after="transform"):

            def job() -> str:
                rows = wx.read_vertical(self.spark, self.path("psa", f"{feed}_vertical")).filter(F.col("batch_id").isin(*todo))
                write_partitions(dq.batch_summary(rows), self.path("dwh", f"{feed}_batch_summary"), "batch_id")
                odd = dq.range_violations(rows, "psa_id", "obj_pos", "pos", "station_id", "time", "batch_id")
                write_partitions(odd, self.path("dwh", f"{feed}_implausible"), "batch_id")
                return f"batches={len(todo)}"

            self.ledger.run_all(process, todo, job)
            done += todo
        return done

    def batch_summary(self, feed: str) -> DataFrame:
        """Rows, gaps, missing values and times of each reported weather batch."""
        return self.spark.read.parquet(self.path("dwh", f"{feed}_batch_summary"))

    def implausible(self, feed: str) -> DataFrame:
        """Measures of reported batches outside of what is credible."""
        return self.spark.read.parquet(self.path("dwh", f"{feed}_implausible"))

    def alerts(self, feed: str) -> DataFrame:
        """Hours of the latest view in which a threshold is passed."""
        return dq.extreme_alerts(self.hourly(feed), "station_id", "time")

    def duplicate_hours(self, feed: str) -> DataFrame:
        """Station hours that the latest view has more than once; there should be none."""
        return duplicate_keys(self.hourly(feed), ["station_id", "time"])

    def trace(self, feed: str) -> DataFrame:
        """Rows of each batch in the raw layers, by their logs, and the last status of its runs."""
        rows = F.sum("n_rows")
        out = None
        for name, table in (("stg", self.staged(feed)), ("psa", self.kept(feed))):
            one = table.entries().groupBy("batch_id").agg(rows.alias(f"{name}_rows"))
            out = one if out is None else out.join(one, "batch_id", "full_outer")
        runs = self.ledger.read().filter(F.col("process_name").isin(f"{feed}_import", f"{feed}_transform", f"{feed}_report"))
        status = runs.groupBy("batch_id").agg(F.max_by(F.struct("process_name", "status"), F.struct("ts", F.col("event") == "end")).alias("last"))
        counts = [F.coalesce(f"{n}_rows", F.lit(0)).alias(f"{n}_rows") for n in ("stg", "psa")]
        return out.join(status, "batch_id", "full_outer").select("batch_id", *counts, "last.process_name", "last.status")

    def hourly(self, feed: str) -> DataFrame:
        """The stored hourly view of a weather feed."""
        return wx.read_hours(self.spark, self.path("dwh", f"{feed}_hourly"))

    def rebuild_hourly(self, feed: str) -> None:
        """The hourly view anew, after stations have become known or changed their names."""
        measures = HISTORY_MEASURES if feed == "weather_history" else FORECAST_MEASURES
        wx.rebuild_hours(self.spark, self.path("psa", f"{feed}_vertical"), self.path("dwh", f"{feed}_hourly"), self.stations(), measures)

    def rail_weather(self, feed: str = "weather_history", within_hours: int = 0) -> DataFrame:
        """Hourly indicators of the full-change events beside the weather of their station and hour.

        With ``within_hours`` an hour without weather takes the last one of its station that is no older than that, and
        ``weather_hour`` says which.
        """
        events = self.spark.read.parquet(self.path("dwh", "timetables_fchg_events"))
        if within_hours:
            return rail_weather_asof(events, self.hourly(feed), within_hours)
        return rail_weather(events, self.hourly(feed))

    def sketch_calls(self, day: dt.date) -> None:
        """Sketches of a day's calls beside the log; repeating it replaces them."""
        calls = ingested_on(self.calls().withColumnRenamed("called_at", "ingested_at"), day).withColumnRenamed("ingested_at", "called_at")
        write_partitions(call_sketches(calls), self.path("metadata", "api_call_sketches"), "day")

    def performance(self, first: dt.date, last: dt.date, quantile: float = 0.95) -> DataFrame:
        """Response times and distinct calls per source and endpoint over days that have been sketched; reads no log."""
        sketches = self.spark.read.parquet(self.path("metadata", "api_call_sketches"))
        return sketched_performance(sketches.filter(F.col("day").between(F.lit(first), F.lit(last))), quantile=quantile)

    def _write_events(self, feed: str, parse: Callable[[DataFrame], DataFrame], finish: Callable[[DataFrame], DataFrame]):
        target = self.path("dwh", f"{feed}_events")

        def write(raw: DataFrame, todo: list[str]) -> str:
            dealt = Dealt(parse(raw))
            write_partitions(finish(dealt.rows), target, "batch_id", rebalance=True)
            self._set_aside(feed, dealt, "reject.reason", "reject.payload")
            return f"rows_inserted={self._written(target, todo)}"

        return write

    def transform_plan(self, latest_only: bool = False) -> list[str]:
        parse = lambda raw: tt.plan_rows(raw, self.source_tz, rejects=True)
        return self._transform("timetables_plan", self._write_events("timetables_plan", parse, lambda rows: tt.distinct_plan(rows.select(*PLAN_COLUMNS))), latest_only)

    def transform_fchg(self, latest_only: bool = False) -> list[str]:
        parse = lambda raw: tt.fchg_rows_of(raw, self.source_tz, rejects=True)
        return self._transform("timetables_fchg", self._write_events("timetables_fchg", parse, lambda rows: rows.select(*FCHG_COLUMNS)), latest_only)

    def changes_index(self) -> KeyIndex:
        return KeyIndex(self.spark, self.path("dwh", "timetables_rchg_index"))

    def transform_rchg(self, latest_only: bool = False) -> list[str]:
        """Insert-ignore: the batch that arrived first keeps a row. What is stored is asked of the index, not of the events.

        Two jobs may run at a time: the one that claims its keys later looks again.
        """
        target, index = self.path("dwh", "timetables_rchg_events"), self.changes_index()
        if index.keys.version() == 0 and self.exists(target):
            stored = self.spark.read.schema("event_hash STRING, event_date STRING, batch_id STRING").parquet(target)
            index.claim(stored, 0)

        def write(raw: DataFrame, todo: list[str]) -> str:
            dealt = Dealt(tt.rchg_rows(raw, source_tz=self.source_tz, rejects=True))
            found = staged(tt.first_arrivals(dealt.rows), "found")
            while True:
                unseen, base = index.unseen(found, todo)
                new = unseen if unseen is found else staged(unseen, "unseen")
                inserted = new.count()
                try:
                    if inserted:
                        index.claim(new, base)
                    break
                except Conflict:
                    continue
            write_partitions(new, target, "event_date", "batch_id", rebalance=True, sort=("eva_number", "timestamp_event"))
            self._set_aside("timetables_rchg", dealt, "reject.reason", "reject.payload")
            return f"rows_attempted={found.count()}, rows_inserted={inserted}"

        return self._transform("timetables_rchg", write, latest_only)

    def maintain(self, day: dt.date) -> None:
        """Housekeeping of a day that is over: its raw batches, keys and log events in few files, old leftovers gone."""
        for feed in FEEDS:
            table = self.kept(feed)
            table.compact(f"{day:%Y-%m-%d}")
            table.vacuum(), self.staged(feed).vacuum()
        self.changes_index().compact(f"{day:%Y-%m-%d}")
        self.ledger.compact()
