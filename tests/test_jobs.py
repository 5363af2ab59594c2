"""Jobs end to end: replays change nothing, order of arrival does not matter."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from railfeed.operators.weather import forecast_hourly, read_vertical
from railfeed.operators.timetables import rchg_unstored, text_partition
from railfeed.plans.jobs import Warehouse
from railfeed.plans.layers import latest_batch
from railfeed.plans.ledger import process_state
from railfeed.session import shared_dir, work_dir
from railfeed.sources import landing, requests

T0 = dt.datetime(2025, 3, 11, 9, 0, 0)


@pytest.fixture
def house(spark):
    return Warehouse(spark, work_dir(spark, "house"))


def texts(spark, *payloads):
    return spark.createDataFrame([(p,) for p in payloads], "payload STRING")


def test_replayed_changes_are_ignored(spark, house):
    def doc(minute):
        return f'<timetable station="A" eva="1"><s id="7"><dp pt="2503110900" ct="25031109{minute:02d}"/><m id="M" ts="2503110855"/></s></timetable>'

    house.ingest("timetables_rchg", texts(spark, doc(5)), T0)
    assert len(house.transform_rchg()) == 1
    assert house.transform_rchg() == []
    # the next poll repeats what is known and adds one change
    house.ingest("timetables_rchg", texts(spark, doc(5), doc(6), "broken"), T0 + dt.timedelta(minutes=10))
    house.ingest("timetables_rchg", texts(spark, doc(6)), T0 + dt.timedelta(minutes=20))
    assert len(house.transform_rchg()) == 2
    rows = spark.read.parquet(house.path("dwh", "timetables_rchg_events"))
    assert rows.groupBy("batch_id").count().orderBy("batch_id").collect() == [
        ("RCHG_20250311_090000", 2),
        ("RCHG_20250311_091000", 1),
    ]
    messages = {r.batch_id: r.message for r in process_state(house.ledger.read()).filter("process_name LIKE '%transform' AND status = 'success'").collect()}
    assert messages["RCHG_20250311_090000"] == "rows_attempted=2, rows_inserted=2"
    assert messages["RCHG_20250311_091000"] == "rows_attempted=3, rows_inserted=1"


def test_jobs_without_rows_succeed(spark, house):
    """A poll of known changes, broken documents and an empty batch leave nothing pending, in every feed."""
    known = '<timetable station="A" eva="1"><s id="7"><dp pt="2503110900" ct="2503110905"/><m id="M" ts="2503110855"/></s></timetable>'
    house.ingest("timetables_rchg", texts(spark, known), T0)
    house.transform_rchg()
    none = spark.createDataFrame([], "payload STRING")
    for minute, payloads in enumerate([texts(spark, known), texts(spark, "broken", "<a>"), none], start=10):
        now = T0 + dt.timedelta(minutes=minute)
        for feed in ("timetables_rchg", "timetables_plan", "timetables_fchg", "weather_forecast", "weather_history"):
            house.ingest(feed, texts(spark, "{") if "weather" in feed and minute == 10 else payloads, now)
    house.transform_rchg(), house.transform_plan(), house.transform_fchg()
    house.transform_weather("weather_forecast"), house.transform_weather("weather_history")
    feeds = ("timetables_rchg", "timetables_plan", "timetables_fchg", "weather_forecast", "weather_history")
    assert [house.pending(f) for f in feeds] == [[]] * 5
    state = process_state(house.ledger.read()).filter("process_name LIKE '%transform'")
    assert {r.status for r in state.collect()} <= {"success", "skipped"}
    rchg = [r.message for r in state.filter("process_name = 'timetables_rchg_transform' AND status = 'success'").collect()]
    assert sorted(rchg) == ["rows_attempted=2, rows_inserted=0"] * 3 + ["rows_attempted=2, rows_inserted=2"]
    assert sorted(r.reason for r in house.quarantine("timetables_rchg").collect()) == ["malformed", "malformed"]
    assert {r.reason for r in house.quarantine("weather_forecast").collect()} == {"not_json"}


def test_ingests_of_one_second_keep_all_payloads(spark, house):
    ids = [house.ingest("timetables_plan", texts(spark, f"<a n='{i}'/>", f"<b n='{i}'/>"), T0) for i in range(6)]
    assert len(set(ids)) == 6 and ids[0] == "PLAN_20250311_090000"
    rows = house.raw("timetables_plan").collect()
    assert len({r.payload for r in rows}) == 12 and sorted(r.raw_id for r in rows) == list(range(12))
    assert {r.ingest_date for r in rows} == {"2025-03-11"}
    house.ingest("timetables_plan", texts(spark, "<c/>"), T0, batch_id=ids[2])
    assert house.raw("timetables_plan").count() == 12
    plan = house.batch("timetables_plan", *ids[:2])._jdf.queryExecution().executedPlan().toString()
    assert "ingest_date" in plan.split("PartitionFilters")[1].split("]")[0]


def test_the_first_arrival_keeps_a_row_whatever_the_job_takes(spark, house, monkeypatch):
    doc = '<timetable station="A" eva="1"><s id="7"><dp pt="2503110900" ct="2503110905"/></s></timetable>'
    for size in (1, 500):
        monkeypatch.setattr("railfeed.plans.jobs.BATCHES_PER_JOB", size)
        one = Warehouse(spark, work_dir(spark, "house"))
        one.ingest("timetables_rchg", texts(spark, doc), T0, batch_id="zz")
        one.ingest("timetables_rchg", texts(spark, doc), T0 + dt.timedelta(hours=1), batch_id="aa")
        one.transform_rchg()
        assert [r.batch_id for r in spark.read.parquet(one.path("dwh", "timetables_rchg_events")).collect()] == ["zz"]


def test_a_first_poll_is_numbered_and_stored_without_detours(spark, house, monkeypatch):
    """Landed rows are numbered where they lie, rows are not sorted by outcome, and new rows are not copied when all are new."""
    from railfeed.plans import jobs
    from railfeed.plans.outcomes import Dealt
    from railfeed.sources.tables import numbered

    doc = '<timetable station="A" eva="1"><s id="{0}"><dp pt="2503110900" ct="25031109{0:02d}"/></s></timetable>'
    docs = spark.range(0, 40, 1, 5).select(F.format_string("%02d", "id").alias("payload"), F.lit(T0).alias("ingested_at"), F.lit("b").alias("batch_id"))
    rows = numbered(docs.filter("id NOT BETWEEN 8 AND 15"))
    assert "row_number" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.raw_id, int(r.payload)) for r in rows.collect()) == list(enumerate([*range(8), *range(16, 40)]))
    names, paths, whole = [], [], jobs.staged
    monkeypatch.setattr(jobs, "staged", lambda df, name: (names.append(name), whole(df, name))[1])
    monkeypatch.setattr(jobs, "Dealt", lambda rows: (d := Dealt(rows), paths.extend(d._all.inputFiles()))[0])
    house.ingest("timetables_rchg", texts(spark, doc.format(5), doc.format(6), "broken"), T0)
    house.transform_rchg()
    assert names == ["found"] and paths and not [f for f in paths if "outcome=" in f]
    house.ingest("timetables_rchg", texts(spark, doc.format(6), doc.format(7)), T0 + dt.timedelta(minutes=10))
    house.transform_rchg()
    stored = spark.read.parquet(house.path("dwh", "timetables_rchg_events")).collect()
    assert sorted(r.new_time.minute for r in stored) == [5, 6, 7] and names == ["found", "found", "unseen"]
    assert [r.reason for r in house.quarantine("timetables_rchg").collect()] == ["malformed"]


def test_odd_texts_do_not_read_the_whole_target(spark, house):
    doc = '<timetable station="A" eva="1"><s id="7"><dp pt="2503110900" ct="{}" l="{}"/></s></timetable>'
    house.ingest("timetables_rchg", texts(spark, doc.format("2503110905", "1"), doc.format("2504110905", "1")), T0)
    house.transform_rchg()
    target = house.path("dwh", "timetables_rchg_events")
    house.ingest("timetables_rchg", texts(spark, doc.format("2503110906", "a|b"), doc.format("2599990000", "1")), T0 + dt.timedelta(minutes=10))
    new, _ = rchg_unstored(spark, house.raw("timetables_rchg"), target)
    filters = new._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[-1].split("]")[0]
    assert "event_date" in filters and "2025-03-11" in filters
    house.transform_rchg()
    assert spark.read.parquet(target).count() == 4


def test_weather_and_rail_meet_on_the_modelled_tables(spark, house):
    left = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    before = {f.getPath().getName().rsplit("-", 1)[0] for f in left.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(left)}
    station = '{"number":"1","name":"Bremen","evaNumbers":[{"number":80,"isMain":true,"geographicCoordinates":{"coordinates":[8.8,53.1]}}],"ril100Identifiers":[{"rilIdentifier":"HB","isMain":true}]}'
    house.ingest("db_stations", texts(spark, f"[{station}]"), T0)
    hours = '{"latitude":53.1,"longitude":8.8,"hourly":{"time":["2025-03-11T09:00","2025-03-11T10:00","odd"],"temperature_2m":[4,5,6]}}'
    house.ingest("weather_history", texts(spark, hours), T0)
    house.transform_weather("weather_history")
    assert {r.time: r.temperature_2m for r in house.hourly("weather_history").collect()} == {"2025-03-11T09:00": 4.0, "2025-03-11T10:00": 5.0, "odd": 6.0}
    change = '<timetable station="Bremen" eva="80"><s id="7"><m id="M" t="d" c="7" ts="2503110905"/><m id="N" t="d" c="3" ts="2503111205"/></s></timetable>'
    house.ingest("timetables_fchg", texts(spark, change), T0)
    house.transform_fchg()
    left = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    names = {f.getPath().getName().rsplit("-", 1)[0] for f in left.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(left)}
    assert not names & {"matches", "days", "spots", "numbered"} - before
    rows = {r.hour.hour: (r.n_events, r.mean_delay, r.temperature_2m) for r in house.rail_weather().collect()}
    assert rows == {9: (1, 7.0, 4.0), 12: (1, 3.0, None)}


def test_compacting_the_ledger_keeps_every_event(spark, house):
    for i in range(5):
        house.ledger.run_batch("p", f"B{i}", lambda: "rows=1")
    before = sorted(house.ledger.read().collect())
    house.ledger.compact()
    assert sorted(house.ledger.read().collect()) == before and house.ledger.is_done("p", "B3")


def test_a_batch_lost_from_the_ledger_can_run_again(spark, house):
    doc = '<timetable station="A"><s id="7"><dp pt="2503110900"/></s></timetable>'
    for minute in range(3):
        house.ingest("timetables_plan", texts(spark, doc), T0 + dt.timedelta(minutes=minute))
    assert house.transform_plan(latest_only=True) == ["PLAN_20250311_090200"]
    assert house.transform_plan(latest_only=True) == []
    assert house.transform_plan() == ["PLAN_20250311_090000", "PLAN_20250311_090100"]
    skipped = process_state(house.ledger.read()).filter("status = 'skipped'").collect()
    assert [r.batch_id for r in skipped] == ["PLAN_20250311_090200"]
    house.ledger.path += "_lost"
    assert len(house.transform_plan()) == 3
    assert spark.read.parquet(house.path("dwh", "timetables_plan_events")).count() == 3


def test_ledger_logs_success_skip_and_failure(spark, house):
    def broken():
        raise ValueError("no")

    assert house.ledger.run_batch("p", "B1", lambda: "rows=1") == "success"
    assert house.ledger.run_batch("p", "B1", lambda: "rows=1") == "skipped"
    with pytest.raises(ValueError):
        house.ledger.run_batch("p", "B2", broken)
    state = {(r.batch_id, r.status) for r in process_state(house.ledger.read()).collect()}
    assert state == {("B1", "success"), ("B1", "skipped"), ("B2", "failed")}
    assert not house.ledger.is_done("p", None)
    assert not house.ledger.is_done("p", "B2")


def test_forecast_from_landing_to_view(spark, house):
    station = '{"number":"1","name":"Bremen","evaNumbers":[{"number":80,"isMain":true,"geographicCoordinates":{"coordinates":[8.8,53.1]}}],"ril100Identifiers":[{"rilIdentifier":"HB","isMain":true}]}'
    house.ingest("db_stations", texts(spark, f"[{station}]"), T0)

    def forecast(value):
        one = f'{{"latitude":53.10001,"longitude":8.8,"hourly":{{"time":["2025-03-11T09:00"],"temperature_2m":[{value}]}}}}'
        return texts(spark, f"[{one},{one}]")

    # the later batch arrives first; the view must not care
    house.ingest("weather_forecast", forecast(2), T0, "open_meteo_20250311090000_00000002")
    house.ingest("weather_forecast", forecast(1), T0, "open_meteo_20250311030000_00000001")
    assert len(house.transform_weather("weather_forecast")) == 2
    vertical = read_vertical(spark, house.path("psa", "weather_forecast_vertical"))
    assert vertical.count() == 4
    (row,) = forecast_hourly(vertical, house.stations()).collect()
    assert (row.station_id, row.eva_number, row.temperature_2m) == ("1", "80", 2.0)


def test_ingest_keeps_text_and_purges_staging(spark, house):
    odd = ' <a>\n "x" & y</a> \t'
    house.ingest("timetables_fchg", texts(spark, odd, ""), T0)
    assert sorted(r.payload for r in house.raw("timetables_fchg").collect()) == ["", odd]
    stg = spark._jvm.org.apache.hadoop.fs.Path(house.path("stg", "timetables_fchg"))
    names = [f.getPath().getName() for f in stg.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(stg)]
    assert [n for n in names if n.startswith("batch_id")] == []


def test_latest_batch_goes_by_arrival(spark):
    rows = [(1, "x", T0, "B9"), (2, "x", T0 + dt.timedelta(hours=1), "B1"), (3, "x", T0 + dt.timedelta(hours=2), None)]
    raw = spark.createDataFrame(rows, "raw_id BIGINT, payload STRING, ingested_at TIMESTAMP_NTZ, batch_id STRING")
    assert latest_batch(raw).first().batch_id == "B1"


def test_equal_texts_share_a_partition(spark):
    texts_ = ["a|b|2025-03-11T09:00:00Z", "x|2025-03-11T09:00:00Z|RS1", "x|2025-13-45T09:00:00Z|a|b", "x|none|", "x|2024-01-01T00:00:00Z|2025-03-11T00:00:00Z"]
    df = spark.createDataFrame([(t,) for t in texts_], "t STRING")
    found = [r[0] for r in df.select(text_partition(F.col("t"))).collect()]
    assert found == ["2025-03-11", "2025-03-11", "2025-13-45", "none", "2025-03-11"]


@pytest.mark.parametrize(
    "payload, n_items, total",
    [
        ('{"total":3,"data":[1,2]}', 2, 3),
        ('{"stations":[1],"data":"x"}', 1, None),
        ('{"z":[9],"data":[],"a":[1,2]}', 1, None),
        ('{"data":[],"z":[9]}', 0, None),
        ('{"b":[1,2,3],"a":[1]}', 3, None),
        ("[1,2]", 2, 2),
        ('{"a":1}', None, None),
        ("no json", None, None),
    ],
)
def test_page_envelopes(spark, payload, n_items, total):
    row = landing.page_envelope(texts(spark, payload)).select(F.array_size("items").alias("n"), "total").first()
    assert (row.n, row.total) == (n_items, total)


def test_land_json_rows(spark):
    rows = landing.land_json(texts(spark, '[{"a": 1}, 2]', ' {"a":  1}', "[]", "no json"))
    assert sorted(r.payload for r in rows.collect()) == sorted(['{"a":1}', "2", ' {"a":  1}', "no json"])


def test_coordinate_groups(spark):
    one = spark.createDataFrame([(i, 50 + i / 7, 8.0) for i in range(450)], "k BIGINT, latitude DOUBLE, longitude DOUBLE")
    groups = requests.coord_batches(one, "k").orderBy("request_no").collect()
    assert [g.station_count for g in groups] == [200, 200, 50]
    assert groups[0].latitude.split(",")[:3] == ["50.0", "50.142857", "50.285714"]
    none = requests.coord_batches(one.limit(0), "k").collect()
    assert [(g.request_no, g.station_count, g.latitude, g.longitude) for g in none] == [(0, 1, "53.0793", "8.8017")]


def test_archive_window_rules(spark):
    schema = "source STRING, endpoint STRING, params STRING, status_code INT, response_time_ms INT, result_count INT, called_at TIMESTAMP_NTZ"

    def window(*calls, **kwargs):
        log = spark.createDataFrame([("open_meteo", "archive", p, s, 1, n, t) for p, s, n, t in calls], schema)
        return tuple(requests.archive_window(log, dt.date(2025, 3, 10), **kwargs).first())

    day = lambda d: f'{{"end_date":"2025-02-{d:02d}"}}'
    assert window() == ("2025-01-01", "2025-03-08")
    assert window((day(1), 200, 1, T0), (day(2), 500, 1, T0 + dt.timedelta(1)))[0] == "2025-02-01"
    assert window((day(1), 200, 1, T0), (day(2), 204, 0, T0 + dt.timedelta(1)))[0] == "2025-02-02"
    assert window((day(1), 200, 1, T0), (day(2), 204, 0, T0 + dt.timedelta(1)), require_results=True)[0] == "2025-02-01"
    assert window((day(1), 200, 1, T0), (day(3), 200, 1, None))[0] == "2025-02-03"
    assert window(('{"end_date":null}', 200, 1, T0))[0] == "2025-01-01"


def test_region_settings_come_from_arguments_then_environment(spark, monkeypatch):
    from railfeed.operators.stations import region_eva

    rows = [("Bremen", "HB", "1"), ("Hamburg", "AH", "2"), ("Hameln", "AH", "3")]
    stations = spark.createDataFrame(rows, "name STRING, ds100 STRING, eva_number STRING")
    assert [r[0] for r in region_eva(stations).collect()] == ["1"]
    monkeypatch.setenv("DB_TIMETABLES_FILTER_NAME_PREFIX", "Ham%")
    monkeypatch.setenv("DB_TIMETABLES_FILTER_DS100_PREFIX", "A%")
    assert sorted(r[0] for r in region_eva(stations).collect()) == ["2", "3"]
    monkeypatch.setenv("DB_TIMETABLES_STATIONS_LIMIT", "1")
    assert [r[0] for r in region_eva(stations).collect()] == ["2"]
    assert [r[0] for r in region_eva(stations, "Bre%", "HB%").collect()] == ["1"]
    monkeypatch.setenv("ARCHIVE_START_DATE", "2020-01-01")
    schema = "source STRING, endpoint STRING, params STRING, status_code INT, result_count INT, called_at TIMESTAMP_NTZ"
    log = spark.createDataFrame([], schema)
    assert requests.archive_window(log, dt.date(2025, 3, 10)).first().start_date == "2020-01-01"


def test_requests_of_a_warehouse(spark, house):
    def station(i):
        return (
            f'{{"number":"{i}","name":"Bremen {i}","evaNumbers":[{{"number":{i},"isMain":true,"geographicCoordinates":{{"coordinates":[8.{i},53.1]}}}}],'
            f'"ril100Identifiers":[{{"rilIdentifier":"HB{i}","isMain":true}}]}}'
        )

    assert house.archive_requests(dt.date(2025, 3, 10)).count() == 0
    assert house.forecast_requests().first().latitude == "53.0793"
    house.ingest("db_stations", texts(spark, f"[{station(1)},{station(2)}]"), T0)
    # the clocks change on this day: still 30 hours on the wall clock
    grid = house.plan_requests(dt.datetime(2025, 3, 30, 0, 0))
    hours = [(r.date_yymmdd, r.hour_hh) for r in grid.filter("eva_number = '1'").collect()]
    assert sorted(hours) == [("250330", f"{h:02d}") for h in range(24)] + [("250331", f"{h:02d}") for h in range(6)]
    assert [(r.station_count, r.longitude) for r in house.forecast_requests().collect()] == [(2, "8.1,8.2")]

    call = ("open_meteo", "archive", 200, 5, 1, T0, "2025-02-01", "2025-03-01")
    schema = "source STRING, endpoint STRING, status_code INT, response_time_ms INT, result_count INT, called_at TIMESTAMP_NTZ, start_date STRING, end_date STRING"
    house.log_calls(spark.createDataFrame([call], schema), ["start_date", "end_date"])
    (row,) = house.archive_requests(dt.date(2025, 3, 10)).collect()
    assert (row.start_date, row.end_date, row.station_count) == ("2025-03-01", "2025-03-08", 2)
    assert len(row.hourly.split(",")) == 16 and "visibility" not in row.hourly


def test_captured_files_and_counts(spark, tmp_path):
    from railfeed.sources.landing import answered, forecast_result_count, read_responses, result_count

    (tmp_path / "a.xml").write_bytes(b"<a>\r\n x</a>\n\n")
    (row,) = read_responses(spark, str(tmp_path)).collect()
    assert row.payload == "<a>\r\n x</a>\n\n" and row.source_file.endswith("a.xml")
    counts = texts(spark, "[1,2]", "[]", "{}", '{"results":[1,2,3]}', '{"a":1}', "null", "no json")
    found = counts.select(result_count(F.col("payload")), forecast_result_count(F.col("payload"))).collect()
    assert [tuple(r) for r in found] == [(2, 1), (0, 0), (1, 0), (3, 1), (1, 1), (1, 0), (1, 1)]
    calls = spark.createDataFrame([("", 404, False), (None, 500, True), ("x", 200, False)], "payload STRING, status_code INT, raised BOOLEAN")
    assert answered(calls).count() == 2
