"""Reports over the modelled tables, and logs and totals that are kept up to date while others write."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from railfeed.functions import parse_json
from railfeed.operators import analytics as an
from railfeed.operators import quality as dq
from railfeed.plans.jobs import Warehouse
from railfeed.plans.ledger import CALL_SCHEMA
from railfeed.session import work_dir
from railfeed.streaming import streams

T0 = dt.datetime(2025, 3, 11, 9, 0, 0)


@pytest.fixture
def house(spark):
    return Warehouse(spark, work_dir(spark, "house"))


def texts(spark, *payloads):
    return spark.createDataFrame([(p,) for p in payloads], "payload STRING")


def test_hours_without_weather_take_the_last_one(spark, house):
    station = '{"number":"1","name":"Bremen","evaNumbers":[{"number":80,"isMain":true,"geographicCoordinates":{"coordinates":[8.8,53.1]}}],"ril100Identifiers":[{"rilIdentifier":"HB","isMain":true}]}'
    house.ingest("db_stations", texts(spark, f"[{station}]"), T0)
    hours = '{"latitude":53.1,"longitude":8.8,"hourly":{"time":["2025-03-11T09:00","2025-03-11T10:00","odd"],"temperature_2m":[4,5,6]}}'
    house.ingest("weather_history", texts(spark, hours), T0)
    house.transform_weather("weather_history")
    message = '<m id="M{0}" t="d" c="7" ts="25031{1}05"/>'
    change = "".join(message.format(i, h) for i, h in enumerate(["108", "109", "112", "120"]))
    house.ingest("timetables_fchg", texts(spark, f'<timetable station="Bremen" eva="80"><s id="7">{change}</s></timetable>'), T0)
    house.transform_fchg()
    rows = {(r.hour.day, r.hour.hour): (r.n_events, r.temperature_2m, r.weather_hour and r.weather_hour.hour) for r in house.rail_weather(within_hours=4).collect()}
    assert rows == {(11, 8): (1, None, None), (11, 9): (1, 4.0, 9), (11, 12): (1, 5.0, 10), (11, 20): (1, None, None)}
    assert {r.hour.hour: r.temperature_2m for r in house.rail_weather().collect()} == {8: None, 9: 4.0, 12: None, 20: None}


def test_key_changes_follow_arrival(spark):
    batches = [("b_10", "ab"), ("b_9", "ac"), ("b_11", "abc"), ("b_2", ""), ("b_1", "a")]
    rows = [(b, T0 + dt.timedelta(hours=i), "{" + ",".join(f'"{k}":1' for k in keys) + "}") for i, (b, keys) in enumerate(batches)]
    raw = spark.createDataFrame(rows + rows[:1], "batch_id STRING, ingested_at TIMESTAMP_NTZ, payload STRING")
    got = sorted((r.batch_id, r.measure, r.change) for r in dq.key_changes(raw, parse_json(F.col("payload"))).collect())
    assert got == sorted([
        ("b_9", "b", "vanished"), ("b_9", "c", "new"), ("b_11", "b", "returning"),
        ("b_2", "a", "vanished"), ("b_2", "b", "vanished"), ("b_2", "c", "vanished"), ("b_1", "a", "returning"),
    ])
    assert dq.key_changes(raw.filter("false"), parse_json(F.col("payload"))).count() == 0


def test_sketches_answer_for_any_span_without_the_log(spark, house):
    rows = [("db", "plan", f'{{"n":{i % 700}}}', 200, (i * 7919) % 10_000, 1, T0 + dt.timedelta(days=i % 10)) for i in range(20_000)]
    spark.createDataFrame(rows, CALL_SCHEMA).write.parquet(house.path("metadata", "api_call_log"))
    for day in range(10):
        house.sketch_calls(T0.date() + dt.timedelta(days=day))
    house.sketch_calls(T0.date())  # again: the day is replaced
    (week,) = house.performance(T0.date(), T0.date() + dt.timedelta(days=6)).collect()
    times = sorted(r[4] for i, r in enumerate(rows) if i % 10 < 7)
    below = sum(t < week.quantile_ms for t in times) / len(times)
    assert week.n_calls == 14_000 and abs(below - 0.95) < 0.02 and abs(week.n_distinct - 490) < 25
    plan = house.performance(T0.date(), T0.date())._jdf.queryExecution().executedPlan().toString()
    assert "api_call_log" not in plan


def test_compaction_keeps_events_appended_meanwhile(spark, house, monkeypatch):
    for i in range(4):
        house.ledger.run_batch("p", f"B{i}", lambda: "rows=1")
    plain, calls = house.spark.read.__class__.parquet, []

    def slow(self, *paths, **options):
        out = plain(self, *paths, **options)
        if len(paths) > 1 and not calls:  # the files are chosen; another job logs before they are replaced
            calls.append(1)
            monkeypatch.undo()
            house.ledger.append([("late", "p", "B9", "end", "success", "rows=2")])
        return out

    monkeypatch.setattr(house.spark.read.__class__, "parquet", slow)
    before = sorted(house.ledger.read().collect(), key=str)
    assert house.ledger.compact() == 8
    after = sorted(house.ledger.read().collect(), key=str)
    assert calls and len(after) == len(before) + 1 and set(before) < set(after) and house.ledger.is_done("p", "B9")
    assert len(spark.read.parquet(house.ledger.path).inputFiles()) <= 3


def _sums(spark, epoch, *rows):
    schema = "station STRING, hour TIMESTAMP, n_events BIGINT, sum_value DECIMAL(28,2)"
    df = spark.createDataFrame([(s, dt.datetime(2025, 3, 1, h), n, None) for s, h, n in rows], schema)
    path = work_dir(spark, "sums")
    df.select(F.lit("2025-03-01").alias("day"), F.lit(0).alias("bucket"), "*", F.lit(epoch).cast("long").alias("epoch")).write.parquet(path)
    return spark.read.parquet(path)


def test_a_repeated_micro_batch_adds_nothing_twice(spark):
    target, keys = work_dir(spark, "totals"), ["station", "hour"]

    def bring(epoch, *rows):
        new = _sums(spark, epoch, *rows)
        streams.write_partitions(streams._added(new, target, epoch, keys), target, "day", "bucket")
        return {(r.station, r.hour.hour): r.n_events for r in spark.read.parquet(target).collect()}

    assert bring(0, ("a", 9, 2), ("b", 9, 1)) == {("a", 9): 2, ("b", 9): 1}
    assert bring(1, ("a", 9, 5), ("a", 8, 1)) == {("a", 8): 1, ("a", 9): 7, ("b", 9): 1}
    assert bring(1, ("a", 9, 5), ("a", 8, 1)) == {("a", 8): 1, ("a", 9): 7, ("b", 9): 1}
    assert bring(2, ("b", 9, 4)) == {("a", 8): 1, ("a", 9): 7, ("b", 9): 5}


def test_a_repeated_landing_has_the_same_arrival(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "1.xml").write_text("<a/>")
    seen = set()
    for run in range(2):  # a lost checkpoint reads the file again
        streams.land_stream(spark, str(source), target, str(tmp_path / f"progress{run}")).awaitTermination()
        seen |= {r.ingested_at for r in spark.read.parquet(target).collect()}
    assert len(seen) == 1


def test_housekeeping_leaves_everything_readable(spark, house):
    doc = '<timetable station="A" eva="1"><s id="7"><dp pt="2503110900" ct="25031109{:02d}"/></s></timetable>'
    for minute in range(3):
        house.ingest("timetables_rchg", texts(spark, doc.format(minute)), T0 + dt.timedelta(minutes=minute))
        house.transform_rchg()
    house.maintain(T0.date())
    assert house.raw("timetables_rchg").count() == 3 and house.kept("timetables_rchg").entries().select("folder").distinct().count() == 1
    assert house.batch("timetables_rchg", "RCHG_20250311_090100").first().payload == doc.format(1)
    house.ingest("timetables_rchg", texts(spark, doc.format(1), doc.format(9)), T0 + dt.timedelta(minutes=9))
    house.transform_rchg()
    assert spark.read.parquet(house.path("dwh", "timetables_rchg_events")).count() == 4 and house.transform_rchg() == []


def test_stations_from_pages_in_one_job(spark, house):
    """Pages out of order; what comes after the empty page is not used."""
    one = '{{"number":"{0}","name":"S{0}","evaNumbers":[{{"number":{0},"isMain":true,"geographicCoordinates":{{"coordinates":[8.8,53.1]}}}}],"ril100Identifiers":[]}}'
    page = lambda *n: '{"total":9,"stations":[' + ",".join(one.format(i) for i in n) + "]}"
    pages = [(4, 200, page(5)), (0, 200, page(1, 2)), (2, 200, page(3, 4)), (8, 200, page(9)), (6, 200, page())]
    batch = house.ingest_pages(spark.createDataFrame(pages, "offset INT, status_code INT, payload STRING"), T0, 2)
    assert sorted(r.station_id for r in house.stations().collect()) == ["1", "2", "3", "4", "5"]
    (used,) = [r.message for r in house.ledger.read("db_stations_pages").collect()]
    assert used == "total=9, page_count=3, limit=2, status_code=200" and house.manifest("db_stations").first().batch_id == batch


def test_times_of_another_zone(spark):
    house = Warehouse(spark, work_dir(spark, "house"), source_tz="Europe/Berlin")
    house.ingest("timetables_plan", texts(spark, '<timetable station="A"><s id="7"><dp pt="2507011200"/></s></timetable>'), T0)
    house.transform_plan()
    assert spark.read.parquet(house.path("dwh", "timetables_plan_events")).first().event_time == dt.datetime(2025, 7, 1, 10, 0)


def test_quality_of_batches_as_a_job(spark, house):
    station = '{"number":"1","name":"Bremen","evaNumbers":[{"number":80,"isMain":true,"geographicCoordinates":{"coordinates":[8.8,53.1]}}],"ril100Identifiers":[{"rilIdentifier":"HB","isMain":true}]}'
    house.ingest("db_stations", texts(spark, f"[{station}]"), T0)
    day = '{{"latitude":53.1,"longitude":8.8,"hourly":{{"time":["2025-03-11T09:00","2025-03-11T10:00"],"temperature_2m":[{},{}]}}}}'
    house.ingest("weather_history", texts(spark, day.format(4, 70)), T0, "b1")
    assert house.report_weather("weather_history") == []  # nothing has been transformed
    house.transform_weather("weather_history")
    house.ingest("weather_history", texts(spark, day.format(36, 5)), T0 + dt.timedelta(hours=1), "b2")
    assert house.report_weather("weather_history") == ["b1"]
    house.transform_weather("weather_history")
    assert house.report_weather("weather_history") == ["b2"] and house.report_weather("weather_history") == []
    summary = {r.batch_id: (r.n_rows, r.n_implausible, r.first_time) for r in house.batch_summary("weather_history").collect()}
    assert summary == {"b1": (2, 1, "2025-03-11T09:00"), "b2": (2, 0, "2025-03-11T09:00")}
    assert [(r.batch_id, r.measure, r.value) for r in house.implausible("weather_history").collect()] == [("b1", "temperature_2m", 70.0)]
    assert [(r.time, r.alert, r.value) for r in house.alerts("weather_history").collect()] == [("2025-03-11T09:00", "heat", 36.0)]
    assert house.duplicate_hours("weather_history").count() == 0
    trace = {r.batch_id: (r.stg_rows, r.psa_rows, r.process_name, r.status) for r in house.trace("weather_history").collect()}
    assert trace == {b: (0, 1, "weather_history_report", "success") for b in ("b1", "b2")}
