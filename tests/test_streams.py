"""Streams: restarts pick up where they stopped, repeats change nothing."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from railfeed.operators import weather as wx
from railfeed.operators.matching import build_station_index
from railfeed.schemas import FORECAST_MEASURES
from railfeed.session import work_dir
from railfeed.streaming import land_stream, latest_weather_stream, page_stream, rchg_insert_stream, station_hour_stream


def test_whole_files_land_untouched_and_once(spark, tmp_path):
    source, target, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "progress")
    source.mkdir()
    first, second = "<a>\n one </a>\n", '{\n "two": 2}'
    (source / "1.xml").write_text(first)
    land_stream(spark, str(source), target, progress, whole_files=True).awaitTermination()
    (source / "2.json").write_text(second)
    for _ in range(2):
        land_stream(spark, str(source), target, progress, whole_files=True).awaitTermination()
    rows = spark.read.parquet(target).collect()
    assert sorted(r.payload for r in rows) == sorted([first, second])
    assert {r.batch_id for r in rows} == {"stream_000000000000", "stream_000000000001"}
    assert all(r.raw_id is not None and r.ingested_at is not None and r.source_file for r in rows)


def test_a_batch_split_over_micro_batches_stays_whole(spark):
    source, vertical, target, progress = (work_dir(spark, f"split-{n}") for n in ("in", "vertical", "out", "progress"))
    schema = "raw_id BIGINT, payload STRING, ingested_at TIMESTAMP_NTZ, batch_id STRING"

    def land(*rows):
        for i, batch, hour, value in rows:
            doc = f'{{"latitude":53.1,"longitude":8.8,"hourly":{{"time":["2025-03-11T{hour:02d}:00"],"temperature_2m":[{value}]}}}}'
            spark.createDataFrame([(i, doc, dt.datetime(2025, 3, 11), batch)], schema).coalesce(1).write.mode("append").parquet(source)
        payloads = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        latest_weather_stream(payloads, index, stations, FORECAST_MEASURES, vertical, target, progress).awaitTermination()
        return {r.time[11:13]: r.temperature_2m for r in spark.read.parquet(target).collect()}

    dimension = "station_id STRING, name STRING, latitude DOUBLE, longitude DOUBLE, ds100 STRING, eva_number STRING"
    stations = spark.createDataFrame([("1", "A", 53.1, 8.8, "HB", "80")], dimension)
    index = build_station_index(stations.select("station_id", "latitude", "longitude"))
    assert land((1, "b1", 9, 1), (2, "b1", 10, 2), (3, "b1", 11, 3)) == {"09": 1.0, "10": 2.0, "11": 3.0}
    # a missing batch counts as the newest
    assert land((4, None, 9, 7)) == {"09": 7.0, "10": 2.0, "11": 3.0}
    assert land((5, "b2", 9, 8), (6, "b2", 10, 9)) == {"09": 7.0, "10": 9.0, "11": 3.0}


def test_late_events_count_and_full_hours_raise_alerts(spark):
    source, stored, target, alerts, progress = (work_dir(spark, f"alert-{n}") for n in ("in", "events", "out", "alerts", "progress"))
    schema = "station STRING, ts TIMESTAMP, value DOUBLE"

    def poll(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        events = spark.readStream.schema(schema).parquet(source)
        station_hour_stream(
            events, stored, target, progress, "station", "ts", F.col("value") > 5, F.col("n_incidents") >= 2, alerts
        ).awaitTermination()
        hours = {(r.station, r.hour.day): (r.n_events, r.n_incidents) for r in spark.read.parquet(target).collect()}
        return hours, sorted((r.station, r.hour.day) for r in spark.read.schema("station STRING, hour TIMESTAMP").parquet(alerts).collect())

    day = lambda d: dt.datetime(2025, 3, d, 9, 30)
    assert poll(("a", day(1), 9.0), ("a", day(20), 1.0)) == ({("a", 1): (1, 1), ("a", 20): (1, 0)}, [])
    assert poll(("a", day(1), 8.0)) == ({("a", 1): (2, 2), ("a", 20): (1, 0)}, [("a", 1)])


def test_repeated_changes_are_inserted_once(spark):
    source, target, progress = (work_dir(spark, f"repeat-{n}") for n in ("in", "out", "progress"))
    schema = "payload STRING, ingested_at TIMESTAMP_NTZ"

    def poll(*minutes):
        docs = [
            (f'<timetable eva="1"><s id="7"><dp pt="2503110900" ct="25031109{m:02d}"/></s></timetable>', dt.datetime(2025, 3, 11))
            for m in minutes
        ]
        spark.createDataFrame(docs, schema).coalesce(1).write.mode("append").parquet(source)
        rchg_insert_stream(spark.readStream.schema(schema).parquet(source), target, progress).awaitTermination()
        return sorted((r.new_time.minute, r.batch_id) for r in spark.read.parquet(target).collect())

    one = "RCHG_000000000000"
    assert poll(5, 5) == [(5, one)]
    assert poll(5, 6) == [(5, one), (6, "RCHG_000000000001")]
    assert poll(6) == [(5, one), (6, "RCHG_000000000001")]


def test_pages_in_any_order_give_their_run(spark):
    source, stored, target, progress = (work_dir(spark, f"pages-{n}") for n in ("in", "stored", "out", "progress"))
    schema = "batch_id STRING, offset INT, status_code INT, payload STRING"
    page = lambda *n: "[" + ",".join(f'{{"n":{i}}}' for i in n) + "]"

    def poll(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        page_stream(spark.readStream.schema(schema).parquet(source), stored, target, progress, 2).awaitTermination()
        items = spark.read.schema("batch_id STRING, offset INT, pos INT, payload STRING").parquet(target).collect()
        return {b: [int(r.payload[5:-1]) for r in sorted(items, key=lambda r: (r.offset, r.pos)) if r.batch_id == b] for b in {r.batch_id for r in items}}

    whole = '{"total":6,"data":' + page(1, 2) + "}"
    assert poll(("a", 4, 200, "{\"data\":[{\"n\":5},{\"n\":6}]}")) == {"a": [5, 6]}
    assert poll(("a", 0, 200, whole), ("b", 0, 200, page())) == {"a": [1, 2, 5, 6]}
    assert poll(("a", 2, 500, "down")) == {"a": [1, 2]}
    # the page is fetched again: the run is whole
    assert poll(("a", 2, 200, '{"data":[{"n":3},{"n":4}]}')) == {"a": [1, 2, 3, 4, 5, 6]}
    assert poll(("a", 0, 500, "down")) == {}


def _files(folder):
    return [os.path.join(at, n) for at, _, names in os.walk(folder.removeprefix("file:")) for n in names if n.endswith(".parquet")]


def test_many_runs_share_few_folders(spark):
    source, stored, target, progress = (work_dir(spark, f"many-{n}") for n in ("in", "stored", "out", "progress"))
    schema = "batch_id STRING, offset INT, status_code INT, payload STRING"

    def poll(first, last, offset):
        rows = [(f"run{i}", offset, 200, f'{{"data":[{i}]}}') for i in range(first, last)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        page_stream(spark.readStream.schema(schema).parquet(source), stored, target, progress, 1).awaitTermination()
        items = spark.read.schema("batch_id STRING, offset INT, pos INT, payload STRING").parquet(target).collect()
        return sorted((int(r.batch_id[3:]), r.offset, r.payload) for r in items)

    assert poll(0, 300, 0) == [(i, 0, f"{i}") for i in range(300)]
    old = set(_files(target))
    assert len({os.path.dirname(f) for f in old}) <= 8 and len({os.path.dirname(f) for f in _files(stored)}) <= 8
    # runs that go on are redone where they began, new ones have parts of their own
    assert poll(300, 310, 0) == [(i, 0, f"{i}") for i in range(310)] and old <= set(_files(target))
    assert poll(305, 310, 1) == sorted([(i, 0, f"{i}") for i in range(310)] + [(i, 1, f"{i}") for i in range(305, 310)])
    assert old <= set(_files(target))


def test_inserted_changes_lie_in_one_file_per_day(spark):
    source, target, progress = (work_dir(spark, f"days-{n}") for n in ("in", "out", "progress"))
    docs = [
        (f'<timetable eva="1"><s id="{i}"><dp pt="25031109{i:02d}" ct="25031{d}09{i:02d}"/></s></timetable>', dt.datetime(2025, 3, 11))
        for d in (1, 2) for i in range(50)
    ]
    spark.createDataFrame(docs, "payload STRING, ingested_at TIMESTAMP_NTZ").write.parquet(source)
    rchg_insert_stream(spark.readStream.schema("payload STRING, ingested_at TIMESTAMP_NTZ").parquet(source), target, progress).awaitTermination()
    assert spark.read.parquet(target).count() == 100 and len(_files(target)) == 2


def test_new_changes_are_not_copied_when_all_are_new(spark, monkeypatch):
    from railfeed.streaming import streams

    names, whole = [], streams.staged
    monkeypatch.setattr(streams, "staged", lambda df, name: (names.append(name), whole(df, name))[1])
    source, target, progress = (work_dir(spark, f"copies-{n}") for n in ("in", "out", "progress"))
    schema = "payload STRING, ingested_at TIMESTAMP_NTZ"
    for minutes in ((5,), (5, 6)):
        docs = [(f'<timetable eva="1"><s id="7"><dp pt="2503110900" ct="25031109{m:02d}"/></s></timetable>', dt.datetime(2025, 3, 11)) for m in minutes]
        spark.createDataFrame(docs, schema).coalesce(1).write.mode("append").parquet(source)
        rchg_insert_stream(spark.readStream.schema(schema).parquet(source), target, progress).awaitTermination()
    assert sorted(r.new_time.minute for r in spark.read.parquet(target).collect()) == [5, 6]
    assert names == ["found", "found", "unseen"]


def test_one_file_of_weather_is_parsed_by_all_cores(spark):
    source, vertical, target, progress = (work_dir(spark, f"cores-{n}") for n in ("in", "vertical", "out", "progress"))
    schema = "raw_id BIGINT, payload STRING, ingested_at TIMESTAMP_NTZ, batch_id STRING"
    doc = '{{"latitude":53.1,"longitude":8.8,"hourly":{{"time":["2025-03-11T{:02d}:00"],"temperature_2m":[1]}}}}'
    rows = [(i, doc.format(i % 24), dt.datetime(2025, 3, 11), "b1") for i in range(200)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(source)
    dimension = "station_id STRING, name STRING, latitude DOUBLE, longitude DOUBLE, ds100 STRING, eva_number STRING"
    stations = spark.createDataFrame([("1", "A", 53.1, 8.8, "HB", "80")], dimension)
    index = build_station_index(stations.select("station_id", "latitude", "longitude"))
    parts, whole = [], wx.parsed_objects
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(wx, "parsed_objects", lambda df: (parts.append(df.rdd.getNumPartitions()), whole(df))[1])
        payloads = spark.readStream.schema(schema).parquet(source)
        latest_weather_stream(payloads, index, stations, FORECAST_MEASURES, vertical, target, progress).awaitTermination()
    assert spark.read.parquet(target).count() == 24 and min(parts) >= spark.sparkContext.defaultParallelism
