"""Jobs parse each payload once, and what cannot be read is stored and counted beside what can."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from railfeed.operators import timetables as tt
from railfeed.operators import weather as wx
from railfeed.plans.jobs import Warehouse
from railfeed.plans.outcomes import Dealt
from railfeed.schemas import FORECAST_MEASURES
from railfeed.session import work_dir
from railfeed.sources.membership import KeyIndex
from railfeed.sources.snapshots import Conflict

T0 = dt.datetime(2025, 3, 11, 9, 0, 0)
RAW = "raw_id BIGINT, payload STRING, ingested_at TIMESTAMP_NTZ, batch_id STRING"
BAD = (
    '<timetable station="A" eva="1"><s id="7">'
    '<ar pt="2513110900" ct="25031109" l="RS1"/><dp pt="2503110900" ct="2502300900"/>'
    '<m id="M" t="d" ts="2503119999" c="-3" pr="1" from="x" to="2503110900"/><m id="N" ts="2503110855" c="99999999999"/></s></timetable>'
)


@pytest.fixture
def house(spark):
    return Warehouse(spark, work_dir(spark, "house"))


def texts(spark, *payloads):
    return spark.createDataFrame([(p,) for p in payloads], "payload STRING")


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _quality(house):
    events = house.ledger.read().filter("process_name LIKE '%quality'")
    return {r.process_name: r.message for r in events.collect()}


@pytest.mark.parametrize("kind", ["plan", "fchg", "rchg"])
def test_documents_are_parsed_once_whatever_becomes_of_them(spark, kind):
    raw = spark.createDataFrame([(1, BAD, T0, "b")], RAW)
    parse = {"plan": tt.plan_rows, "fchg": tt.fchg_rows_of, "rchg": tt.rchg_rows}[kind]
    rows = parse(raw, rejects=True)
    assert optimized(rows).count("from_xml(") == 1
    dealt = Dealt(rows)
    for df in (dealt.rows, dealt.rejected("reject.reason"), dealt.errors()):
        assert "from_xml" not in optimized(df)


@pytest.mark.parametrize("history", [False, True])
def test_payloads_are_parsed_once(spark, history):
    raw = spark.createDataFrame([(1, "{}", T0, "b")], RAW)
    rows = wx.parsed_objects(raw, history)
    assert optimized(rows).count("parse_json") + optimized(rows).count("parseJson") == 1
    assert "json" not in optimized(wx.placed_hours(Dealt(rows).rows, None)).lower()


def test_timetable_outcomes(spark, house):
    for feed in ("timetables_plan", "timetables_fchg", "timetables_rchg"):
        house.ingest(feed, texts(spark, BAD, "broken", "<a/><b/>", BAD.replace('"7"', '"8"')), T0)
    house.transform_plan(), house.transform_fchg(), house.transform_rchg()
    errors = {f: sorted((r.field, r.reason, r.text) for r in house.field_errors(f).dropDuplicates(["field", "reason", "text"]).collect()) for f in
              ("timetables_plan", "timetables_fchg", "timetables_rchg")}
    assert errors["timetables_plan"] == [("event_time", "impossible_date", "2513110900")]
    assert errors["timetables_fchg"] == [
        ("arrival_change_time", "not_a_time", "25031109"),
        ("arrival_planned_time", "impossible_date", "2513110900"),
        ("delay_in_min", "not_a_number", "-3"),
        ("delay_in_min", "out_of_range", "99999999999"),
        ("departure_change_time", "impossible_date", "2502300900"),
        ("event_time", "impossible_date", "2503119999"),
    ]
    assert ("valid_from", "not_a_time", "x") in errors["timetables_rchg"] and ("new_time", "impossible_date", "2502300900") in errors["timetables_rchg"]
    quality = _quality(house)
    assert quality["timetables_plan_quality"] == "event_time_impossible_date=2, rejected_extra_content=1, rejected_malformed=1"
    # a service tells its own errors once, however many events it has
    assert "arrival_planned_time_impossible_date=2" in quality["timetables_fchg_quality"]
    assert {r.reason for r in house.quarantine("timetables_fchg").collect()} == {"malformed", "extra_content"}
    # the events are those that a plain parse gives
    for feed, plain in (("timetables_plan", tt.plan_events), ("timetables_fchg", tt.fchg_events)):
        stored = spark.read.parquet(house.path("dwh", f"{feed}_events"))
        assert sorted(map(str, stored.collect())) == sorted(map(str, plain(house.raw(feed)).select(*stored.columns).collect()))
    message = house.ledger.read("timetables_fchg_transform").filter("event = 'end'").first().message
    assert message == f"rows_inserted={tt.fchg_events(house.raw('timetables_fchg')).count()}"


def test_weather_outcomes(spark, house):
    hour = '"time":["2025-03-11T09:00","2025-03-11T10:00"]'
    good = f'{{"latitude":53.1,"longitude":8.8,"hourly":{{{hour},"temperature_2m":["x",5],"precipitation":3,"cloud_cover":[null,7]}}}}'
    bad = f'{{"latitude":"north","longitude":8.8,"hourly":{{{hour}}}}}'
    house.ingest("weather_history", texts(spark, good, bad, "{"), T0)
    house.transform_weather("weather_history")
    assert sorted((r.field, r.reason, r.text) for r in house.field_errors("weather_history").collect()) == [
        ("precipitation", "not_a_list", "3"), ("temperature_2m", "not_a_number", '"x"'),
    ]
    assert _quality(house)["weather_history_quality"] == "precipitation_not_a_list=1, rejected_bad_latitude=1, rejected_not_json=1, temperature_2m_not_a_number=1"
    message = house.ledger.read("weather_history_transform").filter("event = 'end'").first().message
    assert message.startswith("rows_attempted=4, rows_inserted=2")
    plain = wx.weather_vertical(wx.weather_objects(house.raw("weather_history"), history=True), None, exact=True).drop("station_id")
    stored = wx.read_vertical(spark, house.path("psa", "weather_history_vertical")).select(*plain.columns)
    assert sorted(map(str, stored.collect())) == sorted(map(str, plain.collect()))


# ---------------------------------------------------------------- keys


def _found(spark, *rows):
    path = work_dir(spark, "found")
    df = spark.createDataFrame([(t, d, b) for t, d, b in rows], "t STRING, event_date STRING, batch_id STRING")
    df.select("t", F.sha1("t").alias("event_hash"), "event_date", "batch_id").write.parquet(path)
    return spark.read.parquet(path)


def _texts(df):
    return sorted(r.t for r in df.collect())


def test_keys_are_found_again_and_only_where_they_can_be(spark):
    index = KeyIndex(spark, work_dir(spark, "index"))
    many = [(f"t{i}", "none" if i % 3 else "2025-03-11", "b1") for i in range(3000)]
    first = _found(spark, *many)
    new, base = index.unseen(first, ["b1"])
    assert new.count() == 3000
    index.claim(new, base)
    again, _ = index.unseen(_found(spark, *[(t, d, "b2") for t, d, _ in many], ("fresh", "none", "b2"), ("later", "2025-04-01", "b2")), ["b2"])
    assert _texts(again) == ["fresh", "later"]
    # keys of the batch itself do not count, so a repeated job finds its rows again
    assert index.unseen(first, ["b1"])[0].count() == 3000
    # nothing of this day is stored: no key file is opened
    other, _ = index.unseen(_found(spark, ("t1", "2025-05-05", "b3")), ["b3"])
    assert _texts(other) == ["t1"] and not [f for f in other.inputFiles() if "/keys/" in f]


def test_filters_spare_the_key_files(spark):
    """Fresh keys of a day that holds others pass without a look into the key files, but for a few chance hits."""
    index = KeyIndex(spark, work_dir(spark, "index"))
    index.claim(_found(spark, *[(f"t{i}", "2025-03-11", "b1") for i in range(2000)]), 0)
    looked = 0
    for i in range(5):
        new, _ = index.unseen(_found(spark, (f"new{i}", "2025-03-11", "b2")), ["b2"])
        looked += any("/keys/" in f for f in new.inputFiles())
        assert new.count() == 1
    assert looked <= 1


def test_compacted_keys_are_the_same_keys(spark):
    index = KeyIndex(spark, work_dir(spark, "index"))
    for part in range(4):
        new, base = index.unseen(_found(spark, *[(f"t{i}", "2025-03-11", f"b{part}") for i in range(part, 400, 4)]), [f"b{part}"])
        index.claim(new, base)
    index.compact("2025-03-11")
    assert index.keys.entries().count() == 1 and index.keys.read().count() == 400
    assert index.filters.read().groupBy("page").count().filter("count > 1").isEmpty()
    again, _ = index.unseen(_found(spark, *[(f"t{i}", "2025-03-11", "z") for i in range(410)]), ["z"])
    assert _texts(again) == sorted(f"t{i}" for i in range(400, 410))


def test_filters_grow_with_the_keys_of_a_day(spark):
    """Twenty days with fifty keys each need a page each, and a day with many keys more than one; both are found again."""
    index = KeyIndex(spark, work_dir(spark, "index"))
    rows = [(f"t{i}", f"2025-03-{1 + i % 20:02d}", "b1") for i in range(1000)] + [(f"u{i}", "2025-04-01", "b1") for i in range(7000)]
    index.claim(_found(spark, *rows), 0)
    pages = {r.event_date: r["count"] for r in index.filters.read().groupBy("event_date").count().collect()}
    assert pages.pop("2025-04-01") == 4 and set(pages.values()) == {1} and len(pages) == 20
    again, _ = index.unseen(_found(spark, *rows, ("fresh", "2025-03-01", "b2")).withColumn("batch_id", F.lit("b2")), ["b2"])
    assert _texts(again) == ["fresh"]


def test_the_slower_of_two_jobs_looks_again(spark):
    index = KeyIndex(spark, work_dir(spark, "index"))
    mine, theirs = _found(spark, ("x", "d", "a"), ("y", "d", "a")), _found(spark, ("x", "d", "b"))
    new, base = index.unseen(mine, ["a"])
    index.claim(index.unseen(theirs, ["b"])[0], base)
    with pytest.raises(Conflict):
        index.claim(new, base)
    new, base = index.unseen(mine, ["a"])
    assert _texts(new) == ["y"]
    index.claim(new, base)


CHANGE = '<timetable station="A" eva="1"><s id="7"><dp pt="2503110900" ct="25031109{:02d}"/></s></timetable>'


def test_a_known_poll_opens_no_event_file(spark, house):
    """The events could be anywhere: they are moved away, and a poll of known and new changes still finds out which is which."""
    house.ingest("timetables_rchg", texts(spark, CHANGE.format(5)), T0)
    house.transform_rchg()
    target = house.path("dwh", "timetables_rchg_events")
    found = tt.first_arrivals(tt.rchg_rows(house.raw("timetables_rchg")))
    path = work_dir(spark, "poll")
    found.withColumn("batch_id", F.lit("next")).write.parquet(path)
    new, _ = house.changes_index().unseen(spark.read.parquet(path), ["next"])
    assert new.count() == 0 and not [f for f in new.inputFiles() if target in f]


@pytest.mark.parametrize("step", ["claim", "write_partitions"])
def test_a_job_that_dies_between_claim_and_write_is_run_again(spark, house, monkeypatch, step):
    from railfeed.plans import jobs

    house.ingest("timetables_rchg", texts(spark, CHANGE.format(5), CHANGE.format(6)), T0)
    with monkeypatch.context() as patch:
        if step == "claim":
            whole = KeyIndex.claim
            patch.setattr(KeyIndex, "claim", lambda *a: (whole(*a), (_ for _ in ()).throw(InterruptedError()))[0])
        else:
            patch.setattr(jobs, "write_partitions", lambda *a, **k: (_ for _ in ()).throw(InterruptedError()))
        with pytest.raises(InterruptedError):
            house.transform_rchg()
    house.ingest("timetables_rchg", texts(spark, CHANGE.format(6), CHANGE.format(7)), T0 + dt.timedelta(minutes=10))
    house.transform_rchg()
    rows = spark.read.parquet(house.path("dwh", "timetables_rchg_events")).collect()
    assert sorted(r.new_time.minute for r in rows) == [5, 6, 7]


def test_events_from_before_the_index_are_known(spark, house):
    house.ingest("timetables_rchg", texts(spark, CHANGE.format(5)), T0)
    tt.rchg_found(house.raw("timetables_rchg")).write.partitionBy("event_date", "batch_id").parquet(house.path("dwh", "timetables_rchg_events"))
    house.ingest("timetables_rchg", texts(spark, CHANGE.format(5), CHANGE.format(8)), T0 + dt.timedelta(minutes=10))
    house.transform_rchg()
    assert spark.read.parquet(house.path("dwh", "timetables_rchg_events")).count() == 2


# ---------------------------------------------------------------- hours


def _hours(spark, *rows):
    """Vertical rows of (psa_id, batch_id, station_id, time, temperature)."""
    schema = "psa_id BIGINT, batch_id STRING, station_id STRING, time STRING, t DOUBLE"
    df = spark.createDataFrame(rows, schema)
    place = [F.lit(0).alias("obj_pos"), F.lit(53.1).alias("latitude"), F.lit(8.8).alias("longitude"), F.lit(0).alias("pos")]
    return df.select("psa_id", "batch_id", "station_id", "time", *place, F.create_map(F.lit("temperature_2m"), "t").alias("measures"))


def test_a_correction_rewrites_its_bucket_only(spark):
    dimension = "station_id STRING, name STRING, ds100 STRING, eva_number STRING"
    stations = spark.createDataFrame([(str(i), f"S{i}", "X", str(i)) for i in range(40)], dimension)
    target = work_dir(spark, "hours")
    times = [f"2025-03-{d:02d}T09:00" for d in (11, 12)]
    first = _hours(spark, *[(1, "b1", str(i), t, 1.0) for i in range(40) for t in times])
    assert wx.refresh_hours(spark, first, target, stations, FORECAST_MEASURES) == 80
    files = lambda: set(spark.read.parquet(target).inputFiles())
    before = files()
    assert wx.refresh_hours(spark, _hours(spark, (2, "b2", "7", times[0], 9.0)), target, stations, FORECAST_MEASURES) == 1
    gone = before - files()
    assert len({f.rsplit("/", 1)[0] for f in gone}) == 1 and "2025-03-11" in next(iter(gone))
    view = {(r.station_id, r.time): (r.temperature_2m, r.batch_id) for r in wx.read_hours(spark, target).collect()}
    assert len(view) == 80 and view["7", times[0]] == (9.0, "b2") and view["7", times[1]] == (1.0, "b1")
    # an older version and a repetition change nothing
    for rows in (_hours(spark, (1, "b1", "7", times[0], 1.0)), _hours(spark, (2, "b2", "7", times[0], 9.0))):
        wx.refresh_hours(spark, rows, target, stations, FORECAST_MEASURES)
    assert {(r.station_id, r.time): (r.temperature_2m, r.batch_id) for r in wx.read_hours(spark, target).collect()} == view
    assert wx.refresh_hours(spark, first.filter("false"), target, stations, FORECAST_MEASURES) == 0
