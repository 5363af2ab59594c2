"""Worked examples and the malformed matrix of the timetable jobs."""

from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from railfeed.operators import timetables as tt

ARRIVED = dt.datetime(2025, 3, 11, 9, 0, 0, 700000)
SCHEMA = "raw_id BIGINT, payload STRING, batch_id STRING, ingested_at TIMESTAMP_NTZ"


def raw(spark, *payloads, batch="B1"):
    return spark.createDataFrame([(i, p, batch, ARRIVED) for i, p in enumerate(payloads)], SCHEMA)


def at(text):
    return dt.datetime.strptime(text, "%y%m%d%H%M")


CHANGES = """<timetable eva="9100" station="Talstadt">
<s id="ride-a">
 <dp l="T4" ct="2407050141" pt="2407050130"><m c="1" id="cut" t="f" ts="2407050125"/></dp>
 <m cat="works" id="note" pr="3" t="q" ts="2407050100"/>
 <tl c="TX"/>
 <ar l="T4" ppth="Hafen|Werft|Talstadt" pt="2407050118" ct="2407050127"/>
</s>
<s id="ride-b"><dp l="T9" pt="2407050300"><m c="0" id="calm" t="q" ts="2407050255"/></dp></s>
</timetable>"""


def test_changes_of_two_rides(spark):
    rows = {(r.train_line_ride_id, r.source_node): r for r in tt.fchg_events(raw(spark, CHANGES)).collect()}
    assert set(rows) == {("ride-a", "m"), ("ride-a", "ar"), ("ride-a", "dp"), ("ride-b", "dp")}
    ar, dp, m = (rows["ride-a", k] for k in ("ar", "dp", "m"))
    # an arrival without a message still is a row, and carries the flag of its ride
    assert (ar.message_id, ar.type, ar.event_time, ar.is_canceled) == (None, None, None, True)
    assert (dp.message_id, dp.event_time, dp.delay_in_min, dp.is_canceled) == ("cut", at("2407050125"), 1, True)
    # so does the message of the ride
    assert (m.message_id, m.category, m.priority, m.delay_in_min, m.is_canceled) == ("note", "works", 3, None, True)
    assert (m.train_type, m.train_name, m.final_destination_station) == ("TX", "T4", "Talstadt")
    assert (m.departure_planned_time, m.departure_change_time) == (at("2407050130"), at("2407050141"))
    assert (m.arrival_planned_time, m.arrival_change_time) == (at("2407050118"), at("2407050127"))
    # no path, no label, no cancelling message
    other = rows["ride-b", "dp"]
    assert (other.train_name, other.train_type, other.final_destination_station) == ("T9", None, None)
    assert (other.message_id, other.delay_in_min, other.is_canceled) == ("calm", 0, False)


PLANNED = """<timetable station="Seeblick">
<s id="one"><dp l="88" pp="2b" ppth="Ufer|Steg" pt="2402291159"/><tl c="FX" n="404"/></s>
<s id="two"><tl c="GX" f="von Osten" n="405" t="nach Westen"/><ar l="K" pp="9" pt="2402291201"/></s>
</timetable>"""


def test_planned_rows(spark):
    one, two = tt.plan_events(raw(spark, PLANNED)).orderBy("train_line_ride_id").collect()
    assert (one.station_name, one.event_type, one.event_time) == ("Seeblick", "dp", at("2402291159"))
    assert (one.train_number, one.train_category, one.train_type, one.train_direction) == ("404", "FX", None, None)
    assert (one.platform, one.train_line_name, one.route_path) == ("2b", "88", "Ufer|Steg")
    # type and direction come from the label
    assert (two.event_type, two.train_type, two.train_direction, two.route_path) == ("ar", "nach Westen", "von Osten", None)


def test_plan_keeps_equal_rows_of_different_batches(spark):
    doc = '<timetable station="A"><s id="1"><dp pt="2503110915"/><dp pt="2503110915"/></s></timetable>'
    both = raw(spark, doc, doc, batch="B1").union(raw(spark, doc, batch="B2"))
    assert sorted(r.batch_id for r in tt.plan_events(both).collect()) == ["B1", "B2"]


RECENT = """<timetable eva="9200" station="Bergheim">
<s id="ride-c">
 <ar l="Z2" pt="2406010700" ct="2406010709" pp="3" cp="4" ppth="Moor|Heide"><m id="late" t="q" c="9" ts="2406010640"/></ar>
 <m id="sign" t="s" cat="event" pr="2" ts="2406010630" from="2406010600" to="2406011000"/>
</s></timetable>"""


def test_recent_changes_and_their_hashes(spark):
    rows = {r.event_type: r for r in tt.rchg_events(raw(spark, RECENT)).collect()}
    ar, m = rows["ar"], rows["m"]
    assert (m.message_id, m.category, m.change_type, m.priority) == ("sign", "event", "s", 2)
    assert (m.valid_from, m.valid_to, m.timestamp_event) == (at("2406010600"), at("2406011000"), at("2406010630"))
    assert (ar.old_time, ar.new_time, ar.timestamp_event) == (at("2406010700"), at("2406010709"), at("2406010709"))
    assert (ar.platform, ar.platform_change, ar.train_line_name, ar.route) == ("3", "4", "Z2", "Moor|Heide")
    assert (ar.message_id, ar.change_type, ar.delay_minutes, ar.priority, ar.category) == ("late", "q", 9, None, None)
    head = {"event": "ride-c", "eva": "9200", "station": "Bergheim"}
    # 17 parts for a message, and the line's name as the 18th for a node
    seventeen = [*head.values(), "sign", "m", "event", "s", "2", "2024-06-01T06:00:00Z", "2024-06-01T10:00:00Z", *[""] * 6, "2024-06-01T06:30:00Z"]
    eighteen = [*head.values(), "late", "ar", "", "q", "", "", "", "2024-06-01T07:00:00Z", "2024-06-01T07:09:00Z", "9", "3", "4"]
    eighteen += ["Moor|Heide", "2024-06-01T07:09:00Z", "Z2"]
    assert (len(seventeen), len(eighteen)) == (17, 18)
    for row, parts in ((m, seventeen), (ar, eighteen)):
        assert row.event_hash == hashlib.sha1("|".join(parts).encode()).hexdigest()


def test_rchg_without_time_takes_the_arrival_of_the_batch(spark):
    doc = '<timetable><s id="1"><ar pt="2503110915"/></s></timetable>'
    first = tt.rchg_events(raw(spark, doc)).collect()
    again = tt.rchg_events(raw(spark, doc)).collect()
    assert first[0].timestamp_event == ARRIVED.replace(microsecond=0)
    assert first[0].event_hash == again[0].event_hash


SERVICE = '<s id="1"><dp pt="2503110915"/></s>'


@pytest.mark.parametrize(
    "payload, n_rows, reason",
    [
        (f"<timetable>{SERVICE}</timetable>", 1, None),
        (f'<?xml version="1.0"?><!-- a > b -->\n<timetable a="x>y">{SERVICE}</timetable>\n<!-- end --> ', 1, None),
        (f"<other>{SERVICE}</other>", 1, None),
        ("<timetable/>", 0, None),
        ('<timetable station="A"/><!-- end -->', 0, None),
        (f"<timetable><![CDATA[ <s/> ]]>{SERVICE}</timetable>", 1, None),
        (f'<timetable xmlns="urn:x">{SERVICE}</timetable>', 0, None),
        ('<timetable xmlns:q="urn:x"><q:s id="1"><q:dp pt="2503110915"/></q:s></timetable>', 0, None),
        (f"\ufeff<timetable>{SERVICE}</timetable>", 1, None),
        (f"<größe>{SERVICE}</größe>", 1, None),
        (f"<!DOCTYPE timetable [<!ENTITY x 'a]>b'><!-- it's -->]><timetable>{SERVICE}</timetable>", 1, None),
        (f"<timetable>{SERVICE}<!-- </timetable> --></timetable>", 1, None),
        (f'<timetable>{SERVICE}<timetable a="x>y"></timetable><timetable/></timetable>', 1, None),
        (f"<timetable><![CDATA[</timetable>]]>{SERVICE}</timetable>", 1, None),
        ("<!-- c -->" * 100_000 + f"<timetable>{SERVICE}</timetable>", 1, None),
        (f"<timetable>{SERVICE}</timetable>" + "<!-- c -->" * 100_000, 1, None),
        (f"<timetable>{SERVICE}</timetable><a><timetable></timetable></a>", 0, "extra_content"),
        (f"<timetable>{SERVICE}</timetable><timetable>{SERVICE}</timetable>", 0, "extra_content"),
        (f"<timetable>{SERVICE}", 0, "malformed"),
        ("", 0, "malformed"),
        ("Service Unavailable", 0, "malformed"),
        (None, 0, "malformed"),
        ('<timetable a="1" a="2"/>', 0, "malformed"),
        ("<timetable>&nope;</timetable>", 0, "malformed"),
        (f"<timetable>{SERVICE}</timetable><timetable/>", 0, "extra_content"),
        (f"<timetable/><timetable>{SERVICE}</timetable>", 0, "extra_content"),
        (f"<timetable>{SERVICE}</timetable>junk", 0, "extra_content"),
        ("<timetable/>junk", 0, "extra_content"),
    ],
)
def test_payload_matrix(spark, payload, n_rows, reason):
    rows = raw(spark, payload)
    assert tt.plan_events(rows).count() == n_rows
    assert [r.reason for r in tt.xml_quarantine(rows).collect()] == ([reason] if reason else [])


def test_attribute_matrix(spark):
    doc = """<timetable station=" A " eva="null"><s id="1">
      <ar pt="250311091" l="" ppth="" cpth="X|Y"><m id="a" t="f" c="-3"/><m id="b" t="f" c="x"/></ar>
      <ar pt="2503110915" l="51"/>
      <dp pt="2513110915" l="007"><m id="c" t="f" c="0" ts-tts="25-03-11 09:18:07.123"/></dp>
      <m/></s>
      <s id="2"><dp l="12" ppth="A|"><m t="f" c="0012" ts="bad" ts-tts="25/03/11T09.18.7"/></dp></s></timetable>"""
    rows = {(r.train_line_ride_id, r.source_node): r for r in tt.fchg_events(raw(spark, doc)).collect()}
    assert len(rows) == 4
    ar, dp, m = (rows["1", k] for k in ("ar", "dp", "m"))
    assert (ar.station_name, ar.eva_number) == (" A ", "null")
    # first arrival only; nine digits and an impossible month are no times
    assert (ar.arrival_planned_time, ar.departure_planned_time) == (None, None)
    assert (ar.train_name, ar.train_line_station_num, ar.final_destination_station) == ("007", 7, "Y")
    assert (ar.message_id, ar.delay_in_min, ar.is_canceled) == ("b", None, False)
    assert (dp.event_time, dp.delay_in_min) == (dt.datetime(2025, 3, 11, 9, 18, 7), 0)
    assert (m.message_id, m.type, m.is_canceled) == (None, None, False)
    last = rows["2", "dp"]
    assert (last.final_destination_station, last.is_canceled, last.delay_in_min) == ("", True, 12)
    assert last.event_time == dt.datetime(2025, 3, 11, 9, 18, 7)


def test_source_zone(spark):
    doc = '<timetable><s id="1"><dp pt="2507110915"/></s></timetable>'
    assert tt.plan_events(raw(spark, doc)).first().event_time == dt.datetime(2025, 7, 11, 9, 15)
    local = tt.plan_events(raw(spark, doc), source_tz="Europe/Berlin").first()
    assert local.event_time == dt.datetime(2025, 7, 11, 7, 15)


def test_quarantine_reads_each_document_once(spark, tmp_path):
    """A reason that is filtered where it is made is worked out again, document and all; and few columns are asked for."""
    good = f"<timetable>{SERVICE}</timetable>"
    odd = [
        good, good + "junk", good + "<!-- c -->", good + good, "<timetable/>", "<timetable />x", good.replace("</s>", "</S>"), good.replace("1", "&nope;"),
        f"<timetable>{SERVICE}text{SERVICE}<m>words</m></timetable>", "<timetable><s><ar>words</ar><m/>more</s></timetable>", good[:-3], "", None,
        f"<timetable>{SERVICE}</timetable >\n", f"<timetable>{SERVICE}<timetables/></timetable>", f"<a:b xmlns:a='u'>{SERVICE}</a:b>",
        "<timetable>" + SERVICE * 50_000 + "</timetable>", f"<timetable><![CDATA[</timetable>]]>{SERVICE}</timetable>", f"<timetable _corrupt='x'>{SERVICE}</timetable>", "<timetable><_corrupt>x</_corrupt></timetable>",
    ]
    raw(spark, *odd).write.parquet(str(tmp_path / "raw"))
    rows = spark.read.parquet(str(tmp_path / "raw"))
    quarantined = tt.xml_quarantine(rows)
    plan = quarantined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml(") == 1 and "_ppth" not in plan
    reasons = {r.raw_id: r.reason for r in tt.shred(rows).filter("reason IS NOT NULL").collect()}
    assert {r.raw_id: r.reason for r in quarantined.collect()} == reasons and set(reasons.values()) == {"malformed", "extra_content"}


def test_what_few_rows_need_is_worked_out_for_these_alone(spark, tmp_path):
    """Start tags are cut out of documents that are not plain, lists of errors made for rows with one, and a text's date sought once."""
    raw(spark, "<timetable/>").write.parquet(str(tmp_path / "raw"))
    rows = spark.read.parquet(str(tmp_path / "raw"))
    optimized = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "_common_expr" not in optimized(tt.shred(rows))
    assert "CASE WHEN isnotnull(coalesce(" in optimized(tt.rchg_rows(rows, rejects=True))
    texts = spark.createDataFrame([("a|2025-03-11T09:00|b",), ("2025-03-11T|2025-03-12T09\n2025-03-13",), ("x" * 3000,), ("",), (None,)], "t STRING")
    days = texts.select(tt.text_partition(texts.t).alias("day"))
    assert [r.day for r in days.collect()] == ["2025-03-11", "2025-03-12", "none", "none", None]
    texts.write.parquet(str(tmp_path / "texts"))
    assert optimized(spark.read.parquet(str(tmp_path / "texts")).select(tt.text_partition(F.col("t")).alias("day"))).count("regexp_extract") == 1
