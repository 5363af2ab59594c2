"""Edge cases of the weather jobs."""

from __future__ import annotations

import datetime as dt
import json

import pytest

from railfeed.operators import weather as wx
from railfeed.operators.stations import region_coords, region_eva, station_dimension
from railfeed.schemas import FORECAST_MEASURES, HISTORY_MEASURES

RAW = "raw_id BIGINT, payload STRING, batch_id STRING, ingested_at TIMESTAMP_NTZ"
DAY = dt.datetime(2025, 1, 1)


def rows(spark, payload, history=False):
    raw = spark.createDataFrame([(1, payload, "B1", DAY)], RAW)
    objects = wx.weather_objects(raw, history)
    vertical = wx.weather_vertical(objects, None).orderBy("obj_pos", "pos").collect()
    return vertical, [r.reason for r in wx.weather_quarantine(objects).collect()]


def test_measures(spark):
    payload = """{"latitude":"53.1","longitude":8,"hourly":{"time":["a",null,"c"],"t":[1,null,"3.5"],"short":[7],
      "scalar":5,"nothing":null,"text":["x",true,{}]}}"""
    vertical, bad = rows(spark, payload)
    assert bad == []
    assert [(r.pos, r.time, r.latitude, r.longitude) for r in vertical] == [(0, "a", 53.1, 8.0), (1, None, 53.1, 8.0), (2, "c", 53.1, 8.0)]
    assert [r.measures for r in vertical] == [{"short": 7.0, "t": 1.0}, {"text": 1.0}, {"t": 3.5}]


def test_values_stay_as_they_were_sent(spark):
    payload = """{"latitude":1,"longitude":2,"hourly":{"time":["a","b","c"],"code":[3,null,4.25],"flag":[true,false,null],
      "text":["x","3.5",{"k":[1]}],"scalar":5}}"""
    raw = spark.createDataFrame([(1, payload, "B1", DAY)], RAW)
    rows = wx.weather_vertical(wx.weather_objects(raw), None, exact=True).orderBy("pos").collect()
    assert [json.loads(r.payload) for r in rows] == [
        {"code": 3, "flag": True, "text": "x"},
        {"flag": False, "text": "3.5"},
        {"code": 4.25, "text": {"k": [1]}},
    ]
    assert '"code":3,' in rows[0].payload


@pytest.mark.parametrize(
    "payload, n, reasons",
    [
        ("not json", 0, ["not_json"]),
        ('{"error":"invalid_json","text":"x"}', 0, ["no_hourly"]),
        ("[1,2]", 0, ["not_object"]),
        ('{"hourly":null}', 0, ["no_hourly"]),
        ('{"hourly":[1]}', 0, ["no_hourly"]),
        ('{"hourly":{}}', 0, []),
        ('{"hourly":{"time":[]}}', 0, []),
        ('{"hourly":{"time":null}}', 0, ["time_not_list"]),
        ('{"latitude":null,"longitude":8,"hourly":{"time":["a"]}}', 1, []),
        ('{"latitude":"x","longitude":8,"hourly":{"time":["a"]}}', 0, ["bad_latitude"]),
        ('{"latitude":1,"longitude":{},"hourly":{"time":["a"]}}', 0, ["bad_longitude"]),
    ],
)
def test_payload_matrix(spark, payload, n, reasons):
    vertical, bad = rows(spark, payload)
    assert (len(vertical), bad) == (n, reasons)


def test_history_envelopes_isolate_bad_objects(spark):
    good = '{"latitude":1,"longitude":2,"hourly":{"time":["a"]}}'
    for payload, n, bad in [
        (good, 1, 0),
        (f"[{good},5,{good}]", 2, 1),
        (f'{{"results":[{good},{good}]}}', 2, 0),
        ('{"results":5}', 0, 1),
        ("[]", 0, 0),
    ]:
        vertical, reasons = rows(spark, payload, history=True)
        assert (len(vertical), len(reasons)) == (n, bad if payload != "[]" else len(reasons)), payload


def test_measure_lists():
    assert (len(FORECAST_MEASURES), len(HISTORY_MEASURES)) == (21, 17)


def test_view_prefers_missing_batch_then_latest(spark):
    vertical = spark.createDataFrame(
        [
            (1, 0, "B1", "s1", 1.0, 2.0, 0, "t", {"weather_code": 3.0, "temperature_2m": 1.0}),
            (2, 0, "B2", "s1", 1.0, 2.0, 0, "t", {"weather_code": 3.5, "temperature_2m": 2.0}),
            (3, 0, "B1", "s2", 1.0, 2.0, 0, "t", {"temperature_2m": 3.0}),
            (4, 0, None, "s2", 1.0, 2.0, 0, "t", {"temperature_2m": 4.0}),
            (5, 0, "B1", "gone", 1.0, 2.0, 0, "t", {"temperature_2m": 5.0}),
            (6, 0, "B1", "lost", 1.0, 2.0, 0, "t", {"temperature_2m": 6.0}),
            (7, 0, "B9", "s1", 1.0, 2.0, 0, None, {}),
            (8, 0, "B9", None, 1.0, 2.0, 0, "t", {}),
        ],
        "psa_id BIGINT, obj_pos INT, batch_id STRING, station_id STRING, latitude DOUBLE, longitude DOUBLE, pos INT, time STRING, measures MAP<STRING, DOUBLE>",
    )
    stations = spark.createDataFrame([("s1", "A", "HB", "1"), ("s2", "B", "HB", "2")], "station_id STRING, name STRING, ds100 STRING, eva_number STRING")
    found = wx.forecast_hourly(vertical, stations).orderBy("psa_id").collect()
    # stations the dimension does not know share one row per time
    assert [(r.psa_id, r.station_id) for r in found] == [(2, "s1"), (4, "s2"), (6, None)]
    assert found[0].weather_code is None


def test_station_versions_and_regions(spark):
    def payload(name, eva, ril):
        return f'{{"number":7,"name":"{name}","evaNumbers":{eva},"ril100Identifiers":{ril}}}'

    evas = '[{"number":1,"isMain":null},{"number":2,"isMain":false},{"number":3,"isMain":true,"geographicCoordinates":{"coordinates":[8.8,53.1]}},{"number":4,"isMain":true}]'
    data = [
        (1, payload("Old", "[]", "[]"), "B1", dt.datetime(2025, 1, 2)),
        (2, payload("Bremen", evas, '[{"rilIdentifier":"X","isMain":false},{"rilIdentifier":"\\"HB\\"1","isMain":true}]'), "B1", None),
        (3, '{"number":"8","name":"Brem 8","evaNumbers":{"a":1},"ril100Identifiers":[{"rilIdentifier":"HB"}]}', "B1", DAY),
    ]
    dim = station_dimension(spark.createDataFrame(data, RAW))
    seven, eight = dim.orderBy("station_id").collect()
    assert (seven.name, seven.eva_number, seven.latitude, seven.longitude, seven.ds100) == ("Bremen", "3", 53.1, 8.8, '"HB"1')
    assert (eight.eva_number, eight.ds100) == (None, "HB")
    assert sorted(r.eva_number or "" for r in region_eva(dim).collect()) == ["", "3"]
    assert [r.eva_number for r in region_eva(dim, limit=1).collect()] == [None]
    assert region_eva(dim, limit=0).count() == 2
    assert [r.station_id for r in region_coords(dim).collect()] == ["7"]


@pytest.mark.parametrize(
    "values, want",
    [
        ("[1, 2.5, null, -3e2]", [1.0, 2.5, None, -300.0]),
        ('[1, "x"]', [1.0, None]),
        ('["3.5", 1]', [3.5, 1.0]),
        ("[true, 2]", [1.0, 2.0]),
        ('[{"a":1}, [2], 3]', [None, None, 3.0]),
        ("[0.1234567890123456789, 12345678901234567890]", [0.12345678901234568, 1.2345678901234567e19]),
        ("[]", [None, None]),
        ('{"a":1}', [None, None]),
        ("5", [None, None]),
        ('"text"', [None, None]),
    ],
)
def test_measure_lists_of_any_kind(spark, values, want):
    vertical, _ = rows(spark, f'{{"latitude":1,"longitude":2,"hourly":{{"time":["a","b","c","d"],"m":{values}}}}}')
    found = [r.measures.get("m") for r in vertical]
    assert found == want + [None] * (4 - len(want))


def test_times_are_not_read_as_numbers(spark):
    raw = spark.createDataFrame([(1, "b", '{"latitude":1,"longitude":2,"hourly":{"time":["2025-03-11T09:00"],"rain":[1.5],"x":["a"]}}')], "raw_id BIGINT, batch_id STRING, payload STRING")
    lists = wx._with_lists(wx.weather_objects(raw), exact=False)
    assert "transform_values(map_filter(" in lists._jdf.queryExecution().analyzed().toString()
    assert lists.first().lists == {"rain": [1.5], "x": [None]}
