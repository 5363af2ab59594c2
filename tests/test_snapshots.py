"""Commit logs: whole versions only, one writer per version, nothing lost after a failure at any step."""

from __future__ import annotations

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from railfeed.plans import jobs, layers
from railfeed.plans.jobs import Warehouse
from railfeed.session import work_dir
from railfeed.sources import snapshots as S

T0 = dt.datetime(2025, 3, 11, 9, 0, 0)
DOC = '<timetable station="A"><s id="{}"><dp pt="2503110900"/></s></timetable>'


def _table(spark, name="t"):
    return S.SnapshotTable(spark, work_dir(spark, name), "n BIGINT, batch_id STRING", "day")


def _add(table, *numbers, batch="b", day="d"):
    df = table.spark.createDataFrame([(n, batch, day) for n in numbers], "n BIGINT, batch_id STRING, day STRING").coalesce(1)
    made = table.put(df)
    table.commit(lambda head: [S.added(f, day=d, batch_id=batch, n_rows=len(numbers)) for d, f in made.items()], table.version())


def _numbers(df):
    return sorted(r.n for r in df.collect())


def test_uncommitted_and_removed_folders_are_not_read(spark):
    table = _table(spark)
    assert table.version() == 0 and table.read().columns == ["n", "batch_id", "day"] and table.read().count() == 0
    table.put(spark.createDataFrame([(9, "x", "d")], "n BIGINT, batch_id STRING, day STRING"))
    _add(table, 1, 2), _add(table, 3, batch="c", day="e")
    assert _numbers(table.read()) == [1, 2, 3] and _numbers(table.read(version=1)) == [1, 2]
    assert _numbers(table.read(F.col("day") == "e")) == [3]
    folder = table.entries().filter("day = 'd'").first().folder
    table.commit(lambda head: [S.removed(folder)], table.version())
    assert _numbers(table.read()) == [3] and _numbers(table.read(version=2)) == [1, 2, 3]
    assert table.vacuum(dt.timedelta(days=1)) == 0 and table.vacuum(dt.timedelta(seconds=-60)) == 2
    assert _numbers(table.read()) == [3]


def test_one_writer_makes_a_version(spark):
    """Writers that start from the same state all get in, each as a version of its own, and ids never overlap."""
    table, won = _table(spark), []

    def write(i):
        made = SnapshotTable.put(spark.createDataFrame([(i, str(i), "d")], "n BIGINT, batch_id STRING, day STRING"))
        entry = {"day": "d", "batch_id": str(i), "n_rows": 10}
        won.append(table.commit(lambda head: [S.added(f, first_id=head.next_id, **entry) for f in made.values()], 0))

    SnapshotTable = table
    threads = [threading.Thread(target=write, args=(i,)) for i in range(6)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert sorted(won) == [1, 2, 3, 4, 5, 6] and _numbers(table.read()) == list(range(6))
    assert sorted(e.first_id for e in table.entries().collect()) == [0, 10, 20, 30, 40, 50]
    assert not table._claim(3, "late") and '"late"' not in table._text(f"{table.log}/{3:020d}.json")


def test_listings_replace_the_start_of_the_log(spark, monkeypatch):
    monkeypatch.setattr(S, "LISTED_EVERY", 3)
    table = _table(spark)
    for i in range(7):
        _add(table, i, batch=f"b{i}")
    folder = table.entries().filter("batch_id = 'b1'").first().folder
    table.commit(lambda head: [S.removed(folder)], table.version())
    assert table._versions()[1] == [3, 6]
    assert _numbers(table.read()) == [0, 2, 3, 4, 5, 6]
    assert [_numbers(table.read(version=v)) for v in (2, 3, 5, 7)] == [[0, 1], [0, 1, 2], [0, 1, 2, 3, 4], list(range(7))]


def test_compaction_joins_a_day_and_one_batch_still_reads_little(spark):
    table = _table(spark)
    for i in range(12):
        _add(table, *range(100 * i, 100 * i + 100), batch=f"b{i:02d}")
    _add(table, 7, batch="other", day="e")
    before = _numbers(table.read())
    assert table.compact("d") == 12 and table.compact("d") == 1
    assert _numbers(table.read()) == before and table.entries().select("folder").distinct().count() == 2
    assert len(table.read().inputFiles()) < 13
    one = table.read(F.col("batch_id") == "b03").filter("batch_id = 'b03'")
    assert _numbers(one) == list(range(300, 400)) and "EqualTo(batch_id,b03)" in one._jdf.queryExecution().executedPlan().toString()
    assert all("day=d" in f for f in one.inputFiles())


def test_compaction_gives_way_to_whoever_took_a_folder_out(spark, monkeypatch):
    table = _table(spark)
    _add(table, 1), _add(table, 2, batch="c")
    first = table.entries().filter("batch_id = 'b'").first().folder
    put = table.put

    def slow(df, **options):
        made = put(df, **options)
        _table_again = S.SnapshotTable(spark, table.path, table.schema, table.partition)
        _table_again.commit(lambda head: [S.removed(first)], _table_again.version())
        return made

    monkeypatch.setattr(table, "put", slow)
    with pytest.raises(S.Conflict):
        table.compact("d")
    monkeypatch.undo()
    assert _numbers(table.read()) == [2]


@pytest.fixture
def house(spark):
    return Warehouse(spark, work_dir(spark, "house"))


def _poll(house, i, **kwargs):
    return house.ingest("timetables_plan", house.spark.createDataFrame([(DOC.format(i),)], "payload STRING"), T0 + dt.timedelta(minutes=i), **kwargs)


def _rides(house):
    house.transform_plan()
    return sorted(r.train_line_ride_id for r in house.spark.read.parquet(house.path("dwh", "timetables_plan_events")).collect())


@pytest.mark.parametrize("step", ["stage", "promote", "purge"])
def test_an_ingest_that_dies_loses_and_doubles_nothing(house, monkeypatch, step):
    """The first ingest fails right after the step; the batch it left is finished by the next one."""
    whole, calls = getattr(jobs, step), []

    def fail(*args, **kwargs):
        out = whole(*args, **kwargs)
        calls.append(1)
        if len(calls) == (1 if step == "stage" else 2):
            raise InterruptedError(step)
        return out

    monkeypatch.setattr(jobs, step, fail)
    with pytest.raises(InterruptedError):
        _poll(house, 1, batch_id="one")
    monkeypatch.setattr(jobs, step, whole)
    _poll(house, 2)
    assert sorted(r.batch_id for r in house.manifest("timetables_plan").collect()) == ["PLAN_20250311_090200", "one"]
    assert house.raw("timetables_plan").count() == 2 and house.pending("timetables_plan") != []
    assert _rides(house) == ["1", "2"]
    assert _poll(house, 1, batch_id="one") == "one" and _rides(house) == ["1", "2"]
    assert sorted(r.raw_id for r in house.raw("timetables_plan").collect()) == [0, 1]
    assert house.staged("timetables_plan").entries().count() == 0


def test_a_failed_landing_leaves_nothing(house, monkeypatch):
    monkeypatch.setattr(S.SnapshotTable, "commit", lambda *a, **k: (_ for _ in ()).throw(OSError("disk")))
    with pytest.raises(OSError):
        _poll(house, 1)
    monkeypatch.undo()
    _poll(house, 2)
    assert house.raw("timetables_plan").count() == 1


def test_two_processes_ingest_one_feed(spark, house):
    """Two warehouses on one root, calls of the same seconds: every payload is kept once, under ids of its own."""
    errors = []

    def run(who):
        mine = Warehouse(spark, house.root)
        try:
            for i in range(2):
                payloads = spark.createDataFrame([(DOC.format(f"{who}{i}"),), (DOC.format(f"{who}{i}x"),)], "payload STRING")
                mine.ingest("timetables_plan", payloads, T0 + dt.timedelta(seconds=i))
        except Exception as exc:  # noqa: BLE001
            errors.append(exc)

    threads = [threading.Thread(target=run, args=(who,)) for who in "ab"]
    [t.start() for t in threads], [t.join() for t in threads]
    assert errors == []
    rows = house.raw("timetables_plan").collect()
    assert sorted(r.raw_id for r in rows) == list(range(8)) and len({r.payload for r in rows}) == 8
    assert len({r.batch_id for r in rows}) == 4 and house.manifest("timetables_plan").count() == 4
    assert _rides(house) == sorted(f"{w}{i}{x}" for w in "ab" for i in range(2) for x in ("", "x"))


def test_purge_and_batch_reads_open_no_other_payload(spark, house):
    for i in range(3):
        _poll(house, i, batch_id=f"b{i}")
    files = house.batch("timetables_plan", "b1").inputFiles()
    assert len(files) == 1 and house.batch("timetables_plan", "b1").first().payload == DOC.format(1)
    stg, psa = layers.staging(spark, work_dir(spark, "stg")), house.kept("timetables_plan")
    assert layers.purge(stg, psa) == [] and layers.promote(stg, psa) == {}
